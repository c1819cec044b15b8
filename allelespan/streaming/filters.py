"""Structured Streaming over arriving VCF files: stateless per-record filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from allelespan.sources.vcf import record_columns, variant_key


def stream_variants(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Records of every VCF text file that appears in ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(folder).filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    return lines.select(*record_columns()).withColumn("variant_id", variant_key())


def stream_filter_variants(
    spark: SparkSession, folder: str, out: str, checkpoint: str, tests: list[Column], once: bool = False
) -> StreamingQuery:
    """Append the records that pass every test to a Parquet folder.

    The tests are the columns of ``functions.predicates``. The file source and sink give exactly-once
    output through the checkpoint; nothing is kept between records, so no watermark is needed.
    """
    kept = stream_variants(spark, folder)
    for test in tests:
        kept = kept.filter(test)
    writer = kept.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", out).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
