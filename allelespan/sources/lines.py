"""Text lines with their place in the file, without a driver pass or one ordered task.

A line's place is (file, split start, order within the split): split starts come from file metadata
and rows of a split keep their order. Windows run per split; only the table of splits is ordered
across a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PLACE = ["file", "split", "row"]


def placed_lines(spark: SparkSession, path) -> DataFrame:
    """``file, split, row, value`` for every line."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


#: Offsets of splits, one row each, are broadcast up to so many rows.
SPLITS = 100_000


def numbered_lines(spark: SparkSession, path, keep=None) -> DataFrame:
    """``file, line_no, value`` counting from zero over lines for which ``keep`` holds.

    Row ids count up within a split, so a line's number is its id less a constant of its split. Only the
    table of these constants is shuffled and ordered; the lines stay where they are read.
    """
    text = spark.read.text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    )
    if keep is not None:
        lines = lines.filter(keep)
    lines = lines.withColumn("__id", F.monotonically_increasing_id())
    splits = lines.groupBy("file", "split").agg(F.count("*").alias("n"), F.min("__id").alias("first"))
    earlier = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    offsets = splits.select("file", "split", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("__off"))
    # a file has at most as many splits as the scan has tasks, plus one for each further file
    if len(text.inputFiles()) + text._jdf.rdd().getNumPartitions() <= SPLITS:
        offsets = F.broadcast(offsets)
    return lines.join(offsets, ["file", "split"]).select("file", (F.col("__id") + F.col("__off")).alias("line_no"), "value")
