"""Interval, size, statistic, list and model readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.functions.genome import from_input_coordinates


def read_bed(
    spark: SparkSession,
    path,
    cols: tuple[int, int, int] = (1, 2, 0),
    one_based: bool = False,
    zero_closed: bool = False,
    chrom: str | None = None,
    keep_line: bool = False,
) -> DataFrame:
    """Intervals ``iv_id, chrom, start, end[, payload]``, zero-based half-open.

    ``cols`` are the positions of start, end and chromosome. Comment lines are skipped, and so is the
    header, the first line if it has no number where the start should be; files read together have the
    header of the first file, by name, or none, so the part files of ``write_bed`` are one document. Any other line
    without three readable fields raises, as do negative coordinates.
    """
    f = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    start_of = F.try_element_at(f, F.lit(cols[0] + 1)).try_cast("long")
    # a scan takes large files first, so the first line is found by its place
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    first = lines.select("value", start_of.alias("s"), place.alias("at")).agg(F.min_by(F.struct("value", "s"), "at").alias("line")).first()["line"]
    if first is not None and first["s"] is None:
        lines = lines.filter(F.col("value") != first["value"])
    raw = lines.select(
        F.monotonically_increasing_id().alias("iv_id"),
        F.try_element_at(f, F.lit(cols[2] + 1)).alias("chrom"),
        start_of.alias("s"),
        F.try_element_at(f, F.lit(cols[1] + 1)).try_cast("long").alias("e"),
        F.array_join(f, "\t").alias("payload"),
    )
    unreadable = F.raise_error(F.concat(F.lit("not an interval: "), "payload")).cast("boolean")
    raw = raw.filter(F.when(F.col("s").isNull() | F.col("e").isNull() | F.col("chrom").isNull(), unreadable).otherwise(F.lit(True)))
    if chrom is not None:
        raw = raw.filter(F.col("chrom") == chrom)
    start, end = from_input_coordinates("s", "e", one_based, zero_closed)
    negative = F.raise_error(F.concat(F.lit("negative coordinate: "), "payload")).cast("boolean")
    out = raw.withColumn("start", start).withColumn("end", end)
    out = out.filter(F.when((F.col("start") < 0) | (F.col("end") < 0), negative).otherwise(F.lit(True)))
    return out.select("iv_id", "chrom", "start", "end", *(["payload"] if keep_line else []))


def parse_region(df: DataFrame, column: str, cols: tuple[int, int, int] = (1, 2, 0)) -> DataFrame:
    """Add ``chrom, start, end`` from ``chrom:start:end`` text."""
    f = F.split(F.col(column), ":")
    return (
        df.withColumn("chrom", F.get(f, F.lit(cols[2])))
        .withColumn("start", F.get(f, F.lit(cols[0])).cast("long"))
        .withColumn("end", F.get(f, F.lit(cols[1])).cast("long"))
    )


def read_chrom_sizes(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, size long")


def read_stat(
    spark: SparkSession, path, window_size: int | None = None, correct: bool = True, schema: str | None = None
) -> DataFrame:
    """Statistic table with a header. A missing ``BIN_END`` is ``BIN_START + window_size``, less one
    unless ``correct`` is off. Without ``schema`` every column but the coordinates is a double."""
    if schema is None:
        names = spark.read.csv(path, sep="\t", header=True).columns
        whole = {"POS", "BIN_START", "BIN_END", "N_VARIANTS", "N_SNPS"}
        schema = ", ".join(
            f"`{n}` {'string' if n == 'CHROM' else 'long' if n in whole else 'double'}" for n in names
        )
    st = spark.read.csv(path, sep="\t", header=True, schema=schema, nanValue="nan", enforceSchema=False)
    missing = [c for c in ("CHROM", "BIN_START") if c not in st.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    if "BIN_END" not in st.columns:
        if window_size is None:
            raise ValueError("BIN_END is missing: give window_size")
        st = st.withColumn("BIN_END", F.col("BIN_START") + (window_size - 1 if correct else window_size))
    return st


def read_id_list(spark: SparkSession, path, column: str = "id") -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias(column)).filter(F.col(column) != "").distinct()


MODEL_SCHEMA = "name string, tree string, pops map<string, struct<inds: array<string>>>"


def read_model(spark: SparkSession, path) -> DataFrame:
    """Model file to membership rows ``model, tree, pop, pop_ix, sample, sample_ix``."""
    raw = spark.read.schema(MODEL_SCHEMA).json(path, multiLine=True)
    pops = raw.select(F.col("name").alias("model"), "tree", F.posexplode("pops").alias("pop_ix", "pop", "members"))
    return pops.select(
        "model", "tree", "pop", "pop_ix", F.posexplode("members.inds").alias("sample_ix", "sample")
    ).select("model", "tree", "pop", "pop_ix", "sample", "sample_ix")
