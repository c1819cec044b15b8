"""VCF text to variants and long genotypes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.sources.lines import placed_lines

FIXED_COLUMNS = 9  # fixed value: columns before the first sample


def header_line(spark: SparkSession, path) -> str:
    """The first ``#CHROM`` line; the search stops at the file split that has one."""
    head = spark.read.text(path).filter(F.col("value").startswith("#CHROM")).first()
    if head is None:
        raise ValueError("no #CHROM header line")
    return head["value"]


def header_samples(spark: SparkSession, path) -> list[str]:
    return header_line(spark, path).split("\t")[FIXED_COLUMNS:]


def read_vcf_header(spark: SparkSession, path) -> DataFrame:
    """``ord, line``: the ``##`` lines of all files, each once, in the order they first come."""
    first = F.min(F.struct("file", "split", "row")).alias("at")
    lines = placed_lines(spark, path).filter(F.col("value").startswith("##")).groupBy("value").agg(first)
    return lines.select((F.row_number().over(W.orderBy("at")) - 1).alias("ord"), F.col("value").alias("line"))


def record_lines(lines: DataFrame, header: str) -> DataFrame:
    """Record lines only. A file whose header differs raises in the same pass, so checking the
    headers of many files costs no scan of its own."""
    value = F.col("value")
    other = F.raise_error(F.lit("files have different #CHROM lines: read them apart and concatenate"))
    differs = value.startswith("#CHROM") & (value != F.lit(header))
    return lines.filter(F.when(differs, other.cast("boolean")).otherwise(~value.startswith("#") & (value != "")))


def variant_key() -> Column:
    return F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", F.array_join("alts", ","))


def record_columns(value: Column | str = "value") -> list[Column]:
    """The fixed columns of a record line; shared with the streaming reader."""
    line = F.col(value) if isinstance(value, str) else value
    f = F.split(line, "\t")

    def field(i: int) -> Column:  # get() is safe on lines that a filter has yet to drop
        return F.get(f, F.lit(i))

    def text(i: int) -> Column:
        return F.when(field(i) != ".", field(i))

    return [
        field(0).alias("chrom"),
        # guarded, because a pushed-down predicate may see a header line before it is dropped
        F.when(~line.startswith("#"), field(1).cast("long")).alias("pos"),
        text(2).alias("id"),
        field(3).alias("ref"),
        F.when(field(4) == ".", F.array().cast("array<string>")).otherwise(F.split(field(4), ",")).alias("alts"),
        F.try_to_number(field(5), F.lit("999999999.999999")).cast("double").alias("qual"),
        field(6).alias("filter"),
        F.when(field(7) == ".", F.lit(None).cast("map<string,string>"))
        .otherwise(F.str_to_map(field(7), F.lit(";"), F.lit("=")))
        .alias("info"),
    ]


def read_vcf(
    spark: SparkSession,
    path,
    samples: list[str] | None = None,
    first_n: int | None = None,
    min_partitions: int | None = None,
    model: DataFrame | None = None,
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(variants, genotypes)``. ``samples``, a ``model`` (membership table) or ``first_n`` restrict the
    samples at read time; samples of a model that the file lacks are passed over unless ``strict``.

    Every line is a variant of its own: ``variant_id`` ends with the line's place (file, split, row), so
    lines that repeat stay apart. ``format`` lists the keys of a line's calls, ``fields`` has the values of a
    call by key, but for GT. ``ploidy`` is the number of alleles of a call, 1 or 2; calls of more raise when
    the genotypes are read.

    A gzip file is one split; ``min_partitions`` spreads its records before they are parsed. Prefer one
    file per chromosome, written to Parquet once.
    """
    header = header_line(spark, path)
    columns = header.split("\t")
    names = columns[FIXED_COLUMNS:]
    if model is not None:
        wanted = {r["sample"] for r in model.select("sample").distinct().collect()}
        if strict and wanted - set(names):
            raise ValueError(f"samples not in the header: {sorted(wanted - set(names))}")
        samples = [n for n in names if n in wanted and (samples is None or n in set(samples))]
    place = F.concat_ws(
        ".", F.translate(F.hex(F.xxhash64(F.col("_metadata.file_path"))), "ABCDEF", "abcdef"), F.col("_metadata.file_block_start").cast("string"),
        F.monotonically_increasing_id().cast("string"),
    )
    body = record_lines(spark.read.text(path).select("value", place.alias("__place")), header)
    if min_partitions:
        body = body.repartition(min_partitions)
    rows = body.select(*record_columns(), F.split("value", "\t").alias("__f"), "__place")
    rows = rows.withColumn("format", F.split(F.get("__f", F.lit(FIXED_COLUMNS - 1)), ":"))
    wrong = F.raise_error(F.concat(F.lit("wrong number of columns at "), "chrom", F.lit(":"), F.col("pos").cast("string")))
    rows = rows.withColumn(
        "__f", F.when(F.size("__f") == len(columns), F.col("__f")).otherwise(wrong.cast("array<string>"))
    ).withColumn("variant_id", F.concat_ws("@", variant_key(), "__place"))
    v = rows.select("variant_id", "chrom", "pos", "id", "ref", "alts", "qual", "filter", "info", "format")
    calls = F.posexplode(F.slice("__f", FIXED_COLUMNS + 1, len(names) or 1)).alias("sample_ix", "call")
    # once a line: where GT is, and whether the other keys are those behind it
    at = F.array_position("format", F.lit("GT")).cast("int")
    others = F.slice("format", F.lit(2), F.size("format"))
    plain = (at == 1) & ~F.array_contains(others, "GT")
    g = rows.select("variant_id", "chrom", "pos", "format", at.alias("__gt"), plain.alias("__plain"), calls)
    keep = range(len(names))
    if samples is not None:
        unknown = set(samples) - set(names)
        if unknown:
            raise ValueError(f"samples not in the header: {sorted(unknown)}")
        keep = [i for i, n in enumerate(names) if n in set(samples)]
    if first_n is not None:
        keep = list(keep)[:first_n]
    if len(keep) < len(names):
        g = g.filter(F.col("sample_ix").isin(list(keep)))
    # once a call, made in generators
    g = g.select("*", F.explode(F.array(F.split("call", ":"))).alias("__values"))
    gt = F.get("__values", F.col("__gt") - 1)
    alleles = F.explode(F.array(F.struct(gt.alias("gt"), F.split(F.translate(gt, "|", "/"), "/").alias("part")))).alias("__call")
    g = g.select("*", alleles)
    gt, part, values = F.col("__call.gt"), F.col("__call.part"), F.col("__values")
    known = F.least(F.size("format"), F.size(values))
    pairs = F.map_from_arrays(F.slice("format", F.lit(1), known), F.slice(values, F.lit(1), known))
    behind = F.map_from_arrays(F.slice("format", F.lit(2), known - 1), F.slice(values, F.lit(2), known - 1))

    def allele(i: int) -> Column:
        # a text that is no number costs an exception, so missing alleles are not tried
        text = F.try_element_at(part, F.lit(i))
        return F.when(text != ".", text.try_cast("int"))

    many = F.raise_error(F.concat(F.lit("a call of more than two alleles at "), "variant_id"))
    ploidy = F.when(F.size(part) > 2, many.cast("int")).otherwise(F.size(part))
    return v, g.select(
        "variant_id",
        "chrom",
        "pos",
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("sample_ix") + 1).alias("sample"),
        "sample_ix",
        allele(1).alias("a1"),
        allele(2).alias("a2"),
        F.coalesce(gt.contains("|"), F.lit(False)).alias("phased"),
        ploidy.alias("ploidy"),
        F.when(F.col("__plain"), behind).otherwise(F.map_filter(pairs, lambda k, _: k != "GT")).alias("fields"),
    )


def list_samples(spark: SparkSession, path) -> DataFrame:
    names = header_samples(spark, path)
    return spark.createDataFrame(list(enumerate(names)), "sample_ix int, sample string").select("sample", "sample_ix")
