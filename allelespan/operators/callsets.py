"""Operators on whole callsets, each a pair of variants ``v`` and genotypes ``g``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.functions import predicates as P
from allelespan.functions.genome import natural_key
from allelespan.operators.filters import check_record, filter_variants
from allelespan.operators.rangejoin import sites_with_regions

Callset = tuple[DataFrame, DataFrame]


def list_chroms(v: DataFrame) -> DataFrame:
    return v.select("chrom").distinct()


def list_samples(g: DataFrame) -> DataFrame:
    """Samples with their header position when the callset has one."""
    if "sample_ix" in g.columns:
        return g.groupBy("sample").agg(F.min("sample_ix").alias("sample_ix")).orderBy("sample_ix")
    return g.select("sample").distinct().orderBy("sample")


def sort_variants(v: DataFrame) -> DataFrame:
    return v.orderBy(natural_key("chrom"), "pos", "variant_id")


def _different_samples(a: DataFrame, b: DataFrame) -> DataFrame:
    x, y = a.select("sample").distinct(), b.select("sample").distinct()
    return x.join(y, "sample", "left_anti").unionByName(y.join(x, "sample", "left_anti"))


def concat_callsets(*callsets: Callset) -> Callset:
    """Same samples, different sites. Unequal sample sets raise when the result is computed."""
    v, g = callsets[0]
    for v2, g2 in callsets[1:]:
        odd = _different_samples(g, g2).agg(F.count("*")).scalar()
        bad = F.raise_error(F.lit("callsets hold different samples")).cast("boolean")
        ok = F.when(odd > 0, bad).otherwise(F.lit(True))
        v, g = v.unionByName(v2), g.unionByName(g2).filter(ok)
    return v, g


def _merge_group(mode: str) -> Column:
    """Records at one position with the same group become one record."""
    exact = F.concat_ws(":", "ref", F.array_join("alts", ","))
    groups = {
        "none": exact,
        "snps": F.when(P.is_snp(), F.lit("snp")).otherwise(exact),
        "indels": F.when(P.is_snp(), exact).otherwise(F.lit("indel")),
        "both": F.when(P.is_snp(), F.lit("snp")).otherwise(F.lit("indel")),
        "all": F.lit("any"),
        "id": F.col("id"),
    }
    if mode not in groups:
        raise ValueError(f"merge mode must be one of {sorted(groups)}")
    return groups[mode]


def merge_callsets(x: Callset, y: Callset, mode: str = "both", missing_as_ref: bool = False) -> Callset:
    """Different samples, union of sites.

    ``mode`` says which records at a position may join into one multi-allelic record: ``none``,
    ``snps``, ``indels``, ``both``, ``all`` or by ``id``. The longest reference is kept and shorter
    records' alleles are extended to it; genotype indices follow. ``missing_as_ref`` writes 0/0 for
    the samples of a callset that lacks the site.

    Records of one callset never join each other. Where a callset has several in a group, records that
    both callsets hold are paired first, the others in order of their alleles, and the ids of all but
    the first pair end in their number.
    """
    cols = ["variant_id", "chrom", "pos", "id", "ref", "alts", "filter"]
    both = x[0].select(*cols, F.lit(0).alias("src")).unionByName(y[0].select(*cols, F.lit(1).alias("src")))
    both = both.withColumn("__grp", _merge_group(mode))
    # one exchange by position serves the windows and the grouping
    both = both.repartition("chrom", "pos", "__grp")
    alike = W.partitionBy("chrom", "pos", "__grp", "ref", "alts")
    both = both.withColumn("__shared", F.min("src").over(alike) != F.max("src").over(alike))
    own = W.partitionBy("chrom", "pos", "__grp", "src").orderBy(F.desc("__shared"), "ref", F.array_join("alts", ","), "variant_id")
    both = both.withColumn("__nth", F.row_number().over(own))
    # one record of each callset: small groups
    entry = F.struct("src", F.col("variant_id").cast("string").alias("old"), "id", "ref", "alts", "filter")
    sites = both.groupBy("chrom", "pos", "__grp", "__nth").agg(F.array_sort(F.collect_list(entry)).alias("recs"))
    longest = F.aggregate(
        "recs", F.lit(""), lambda s, r: F.when(F.length(r["ref"]) > F.length(s), r["ref"]).otherwise(s)
    )
    sites = sites.withColumn("ref", longest)

    def extended(r):
        tail = F.substring(F.col("ref"), F.length(r["ref"]) + 1, F.length("ref"))
        return F.transform(r["alts"], lambda a: F.concat(a, tail))

    sites = sites.withColumn("alts", F.array_distinct(F.flatten(F.transform("recs", extended))))
    new_id = F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", F.array_join("alts", ","), F.when(F.col("__nth") > 1, F.col("__nth").cast("string")))
    sites = sites.withColumn("variant_id", new_id).withColumn(
        "id", F.element_at("recs", 1)["id"]
    ).withColumn("filter", F.element_at("recs", 1)["filter"])
    v = sites.select(*cols)

    def mapping(r):
        index = F.transform(extended(r), lambda a: F.array_position(F.col("alts"), a).cast("int"))
        return F.struct(r["src"].alias("src"), r["old"].alias("old"), F.concat(F.array(F.lit(0)), index).alias("ix"))

    maps = sites.select("variant_id", "chrom", "pos", F.explode(F.transform("recs", mapping)).alias("m"))
    maps = maps.select("variant_id", "chrom", "pos", "m.*")
    g = x[1].withColumn("src", F.lit(0)).unionByName(y[1].withColumn("src", F.lit(1)), allowMissingColumns=True)
    g = g.select("src", F.col("variant_id").cast("string").alias("old"), "sample", "a1", "a2")
    g = g.join(maps, ["src", "old"]).select(
        "variant_id", "chrom", "pos", "sample",
        *[F.try_element_at("ix", F.col(a) + 1).alias(a) for a in ("a1", "a2")],
    )
    if missing_as_ref:
        has = sites.select("variant_id", "chrom", "pos", F.transform("recs", lambda r: r["src"]).alias("has"))
        for src, (_, gg) in enumerate((x, y)):
            names = gg.select("sample").distinct().agg(F.collect_list("sample")).scalar()
            lacking = has.filter(~F.array_contains("has", src)).select(
                "variant_id", "chrom", "pos", F.explode(names).alias("sample")
            )
            g = g.unionByName(lacking.withColumn("a1", F.lit(0)).withColumn("a2", F.lit(0)))
    return v, g


def extract_regions(
    v: DataFrame,
    iv: DataFrame,
    filters: dict | None = None,
    g: DataFrame | None = None,
    gates: dict | None = None,
    allow_empty: bool = True,
) -> DataFrame:
    """Records of every region, labelled by ``iv_id``: one job for all regions.

    ``filters`` are options of ``filter_variants`` and ``gates`` of ``check_record``; both run before
    the split. Without ``allow_empty`` a region without records raises. Write the result with
    ``partitionBy("iv_id")`` for one folder per locus.
    """
    if filters:
        v = filter_variants(v, g, **filters)
    if gates:
        v = check_record(v, g, **gates)
    regions = iv.select("iv_id", "chrom", "start", "end")
    hits = sites_with_regions(v, regions).withColumnRenamed("r_iv_id", "iv_id")
    hits = hits.select("iv_id", *v.columns)
    if allow_empty:
        return hits
    n_empty = empty_regions(hits, regions).agg(F.count("*")).scalar()
    bad = F.raise_error(F.lit("regions without records")).cast("boolean")
    return hits.filter(F.when(n_empty > 0, bad).otherwise(F.lit(True)))


def empty_regions(hits: DataFrame, iv: DataFrame) -> DataFrame:
    return iv.join(hits.select("iv_id").distinct(), "iv_id", "left_anti")


BUCKETS = 64


def bins_as_regions(st: DataFrame) -> DataFrame:
    """Bins of a statistic table (``CHROM, BIN_START, BIN_END``, one-based) as regions."""
    start = (F.col("BIN_START") - 1).cast("long")
    name = F.concat_ws(":", "CHROM", F.col("BIN_START").cast("string"), F.col("BIN_END").cast("string"))
    return st.select(name.alias("iv_id"), F.col("CHROM").alias("chrom"), start.alias("start"), F.col("BIN_END").cast("long").alias("end")).distinct()


def _bucket(region: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(region.cast("string")), F.lit(buckets)).cast("int")


def write_regions(hits: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "error") -> None:
    """Records labelled by region, in ``buckets`` folders by a hash of ``iv_id`` and in order there.

    There are at most buckets x tasks files, however many regions; a large region is dealt out by position.
    """
    rows = hits.withColumn("bucket", _bucket(F.col("iv_id"), buckets))
    rows = rows.repartition("bucket", F.floor(F.col("pos") / (1 << 16))).sortWithinPartitions("bucket", "iv_id", "pos")
    rows.write.mode(mode).partitionBy("bucket").parquet(path)


def read_regions(spark, path: str, regions: list, buckets: int = BUCKETS) -> DataFrame:
    """The records of some regions of ``write_regions``; only their folders are read."""
    rows, wanted = spark.read.parquet(path), F.lit(False)
    for r in regions:
        wanted = wanted | ((F.col("bucket") == _bucket(F.lit(r), buckets)) & (F.col("iv_id") == r))
    return rows.filter(wanted).drop("bucket")
