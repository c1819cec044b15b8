"""Interval algebra on ``iv(chrom, start, end, ...)``, zero-based half-open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.functions.genome import natural_key, strip_chr
from allelespan.operators.ordered import running
from allelespan.operators.rangejoin import islands, not_overlapping, overlap_pairs, overlapping

TILES = 1 << 16


def bed_intersect(a: DataFrame, b: DataFrame, pieces: bool = False) -> DataFrame:
    """Features of ``a`` that overlap ``b``, or with ``pieces`` every overlap piece."""
    if not pieces:
        return overlapping(a, b)
    pairs = overlap_pairs(a, b.select("chrom", "start", "end"))
    return (
        pairs.withColumn("start", F.greatest("start", "b_start"))
        .withColumn("end", F.least("end", "b_end"))
        .drop("b_chrom", "b_start", "b_end")
    )


def _between(b: DataFrame) -> DataFrame:
    """What lies between the islands of ``b``, and before the first one of each chromosome."""
    start = F.coalesce("prev_end", F.lit(0).cast("long"))
    gaps = islands(b).select("chrom", start.alias("start"), F.col("start").alias("end"))
    return gaps.filter(F.col("start") < F.col("end"))


def _behind(a: DataFrame, b: DataFrame) -> DataFrame:
    """The parts of ``a`` behind the last end of ``b`` on their chromosome: the other side has one row per
    chromosome, so this needs no bins."""
    last = b.groupBy(F.col("chrom").alias("__chrom")).agg(F.max("end").alias("__last"))
    out = a.filter("chrom is not null").join(last, F.col("chrom") == F.col("__chrom"), "left")
    out = out.withColumn("__last", F.coalesce("__last", F.lit(0).cast("long"))).filter(F.col("end") > F.col("__last"))
    return out.withColumn("start", F.greatest("start", "__last")).select(*a.columns)


def bed_subtract(
    a: DataFrame,
    b: DataFrame,
    entire: bool = False,
    min_a: float | None = None,
    min_b: float | None = None,
    reciprocal: float | None = None,
    either: bool = False,
    key: str = "iv_id",
) -> DataFrame:
    """Cut ``b`` out of ``a``; ``entire`` drops a feature on any overlap.

    ``min_a`` / ``min_b``: an overlap counts only if it covers that fraction of the ``a`` / ``b``
    feature, both unless ``either``; ``reciprocal`` sets both to one value. With thresholds ``key``
    must identify the rows of ``a``.
    """
    b = b.select("chrom", "start", "end").filter(F.col("end") > F.col("start"))
    if reciprocal is not None:
        min_a = min_b = reciprocal
    if min_a is None and min_b is None:
        if entire:
            return not_overlapping(a, b)
        between = (
            overlap_pairs(a, _between(b))
            .withColumn("start", F.greatest("start", "b_start"))
            .withColumn("end", F.least("end", "b_end"))
            .select(*a.columns)
        )
        return between.unionByName(_behind(a, b))

    shared = F.least("end", "b_end") - F.greatest("start", "b_start")
    tests = []
    if min_a is not None:
        tests.append(shared >= F.lit(float(min_a)) * (F.col("end") - F.col("start")))
    if min_b is not None:
        tests.append(shared >= F.lit(float(min_b)) * (F.col("b_end") - F.col("b_start")))
    wanted = tests[0]
    for test in tests[1:]:
        wanted = (wanted | test) if either else (wanted & test)
    hits = overlap_pairs(a, b).filter(wanted)
    untouched = a.join(hits.select(key).distinct(), key, "left_anti").select(*a.columns)
    if entire:
        return untouched
    # cut the counted overlaps out of each feature: running end of the cuts gives the left edges
    cuts = hits.groupBy(*a.columns, F.greatest("start", "b_start").alias("c_start")).agg(
        F.max(F.least("end", "b_end")).alias("c_end")
    )
    w = W.partitionBy(key).orderBy("c_start")
    done = F.max("c_end").over(w.rowsBetween(W.unboundedPreceding, -1))
    left = cuts.select(
        "*", F.coalesce(done, F.col("start")).alias("p_start"), F.col("c_start").alias("p_end")
    ).select(*a.columns, "p_start", "p_end")
    right = cuts.groupBy(*a.columns).agg(F.max("c_end").alias("p_start")).withColumn("p_end", F.col("end"))
    parts = left.unionByName(right).filter(F.col("p_start") < F.col("p_end"))
    return (
        parts.withColumn("start", F.col("p_start"))
        .withColumn("end", F.col("p_end"))
        .select(*a.columns)
        .unionByName(untouched)
    )


def subtract_regions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Drop every statistic region that overlaps a filter region."""
    return not_overlapping(a, b)


def bed_merge(iv: DataFrame, *more: DataFrame, max_gap: int = 0) -> DataFrame:
    """Union of overlapping and touching features of all inputs."""
    return islands(bed_union(iv, *more), max_gap).select("chrom", "start", "end")


def bed_union(iv: DataFrame, *more: DataFrame) -> DataFrame:
    out = iv.select("chrom", "start", "end")
    for other in more:
        out = out.unionByName(other.select("chrom", "start", "end"))
    return out


def fix_overlap(iv: DataFrame) -> DataFrame:
    """Merge strict overlaps only; touching regions stay apart."""
    return islands(iv, strict=True).select("chrom", "start", "end")


def has_overlap(iv: DataFrame) -> DataFrame:
    """One row, ``has_overlap``: does any region overlap another?"""
    starts = iv.groupBy("chrom", "start").agg(F.max("end").alias("end"), F.count("*").alias("n"))
    seen = running(starts, ["chrom"], "start", {"prev_end": ("max_before", "end")})
    clash = (F.col("prev_end") > F.col("start")) | ((F.col("n") > 1) & (F.col("end") > F.col("start")))
    return seen.agg(F.coalesce(F.bool_or(clash), F.lit(False)).alias("has_overlap"))


def bed_complement(iv: DataFrame, sizes: DataFrame) -> DataFrame:
    """Gaps up to each chromosome's size; chromosomes without features come out whole."""
    between = _between(iv).join(sizes.select("chrom", "size"), "chrom")
    between = between.select("chrom", "start", F.least("end", "size").alias("end")).filter(F.col("start") < F.col("end"))
    whole = sizes.select("chrom", F.lit(0).cast("long").alias("start"), F.col("size").alias("end"))
    return between.unionByName(_behind(whole, iv))


def gaps_between(iv: DataFrame, pad: int = 0, first: bool = True) -> DataFrame:
    """Spaces between consecutive regions, shrunk by ``pad``; nothing after the last region.

    ``first`` also gives the space before the very first region of the natural order.
    """
    # among equal starts only the longest region can be followed by a gap
    starts = iv.groupBy("chrom", "start").agg(F.max("end").alias("end"))
    ordered = running(starts, ["chrom"], "start", {"before": ("prev", "end")})
    gaps = ordered.filter(F.col("before").isNotNull()).select(
        "chrom", (F.col("before") + pad).alias("start"), (F.col("start") - pad).alias("end")
    )
    if first:
        head = iv.agg(
            F.min(F.struct(natural_key("chrom").alias("k"), "start", "chrom")).alias("f")
        ).select(
            F.col("f.chrom").alias("chrom"),
            F.lit(0).cast("long").alias("start"),
            (F.col("f.start") - pad).alias("end"),
        )
        gaps = gaps.unionByName(head)
    return gaps.filter(F.col("start") < F.col("end"))


def bed_extend(iv: DataFrame, sizes: DataFrame, flanks: int = 0, up: int = 0, down: int = 0) -> DataFrame:
    """Grow features on either side, clamped to ``[0, size]``; strand is ignored."""
    return (
        iv.join(sizes, "chrom")
        .withColumn("start", F.greatest(F.lit(0).cast("long"), F.col("start") - (flanks + up)))
        .withColumn("end", F.least(F.col("size"), F.col("end") + (flanks + down)))
        .drop("size")
    )


def expand_regions(iv: DataFrame, n: int) -> DataFrame:
    return iv.withColumn("start", F.greatest(F.lit(0).cast("long"), F.col("start") - n)).withColumn(
        "end", F.col("end") + n
    )


def steps(df: DataFrame, lo: Column, hi: Column, step: int, name: str) -> DataFrame:
    """A row of ``df`` for each of ``lo, lo + step, ...`` below ``hi``.

    In two levels: blocks of ``TILES`` steps are rows that are dealt out, steps are made inside them, so
    neither an array nor a task grows with the length of a chromosome.
    """
    n = F.ceil((hi - lo) / F.lit(step)).cast("long")
    none = F.array().cast("array<bigint>")
    blocks = F.when(n > 0, F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / TILES).cast("long"))).otherwise(none)
    dealt = df.select("*", lo.alias("__lo"), n.alias("__n"), F.explode(blocks).alias("__block")).repartition(*df.columns, "__block")
    first = F.col("__block") * TILES
    inside = F.sequence(first, F.least(F.col("__n"), first + TILES) - 1)
    at = F.col("__lo") + F.col("__step") * step
    return dealt.withColumn("__step", F.explode(inside)).withColumn(name, at).drop("__lo", "__n", "__block", "__step")


def make_windows(sizes: DataFrame, size: int, step: int | None = None) -> DataFrame:
    """Tiles of ``size`` every ``step`` bases, the last ones clipped at the chromosome end."""
    tiles = steps(sizes.select("chrom", "size"), F.lit(0).cast("long"), F.col("size"), step or size, "start")
    return tiles.select("chrom", "start", F.least(F.col("start") + size, F.col("size")).alias("end"))


def sort_intervals(iv: DataFrame, method: str = "natural", order: list[str] | None = None) -> DataFrame:
    """Order by chromosome (natural, string or a given list), then start, then end."""
    if method == "natural":
        return iv.orderBy(natural_key("chrom"), "start", "end")
    if method == "string":
        return iv.orderBy(strip_chr("chrom"), "start", "end")
    if method == "list":
        rank = F.array_position(F.array(*[F.lit(c) for c in order or []]), F.col("chrom"))
        known = F.when(rank == 0, F.raise_error(F.concat(F.lit("chromosome not in sort order: "), "chrom")))
        return iv.orderBy(known.otherwise(rank), "start", "end")
    raise ValueError(method)


def bed_sort(iv: DataFrame) -> DataFrame:
    """Chromosome as text, then start."""
    return iv.orderBy("chrom", "start")


def min_length(iv: DataFrame, n: int) -> DataFrame:
    return iv.filter(F.col("end") - F.col("start") >= n)


def classify_record(v: DataFrame, region: tuple[str, int, int]) -> DataFrame:
    """Add ``placement``: the record lies ``before``, ``in`` or ``after`` the region.

    Chromosomes compare by natural order and a region on an earlier chromosome puts the record
    ``after`` it.
    """
    chrom, start, end = region
    here, there = natural_key("chrom"), natural_key(F.lit(chrom))
    p0 = F.col("pos") - 1
    return v.withColumn(
        "placement",
        F.when(here > there, "after")
        .when(here < there, "before")
        .when(p0 < start, "before")
        .when(p0 >= end, "after")
        .otherwise("in"),
    )


def nonmissing_chunks(
    sites: DataFrame, size: int = 1000, missing_count: int = 0, extend: bool = False
) -> DataFrame:
    """Maximal runs of sites with at most ``missing_count`` missing samples.

    ``sites`` holds ``chrom, pos, n_missing``. A run is reported when it is longer than ``size``;
    ``extend`` moves its ends half-way to the neighbouring bad sites. One-based inclusive bounds
    ``first_pos, last_pos``.
    """
    bad = F.col("n_missing") > missing_count
    marked = sites.select("chrom", "pos", bad.alias("bad"), F.when(bad, F.col("pos")).alias("bad_pos"))
    runs = running(marked, ["chrom"], "pos", {"run": ("max_before", "bad_pos")}, tie=["bad"])
    spans = runs.groupBy("chrom", "run").agg(
        F.min(F.when(~F.col("bad"), F.col("pos"))).alias("first_pos"),
        F.max(F.when(~F.col("bad"), F.col("pos"))).alias("last_pos"),
        F.max("bad_pos").alias("next_bad"),
    )
    spans = spans.filter(F.col("first_pos").isNotNull())
    if extend:
        first = F.coalesce(F.floor((F.col("run") + F.col("first_pos") + 1) / 2), F.col("first_pos"))
        last = F.coalesce(F.floor((F.col("last_pos") + F.col("next_bad")) / 2), F.col("last_pos"))
        spans = spans.withColumn("first_pos", first.cast("long")).withColumn("last_pos", last.cast("long"))
    return spans.filter(F.col("last_pos") - F.col("first_pos") > size).select(
        "chrom", "first_pos", "last_pos"
    )
