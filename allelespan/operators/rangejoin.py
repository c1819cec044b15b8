"""Interval joins as equi-joins on bins.

``overlap_pairs`` puts every interval on the smallest bin width that is at least its length, so an
interval falls into at most two bins per width however long it is. A pair meets at the wider of
the two widths, in the bin that holds the larger start, hence exactly once. A side is emitted at a
wider level only if the other side has intervals there.

``overlapping`` / ``not_overlapping`` need no pairs: the right side is merged into disjoint
islands; the start of each left interval falls into at most one slab ``[previous island end,
island end)`` and that one island decides the answer. Left rows are never multiplied.

A bin that holds a third of the rows is a skewed sort-merge partition, which adaptive execution
splits (``spark.sql.adaptive.skewJoin.enabled``); ``salts`` adds an explicit split on top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespan.operators.ordered import running

# Bin widths; the last one holds any coordinate.
WIDTHS = (1 << 12, 1 << 17, 1 << 22, 1 << 27, 1 << 62)
SLAB_BIN = 1 << 16


def _level(start: Column, end: Column) -> Column:
    length = end - start
    out = F.lit(len(WIDTHS) - 1)
    for i in reversed(range(len(WIDTHS) - 1)):
        out = F.when(length <= WIDTHS[i], F.lit(i)).otherwise(out)
    return out


def _width(level: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w).cast("long") for w in WIDTHS]), level + 1)


def _emit(df: DataFrame, side: str, start: str, end: str, other_levels: DataFrame | None) -> DataFrame:
    """One row per (level, bin) at which this side takes part.

    ``other_levels`` None: the other side consists of points, which all sit on the first level.
    """
    own, lev, b = f"__own_{side}", "__level", "__bin"
    out = df.withColumn(own, _level(F.col(start), F.col(end)))
    if other_levels is None:
        out = out.withColumn(lev, F.col(own))
    else:
        levels = F.array(*[F.lit(i) for i in range(len(WIDTHS))])
        out = out.withColumn(lev, F.explode(F.filter(levels, lambda i: i >= F.col(own))))
        # at most len(WIDTHS) rows: a fixed size, so the broadcast is safe
        present = F.broadcast(other_levels.withColumnRenamed("__own", lev).withColumn("__there", F.lit(True)))
        out = out.join(present, lev, "left").filter((F.col(lev) == F.col(own)) | F.col("__there")).drop("__there")
    width = _width(F.col(lev))
    return out.withColumn(
        b,
        F.explode(
            F.sequence(
                F.floor(F.col(start) / width).cast("long"),
                F.floor((F.col(end) - 1) / width).cast("long"),
            )
        ),
    )


def overlap_pairs(
    a: DataFrame,
    b: DataFrame,
    a_cols: tuple[str, str, str] = ("chrom", "start", "end"),
    b_cols: tuple[str, str, str] = ("chrom", "start", "end"),
    prefix: str = "b_",
    salts: int = 1,
    points: bool = False,
) -> DataFrame:
    """Every overlapping pair once: columns of ``a``, then those of ``b`` under ``prefix``.

    Empty intervals match nothing. ``points`` says that every interval of ``a`` is one base long,
    which spares the look at its lengths. ``b`` is read twice, once for its lengths only.
    """
    ac, as_, ae = a_cols
    b = b.select(*[F.col(c).alias(prefix + c) for c in b.columns])
    bc, bs, be = (prefix + c for c in b_cols)
    a, b = a.filter(F.col(ae) > F.col(as_)), b.filter(F.col(be) > F.col(bs))
    a_levels = None if points else a.select(_level(F.col(as_), F.col(ae)).alias("__own")).distinct()
    b_levels = b.select(_level(F.col(bs), F.col(be)).alias("__own")).distinct()
    left = _emit(a, "a", as_, ae, b_levels)
    right = _emit(b, "b", bs, be, a_levels)
    keys = ["__level", "__bin"]
    if salts > 1:
        left = left.withColumn("__salt", F.pmod(F.xxhash64(ac, as_, ae), F.lit(salts)).cast("int"))
        right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys.append("__salt")
    right = right.select(
        *[F.col(k).alias(f"{k}_r") for k in keys], "__own_b", *[F.col(c) for c in b.columns]
    )
    cond = F.col(ac) == F.col(bc)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"{k}_r"))
    meet = F.greatest(F.col(as_), F.col(bs))
    cond = (
        cond
        & ((F.col("__own_a") == F.col("__level")) | (F.col("__own_b") == F.col("__level")))
        & (F.col(as_) < F.col(be))
        & (F.col(bs) < F.col(ae))
        & (F.floor(meet / _width(F.col("__level"))).cast("long") == F.col("__bin"))
    )
    return left.join(right, cond).select(*[F.col(c) for c in a.columns], *[F.col(c) for c in b.columns])


def islands(iv: DataFrame, max_gap: int = 0, strict: bool = False) -> DataFrame:
    """Disjoint union of the intervals: ``chrom, start, end, prev_end``.

    Touching intervals, or those up to ``max_gap`` apart, join; with ``strict`` only true overlaps
    do. ``prev_end`` is the end of the island before, null for the first of a chromosome. Equal
    starts are collapsed before any window, so a block never has more rows than positions.
    """
    starts = iv.groupBy("chrom", "start").agg(F.max("end").alias("end"))
    seen = running(starts, ["chrom"], "start", {"prev_end": ("max_before", "end")})
    gap = F.col("start") >= F.col("prev_end") if strict else F.col("start") > F.col("prev_end") + max_gap
    heads = seen.filter(F.col("prev_end").isNull() | gap)
    # the running maximum seen by the next head is the end of this island
    nxt = running(heads, ["chrom"], "start", {"next_prev": ("next", "prev_end")})
    last = starts.groupBy("chrom").agg(F.max("end").alias("last_end"))
    return nxt.join(last, "chrom").select(
        "chrom", "start", F.coalesce("next_prev", "last_end").alias("end"), "prev_end"
    )


def _slabs(iv: DataFrame) -> DataFrame:
    """Islands with the slab of start points they answer for, split into bins of one width.

    Slabs are disjoint, so there are at most genome length / bin width + number of islands rows.
    """
    first_bin = F.floor(F.coalesce("prev_end", F.lit(0).cast("long")) / F.lit(SLAB_BIN)).cast("long")
    last_bin = F.floor((F.col("end") - 1) / F.lit(SLAB_BIN)).cast("long")
    return islands(iv).select(
        F.col("chrom").alias("s_chrom"),
        F.explode(F.sequence(first_bin, last_bin)).alias("s_bin"),
        F.coalesce("prev_end", F.lit(0).cast("long")).alias("s_from"),
        F.col("start").alias("s_start"),
        F.col("end").alias("s_end"),
    )


def _by_slab(a: DataFrame, b: DataFrame, start: Column, end: Column, how: str) -> DataFrame:
    b = b.select("chrom", "start", "end").filter(F.col("end") > F.col("start"))
    probe = a.withColumn("__from", start).withColumn("__to", end).withColumn(
        "__bin", F.floor(F.col("__from") / F.lit(SLAB_BIN)).cast("long")
    )
    cond = (
        (F.col("chrom") == F.col("s_chrom"))
        & (F.col("__bin") == F.col("s_bin"))
        & (F.col("__from") >= F.col("s_from"))
        & (F.col("__from") < F.col("s_end"))
        & (F.col("s_start") < F.col("__to"))
    )
    return probe.join(_slabs(b), cond, how).drop("__from", "__to", "__bin")


def overlapping(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that overlap any interval of ``b``, each once."""
    return _by_slab(a, b, F.col("start"), F.col("end"), "left_semi")


def not_overlapping(a: DataFrame, b: DataFrame) -> DataFrame:
    return _by_slab(a, b, F.col("start"), F.col("end"), "left_anti")


def sites_inside(v: DataFrame, iv: DataFrame) -> DataFrame:
    """Records whose position lies in any interval: ``start <= pos - 1 < end``."""
    return _by_slab(v, iv, F.col("pos") - 1, F.col("pos"), "left_semi")


def sites_outside(v: DataFrame, iv: DataFrame) -> DataFrame:
    return _by_slab(v, iv, F.col("pos") - 1, F.col("pos"), "left_anti")


def sites_with_regions(v: DataFrame, iv: DataFrame, prefix: str = "r_", salts: int = 1) -> DataFrame:
    """One row per (record, interval that contains it); interval columns under ``prefix``."""
    points = v.withColumn("__p0", F.col("pos") - 1)
    at = ("chrom", "__p0", "pos")
    return overlap_pairs(points, iv, at, prefix=prefix, salts=salts, points=True).drop("__p0")
