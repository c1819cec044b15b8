"""Recombination-free blocks by the four-gamete criterion.

Sites are bit sets of haplotypes per allele (``packed``). The first incompatible partner of each
site is searched in growing rank windows; a site leaves the search as soon as a conflict nested in
its window is known, because no block can reach past it. The work per site is therefore bounded by
the length of its block, without any cap on partners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespan.functions import predicates as P
from allelespan.operators.counts import SITE, n_samples
from allelespan.operators.ordered import running
from allelespan.operators.packed import both, pack_haplotypes
from allelespan.operators.rangejoin import sites_with_regions
from allelespan.operators.sampling import draw
from allelespan.session import discard, materialise

FIRST_WINDOW = 64


def polymorphic_sites(
    v: DataFrame,
    g: DataFrame,
    iv: DataFrame,
    samples: DataFrame,
    include_missing: bool = False,
    only_two: bool = False,
) -> DataFrame:
    """Polymorphic single-base sites per region, with ``informative`` and, for informative ones,
    their ``rank`` in the region and the ``carriers`` of each allele.

    Packing reads the genotypes once and writes the bit sets to the shared folder; placing and
    ranking then work on the narrow site columns.

    A site is informative when at least two bases have two copies or more.
    """
    plain = v.filter(P.all_alleles_plain()).select(*SITE)
    packed = plain.join(pack_haplotypes(g, samples), "variant_id")
    if not include_missing:
        packed = packed.filter(F.col("n_haps") == 2 * n_samples(samples))
    n_bases = F.size("carriers")
    twice = F.size(F.filter("carriers", lambda c: c["n"] > 1))
    sites = packed.filter(n_bases > 1).withColumn("informative", twice > 1)
    if only_two:
        sites = sites.filter(n_bases == 2)
    sites = materialise(sites.select(*SITE, "informative", "n_haps", "carriers"), "packed")
    narrow = sites.select(*SITE, "informative")
    hit = sites_with_regions(narrow, iv.select("iv_id", "chrom", "start", "end")).select(
        F.col("r_iv_id").alias("iv_id"), *SITE, "informative"
    )
    ranked = running(
        hit, ["iv_id"], "pos", {"rank": ("sum_before", F.col("informative").cast("long"))}, ["variant_id"]
    )
    ranked = ranked.withColumn("rank", F.when(F.col("informative"), F.col("rank")))
    return ranked.join(sites.select("variant_id", "n_haps", "carriers"), "variant_id")


def informative_only(sites: DataFrame) -> DataFrame:
    return sites.filter("informative").select("iv_id", *SITE, "rank", "carriers")


def incompatible(x: str = "carriers_i", y: str = "carriers_j") -> Column:
    """Four or more allele pairs, both alleles carried more than once, whose shared carriers are a
    proper, non-empty part of either."""

    def crossing(a):
        def with_partner(s, b):
            n = both(a["bits"], b["bits"])
            ok = (a["n"] > 1) & (b["n"] > 1) & (n > 0) & (n < a["n"]) & (n < b["n"])
            return s + ok.cast("int")

        return F.aggregate(F.col(y), F.lit(0), with_partner)

    return F.aggregate(F.transform(F.col(x), crossing), F.lit(0), lambda s, n: s + n) >= 4


def _rank_pairs(left: DataFrame, right: DataFrame, low: int, high: int) -> DataFrame:
    """Pairs of one region with ``low < rank_j - rank_i <= high``."""
    width = high - low
    bins = F.sequence(
        F.floor((F.col("rank") + low + 1) / width).cast("long"), F.floor((F.col("rank") + high) / width).cast("long")
    )
    x = left.select(
        "iv_id", F.col("rank").alias("rank_i"), F.col("variant_id").alias("variant_id_i"),
        F.col("pos").alias("pos_i"), F.col("chrom").alias("chrom_i"),
        F.col("carriers").alias("carriers_i"), F.explode(bins).alias("__bin"),
    )
    y = right.select(
        "iv_id", F.col("rank").alias("rank_j"), F.col("variant_id").alias("variant_id_j"),
        F.col("pos").alias("pos_j"), F.col("chrom").alias("chrom_j"), F.col("carriers").alias("carriers_j"),
        F.floor(F.col("rank") / width).cast("long").alias("__bin"),
    )
    gap = F.col("rank_j") - F.col("rank_i")
    return x.join(y, ["iv_id", "__bin"]).filter((gap > low) & (gap <= high))


def four_gamete_test(sites: DataFrame, window: int) -> DataFrame:
    """Incompatible pairs of informative sites at most ``window`` ranks apart, per region."""
    s = informative_only(sites)
    pairs = _rank_pairs(s, s, 0, window)
    return pairs.filter((F.col("chrom_i") != F.col("chrom_j")) | incompatible()).select(
        "iv_id", "variant_id_i", "pos_i", "variant_id_j", "pos_j"
    )


def _at_or_after(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Smallest ``value`` on this row or any later one of the region."""
    rev = df.withColumn("__neg", -F.col("rank")).withColumn("__val", -value)
    out = running(rev, ["iv_id"], "__neg", {"__later": ("max_before", "__val")})
    return out.withColumn(name, -F.greatest("__later", "__val")).drop("__neg", "__val", "__later")


def first_incompatible(sites: DataFrame) -> DataFrame:
    """``iv_id, variant_id_i, pos_i, variant_id_j, pos_j``: for every informative site the first later one of
    its region that is incompatible, however far away; sites without one are left out."""
    state = first_conflicts(sites, every=True).filter(F.col("conflict").isNotNull())
    at = informative_only(sites)
    named = {s: at.select("iv_id", F.col("rank").alias(r), *[F.col(c).alias(f"{c}_{s}") for c in ("variant_id", "pos")]) for s, r in (("i", "rank"), ("j", "conflict"))}
    out = state.select("iv_id", "rank", "conflict").join(named["i"], ["iv_id", "rank"]).join(named["j"], ["iv_id", "conflict"])
    return out.select("iv_id", "variant_id_i", "pos_i", "variant_id_j", "pos_j")


def first_conflicts(sites: DataFrame, first_window: int = FIRST_WINDOW, every: bool = False) -> DataFrame:
    """``iv_id, rank, pos, conflict, reach``: rank of the first incompatible later site where a block
    may end at it (null if none matters), and ``reach``, the smallest conflict at or after the rank.
    With ``every``, ``conflict`` is given for all sites that have one.

    Runs one job per window size (64, 128, ... ranks) until every site is settled; regions of up to
    65 informative sites need one round. Tables of earlier rounds are deleted.
    """
    s = materialise(informative_only(sites), "informative")
    low, high = 0, first_window
    todo, found, state = s, None, None
    longest = s.agg(F.max("rank")).first()[0]
    ends = s.groupBy("iv_id").agg(F.max("rank").alias("final"))
    while True:
        hits = (
            _rank_pairs(todo, s, low, high)
            .filter((F.col("chrom_i") != F.col("chrom_j")) | incompatible())
            .groupBy("iv_id", F.col("rank_i").alias("rank"))
            .agg(F.min("rank_j").alias("conflict"))
        )
        known = hits if found is None else found.unionByName(hits)
        ranked = s.select("iv_id", "rank", "pos").join(known, ["iv_id", "rank"], "left")
        before, state = state, materialise(_at_or_after(ranked, F.col("conflict"), "reach"), "conflicts")
        discard(*[x for x in (before, todo) if x is not None and x is not s])
        found = state.filter(F.col("conflict").isNotNull()).select("iv_id", "rank", "conflict")
        if longest is None or longest <= high:
            return state
        # settled: own conflict known, or one nested in the searched window
        nested = F.lit(False) if every else F.coalesce(F.col("reach") <= F.col("rank") + high, F.lit(False))
        unsettled = state.filter(F.col("conflict").isNull() & ~nested).join(ends, "iv_id")
        more = unsettled.filter(F.col("rank") + high < F.col("final")).select("iv_id", "rank")
        todo = s.join(more, ["iv_id", "rank"], "left_semi")
        todo = materialise(todo, "open")
        if todo.isEmpty():
            return state
        low, high = high, 2 * high


def compatible_intervals(
    sites: DataFrame, overlap_inf: bool = False, overlap_noninf: bool = False, conflicts: DataFrame | None = None
) -> DataFrame:
    """Longest runs of informative sites without a conflict: ``iv_id, start, end, n_informative``.

    Positions are one-based and inclusive. ``overlap_inf`` lets neighbouring blocks share sites;
    ``overlap_noninf`` stretches a block to the informative sites on either side of it.
    """
    state = first_conflicts(sites) if conflicts is None else conflicts
    last = state.groupBy("iv_id").agg(F.max("rank").alias("final"))
    ends = state.join(last, "iv_id").withColumn("last", F.coalesce(F.col("reach") - 1, F.col("final")))
    ends = running(ends, ["iv_id"], "rank", {"before": ("prev", "last")})
    kept = ends.filter(F.col("before").isNull() | (F.col("last") > F.col("before")))
    kept = kept.select("iv_id", F.col("rank").alias("first"), "last", "final")
    if not overlap_inf:
        kept = running(kept, ["iv_id"], "first", {"before": ("prev", "last")})
        kept = kept.withColumn("first", F.coalesce(F.col("before") + 1, F.col("first"))).drop("before")
    kept = kept.withColumn("n_informative", F.col("last") - F.col("first") + 1)
    at = state.select("iv_id", "rank", "pos")

    def look(df, rank: Column, name: str) -> DataFrame:
        there = at.select("iv_id", F.col("rank").alias("__r"), F.col("pos").alias(name))
        return df.withColumn("__r", rank).join(there, ["iv_id", "__r"], "left").drop("__r")

    final = F.col("last") == F.col("final")
    # the site that ends the block: its own last one at the end of the region, else the next one
    kept = look(kept, F.when(final, F.col("last")).otherwise(F.col("last") + 1), "p_end")
    if overlap_noninf:
        # the first block starts at its own first site
        opening = F.col("first") == 0
        kept = look(kept, F.when(opening, F.col("first")).otherwise(F.col("first") - 1), "p_start")
        start = F.when(opening, F.col("p_start")).otherwise(F.col("p_start") + 1)
        end = F.when(final, F.col("p_end")).otherwise(F.col("p_end") - 1)
    else:
        kept = look(kept, F.col("first"), "p_start")
        start, end = F.col("p_start"), F.col("p_end") - 1
    return kept.select("iv_id", start.alias("start"), end.alias("end"), "n_informative")


def hk_min_intervals(sites: DataFrame, conflicts: DataFrame | None = None) -> DataFrame:
    """Disjoint minimal conflict intervals of Hudson and Kaplan: ``iv_id, start, end``.

    Minimal: no other conflict lies inside. Then, left to right, the next interval is the first that
    starts at or after the end of the last one taken. That chain is followed by pointer doubling,
    so a region with any number of intervals needs a logarithmic number of joins.
    """
    state = first_conflicts(sites) if conflicts is None else conflicts
    rev = state.withColumn("__neg", -F.col("rank")).withColumn("__val", -F.col("conflict"))
    later = running(rev, ["iv_id"], "__neg", {"__later": ("max_before", "__val")})
    nested = F.col("conflict") >= -F.col("__later")
    minimal = later.withColumn(
        "minimal", F.col("conflict").isNotNull() & ~F.coalesce(nested, F.lit(False))
    ).select("iv_id", "rank", "pos", "conflict", "minimal")
    starts = _at_or_after(minimal, F.when(F.col("minimal"), F.col("rank")), "next_start")
    heads = starts.filter("minimal").select("iv_id", F.col("rank").alias("node"), "conflict")
    jump = heads.join(
        starts.select("iv_id", F.col("rank").alias("conflict"), F.col("next_start").alias("to")),
        ["iv_id", "conflict"],
    ).select("iv_id", "node", "conflict", "to")
    nodes = materialise(jump, "hk")
    taken = materialise(nodes.groupBy("iv_id").agg(F.min("node").alias("node")), "hk")
    hop = nodes.filter(F.col("to").isNotNull()).select("iv_id", "node", "to")
    size = taken.count()
    while True:
        reached = taken.join(hop, ["iv_id", "node"]).select("iv_id", F.col("to").alias("node"))
        last_taken, taken = taken, materialise(taken.unionByName(reached).distinct(), "hk")
        discard(last_taken)
        grown = taken.count()
        if grown == size:
            break
        size = grown
        second = hop.select("iv_id", F.col("node").alias("to"), F.col("to").alias("to2"))
        last_hop, hop = hop, materialise(hop.join(second, ["iv_id", "to"]).select("iv_id", "node", F.col("to2").alias("to")), "hk")
        discard(last_hop)
    at = state.select("iv_id", "rank", "pos")
    picked = nodes.join(taken, ["iv_id", "node"], "left_semi")
    first = at.select("iv_id", F.col("rank").alias("node"), F.col("pos").alias("start"))
    second = at.select("iv_id", F.col("rank").alias("conflict"), (F.col("pos") + 1).alias("end"))
    return (
        picked.join(first, ["iv_id", "node"]).join(second, ["iv_id", "conflict"]).select("iv_id", "start", "end")
    )


def pick_interval(
    blocks: DataFrame, how: str, min_inf: int | None = None, seed: int = 0, draw_col: Column | None = None
) -> DataFrame:
    """One block per region: ``left``, ``right``, ``random``, ``random_base`` (weighted by length) or
    ``most_informative`` (the first of the richest, whatever ``min_inf`` says).

    ``draw_col`` must be a number in [0, 1): per block for ``random``, per region for ``random_base``.
    """
    row = F.struct(*blocks.columns)
    if how == "most_informative":
        best = F.max_by(row, F.struct("n_informative", -F.col("start")))
        return blocks.groupBy("iv_id").agg(best.alias("b")).select("b.*")
    if min_inf is not None:
        blocks = blocks.filter(F.col("n_informative") >= min_inf)
    if how == "left":
        chosen = F.min_by(row, F.struct("start", "end"))
    elif how == "right":
        chosen = F.max_by(row, F.struct("start", "end"))
    elif how == "random":
        u = draw(seed, "iv_id", "start") if draw_col is None else draw_col
        chosen = F.min_by(row, F.struct(u, F.col("start")))
    elif how == "random_base":
        u = draw(seed, "iv_id") if draw_col is None else draw_col
        length = F.col("end") - F.col("start") + 1
        totals = blocks.groupBy("iv_id").agg(F.sum(length).alias("__total"))
        placed = running(blocks, ["iv_id"], "start", {"__before": ("sum_before", length)}, ["end"])
        target = F.floor(u * F.col("__total")) + 1
        return (
            placed.join(totals, "iv_id")
            .filter((F.col("__before") < target) & (target <= F.col("__before") + length))
            .select(*blocks.columns)
        )
    else:
        raise ValueError(how)
    return blocks.groupBy("iv_id").agg(chosen.alias("b")).select("b.*")


def block_records(v: DataFrame, blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """Records of each chosen block (``iv_id, start, end`` one-based inclusive)."""
    chrom = regions.select("iv_id", "chrom")
    half_open = blocks.join(chrom, "iv_id").select(
        "iv_id", "chrom", (F.col("start") - 1).alias("start"), "end"
    )
    return sites_with_regions(v, half_open).withColumnRenamed("r_iv_id", "iv_id").drop(
        "r_chrom", "r_start", "r_end"
    )


def snp_density(v: DataFrame, regions: DataFrame) -> DataFrame:
    """(records - 1) / region size per region with records."""
    hits = sites_with_regions(v.select(*SITE), regions.select("iv_id", "chrom", "start", "end"))
    return (
        hits.groupBy(F.col("r_iv_id").alias("iv_id"), (F.col("r_end") - F.col("r_start")).alias("size"))
        .agg(F.count("*").alias("n_records"))
        .select("iv_id", "n_records", ((F.col("n_records") - 1) / F.col("size")).alias("density"))
    )
