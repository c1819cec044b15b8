"""Genotypes as one row per site with an array of calls, one per sample of a cohort.

A VCF line, a Parquet table of sites or a packed call set has this form already; what is counted or expected
at a site is then found inside its row, without a shuffle. ``site_counts``, ``allele_counts`` and
``with_population`` take it in the place of long genotypes, and so do the statistics built on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SITE = ["variant_id", "chrom", "pos"]


def once(df: DataFrame, keep: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """``keep`` and the new ``columns``, each of which is evaluated once per row: what is made inside a
    generator is not written out again wherever a later column or filter uses it."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def times(array: str, value: int) -> Column:
    """How often ``value`` is in an array."""
    return (F.size(array) - F.size(F.array_remove(array, value))).cast("long")


@dataclass(frozen=True)
class SiteRows:
    """``rows``: ``variant_id, chrom, pos, calls array<struct<a1, a2>>`` (perhaps ``phased, ploidy``) and any
    grouping columns; a null call is an absent one. ``who``: ``sample, sample_ix``, the place of its call,
    or where ``rows`` has ``members`` of the call whose member it is."""

    rows: DataFrame
    who: DataFrame

    def of_sites(self, sites: DataFrame) -> SiteRows:
        """The sites whose ``variant_id`` is listed."""
        return SiteRows(self.rows.join(sites.select("variant_id"), "variant_id", "left_semi"), self.who)

    def of_samples(self, samples: DataFrame) -> SiteRows:
        """The calls of the listed samples, in the order of the cohort."""
        kept = self.who.join(samples.select("sample").distinct(), "sample", "left_semi")
        places = kept.agg(F.array_sort(F.collect_list("sample_ix"))).scalar()
        members = F.transform("__kept", lambda i: F.get("members", i)) if "members" in self.rows.columns else F.col("__kept")
        rows = self.rows.withColumn("__kept", places)
        columns = {"members": members, "calls": F.transform("__kept", lambda i: F.get("calls", i))}
        return SiteRows(once(rows, [c for c in self.rows.columns if c not in columns], columns), self.who)

    def by_population(self, m: DataFrame) -> SiteRows:
        """One row per site and population with the calls of its samples, and ``pop, pop_ix, members``."""
        placed = m.select("sample", "pop", "pop_ix").distinct().join(self.who, "sample")
        pops = placed.groupBy("pop_ix", "pop").agg(F.array_sort(F.collect_list("sample_ix")).alias("members"))
        pops = pops.agg(F.array_sort(F.collect_list(F.struct("pop_ix", "pop", "members")))).scalar()
        rows = self.rows.drop("pop", "pop_ix", "members").withColumn("__pops", pops)
        own = lambda p: F.transform(p["members"], lambda i: F.get("calls", i)).alias("calls")
        each = F.transform("__pops", lambda p: F.struct(p["pop"].alias("pop"), p["pop_ix"].alias("pop_ix"), p["members"].alias("members"), own(p)))
        return SiteRows(rows.select(*[c for c in rows.columns if c not in ("__pops", "calls")], F.inline(each)), self.who)

    def long(self) -> DataFrame:
        """A row per call that is not absent."""
        rows = self.rows.select("*", F.posexplode("calls").alias("__at", "__call")).filter("__call IS NOT NULL")
        place = F.get("members", F.col("__at")) if "members" in rows.columns else F.col("__at")
        rows = rows.withColumn("sample_ix", place).select("*", "__call.*").drop("calls", "members", "__at", "__call")
        return rows.join(self.who.select("sample", "sample_ix"), "sample_ix")

    def counts(self, by: Sequence[str] = (), only: Sequence[str] | None = None) -> DataFrame:
        """The columns of ``site_counts``, or ``only`` some, made row by row."""
        found = self._counts()
        held = self.rows.filter(F.exists("calls", lambda c: c.isNotNull()))
        if only is None or {*only} & {"n_full", "n_het", "n_hom_ref", "n_hom_alt", "n_missing_samples"}:
            held = once(held, [*SITE, *by, "calls"], {"__codes": self._codes()})
        return once(held, [*SITE, *by], {name: c for name, c in found.items() if only is None or name in only})

    def _codes(self) -> Column:
        """By call: alternate copies, and 4 more if the alleles differ; null if not whole."""
        alts = lambda c: (c["a1"] > 0).cast("int") + (c["a2"] > 0).cast("int")
        return F.transform("calls", lambda c: alts(c) + F.when(c["a1"] != c["a2"], 4).otherwise(0))

    def _has(self, field: str) -> bool:
        return field in self.rows.schema["calls"].dataType.elementType.names

    def _counts(self) -> dict[str, Column]:
        def known(array: str) -> Column:
            return F.size(F.array_compact(array)).cast("long")

        def bit(a: Column) -> Column:
            high = F.raise_error(F.lit("more than 63 alternate alleles at a site")).cast("long")
            return F.when(a > 63, high).otherwise(F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), a), F.lit(0).cast("long")))

        zero, none = F.lit(0).cast("long"), F.lit(0)
        n_rows, n_called, n_full = known("calls"), known("calls.a1") + known("calls.a2"), known("__codes")
        n_ref = times("calls.a1", 0) + times("calls.a2", 0)
        single = seen = zero  # calls of one allele, and those of them that are not missing
        if self._has("ploidy"):
            single = times("calls.ploidy", 1)
            seen = F.size(F.filter("calls", lambda c: (c["ploidy"] == 1) & c["a1"].isNotNull())).cast("long")
        return {
            "n_called": n_called,
            "n_ref": n_ref,
            "n_alt": n_called - n_ref,
            "n_missing": 2 * n_rows - single - n_called,
            "n_full": n_full,
            "n_het": times("__codes", 5) + times("__codes", 6),
            "n_hom_ref": times("__codes", 0),
            "n_hom_alt": times("__codes", 2),
            "n_missing_samples": n_rows - n_full - seen,
            "n_rows": n_rows,
            "alleles_seen": F.aggregate("calls", zero, lambda s, c: s.bitwiseOR(bit(c["a1"])).bitwiseOR(bit(c["a2"]))),
            "allele_sum": F.aggregate("calls", zero, lambda s, c: s + F.coalesce(c["a1"], none) + F.coalesce(c["a2"], none)),
        }

    def allele_copies(self, by: Sequence[str] = ()) -> DataFrame:
        """``allele, n`` for every allele of a site, missing ones with a null index."""
        every = F.flatten(F.transform(F.filter("calls", lambda c: c.isNotNull()), lambda c: F.array(c["a1"], c["a2"])))
        rows = once(self.rows, [*SITE, *by], {"__every": every}).select("*", F.explode(F.array_distinct("__every")).alias("allele"))
        n = F.size(F.filter("__every", lambda a: a.eqNullSafe(F.col("allele")))).cast("long")
        return rows.select(*SITE, *by, "allele", n.alias("n"))

    def whole_calls(self, by: Sequence[str] = ()) -> DataFrame:
        """``n`` whole calls, their ``alt`` copies and ``het`` per row that has any."""
        keep = [*SITE, *by, "calls", *self._members()]
        rows = once(self.rows, keep, {"__codes": F.array_compact(self._codes())}).filter(F.size("__codes") > 0)
        het, others = times("__codes", 5), times("__codes", 6)
        alt = het + 2 * (others + times("__codes", 2))
        return once(rows, keep, {"n": F.size("__codes").cast("long"), "alt": alt, "het": het + others})

    def _members(self) -> list[str]:
        return ["members"] if "members" in self.rows.columns else []

    def named(self, per_sample: DataFrame) -> DataFrame:
        """Names for places."""
        return per_sample.join(self.who.select("sample", "sample_ix"), "sample_ix").drop("sample_ix")


def site_rows(g: DataFrame, who: DataFrame | None = None) -> SiteRows:
    """Long genotypes as site rows: one shuffle of the calls. ``who`` may give the cohort's order."""
    from allelespan.operators.packed import sample_index

    who = sample_index(g).withColumnRenamed("six", "sample_ix") if who is None else who.select("sample", "sample_ix")
    fields = ["a1", "a2", *[c for c in ("phased", "ploidy") if c in g.columns]]
    entry = F.struct("sample_ix", F.struct(*fields).alias("call"))
    placed = g.drop("sample_ix").join(who, "sample").groupBy(*SITE).agg(F.map_from_entries(F.collect_list(entry)).alias("__calls"))
    last = who.agg(F.max("sample_ix")).scalar()
    calls = F.transform(F.sequence(F.lit(0), F.col("__last")), lambda i: F.try_element_at("__calls", i))
    return SiteRows(placed.withColumn("__last", last).select(*SITE, calls.alias("calls")), who)
