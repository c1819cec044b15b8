"""Per-site allele and genotype counts: one row per site (and population).

Genotypes are long rows ``variant_id, chrom, pos, sample, a1, a2``; null means not called. Only
algebraic aggregates are used, so rows are combined before the shuffle: what moves is one partial
row per site and input split, not one row per call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespan.operators.siterows import SITE, SiteRows

#: What the operators take as genotypes.
Genotypes = DataFrame | SiteRows


def copies(*tests: Column) -> Column:
    """Sum over rows of how many of the tests hold (null counts as no)."""
    total = F.lit(0).cast("long")
    for test in tests:
        total = total + F.coalesce(test, F.lit(False)).cast("long")
    return F.sum(total)


def site_counts(g: Genotypes, by: Sequence[str] = (), only: Sequence[str] | None = None) -> DataFrame:
    """``n_called, n_ref, n_alt, n_missing`` in alleles; ``n_full, n_het, n_hom_ref, n_hom_alt,
    n_missing_samples, n_rows`` in samples; ``alleles_seen`` (a bit per allele index) and ``allele_sum``
    (of the indexes). Alleles of a half-called genotype are counted individually. Where ``g`` has
    ``ploidy``, calls of one allele have no second one to miss; ``n_full`` and what follows from whole
    genotypes leave them out. A site may have alleles 0 to 63; higher ones raise.
    ``only`` names the counts that are needed; of long genotypes Catalyst makes no others anyway."""
    if isinstance(g, SiteRows):
        return g.counts(by, only)
    a1, a2 = F.col("a1"), F.col("a2")
    high = "cast(raise_error('more than 63 alternate alleles at a site') as bigint)"
    bits = [F.expr(f"CASE WHEN {a} > 63 THEN {high} WHEN {a} IS NULL THEN 0L ELSE shiftleft(1L, cast({a} as int)) END") for a in ("a1", "a2")]
    full = a1.isNotNull() & a2.isNotNull()
    single = F.coalesce(F.col("ploidy") == 1, F.lit(False)) if "ploidy" in g.columns else F.lit(False)
    return g.groupBy(*SITE, *by).agg(
        copies(a1.isNotNull(), a2.isNotNull()).alias("n_called"),
        copies(a1 == 0, a2 == 0).alias("n_ref"),
        copies(a1 > 0, a2 > 0).alias("n_alt"),
        copies(a1.isNull(), a2.isNull() & ~single).alias("n_missing"),
        copies(full).alias("n_full"),
        copies(a1 != a2).alias("n_het"),
        copies((a1 == 0) & (a2 == 0)).alias("n_hom_ref"),
        copies((a1 > 0) & (a1 == a2)).alias("n_hom_alt"),
        copies(~full & ~(single & a1.isNotNull())).alias("n_missing_samples"),
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_or(bits[0].bitwiseOR(bits[1])).alias("alleles_seen"),
        F.sum(F.coalesce(a1, F.lit(0)) + F.coalesce(a2, F.lit(0))).cast("long").alias("allele_sum"),
    )


def of_samples(g: Genotypes, samples: DataFrame) -> Genotypes:
    """The calls of the listed samples."""
    if isinstance(g, SiteRows):
        return g.of_samples(samples)
    return g.join(samples.select("sample").distinct(), "sample", "left_semi").select(*g.columns)


def allele_counts(g: Genotypes, by: Sequence[str] = ()) -> DataFrame:
    """Copies of every allele index per site (and group); missing alleles have a null index."""
    if isinstance(g, SiteRows):
        return g.allele_copies(by)
    long = g.select(*SITE, *by, F.explode(F.array("a1", "a2")).alias("allele"))
    return long.groupBy(*SITE, *by, "allele").agg(F.count("*").alias("n"))


def with_population(g: Genotypes, m: DataFrame) -> Genotypes:
    """Keep the model's samples and add ``pop, pop_ix``; population tables stay small enough for
    Catalyst to broadcast on its own size estimate."""
    if isinstance(g, SiteRows):
        return g.by_population(m)
    members = m.select("sample", "pop", "pop_ix").dropDuplicates(["sample", "pop"])
    return g.drop("pop", "pop_ix").join(members, "sample")


def n_samples(m: DataFrame) -> Column:
    """Number of samples in a sample or membership table, as a scalar subquery."""
    return m.agg(F.countDistinct("sample")).scalar()


def with_absent_missing(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Also count samples that have no row at a site as missing (2 alleles each)."""
    absent = F.col("n_total") - F.col("n_rows")
    return (
        counts.withColumn("n_total", n_samples(samples))
        .withColumn("n_missing", F.col("n_missing") + 2 * absent)
        .withColumn("n_missing_samples", F.col("n_missing_samples") + absent)
    )


def is_invariant(pooled: bool = False) -> Column:
    """One key in the allele count, where missing data counts as a key.

    ``pooled`` takes all alternates as one allele, for counts that do not tell them apart.
    """
    alleles = (F.col("n_ref") > 0).cast("int") + (F.col("n_alt") > 0).cast("int")
    if not pooled:
        alleles = F.bit_count("alleles_seen")
    return alleles + (F.col("n_missing") > 0).cast("int") == 1


def is_informative(mincount: int = 2) -> Column:
    """Exactly two alleles present with at least ``mincount`` copies each; missing data is ignored.

    The copies of two alleles x < y follow from their total and the sum of the allele indexes.
    """
    low = F.expr("bit_count((alleles_seen & -alleles_seen) - 1)")
    high = F.expr("bit_count((alleles_seen ^ (alleles_seen & -alleles_seen)) - 1)")
    of_high = (F.col("allele_sum") - low * F.col("n_called")) / (high - low)
    enough = F.least(of_high, F.col("n_called") - of_high) >= mincount
    return F.when(F.bit_count("alleles_seen") == 2, enough).otherwise(F.lit(False))
