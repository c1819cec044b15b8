"""Diversity, differentiation and heterozygosity statistics on biallelic calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.functions.genome import power_sum
from allelespan.operators.counts import (
    SITE,
    Genotypes,
    SiteRows,
    allele_counts,
    copies,
    n_samples,
    of_samples,
    site_counts,
    with_population,
)
from allelespan.operators.intervals import steps
from allelespan.operators.siterows import once


def D(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def ratio(x, y) -> Column:
    """x / y as double, null when y is zero."""
    return D(x) / F.nullif(D(y), F.lit(0.0))


def freq(v: DataFrame, g: Genotypes) -> DataFrame:
    """One row per site and listed allele: ``n_alleles, n_chr, allele_ix, allele, freq``."""
    n = allele_counts(g).filter(F.col("allele").isNotNull())
    seen = n.groupBy("variant_id").agg(F.map_from_entries(F.collect_list(F.struct("allele", "n"))).alias("seen"))
    rows = v.select(*SITE, F.concat(F.array("ref"), "alts").alias("listed")).join(seen, "variant_id", "left")
    copies_of = lambda i: F.coalesce(F.try_element_at("seen", i), F.lit(0).cast("long"))
    copied = F.transform("listed", lambda a, i: F.struct(a.alias("allele"), copies_of(i).alias("n")))
    rows = once(rows, SITE, {"listed": copied})
    rows = rows.select(
        *SITE, F.size("listed").cast("long").alias("n_alleles"),
        F.aggregate("listed", F.lit(0).cast("long"), lambda s, a: s + a["n"]).alias("n_chr"), F.posexplode("listed").alias("allele_ix", "__a"),
    )
    return rows.select(*SITE, "n_alleles", "n_chr", "allele_ix", F.col("__a.allele").alias("allele"), ratio("__a.n", "n_chr").alias("freq"))


def mismatches(c: Column, n: Column) -> Column:
    """Ordered pairs of different copies among n called copies, c of them alternate."""
    return 2 * c * (n - c)


def site_pi(g: Genotypes, by=()) -> DataFrame:
    n, c = F.col("n_called"), F.col("n_alt")
    return site_counts(g, by, ["n_called", "n_alt"]).select(*SITE, *by, ratio(mismatches(c, n), n * (n - 1)).alias("pi"))


def in_windows(sites: DataFrame, size: int, step: int | None = None) -> DataFrame:
    """One row per (site, window that holds it): ``bin_start`` is ``k*step + 1``, one-based.

    A site lies in ceil(size/step) windows at most, so the explode is a small fixed factor.
    """
    step = step or size
    p0 = F.col("pos") - 1
    last = F.floor(p0 / step).cast("long")
    first = F.greatest(F.lit(0).cast("long"), F.floor((p0 - size) / step).cast("long") + 1)
    k = F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>")))
    return (
        sites.withColumn("__k", k)
        .withColumn("bin_start", F.col("__k") * step + 1)
        .withColumn("bin_end", F.col("__k") * step + size)
        .drop("__k")
    )


def window_pi(g: Genotypes, samples: DataFrame, size: int, step: int | None = None) -> DataFrame:
    """Mismatching pairs over all pairs, positions without a variant counting as identical."""
    n, c = F.col("n_called"), F.col("n_alt")
    sites = site_counts(of_samples(g, samples), only=["n_called", "n_alt"]).select(
        "chrom", "pos", mismatches(c, n).alias("diff"), (n * (n - 1)).alias("pairs")
    )
    binned = in_windows(sites, size, step).groupBy("chrom", "bin_start", "bin_end").agg(
        F.count("*").alias("n_variants"), F.sum("diff").alias("diff"), F.sum("pairs").alias("pairs")
    )
    still = (F.lit(size) - F.col("n_variants")) * F.col("nn") * (F.col("nn") - 1)
    return binned.withColumn("nn", 2 * n_samples(samples)).select(
        "chrom", "bin_start", "bin_end", "n_variants", ratio("diff", F.col("pairs") + still).alias("pi")
    )


def tajima_d(g: Genotypes, samples: DataFrame, size: int) -> DataFrame:
    """Tajima's D per bin, with empty bins between the first and last filled in (0 SNPs, null D)."""
    n = D("nn")
    p = ratio("n_alt", "n_called")
    seg = site_counts(of_samples(g, samples), only=["n_called", "n_ref", "n_alt"]).filter((F.col("n_alt") > 0) & (F.col("n_ref") > 0))
    start = F.floor(F.col("pos") / size).cast("long") * size
    binned = seg.groupBy("chrom", start.alias("bin_start")).agg(
        F.count("*").alias("n_snps"), F.sum(2 * p * (1 - p)).alias("het")
    )
    span = binned.groupBy("chrom").agg(F.min("bin_start").alias("lo"), F.max("bin_start").alias("hi"))
    grid = steps(span, F.col("lo"), F.col("hi") + 1, size, "bin_start").select("chrom", "bin_start")
    consts = samples.agg((2 * F.countDistinct("sample")).alias("nn"))
    consts = consts.withColumn("a1", power_sum(F.col("nn") - 1, 1)).withColumn(
        "a2", power_sum(F.col("nn") - 1, 2)
    )
    b1 = (n + 1) / (3 * (n - 1))
    b2 = 2 * (n * n + n + 3) / (9 * n * (n - 1))
    c1 = b1 - 1 / F.col("a1")
    c2 = b2 - (n + 2) / (F.col("a1") * n) + F.col("a2") / (F.col("a1") * F.col("a1"))
    consts = consts.withColumn("e1", c1 / F.col("a1")).withColumn(
        "e2", c2 / (F.col("a1") * F.col("a1") + F.col("a2"))
    )
    s = D("n_snps")
    pi = F.col("het") * n / (n - 1)
    d = (pi - s / F.col("a1")) / F.nullif(
        F.sqrt(F.col("e1") * s + F.col("e2") * s * (s - 1)), F.lit(0.0)
    )
    return (
        grid.join(binned, ["chrom", "bin_start"], "left")
        .withColumn("k", consts.select(F.struct("*")).scalar())
        .select("*", "k.*")
        .select(
            "chrom",
            "bin_start",
            F.coalesce("n_snps", F.lit(0)).cast("long").alias("n_snps"),
            F.when(s > 0, d).alias("tajima_d"),
        )
    )


def pop_site_counts(g: Genotypes, m: DataFrame) -> DataFrame:
    """Per site and population: diploid samples, alternate copies, heterozygotes."""
    if isinstance(g, SiteRows):
        return with_population(g, m).whole_calls(["pop"]).select(*SITE, "pop", "n", "alt", "het")
    return (
        with_population(g, m)
        .filter(F.col("a1").isNotNull() & F.col("a2").isNotNull())
        .groupBy(*SITE, "pop")
        .agg(
            F.count("*").alias("n"),
            copies(F.col("a1") > 0, F.col("a2") > 0).alias("alt"),
            copies(F.col("a1") != F.col("a2")).alias("het"),
        )
    )


def fst_components(per_pop: DataFrame, by=()) -> DataFrame:
    """Weir and Cockerham's variance components ``a, b, c`` per site (and population pair)."""
    ni, p, h = D("n"), ratio("alt", 2 * F.col("n")), ratio("het", "n")
    # algebraic sums only, so that the aggregate combines before the shuffle
    s = per_pop.groupBy(*SITE, *by).agg(
        F.count("*").cast("double").alias("r"),
        F.sum(ni).alias("sn"),
        F.sum(ni * ni).alias("snn"),
        F.sum(ni * p).alias("snp"),
        F.sum(ni * p * p).alias("snpp"),
        F.sum(ni * h).alias("snh"),
    )
    r, sn = F.col("r"), F.col("sn")
    nbar = sn / r
    nc = (sn - F.col("snn") / sn) / (r - 1)
    pbar = F.col("snp") / sn
    s2 = (F.col("snpp") - sn * pbar * pbar) / ((r - 1) * nbar)
    hbar = F.col("snh") / sn
    v = pbar * (1 - pbar) - s2 * (r - 1) / r
    out = s.filter((r > 1) & (sn > r))
    return out.select(
        *SITE,
        *by,
        ((nbar / nc) * (s2 - (v - hbar / 4) / (nbar - 1))).alias("a"),
        ((nbar / (nbar - 1)) * (v - hbar * (2 * nbar - 1) / (4 * nbar))).alias("b"),
        (hbar / 2).alias("c"),
    )


def complete_in_pops(per_pop: DataFrame, m: DataFrame) -> DataFrame:
    """Sites with data in every population of the model."""
    have = per_pop.withColumn("__have", F.count("*").over(W.partitionBy("variant_id")))
    return have.filter(F.col("__have") == m.agg(F.countDistinct("pop")).scalar()).drop("__have")


def _fst(c: DataFrame, by=()) -> DataFrame:
    total = F.col("a") + F.col("b") + F.col("c")
    return c.withColumn("total", total).withColumn("fst", F.when(F.abs("total") > 1e-12, F.col("a") / total))


def weir_fst(g: Genotypes, m: DataFrame) -> DataFrame:
    """Per-site FST over all populations of the model; undefined where nothing varies."""
    return _fst(fst_components(pop_site_counts(g, m))).select(*SITE, "fst")


def _windowed(sites: DataFrame, size: int, step: int | None, by=()) -> DataFrame:
    defined = sites.filter(F.col("fst").isNotNull())
    return (
        in_windows(defined, size, step)
        .groupBy(*by, "chrom", "bin_start", "bin_end")
        .agg(
            F.count("*").alias("n_variants"),
            ratio(F.sum("a"), F.sum("total")).alias("weighted_fst"),
            F.avg("fst").alias("mean_fst"),
        )
    )


def windowed_weir_fst(g: Genotypes, m: DataFrame, size: int, step: int | None = None) -> DataFrame:
    return _windowed(_fst(fst_components(pop_site_counts(g, m))), size, step)


def pop_pairs(m: DataFrame) -> DataFrame:
    """Unordered population pairs, one row per pair and member: ``pair, pop``.

    Made inside one row per model, which lists its populations in order.
    """
    pops = m.groupBy("model").agg(F.array_sort(F.collect_set(F.struct("pop_ix", "pop"))).alias("pops"))

    def with_later(x):
        later = F.filter("pops", lambda y: y["pop_ix"] > x["pop_ix"])
        return F.transform(later, lambda y: F.array(x["pop"], y["pop"]))

    pairs = pops.select(F.explode(F.flatten(F.transform("pops", with_later))).alias("two"))
    return pairs.select(F.array_join("two", "_").alias("pair"), F.explode("two").alias("pop"))


def pairwise_weir_fst(g: Genotypes, m: DataFrame) -> DataFrame:
    """Per-site FST for each population pair in one pass over the genotypes.

    The join works on per-population counts, after the genotypes have been aggregated.
    """
    per_pair = pop_site_counts(g, m).join(pop_pairs(m), "pop")
    return _fst(fst_components(per_pair, ["pair"])).select(*SITE, "pair", "fst")


def pairwise_windowed_weir_fst(g, m, size: int, step: int | None = None) -> DataFrame:
    per_pair = pop_site_counts(g, m).join(pop_pairs(m), "pop")
    return _windowed(_fst(fst_components(per_pair, ["pair"])), size, step, by=["pair"])


def pairwise_site_pi(g: Genotypes, m: DataFrame) -> DataFrame:
    """Site pi of the pooled samples of every population pair."""
    per_pop = site_counts(with_population(g, m), ["pop"], ["n_called", "n_alt"]).join(pop_pairs(m), "pop")
    pooled = per_pop.groupBy(*SITE, "pair").agg(F.sum("n_called").alias("n"), F.sum("n_alt").alias("c"))
    n, c = F.col("n"), F.col("c")
    return pooled.select(*SITE, "pair", ratio(mismatches(c, n), n * (n - 1)).alias("pi"))


def pairwise_window_pi(g: Genotypes, m: DataFrame, size: int, step: int | None = None) -> DataFrame:
    pairs = pop_pairs(m)
    sizes = (
        m.select("pop", "sample").distinct().join(pairs, "pop").groupBy("pair").agg((2 * F.count("*")).alias("nn"))
    )
    per_pop = site_counts(with_population(g, m), ["pop"], ["n_called", "n_alt"]).join(pairs, "pop")
    pooled = per_pop.groupBy(*SITE, "pair").agg(F.sum("n_called").alias("n"), F.sum("n_alt").alias("c"))
    n, c = F.col("n"), F.col("c")
    sites = pooled.select("chrom", "pos", "pair", mismatches(c, n).alias("diff"), (n * (n - 1)).alias("pairs"))
    binned = in_windows(sites, size, step).groupBy("pair", "chrom", "bin_start", "bin_end").agg(
        F.count("*").alias("n_variants"), F.sum("diff").alias("diff"), F.sum("pairs").alias("pairs")
    )
    still = (F.lit(size) - F.col("n_variants")) * F.col("nn") * (F.col("nn") - 1)
    return binned.join(sizes, "pair").select(
        "pair", "chrom", "bin_start", "bin_end", "n_variants",
        ratio("diff", F.col("pairs") + still).alias("pi"),
    )


def heterozygosity(g: Genotypes, by=()) -> DataFrame:
    """Inbreeding per sample: ``o_hom, e_hom, n_sites, f``.

    In site rows the expectation of a site is made in its row and samples are summed before the shuffle: what
    moves is a row per sample and task. Long genotypes need a window over each site (as many rows as
    there are samples), so they are shuffled once.
    """
    if isinstance(g, SiteRows):
        return _inbreeding(_row_heterozygosity(g, by), by)
    w = W.partitionBy("variant_id", *by)
    called = g.filter(F.col("a1").isNotNull() & F.col("a2").isNotNull())
    alt = (F.col("a1") > 0).cast("long") + (F.col("a2") > 0).cast("long")
    called = called.withColumn("__n", 2 * F.count("*").over(w)).withColumn("__c", F.sum(alt).over(w))
    n, p = D("__n"), ratio("__c", "__n")
    usable = called.filter((F.col("__c") > 0) & (F.col("__c") < F.col("__n")))
    per_sample = usable.groupBy("sample", *by).agg(*_sample_sums(F.col("a1") == F.col("a2"), 1 - 2 * p * (1 - p) * n / (n - 1)))
    return _inbreeding(per_sample, by)


def _sample_sums(hom: Column, expected: Column) -> list[Column]:
    return [copies(hom).alias("o_hom"), F.sum(expected).alias("e_hom"), F.count("*").alias("n_sites")]


def _inbreeding(per_sample: DataFrame, by) -> DataFrame:
    f = ratio(F.col("o_hom") - F.col("e_hom"), F.col("n_sites") - F.col("e_hom"))
    return per_sample.select("sample", *by, "o_hom", "e_hom", "n_sites", f.alias("f"))


def _row_heterozygosity(g: SiteRows, by) -> DataFrame:
    rows = g.whole_calls(by)
    n, p = 2 * D("n"), ratio("alt", 2 * F.col("n"))
    rows = rows.filter((F.col("alt") > 0) & (F.col("alt") < 2 * F.col("n")))
    rows = rows.withColumn("__e", 1 - 2 * p * (1 - p) * n / (n - 1))
    each = rows.select(*by, "__e", *g._members(), F.posexplode("calls").alias("__at", "c"))
    place = F.get("members", F.col("__at")) if g._members() else F.col("__at")
    each = each.filter(F.col("c.a1").isNotNull() & F.col("c.a2").isNotNull()).withColumn("sample_ix", place)
    return g.named(each.groupBy("sample_ix", *by).agg(*_sample_sums(F.col("c.a1") == F.col("c.a2"), F.col("__e"))))


def het_fit(g: Genotypes) -> DataFrame:
    return heterozygosity(g)


def het_fis(g: Genotypes, m: DataFrame) -> DataFrame:
    """The same inside each population."""
    return heterozygosity(with_population(g, m), ["pop"])


def hwe_exact(n_het: Column, n_hom1: Column, n_hom2: Column) -> Column:
    """Exact Hardy-Weinberg p-value: total chance of heterozygote counts no likelier than seen.

    Relative chances follow from the ratio of neighbouring counts, two heterozygotes apart, walked
    up from the smallest possible count on a log scale. The sums are kept relative to the largest
    term so far, so one pass of constant memory is enough.
    """
    rare = (2 * F.least(n_hom1, n_hom2) + n_het).cast("int")
    total = n_het + n_hom1 + n_hom2
    low = rare % 2

    def step(l, h):
        hom_rare = (rare - h) / 2.0
        hom_common = total - h - hom_rare
        return l + F.log(4.0 * hom_rare * hom_common / ((h + 2.0) * (h + 1.0)))

    def until(stop):
        return F.filter(F.sequence(low, F.greatest(rare, low), F.lit(2)), lambda h: h < stop)

    seen = F.aggregate(until(n_het), F.lit(0.0), step) + 1e-9

    def add(acc, h):
        l = step(acc["l"], h)
        top = F.greatest(acc["top"], l)
        scale, term = F.exp(acc["top"] - top), F.exp(l - top)
        return F.struct(
            l.alias("l"),
            top.alias("top"),
            (acc["all"] * scale + term).alias("all"),
            (acc["few"] * scale + F.when(l <= seen, term).otherwise(0.0)).alias("few"),
        )

    start = F.struct(
        F.lit(0.0).alias("l"),
        F.lit(0.0).alias("top"),
        F.lit(1.0).alias("all"),
        F.when(seen >= 0, 1.0).otherwise(0.0).alias("few"),
    )
    return F.aggregate(until(rare), start, add, lambda a: F.least(F.lit(1.0), a["few"] / a["all"]))


def hardy_weinberg(g: Genotypes) -> DataFrame:
    """Observed and expected genotype counts, chi-square and exact p per site."""
    c = site_counts(g, only=["n_full", "n_het", "n_hom_ref", "n_hom_alt"]).filter(F.col("n_full") > 0)
    n, p = D("n_full"), ratio(F.col("n_hom_alt") * 2 + F.col("n_het"), 2 * F.col("n_full"))
    q = 1 - p
    c = (
        c.withColumn("e_hom_ref", n * q * q)
        .withColumn("e_het", 2 * n * p * q)
        .withColumn("e_hom_alt", n * p * p)
    )

    def term(o, e):
        return F.coalesce(ratio((F.col(o) - F.col(e)) * (F.col(o) - F.col(e)), e), F.lit(0.0))

    chi = term("n_hom_ref", "e_hom_ref") + term("n_het", "e_het") + term("n_hom_alt", "e_hom_alt")
    return c.select(
        *SITE, "n_hom_ref", "n_het", "n_hom_alt", "e_hom_ref", "e_het", "e_hom_alt",
        chi.alias("chisq"),
        hwe_exact(F.col("n_het"), F.col("n_hom_ref"), F.col("n_hom_alt")).alias("p_exact"),
    )


def drop_undefined(st: DataFrame, value: str) -> DataFrame:
    """Rows of a statistic table where the statistic is defined."""
    return st.dropna(subset=[value]).filter(~F.isnan(value))


def manhattan_points(st: DataFrame, value: str = "fst") -> DataFrame:
    return drop_undefined(st, value).select("chrom", "pos", value)
