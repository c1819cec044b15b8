"""Loci: informative regions, Watterson's theta, priors, layouts of counts, sample PCA."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespan.functions import predicates as P
from allelespan.functions.genome import harmonic, region_name
from allelespan.operators.counts import copies, is_invariant, n_samples, with_population
from allelespan.operators.filters import pass_sites
from allelespan.operators.intervals import min_length as longer
from allelespan.operators.rangejoin import sites_with_regions
from allelespan.operators.sampling import draw, take_lowest
from allelespan.operators.sfs import polarise


def informative_loci(
    v: DataFrame,
    g: DataFrame,
    iv: DataFrame,
    min_sites: int = 3,
    min_length: int = 1000,
    rand_count: int | None = None,
    seed: int = 0,
    draw_col=None,
    **gates,
) -> DataFrame:
    """Regions with at least ``min_sites`` passing records; ``rand_count`` of them at random.

    All regions are judged first and then sampled, which has the same distribution as drawing
    regions until enough pass.
    """
    good = pass_sites(v, g, **gates).select("variant_id", "chrom", "pos")
    hits = sites_with_regions(good, longer(iv, min_length).select("iv_id", "chrom", "start", "end"))
    n = hits.groupBy(F.col("r_iv_id").alias("iv_id")).agg(F.count("*").alias("n_sites"))
    out = iv.join(n.filter(F.col("n_sites") >= min_sites), "iv_id").select(*iv.columns, "n_sites")
    if rand_count is not None:
        out = take_lowest(out, rand_count, draw(seed, "iv_id") if draw_col is None else draw_col, ["iv_id"])
    return out


def watterson_theta(seqs: DataFrame) -> DataFrame:
    """``locus, pop, n_seqs, segregating, theta`` from aligned sequences ``locus, pop, seq``.

    The harmonic number runs to half the number of sequences.
    """
    n = seqs.groupBy("locus", "pop").agg(F.count("*").alias("n_seqs"))
    bases = seqs.select("locus", "pop", F.posexplode(F.split("seq", "")).alias("at", "base"))
    var = bases.groupBy("locus", "pop", "at").agg((F.min("base") != F.max("base")).alias("varies"))
    seg = var.groupBy("locus", "pop").agg(F.sum(F.col("varies").cast("long")).alias("segregating"))
    half = F.col("n_seqs") / F.lit(2)
    return n.join(seg, ["locus", "pop"], "left").select(
        "locus", "pop", "n_seqs",
        F.coalesce("segregating", F.lit(0).cast("long")).alias("segregating"),
        (F.coalesce("segregating", F.lit(0)) / harmonic(half)).alias("theta"),
    )


def theta_means(theta: DataFrame) -> DataFrame:
    """Geometric mean over loci per population, zeros counting as one."""
    x = F.when(F.col("theta") == 0, F.lit(1.0)).otherwise(F.col("theta"))
    return theta.groupBy("pop").agg(F.exp(F.avg(F.log(x))).alias("mean_theta"))


def ima_priors(theta: DataFrame) -> DataFrame:
    """One row ``q, t, m`` from the largest mean theta."""
    top = theta_means(theta).agg(F.max("mean_theta").alias("top"))
    return top.select((5 * F.col("top")).alias("q"), (2 * F.col("top")).alias("t"), (F.lit(2.0) / F.col("top")).alias("m"))


def population_counts(
    v: DataFrame, g: DataFrame, m: DataFrame, pops: list[str], gated: bool = True, max_missing: int = 0
) -> DataFrame:
    """Reference and first-alternate copies per population as arrays in ``pops`` order.

    The record gate and the counts share one aggregate over the genotypes.
    """
    members = m.filter(F.col("pop").isin(pops))
    sub = with_population(g, members)
    a1, a2 = F.col("a1"), F.col("a2")
    aggs = []
    for allele in (0, 1):
        for p in pops:
            here = F.col("pop") == p
            aggs.append(copies(here & (a1 == allele), here & (a2 == allele)).alias(f"{allele}_{p}"))
    n = sub.groupBy("variant_id").agg(
        *aggs,
        copies(a1.isNotNull(), a2.isNotNull()).alias("n_called"),
        copies(a1 == 0, a2 == 0).alias("n_ref"),
        copies(a1 > 0, a2 > 0).alias("n_alt"),
    )
    records = v
    if gated:
        n = n.withColumn("n_missing", 2 * n_samples(members) - F.col("n_called"))
        n = n.filter((F.col("n_missing") <= max_missing) & ~is_invariant(pooled=True))
        records = v.filter(P.is_snp())
    n = n.select(
        "variant_id",
        F.array(*[F.col(f"`0_{p}`") for p in pops]).alias("n_ref"),
        F.array(*[F.col(f"`1_{p}`") for p in pops]).alias("n_alt"),
    )
    return records.join(n, "variant_id")


def _total(name: str):
    return F.aggregate(name, F.lit(0).cast("long"), lambda s, x: s + x)


def snp_counts(v, g, m, pops: list[str], iv=None, ref=None, gated: bool = True, max_missing: int = 0) -> DataFrame:
    """Count table: ``ingroup, outgroup, allele1, n1, allele2, n2, place, pos``.

    ``ref`` (outgroup bases) makes the outgroup's allele the first one and drops SNPs where it is
    neither. Both alleles must occur. ``place`` is the chromosome or the region.
    """
    t = population_counts(v, g, m, pops, gated, max_missing)
    t = t.filter((_total("n_ref") > 0) & (_total("n_alt") > 0))
    if ref is not None:
        t = polarise(t, ref).filter("known")
    else:
        t = t.withColumn("swap", F.lit(False))
    t = t.withColumn("place", F.col("chrom"))
    if iv is not None:
        t = sites_with_regions(t, iv.select("chrom", "start", "end")).withColumn(
            "place", region_name("r_chrom", "r_start", "r_end")
        )
    swap, r, a = F.col("swap"), F.upper("ref"), F.upper(F.element_at("alts", 1))
    first, second = F.when(swap, a).otherwise(r), F.when(swap, r).otherwise(a)

    def joined(x, y):
        return F.array_join(F.transform(F.when(swap, F.col(y)).otherwise(F.col(x)), lambda n: n.cast("string")), "\t")

    return t.select(
        F.concat(F.lit("-"), first, F.lit("-")).alias("ingroup"),
        F.concat(F.lit("-"), second, F.lit("-")).alias("outgroup"),
        first.alias("allele1"), joined("n_ref", "n_alt").alias("n1"),
        second.alias("allele2"), joined("n_alt", "n_ref").alias("n2"),
        "place", "pos",
    )


def pop_allele_pairs(
    v, g, m, pops: list[str], iv=None, kblock: int | None = None, max_missing: int = 0
) -> DataFrame:
    """One line of ``ref,alt`` per population and SNP. With ``iv`` each region's SNPs form a block,
    padded to ``kblock`` lines of ``2n,0`` when it has any."""
    t = population_counts(v, g, m, pops, True, max_missing)
    t = t.filter((_total("n_ref") > 0) & (_total("n_alt") > 0))
    line = F.array_join(
        F.zip_with("n_ref", "n_alt", lambda x, y: F.concat_ws(",", x.cast("string"), y.cast("string"))), " "
    )
    if iv is None:
        return t.select("chrom", "pos", line.alias("line"))
    hits = sites_with_regions(t, iv.select("iv_id", "chrom", "start", "end")).select(
        F.col("r_iv_id").alias("iv_id"), "pos", line.alias("line")
    )
    if kblock is None:
        return hits
    sizes = m.filter(F.col("pop").isin(pops)).groupBy("pop").agg(F.countDistinct("sample").alias("n"))
    size_map = sizes.agg(F.map_from_entries(F.collect_list(F.struct("pop", "n")))).scalar()
    empty = F.concat_ws(" ", *[F.concat((2 * F.element_at("sz", F.lit(p))).cast("string"), F.lit(",0")) for p in pops])
    have = hits.groupBy("iv_id").agg(F.count("*").alias("k")).filter(F.col("k") < kblock)
    pad = have.select(
        "iv_id",
        F.explode(F.sequence(F.col("k") + 1, F.lit(kblock).cast("long"))).alias("__i"),
        size_map.alias("sz"),
    ).select("iv_id", F.lit(None).cast("long").alias("pos"), empty.alias("line"))
    return hits.unionByName(pad)


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns shifted to mean 0 and scaled to population deviation 1."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
        )
    ).scalar()
    out = df.withColumn("__st", stats)
    for c in cols:
        z = (F.col(c) - F.col(f"__st.m_{c}")) / F.nullif(F.col(f"__st.s_{c}"), F.lit(0.0))
        out = out.withColumn(c, F.coalesce(z, F.lit(0.0)))
    return out.drop("__st")


def sample_pca(df: DataFrame, cols: list[str], k: int = 2) -> DataFrame:
    """Standardise the columns and project every row on the first ``k`` components.

    The sign of a component is arbitrary. Only the k x columns loadings reach the driver.
    """
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    z = standardise(df, cols)
    vec = VectorAssembler(inputCols=cols, outputCol="__x").transform(z)
    scores = PCA(k=k, inputCol="__x", outputCol="__pc").fit(vec).transform(vec)
    pcs = vector_to_array("__pc")
    keep = [c for c in df.columns if c not in cols]
    return scores.select(*keep, *[pcs[i].alias(f"pc{i + 1}") for i in range(k)])
