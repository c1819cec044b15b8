"""Variant, genotype and sample filters that need a join or an aggregate.

Row-level predicates live in ``functions.predicates`` and are applied with ``v.filter(...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.functions import predicates as P
from allelespan.functions.genome import strip_chr
from allelespan.operators.counts import is_informative, is_invariant, of_samples, site_counts, with_absent_missing
from allelespan.operators.rangejoin import overlap_pairs, sites_inside, sites_outside


# ---- samples -------------------------------------------------------------------------------


def filter_samples(
    g: DataFrame, names: list[str] | DataFrame, exclude: bool = False, force: bool = False
) -> DataFrame:
    """Keep or drop samples by name list, id-list DataFrame or membership table (``sample``).

    Unknown names raise when the query runs, unless ``force``.
    """
    if isinstance(names, DataFrame):
        wanted = names.select("sample").distinct()
    else:
        wanted = g.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], "sample string")
    if not force:
        known = g.select("sample").distinct().withColumn("__known", F.lit(True))
        unknown = F.raise_error(F.concat(F.lit("unknown sample: "), "sample")).cast("boolean")
        wanted = wanted.join(known, "sample", "left").filter(
            F.when(F.col("__known").isNull(), unknown).otherwise(F.lit(True))
        )
    return g.join(wanted.select("sample"), "sample", "left_anti" if exclude else "left_semi").select(
        *g.columns
    )


def match_samples(m: DataFrame, g: DataFrame, strict: bool = False) -> DataFrame:
    """Members present in the callset; missing ones raise when ``strict``, else are dropped."""
    present = g.select("sample").distinct()
    if not strict:
        return m.join(present, "sample", "left_semi").select(*m.columns)
    flagged = m.join(present.withColumn("__present", F.lit(True)), "sample", "left")
    absent = F.raise_error(F.concat(F.lit("sample not in callset: "), "sample")).cast("boolean")
    return flagged.filter(
        F.when(F.col("__present").isNull(), absent).otherwise(F.lit(True))
    ).select(*m.columns)


def missing_samples(m: DataFrame, g: DataFrame) -> DataFrame:
    return m.join(g.select("sample").distinct(), "sample", "left_anti").select(*m.columns)


# ---- frequency and missingness --------------------------------------------------------------


def _keep(v: DataFrame, sites: DataFrame) -> DataFrame:
    return v.join(sites.select("variant_id"), "variant_id", "left_semi").select(*v.columns)


def filter_frequency(
    v: DataFrame, g: DataFrame, at_least: float | None = None, at_most: float | None = None, minor=False
) -> DataFrame:
    """Bounds on the non-reference frequency, or on the minor one when ``minor``."""
    c = site_counts(g).filter(F.col("n_called") > 0)
    freq = F.col("n_alt") / F.col("n_called")
    freq = F.least(freq, 1 - freq) if minor else freq
    return _keep(v, c.filter(_between(freq, at_least, at_most)))


def filter_allele_count(v, g, at_least: int | None = None, at_most: int | None = None, minor=False):
    """Bounds on the number of non-reference copies, or of the rarer allele when ``minor``."""
    n = F.least("n_alt", "n_ref") if minor else F.col("n_alt")
    return _keep(v, site_counts(g).filter(_between(n, at_least, at_most)))


def _between(x: Column, low, high) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (x >= low)
    if high is not None:
        ok = ok & (x <= high)
    return ok


def filter_missing(
    v: DataFrame,
    g: DataFrame,
    samples: DataFrame,
    max_proportion: float | None = None,
    max_count: int | None = None,
) -> DataFrame:
    """Bounds on the share or number of samples without a call."""
    c = with_absent_missing(site_counts(of_samples(g, samples)), samples)
    ok = _between(F.col("n_missing_samples") / F.col("n_total"), None, max_proportion)
    return _keep(v, c.filter(ok & _between(F.col("n_missing_samples"), None, max_count)))


# ---- ids and positions ------------------------------------------------------------------------


def filter_ids(v: DataFrame, ids: DataFrame, exclude: bool = False) -> DataFrame:
    """``ids`` has one column ``id``, e.g. from ``read_id_list``."""
    return v.join(ids.select("id").distinct(), "id", "left_anti" if exclude else "left_semi").select(
        *v.columns
    )


def filter_sites(v: DataFrame, sites: DataFrame, exclude: bool = False) -> DataFrame:
    """``sites`` has ``chrom, pos``."""
    keys = sites.select("chrom", "pos").distinct()
    return v.join(keys, ["chrom", "pos"], "left_anti" if exclude else "left_semi").select(*v.columns)


def filter_bed(v: DataFrame, iv: DataFrame, exclude: bool = False) -> DataFrame:
    return sites_outside(v, iv) if exclude else sites_inside(v, iv)


def project_bed(v: DataFrame) -> DataFrame:
    p0 = F.col("pos") - 1
    return v.select(
        "chrom", p0.alias("start"), (p0 + F.length("ref")).cast("long").alias("end"), "id"
    )


def project_sites(v: DataFrame) -> DataFrame:
    return v.select("chrom", "pos")


def normalise_chrom(df: DataFrame, prefix: bool) -> DataFrame:
    bare = strip_chr("chrom")
    return df.withColumn("chrom", F.concat(F.lit("chr"), bare) if prefix else bare)


# ---- record gates -------------------------------------------------------------------------------


def records_at_position(v: DataFrame) -> Column:
    return F.count("*").over(W.partitionBy("chrom", "pos"))


def no_duplicate_position(v: DataFrame) -> DataFrame:
    """Drop all records that share a position."""
    return v.withColumn("__same", records_at_position(v)).filter("__same = 1").drop("__same")


def no_multiallelic(v: DataFrame) -> DataFrame:
    """Drop records with more than two alleles and all that share a position."""
    return no_duplicate_position(v).filter(P.n_alleles() <= 2)


def cpg_sites(v: DataFrame, ref: DataFrame) -> DataFrame:
    """Records that change the C or the G of a CpG: C to T before G, or G to A after C.

    ``ref`` holds ``chrom, chunk_start, seq`` with one fixed chunk width; only the neighbour base is
    needed, so every candidate joins exactly one chunk.
    """
    width = ref.agg(F.max(F.length("seq")).cast("long")).scalar()
    c_to_t = (F.col("ref") == "C") & F.array_contains("alts", "T")
    g_to_a = (F.col("ref") == "G") & F.array_contains("alts", "A")
    cand = v.filter(c_to_t | g_to_a).withColumn(
        "__n", F.when(c_to_t, F.col("pos")).otherwise(F.col("pos") - 2)
    )
    cand = cand.withColumn("__w", width).withColumn(
        "chunk_start", F.floor(F.col("__n") / F.col("__w")).cast("long") * F.col("__w")
    )
    near = cand.join(ref, ["chrom", "chunk_start"]).withColumn(
        "__base", F.upper(F.substring("seq", (F.col("__n") - F.col("chunk_start") + 1).cast("int"), 1))
    )
    return near.filter(F.when(c_to_t, F.col("__base") == "G").otherwise(F.col("__base") == "C")).select(
        *v.columns
    )


def _gate(v, g, samples, ref, remove_cpg, remove_indels, remove_missing, inform: Column | None):
    counts = site_counts(g if samples is None else of_samples(g, samples))
    if samples is not None:
        counts = with_absent_missing(counts, samples)
    ok = F.lit(True)
    if remove_missing != -1:
        ok = ok & (F.col("n_missing") <= remove_missing)
    if inform is not None:
        ok = ok & inform
    out = v.filter(P.is_snp()) if remove_indels else v
    if remove_cpg:
        if ref is None:
            raise ValueError("CpG removal needs a reference")
        out = out.join(cpg_sites(v, ref).select("variant_id"), "variant_id", "left_anti")
    return _keep(out.select(*v.columns), counts.filter(ok))


def pass_sites(
    v: DataFrame,
    g: DataFrame,
    ref: DataFrame | None = None,
    samples: DataFrame | None = None,
    remove_cpg: bool = False,
    remove_indels: bool = True,
    remove_multiallele: bool = True,
    remove_missing: int = 0,
    inform_level: int = 2,
) -> DataFrame:
    """Records that pass every gate; ``inform_level`` copies of both alleles are required."""
    if inform_level not in (0, 1, 2):
        raise ValueError("inform_level must be 0, 1 or 2")
    inform = is_informative(inform_level) if inform_level else None
    base = no_multiallelic(v) if remove_multiallele else v
    return _gate(base, g, samples, ref, remove_cpg, remove_indels, remove_missing, inform)


def check_record(
    v: DataFrame,
    g: DataFrame,
    ref: DataFrame | None = None,
    samples: DataFrame | None = None,
    remove_cpg: bool = False,
    remove_indels: bool = True,
    remove_missing: int = 0,
    inform_level: int = 2,
    remove_multiallele: bool = False,
) -> DataFrame:
    """Single-record gate: like ``pass_sites`` but asks only that the site is not invariant, and
    leaves multi-allelic records alone unless told otherwise."""
    inform = ~is_invariant() if inform_level else None
    base = v.filter(P.n_alleles() <= 2) if remove_multiallele else v
    return _gate(base, g, samples, ref, remove_cpg, remove_indels, remove_missing, inform)


# ---- completeness -------------------------------------------------------------------------------


def complete_samples(g: DataFrame, v: DataFrame, iv: DataFrame, samples: DataFrame) -> DataFrame:
    """``iv_id, sample`` for samples called at every record of the region.

    Counting calls instead of listing them keeps this one aggregate: a sample is complete when it
    has as many calls as the region has records.
    """
    points = v.select("variant_id", "chrom", F.col("pos"), (F.col("pos") - 1).alias("p0"))
    hits = overlap_pairs(
        points, iv.select("iv_id", "chrom", "start", "end"), ("chrom", "p0", "pos"), prefix="r_", points=True
    ).select("variant_id", F.col("r_iv_id").alias("iv_id"))
    records = hits.groupBy("iv_id").agg(F.count("*").alias("n_records"))
    called = g.filter(F.col("a1").isNotNull()).select("variant_id", "sample")
    per_sample = hits.join(called, "variant_id").groupBy("iv_id", "sample").agg(F.count("*").alias("n"))
    return (
        per_sample.join(samples.select("sample").distinct(), "sample", "left_semi")
        .join(records, "iv_id")
        .filter("n = n_records")
        .select("iv_id", "sample")
    )


def pops_without_missing(
    g: DataFrame, v: DataFrame, m: DataFrame, iv: DataFrame, min_per_pop: int = 5
) -> DataFrame:
    """Regions with records where every population has enough complete individuals."""
    full = complete_samples(g, v, iv, m).join(m.select("sample", "pop"), "sample")
    per_pop = full.groupBy("iv_id", "pop").agg(F.countDistinct("sample").alias("n"))
    good = per_pop.filter(F.col("n") >= min_per_pop).groupBy("iv_id").agg(F.count("*").alias("n_pops"))
    wanted = m.agg(F.countDistinct("pop")).scalar()
    return good.filter(F.col("n_pops") == wanted).select("iv_id")


def filter_variants(v: DataFrame, g: DataFrame | None = None, samples: DataFrame | None = None, **o):
    """All variant filters combined by AND. Options:

    biallelic, min_alleles, max_alleles, include_indels, include_snps, exclude_indels, exclude_snps,
    include_ids, exclude_ids, include_passed, exclude_passed, include_flags, exclude_flags,
    include_pos, exclude_pos, include_chroms, exclude_chroms, include_bed, exclude_bed, include_sites,
    exclude_sites, maf_min, maf_max, mac_min, mac_max, minor, max_missing, max_missing_count.
    Row predicates run first, joins after them, allele aggregates last.
    """
    unknown = set(o) - _OPTIONS
    if unknown:
        raise TypeError(f"unknown filter options: {sorted(unknown)}")
    get = o.get
    tests = []
    if get("biallelic"):
        tests.append(P.only_biallelic())
    if get("min_alleles") is not None or get("max_alleles") is not None:
        tests.append(P.allele_number(get("min_alleles"), get("max_alleles")))
    if get("include_indels") or get("include_snps"):
        tests.append(P.of_type(bool(get("include_indels")), bool(get("include_snps"))))
    if get("exclude_indels") or get("exclude_snps"):
        tests.append(~P.of_type(bool(get("exclude_indels")), bool(get("exclude_snps"))))
    for name, make in (
        ("ids", P.id_in),
        ("flags", P.flagged),
        ("pos", P.at_positions),
        ("chroms", P.chrom_in),
        ("passed", lambda _: P.passed()),
    ):
        if get(f"include_{name}"):
            tests.append(make(get(f"include_{name}")))
        if get(f"exclude_{name}"):
            tests.append(~make(get(f"exclude_{name}")))
    for test in tests:
        v = v.filter(test)
    for name, apply in (("bed", filter_bed), ("sites", filter_sites)):
        if get(f"include_{name}") is not None:
            v = apply(v, get(f"include_{name}"))
        if get(f"exclude_{name}") is not None:
            v = apply(v, get(f"exclude_{name}"), exclude=True)
    minor = bool(get("minor"))
    if get("maf_min") is not None or get("maf_max") is not None:
        v = filter_frequency(v, g, get("maf_min"), get("maf_max"), minor)
    if get("mac_min") is not None or get("mac_max") is not None:
        v = filter_allele_count(v, g, get("mac_min"), get("mac_max"), minor)
    if get("max_missing") is not None or get("max_missing_count") is not None:
        v = filter_missing(v, g, samples, get("max_missing"), get("max_missing_count"))
    return v


_OPTIONS = {
    "biallelic", "min_alleles", "max_alleles", "maf_min", "maf_max", "mac_min", "mac_max", "minor",
    "max_missing", "max_missing_count",
} | {
    f"{way}_{what}"
    for way in ("include", "exclude")
    for what in ("indels", "snps", "ids", "passed", "flags", "pos", "chroms", "bed", "sites")
}
