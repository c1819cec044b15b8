"""Filters and predicates (F) over the whole variant and call tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from allelespan.functions import predicates as P
from allelespan.operators import counts as C
from allelespan.operators import filters as X
from allelespan.operators import intervals as I
from allelespan.plans.registry import query

KEYS = ["variant_id", "chrom", "pos"]
SEL = "SELECT variant_id, chrom, pos FROM variants"
GSEL = "SELECT variant_id, sample, CAST(a1 AS BIGINT) AS a1, CAST(a2 AS BIGINT) AS a2 FROM genotypes"
NAMES = ["S0", "S3", "S7"]
IN_B = "EXISTS (SELECT 1 FROM iv_b b WHERE b.chrom = variants.chrom AND b.start <= pos - 1 AND pos - 1 < b.end_)"


def calls(g):
    return g.select("variant_id", "sample", "a1", "a2")


def keys(v):
    return v.select(*KEYS)


@query("F01_samples_include", f"{GSEL} WHERE sample IN ('S0','S3','S7')")
def _(t):
    return calls(X.filter_samples(t.g, NAMES))


@query("F01_samples_exclude", f"{GSEL} WHERE sample NOT IN ('S0','S3','S7')")
def _(t):
    return calls(X.filter_samples(t.g, NAMES, exclude=True))


@query("F02_samples_from_list", f"{GSEL} WHERE sample IN (SELECT sample FROM m3 WHERE sample_ix >= 2)")
def _(t):
    return calls(X.filter_samples(t.g, t.m.filter("sample_ix >= 2").select("sample")))


@query("F03_samples_by_model", f"{GSEL} WHERE sample IN (SELECT sample FROM m2)")
def _(t):
    return calls(X.filter_samples(t.g, t.m2))


@query("F04_force_samples", f"{GSEL} WHERE sample IN ('S1', 'nobody')")
def _(t):
    return calls(X.filter_samples(t.g, ["S1", "nobody"], force=True))


@query("F05_only_biallelic", f"{SEL} WHERE n_alleles = 2 AND length(ref) = 1")
def _(t):
    return keys(t.v.filter(P.only_biallelic()))


@query("F06_allele_number", f"{SEL} WHERE n_alleles BETWEEN 3 AND 4")
def _(t):
    return keys(t.v.filter(P.allele_number(3, 4)))


@query("F07_af_bounds", "SELECT variant_id, chrom, pos FROM counts WHERE n_called > 0 AND n_alt >= 2e-1 * n_called AND n_alt <= 8e-1 * n_called")
def _(t):
    return keys(X.filter_frequency(t.v, t.g, 0.2, 0.8))


@query("F07_maf_bounds", "SELECT variant_id, chrom, pos FROM counts WHERE n_called > 0 AND LEAST(n_alt, n_ref) >= 25e-2 * n_called")
def _(t):
    return keys(X.filter_frequency(t.v, t.g, 0.25, minor=True))


@query("F08_ac_bounds", "SELECT variant_id, chrom, pos FROM counts WHERE n_alt BETWEEN 3 AND 12")
def _(t):
    return keys(X.filter_allele_count(t.v, t.g, 3, 12))


@query("F08_mac_bounds", "SELECT variant_id, chrom, pos FROM counts WHERE LEAST(n_alt, n_ref) >= 4")
def _(t):
    return keys(X.filter_allele_count(t.v, t.g, 4, minor=True))


@query("F09_include_types", f"{SEL} WHERE length(ref) <> 1")
def _(t):
    return keys(t.v.filter(P.of_type(indels=True)))


@query("F09_include_either_type", SEL)
def _(t):
    return keys(t.v.filter(P.of_type(indels=True, snps=True)))


@query("F10_exclude_types", f"{SEL} WHERE length(ref) = 1")
def _(t):
    return keys(t.v.filter(~P.of_type(indels=True)))


@query("F11_ids", f"{SEL} WHERE id IN ('rs3', 'rs77', 'rs150')")
def _(t):
    return keys(t.v.filter(P.id_in(["rs3", "rs77", "rs150"])))


@query("F11_ids_excluded", f"{SEL} WHERE id NOT IN ('rs3', 'rs77', 'rs150')")
def _(t):
    return keys(t.v.filter(~P.id_in(["rs3", "rs77", "rs150"])))


@query("F12_ids_from_table", f"{SEL} WHERE id IN (SELECT concat('rs', CAST(c_custkey * 3 AS STRING)) FROM customer)")
def _(t):
    ids = t.raw("customer").select(F.concat(F.lit("rs"), (F.col("c_custkey") * 3).cast("string")).alias("id"))
    return keys(X.filter_ids(t.v, ids))


@query("F13_max_missing", "SELECT variant_id, chrom, pos FROM full_counts WHERE n_missing_samples <= 3e-1 * n_total")
def _(t):
    return keys(X.filter_missing(t.v, t.g, t.samples, max_proportion=0.3))


@query("F13_max_missing_count", "SELECT variant_id, chrom, pos FROM full_counts WHERE n_missing_samples <= 4")
def _(t):
    return keys(X.filter_missing(t.v, t.g, t.samples, max_count=4))


@query("F14_passed", f"{SEL} WHERE filter = 'PASS'")
def _(t):
    return keys(t.v.filter(P.passed()))


@query("F14_not_passed", f"{SEL} WHERE filter <> 'PASS'")
def _(t):
    return keys(t.v.filter(~P.passed()))


@query("F15_flags", f"{SEL} WHERE filter IN ('q10', 'q20')")
def _(t):
    return keys(t.v.filter(P.flagged(["q10", "q20"])))


@query("F15_flags_excluded", f"{SEL} WHERE filter NOT IN ('q10', 'q20')")
def _(t):
    return keys(t.v.filter(~P.flagged(["q10", "q20"])))


_SPECS = ["chr1", "chr2:500-9000", "chr3:4000-", "chr4:101"]
_SPEC_SQL = (
    "(chrom = 'chr1' OR (chrom = 'chr2' AND pos BETWEEN 500 AND 9000) OR (chrom = 'chr3' AND pos >= 4000) "
    "OR (chrom = 'chr4' AND pos = 101))"
)


@query("F16_positions", f"{SEL} WHERE {_SPEC_SQL}")
def _(t):
    return keys(t.v.filter(P.at_positions(_SPECS)))


@query("F16_positions_excluded", f"{SEL} WHERE NOT {_SPEC_SQL}")
def _(t):
    return keys(t.v.filter(~P.at_positions(_SPECS)))


_SITES = "SELECT chrom, start + 1 AS pos FROM iv_b"


@query("F17_position_table", f"{SEL} WHERE (chrom, pos) IN ({_SITES})")
def _(t):
    return keys(X.filter_sites(t.v, t.iv_b.select("chrom", (F.col("start") + 1).alias("pos"))))


@query("F17_position_table_excluded", f"{SEL} WHERE (chrom, pos) NOT IN ({_SITES})")
def _(t):
    return keys(X.filter_sites(t.v, t.iv_b.select("chrom", (F.col("start") + 1).alias("pos")), exclude=True))


@query("F18_bed", f"{SEL} WHERE {IN_B}")
def _(t):
    return keys(X.filter_bed(t.v, t.iv_b))


@query("F18_bed_excluded", f"{SEL} WHERE NOT {IN_B}")
def _(t):
    return keys(X.filter_bed(t.v, t.iv_b, exclude=True))


@query("F19_project_bed", 'SELECT chrom, pos - 1 AS start, pos - 1 + length(ref) AS "end", id FROM variants')
def _(t):
    return X.project_bed(t.v)


@query("F19_project_sites", "SELECT chrom, pos FROM variants")
def _(t):
    return X.project_sites(t.v)


@query("F20_is_snp", "SELECT variant_id, length(ref) = 1 AS is_snp FROM variants")
def _(t):
    return t.v.select("variant_id", P.is_snp().alias("is_snp"))


_CPG = """
  SELECT v.variant_id, v.chrom, v.pos FROM variants v JOIN ref_chunks r ON r.chrom = v.chrom
   AND r.chunk_start = CASE WHEN v.ref = 'C' THEN CAST(FLOOR(v.pos/100) AS BIGINT)*100 ELSE CAST(FLOOR((v.pos-2)/100) AS BIGINT)*100 END
  WHERE (v.ref = 'C' AND contains(v.alts, 'T') AND substr(r.seq, v.pos - r.chunk_start + 1, 1) = 'G')
     OR (v.ref = 'G' AND contains(v.alts, 'A') AND substr(r.seq, v.pos - 2 - r.chunk_start + 1, 1) = 'C')"""


@query("F21_cpg", _CPG)
def _(t):
    return keys(X.cpg_sites(t.v, t.ref))


def _twice(t):
    """Every fourth record repeated under another id, so that positions collide."""
    again = t.v.filter("variant_id % 4 = 0").withColumn("variant_id", -F.col("variant_id") - 1)
    return t.v.unionByName(again)


_TWICE = {"twice": "SELECT variant_id, chrom, pos, n_alleles FROM variants UNION ALL SELECT -variant_id - 1, chrom, pos, n_alleles FROM variants WHERE variant_id % 4 = 0"}
_ONCE = "(chrom, pos) IN (SELECT chrom, pos FROM twice GROUP BY chrom, pos HAVING COUNT(*) = 1)"


@query("F22_no_duplicate_position", f"SELECT variant_id, chrom, pos FROM twice WHERE {_ONCE}", _TWICE)
def _(t):
    return keys(X.no_duplicate_position(_twice(t)))


@query("F23_no_multiallelic", f"SELECT variant_id, chrom, pos FROM twice WHERE {_ONCE} AND n_alleles <= 2", _TWICE)
def _(t):
    return keys(X.no_multiallelic(_twice(t)))


@query("F24_max_missing_alleles", "SELECT variant_id, chrom, pos FROM full_counts WHERE n_missing <= 6")
def _(t):
    c = C.with_absent_missing(C.site_counts(t.g), t.samples)
    return keys(c.filter("n_missing <= 6"))


_INV = "((n_ref > 0)::INT + (n_alt > 0)::INT + (n_missing > 0)::INT) = 1"


@query("F25_is_invariant", f"SELECT variant_id, {_INV} AS invariant FROM counts")
def _(t):
    return C.site_counts(t.g).select("variant_id", C.is_invariant().alias("invariant"))


@query("F26_is_informative", "SELECT variant_id, LEAST(n_ref, n_alt) >= 2 AS informative FROM counts")
def _(t):
    return C.site_counts(t.g).select("variant_id", C.is_informative(2).alias("informative"))


@query(
    "F27_pass_sites",
    f"SELECT variant_id, chrom, pos FROM variants JOIN counts USING (variant_id, chrom, pos) WHERE n_alleles = 2 AND length(ref) = 1 "
    f"AND n_missing <= 4 AND LEAST(n_ref, n_alt) >= 2 AND variant_id NOT IN (SELECT variant_id FROM ({_CPG}))",
)
def _(t):
    return keys(X.pass_sites(t.v, t.g, ref=t.ref, remove_cpg=True, remove_missing=4))


@query(
    "F28_check_record",
    f"SELECT variant_id, chrom, pos FROM variants JOIN counts USING (variant_id, chrom, pos) WHERE length(ref) = 1 AND n_missing <= 2 AND NOT {_INV}",
)
def _(t):
    return keys(X.check_record(t.v, t.g, remove_missing=2))


_COMPLETE = {
    "hits": "SELECT l.iv_id, v.variant_id FROM loci l JOIN variants v ON v.chrom = l.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_",
    "small_hits": "SELECT b.iv_id, v.variant_id FROM iv_b b JOIN variants v ON v.chrom = b.chrom AND v.pos - 1 >= b.start AND v.pos - 1 < b.end_",
    "complete": """SELECT h.iv_id, g.sample FROM small_hits h JOIN genotypes g USING (variant_id) WHERE a1 IS NOT NULL
      GROUP BY h.iv_id, g.sample HAVING COUNT(*) = (SELECT COUNT(*) FROM small_hits x WHERE x.iv_id = h.iv_id)""",
}


@query(
    "F29_pops_without_missing",
    """SELECT iv_id FROM (SELECT iv_id, pop, COUNT(*) AS n FROM complete JOIN m3 USING (sample) GROUP BY iv_id, pop) q
       WHERE n >= 3 GROUP BY iv_id HAVING COUNT(*) = (SELECT COUNT(DISTINCT pop) FROM m3)""",
    _COMPLETE,
)
def _(t):
    return X.pops_without_missing(t.g, t.v, t.m, t.iv_b, 3)


@query("F30_samples_with_all_data", "SELECT iv_id, sample FROM complete", _COMPLETE)
def _(t):
    return X.complete_samples(t.g, t.v, t.iv_b, t.samples)


@query("F31_chrom_filter", "SELECT iv_id FROM iv_a WHERE chrom NOT IN ('chr2', 'chr5')")
def _(t):
    return t.iv_a.filter(~P.chrom_in(["chr2", "chr5"])).select("iv_id")


_SEX = "CASE chrom WHEN 'chr4' THEN 'chrX' WHEN 'chr5' THEN 'Y' ELSE chrom END"


@query("F31_no_sex_chromosomes", "SELECT iv_id FROM iv_a WHERE chrom NOT IN ('chr4', 'chr5')")
def _(t):
    renamed = t.iv_a.withColumn("chrom", F.expr(_SEX))
    return renamed.filter(P.not_sex_chromosome()).select("iv_id")


@query("F32_min_interval_length", "SELECT iv_id FROM iv_a WHERE end_ - start >= 120")
def _(t):
    return I.min_length(t.iv_a, 120).select("iv_id")


@query("F33_normalise_chrom", "SELECT variant_id, substr(chrom, 4) AS chrom FROM variants")
def _(t):
    return X.normalise_chrom(t.v, prefix=False).select("variant_id", "chrom")


@query("F33_add_prefix", "SELECT variant_id, chrom FROM variants")
def _(t):
    bare = X.normalise_chrom(t.v, prefix=False)
    return X.normalise_chrom(bare, prefix=True).select("variant_id", "chrom")


@query(
    "F00_filter_variants",
    f"""SELECT variant_id, chrom, pos FROM variants JOIN counts USING (variant_id, chrom, pos) JOIN full_counts f USING (variant_id)
        WHERE n_alleles = 2 AND length(ref) = 1 AND filter = 'PASS' AND chrom IN ('chr1','chr2','chr3')
        AND NOT {IN_B} AND counts.n_alt >= 1e-1 * counts.n_called AND counts.n_called > 0 AND f.n_missing_samples <= 8""".replace(
        "SELECT variant_id, chrom, pos FROM", "SELECT variants.variant_id, variants.chrom, variants.pos FROM"
    ).replace("pos - 1", "variants.pos - 1"),
)
def _(t):
    return keys(
        X.filter_variants(
            t.v, t.g, t.samples, biallelic=True, include_passed=True, include_chroms=["chr1", "chr2", "chr3"],
            exclude_bed=t.iv_b, maf_min=0.1, max_missing_count=8,
        )
    )
