"""Interval joins (J), ordered operators (W), set operations (U) and sampling (M)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.functions import genome as G
from allelespan.operators import callsets as CS
from allelespan.operators import intervals as I
from allelespan.operators import loci as L
from allelespan.operators import models as M
from allelespan.operators import rangejoin as R
from allelespan.operators import sampling as S
from allelespan.operators import sequence as Q
from allelespan.operators import sfs as SFS
from allelespan.operators.counts import site_counts, with_absent_missing
from allelespan.plans.registry import query
from allelespan.session import materialise, new_path

IV = ["iv_id", "chrom", "start", "end"]
END = 'end_ AS "end"'
HIT = "b.chrom = a.chrom AND a.start < b.end_ AND b.start < a.end_"


def iv(df):
    return df.select(*IV)


def places(ordered, *keys):
    """``keys, place, n``: where the first row of each key comes in the order of ``ordered``, and its rows.

    Rows are numbered inside their partition; only one row per partition is summed in order.
    """
    rows = ordered.select(*keys, F.monotonically_increasing_id().alias("__id"))
    rows = materialise(rows.withColumn("__part", F.shiftright("__id", 33)), "places")
    sizes = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    at = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__before")
    return rows.join(sizes, "__part").groupBy(*keys).agg(F.min(at).alias("place"), F.count("*").alias("n"))


def _places_sql(table, keys, order):
    """The same, of rows in the given order."""
    return f"SELECT {keys}, MIN(k) AS place, COUNT(*) AS n FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) - 1 AS k FROM {table}) GROUP BY ALL"


@query(
    "J01_variants_in_regions",
    "SELECT v.variant_id, v.chrom, v.pos, b.iv_id FROM variants v JOIN iv_a b ON b.chrom = v.chrom AND b.start <= v.pos - 1 AND v.pos - 1 < b.end_",
)
def _(t):
    hits = R.sites_with_regions(t.v, t.iv_a)
    return hits.select("variant_id", "chrom", "pos", F.col("r_iv_id").alias("iv_id"))


@query(
    "J02_classify_record",
    """SELECT variant_id, CASE WHEN chrom > 'chr3' THEN 'after' WHEN chrom < 'chr3' THEN 'before'
       WHEN pos - 1 < 2000 THEN 'before' WHEN pos - 1 >= 9000 THEN 'after' ELSE 'in' END AS placement FROM variants""",
)
def _(t):
    return I.classify_record(t.v, ("chr3", 2000, 9000)).select("variant_id", "placement")


@query("J03_bed_intersect", f"SELECT iv_id, chrom, start, {END} FROM iv_a a WHERE EXISTS (SELECT 1 FROM iv_b b WHERE {HIT})")
def _(t):
    return iv(I.bed_intersect(t.iv_a, t.iv_b))


@query(
    "J04_bed_intersect_pieces",
    f'SELECT a.iv_id, a.chrom, GREATEST(a.start, b.start) AS start, LEAST(a.end_, b.end_) AS "end" FROM iv_a a JOIN iv_b b ON {HIT}',
)
def _(t):
    return iv(I.bed_intersect(t.iv_a, t.iv_b, pieces=True))


_MERGE = """
  SELECT chrom, MIN(start) AS start, MAX(end_) AS end_ FROM (
    SELECT *, SUM(CASE WHEN prev IS NULL OR start {op} prev THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, end_, r) AS isl FROM (
      SELECT *, MAX(end_) OVER (PARTITION BY chrom ORDER BY start, end_, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
      FROM (SELECT chrom, start, end_, ROW_NUMBER() OVER (ORDER BY chrom, start, end_) AS r FROM {src})))
  GROUP BY chrom, isl"""
_ISL = {"isl_b": _MERGE.format(op=">", src="iv_b")}
_GAPS = {
    **_ISL,
    "gaps_b": """
      SELECT chrom, COALESCE(LAG(end_) OVER (PARTITION BY chrom ORDER BY start), 0) AS gs, start AS ge FROM isl_b
      UNION ALL SELECT c.chrom, COALESCE(m.last, 0), 4611686018427387904 FROM (SELECT DISTINCT chrom FROM iv_a) c
        LEFT JOIN (SELECT chrom, MAX(end_) AS last FROM isl_b GROUP BY chrom) m USING (chrom)""",
}


@query(
    "J05_bed_subtract",
    'SELECT a.iv_id, a.chrom, GREATEST(a.start, gs) AS start, LEAST(a.end_, ge) AS "end" FROM iv_a a JOIN gaps_b b ON a.chrom = b.chrom AND gs < ge AND a.start < ge AND gs < a.end_',
    _GAPS,
)
def _(t):
    return iv(I.bed_subtract(t.iv_a, t.iv_b))


@query("J06_bed_subtract_entire", f"SELECT iv_id, chrom, start, {END} FROM iv_a a WHERE NOT EXISTS (SELECT 1 FROM iv_b b WHERE {HIT})")
def _(t):
    return iv(I.bed_subtract(t.iv_a, t.iv_b, entire=True))


_SHARE = "(LEAST(a.end_, b.end_) - GREATEST(a.start, b.start))"
_FA, _FB = f"{_SHARE} >= {{x}} * (a.end_ - a.start)", f"{_SHARE} >= {{y}} * (b.end_ - b.start)"


def _entire(cond):
    return f"SELECT iv_id, chrom, start, {END} FROM iv_a a WHERE NOT EXISTS (SELECT 1 FROM iv_b b WHERE {HIT} AND ({cond}))"


@query("J07_subtract_min_a", _entire(_FA.format(x="3e-1")))
def _(t):
    return iv(I.bed_subtract(t.iv_a, t.iv_b, entire=True, min_a=0.3))


@query("J07_subtract_min_b", _entire(_FB.format(y="9e-1")))
def _(t):
    return iv(I.bed_subtract(t.iv_a, t.iv_b, entire=True, min_b=0.9))


@query("J07_subtract_reciprocal", _entire(_FA.format(x="25e-2") + " AND " + _FB.format(y="25e-2")))
def _(t):
    return iv(I.bed_subtract(t.iv_a, t.iv_b, entire=True, reciprocal=0.25))


@query("J07_subtract_either", _entire(_FA.format(x="2e-1") + " OR " + _FB.format(y="95e-2")))
def _(t):
    return iv(I.bed_subtract(t.iv_a, t.iv_b, entire=True, min_a=0.2, min_b=0.95, either=True))


@query(
    "J07_subtract_pieces",
    f"""WITH cuts AS (SELECT a.iv_id, a.chrom, a.start, a.end_, GREATEST(a.start, b.start) AS cs, MAX(LEAST(a.end_, b.end_)) AS ce
          FROM iv_a a JOIN iv_b b ON {HIT} AND {_FA.format(x="2e-1")} GROUP BY a.iv_id, a.chrom, a.start, a.end_, GREATEST(a.start, b.start)),
        parts AS (
          SELECT iv_id, chrom, COALESCE(MAX(ce) OVER (PARTITION BY iv_id ORDER BY cs ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), start) AS s, cs AS e FROM cuts
          UNION ALL SELECT iv_id, chrom, MAX(ce), end_ FROM cuts GROUP BY iv_id, chrom, end_)
        SELECT iv_id, chrom, s AS start, e AS "end" FROM parts WHERE s < e
        UNION ALL SELECT iv_id, chrom, start, end_ FROM iv_a WHERE iv_id NOT IN (SELECT iv_id FROM cuts)""".replace("WITH cuts AS", "SELECT * FROM (WITH cuts AS", 1) + ")",
)
def _(t):
    return iv(I.bed_subtract(t.iv_a, t.iv_b, min_a=0.2))


@query(
    "J08_subtract_regions",
    f"""SELECT a.chrom, a.start, a.end_ AS "end" FROM (SELECT chrom, s AS start, LEAST(s + 60, size) AS end_
          FROM (SELECT chrom, size, unnest(range(0, size, 60)) AS s FROM sizes)) a
        WHERE NOT EXISTS (SELECT 1 FROM iv_b b WHERE {HIT})""",
)
def _(t):
    return I.subtract_regions(I.make_windows(t.sizes, 60), t.iv_b)


@query(
    "J09_extract_regions",
    "SELECT l.iv_id, v.variant_id, v.pos FROM loci l JOIN variants v ON v.chrom = l.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_ WHERE v.filter = 'PASS' AND v.n_alleles = 2 AND length(v.ref) = 1",
)
def _(t):
    hits = CS.extract_regions(t.v, t.loci, filters={"biallelic": True, "include_passed": True})
    return hits.select("iv_id", "variant_id", "pos")


@query(
    "J10_extract_regions_gated",
    """SELECT l.iv_id, v.variant_id, v.pos FROM loci l JOIN variants v ON v.chrom = l.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_
       JOIN counts c ON c.variant_id = v.variant_id WHERE length(v.ref) = 1 AND n_missing <= 2
       AND ((n_ref > 0)::INT + (n_alt > 0)::INT + (n_missing > 0)::INT) > 1""",
)
def _(t):
    hits = CS.extract_regions(t.v, t.loci, g=t.g, gates={"remove_missing": 2})
    return hits.select("iv_id", "variant_id", "pos")


@query(
    "J10_empty_regions",
    "SELECT iv_id FROM iv_b b WHERE NOT EXISTS (SELECT 1 FROM variants v WHERE v.chrom = b.chrom AND b.start <= v.pos - 1 AND v.pos - 1 < b.end_)",
)
def _(t):
    return CS.empty_regions(CS.extract_regions(t.v, t.iv_b), t.iv_b).select("iv_id")


@query("J11_assign_population", "SELECT g.sample, COALESCE(pop, 'none') AS pop, COUNT(*) AS n FROM genotypes g LEFT JOIN m2 USING (sample) GROUP BY g.sample, pop")
def _(t):
    return M.assign_population(t.g, t.m2, "none").groupBy("sample", "pop").agg(F.count("*").alias("n"))


_REFBASE = "LEFT JOIN {chunks} r ON r.chrom = v.chrom AND r.chunk_start = CAST(FLOOR((v.pos - 1)/100) AS BIGINT)*100"
_TEXT = "substr(r.seq, v.pos - r.chunk_start, CAST(length(v.ref) AS BIGINT))"


@query(
    "J12_check_ref",
    f"SELECT v.variant_id, v.chrom, v.pos, v.ref, {_TEXT} AS ref_seq FROM variants v JOIN outgroup r ON r.chrom = v.chrom AND r.chunk_start = CAST(FLOOR((v.pos - 1)/100) AS BIGINT)*100 WHERE {_TEXT} <> v.ref",
)
def _(t):
    return Q.check_ref(t.v, t.outgroup).select("variant_id", "chrom", "pos", "ref", "ref_seq")


_BASE = "substr(r.seq, v.pos - r.chunk_start, 1)"


@query(
    "J13_polarise",
    f"""SELECT v.variant_id, {_BASE} AS outgroup, COALESCE({_BASE} = v.alt, FALSE) AS swap,
        COALESCE({_BASE} = upper(v.ref) OR contains(v.alts, {_BASE}), FALSE) AS known FROM variants v {_REFBASE.format(chunks='outgroup')}""",
)
def _(t):
    return SFS.polarise(t.v, t.outgroup).select("variant_id", "outgroup", "swap", "known")


def _halves(t):
    """Two callsets with different samples and partly different sites."""
    number = F.substring("sample", 2, 9).cast("int")
    one = (t.v.filter("variant_id % 3 <> 0"), t.g.filter(number < 10).filter("variant_id % 3 <> 0"))
    two = (t.v.filter("variant_id % 3 <> 1"), t.g.filter(number >= 10).filter("variant_id % 3 <> 1"))
    return one, two


_HALF = "((variant_id % 3 <> 0 AND CAST(substr(sample, 2) AS INT) < 10) OR (variant_id % 3 <> 1 AND CAST(substr(sample, 2) AS INT) >= 10))"


@query(
    "J14_merge_callsets",
    f"SELECT g.chrom, g.pos, v.alts, sample, CAST(a1 AS BIGINT) AS a1, CAST(a2 AS BIGINT) AS a2 FROM genotypes g JOIN variants v USING (variant_id) WHERE {_HALF}",
)
def _(t):
    v, g = CS.merge_callsets(*_halves(t), mode="none")
    alts = v.select("variant_id", F.array_join("alts", ",").alias("alts"))
    return g.join(alts, "variant_id").select("chrom", "pos", "alts", "sample", "a1", "a2")


@query(
    "J14_merge_missing_as_ref",
    f"""SELECT chrom, pos, sample, CAST(a1 AS BIGINT) AS a1, CAST(a2 AS BIGINT) AS a2 FROM genotypes WHERE {_HALF}
        UNION ALL SELECT chrom, pos, sample, 0, 0 FROM variants, (SELECT DISTINCT sample FROM genotypes WHERE {_HALF})
        WHERE (variant_id % 3 = 0 AND CAST(substr(sample, 2) AS INT) < 10) OR (variant_id % 3 = 1 AND CAST(substr(sample, 2) AS INT) >= 10)""",
)
def _(t):
    _, g = CS.merge_callsets(*_halves(t), mode="both", missing_as_ref=True)
    return g.select("chrom", "pos", "sample", "a1", "a2")


def _other_alleles(t):
    """The same sites with the next base as the only alternate, called in other samples."""
    number = F.substring("sample", 2, 9).cast("int")
    base = F.substring(F.lit("ACGT"), ((F.col("variant_id") + 1) % 4 + 1).cast("int"), F.lit(1))
    one = (t.snps, t.g.filter(number < 10).join(t.snps.select("variant_id"), "variant_id", "left_semi"))
    two = (
        t.snps.withColumn("alts", F.array(base)),
        t.g.filter(number >= 10).join(t.snps.select("variant_id"), "variant_id", "left_semi"),
    )
    return one, two


@query(
    "J14_merge_multiallelic",
    """SELECT v.chrom, v.pos, CASE WHEN alt = o THEN alt ELSE concat(alt, ',', o) END AS alts, sample,
        CAST(CASE WHEN a1 = 1 AND CAST(substr(sample, 2) AS INT) >= 10 AND alt <> o THEN 2 ELSE a1 END AS BIGINT) AS a1
       FROM (SELECT *, substr('ACGT', CAST((variant_id + 1) % 4 + 1 AS INT), 1) AS o FROM snps) v JOIN genotypes USING (variant_id)""",
)
def _(t):
    v, g = CS.merge_callsets(*_other_alleles(t), mode="snps")
    alts = v.select("variant_id", F.array_join("alts", ",").alias("alts"))
    return g.join(alts, "variant_id").select("chrom", "pos", "alts", "sample", "a1")


# ---- set operations --------------------------------------------------------------------------------


@query("U01_concat_callsets", "SELECT variant_id, sample, CAST(a1 AS BIGINT) AS a1 FROM genotypes")
def _(t):
    odd, even = ("variant_id % 2 = 1", "variant_id % 2 = 0")
    _, g = CS.concat_callsets((t.v.filter(odd), t.g.filter(odd)), (t.v.filter(even), t.g.filter(even)))
    return g.select("variant_id", "sample", "a1")


@query("U02_bed_union", f"SELECT chrom, start, {END} FROM iv_a UNION ALL SELECT chrom, start, end_ FROM iv_b")
def _(t):
    return I.bed_union(t.iv_a, t.iv_b)


@query("U03_list_chroms", "SELECT DISTINCT chrom FROM variants")
def _(t):
    return CS.list_chroms(t.v)


@query("U04_list_samples", "SELECT DISTINCT sample FROM genotypes")
def _(t):
    return CS.list_samples(t.g)


@query("U05_exclude_individuals", "SELECT DISTINCT sample FROM m3 WHERE sample NOT IN (SELECT sample FROM m2)")
def _(t):
    return M.exclude_individuals(t.m.unionByName(t.m5), t.m2)


@query("U06_unique_individuals", "SELECT DISTINCT sample FROM m3 UNION SELECT DISTINCT sample FROM m2")
def _(t):
    return M.unique_individuals(t.m.unionByName(t.m2))


@query("U07_pops_not_in_model", "SELECT DISTINCT pop FROM m5 UNION SELECT DISTINCT pop FROM m3 EXCEPT SELECT pop FROM m2")
def _(t):
    return M.pops_not_in_model(t.m2, t.m5.select("pop").unionByName(t.m.select("pop")))


# ---- ordered operators -----------------------------------------------------------------------------


_MIXED = "CASE WHEN iv_id % 3 = 0 THEN concat('chr', CAST(iv_id % 12 + 1 AS STRING)) WHEN iv_id % 3 = 1 THEN concat('chr', CAST(iv_id % 11 AS STRING), 'b') ELSE 'X' END"


@query(
    "C01_natural_chrom_key",
    f"""SELECT iv_id, DENSE_RANK() OVER (ORDER BY CASE WHEN c = 'X' THEN 1 ELSE 0 END,
         CAST(COALESCE(NULLIF(regexp_replace(c, '[^0-9]', '', 'g'), ''), '0') AS INT), CASE WHEN c LIKE '%b' THEN 1 ELSE 0 END) AS r
        FROM (SELECT iv_id, {_MIXED} AS c FROM iv_b)""",
)
def _(t):
    from pyspark.sql import Window as W

    keyed = t.iv_b.select("iv_id", G.natural_key(F.expr(_MIXED)).alias("k"))
    ranks = keyed.groupBy("k").agg(F.count("*").alias("n")).select(
        "k", F.dense_rank().over(W.orderBy("k")).alias("r")
    )
    return keyed.join(ranks, "k").select("iv_id", "r")


@query("W01_sort_natural", f"SELECT iv_id, chrom, start, {END} FROM iv_a")
def _(t):
    return iv(I.sort_intervals(t.iv_a))


@query("W01_natural_rank", "SELECT iv_id, ROW_NUMBER() OVER (ORDER BY chrom, start, end_, iv_id) - 1 AS locus_ix FROM iv_a")
def _(t):
    return Q.locus_index(t.iv_a).select("iv_id", "locus_ix")


@query("W02_sort_string", f"SELECT iv_id, chrom, start, {END} FROM iv_a")
def _(t):
    return iv(I.sort_intervals(t.iv_a, "string"))


@query("W02_sort_list", f"SELECT iv_id, chrom, start, {END} FROM iv_a")
def _(t):
    return iv(I.sort_intervals(t.iv_a, "list", ["chr3", "chr1", "chr5", "chr2", "chr4"]))


@query("W03_bed_sort", f"SELECT iv_id, chrom, start, {END} FROM iv_a")
def _(t):
    return iv(I.bed_sort(t.iv_a))


@query("W04_sort_variants", "SELECT variant_id, chrom, pos FROM variants")
def _(t):
    return CS.sort_variants(t.v).select("variant_id", "chrom", "pos")


_LIST = ["chr3", "chr1", "chr5", "chr2", "chr4"]
_AT = f"chrom, start, {END}"


@query("W02_string_places", _places_sql("iv_a", _AT, "chrom, start, end_"))
def _(t):
    return places(I.sort_intervals(t.iv_a, "string"), "chrom", "start", "end")


@query("W02_list_places", _places_sql("iv_a", _AT, f"list_position({_LIST}, chrom), start, end_"))
def _(t):
    return places(I.sort_intervals(t.iv_a, "list", _LIST), "chrom", "start", "end")


@query("W03_bed_places", _places_sql("iv_a", "chrom, start", "chrom, start"))
def _(t):
    return places(I.bed_sort(t.iv_a), "chrom", "start")


@query("W04_variant_places", _places_sql("variants", "variant_id", "chrom, pos, variant_id"))
def _(t):
    return places(CS.sort_variants(t.v), "variant_id")


@query("W05_bed_merge", f"SELECT chrom, start, {END} FROM ({_MERGE.format(op='>', src='iv_b')})")
def _(t):
    return I.bed_merge(t.iv_b)


@query("W05_bed_merge_gap", f"SELECT chrom, start, {END} FROM ({_MERGE.format(op='> 60 +', src='iv_b')})")
def _(t):
    return I.bed_merge(t.iv_b, max_gap=60)


@query(
    "W05_bed_merge_many",
    f"SELECT chrom, start, {END} FROM ({_MERGE.format(op='>', src='(SELECT * FROM iv_a UNION ALL SELECT * FROM iv_b)')})",
)
def _(t):
    return I.bed_merge(t.iv_a, t.iv_b)


@query("W06_fix_overlap", f"SELECT chrom, start, {END} FROM ({_MERGE.format(op='>=', src='iv_b')})")
def _(t):
    return I.fix_overlap(t.iv_b)


@query("W07_has_overlap", "SELECT EXISTS (SELECT 1 FROM (SELECT start, MAX(end_) OVER (PARTITION BY chrom ORDER BY start, end_, iv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM iv_b) WHERE prev > start) AS has_overlap")
def _(t):
    return I.has_overlap(t.iv_b)


@query("W07_has_no_overlap", "SELECT FALSE AS has_overlap FROM (SELECT COUNT(*) FROM iv_b)")
def _(t):
    return I.has_overlap(I.bed_merge(t.iv_b))


@query(
    "W08_bed_complement",
    """SELECT c.chrom, gs AS start, LEAST(ge, size) AS "end" FROM gaps_b c JOIN sizes s ON s.chrom = c.chrom WHERE gs < LEAST(ge, size)""",
    _GAPS,
)
def _(t):
    return I.bed_complement(t.iv_b, t.sizes)


@query(
    "W09_gaps_between",
    """SELECT chrom, s + 10 AS start, e - 10 AS "end" FROM (
         SELECT chrom, LAG(end_) OVER (PARTITION BY chrom ORDER BY start, end_) AS s, start AS e FROM iv_b) WHERE s + 10 < e - 10
       UNION ALL SELECT chrom, 0, start - 10 FROM (SELECT chrom, start FROM iv_b ORDER BY chrom, start LIMIT 1) WHERE start > 10""",
)
def _(t):
    return I.gaps_between(t.iv_b, pad=10)


@query(
    "W10_bed_extend",
    'SELECT iv_id, chrom, GREATEST(0, start - 130) AS start, LEAST(size, end_ + 170) AS "end" FROM iv_b JOIN sizes USING (chrom)',
)
def _(t):
    return iv(I.bed_extend(t.iv_b, t.sizes, flanks=100, up=30, down=70))


@query("W11_expand_regions", 'SELECT iv_id, chrom, GREATEST(0, start - 500) AS start, end_ + 500 AS "end" FROM iv_b')
def _(t):
    return iv(I.expand_regions(t.iv_b, 500))


@query(
    "W12_make_windows",
    'SELECT chrom, s AS start, LEAST(s + 700, size) AS "end" FROM (SELECT chrom, size, unnest(range(0, size, 300)) AS s FROM sizes)',
)
def _(t):
    return I.make_windows(t.sizes, 700, 300)


def _chunk_sql(first, last):
    return f"""
      SELECT chrom, {first} AS first_pos, {last} AS last_pos FROM (
        SELECT chrom, run, MIN(CASE WHEN NOT bad THEN pos END) AS f, MAX(CASE WHEN NOT bad THEN pos END) AS l, MAX(CASE WHEN bad THEN pos END) AS nb FROM (
          SELECT chrom, pos, n_missing_samples > 6 AS bad,
            MAX(CASE WHEN n_missing_samples > 6 THEN pos END) OVER (PARTITION BY chrom ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run
          FROM full_counts) GROUP BY chrom, run) WHERE f IS NOT NULL AND {last} - {first} > 150"""


def _missing(t):
    c = with_absent_missing(site_counts(t.g), t.samples)
    return c.select("chrom", "pos", F.col("n_missing_samples").alias("n_missing"))


@query("W13_nonmissing_chunks", _chunk_sql("f", "l"))
def _(t):
    return I.nonmissing_chunks(_missing(t), size=150, missing_count=6)


@query(
    "W14_chunk_extension",
    _chunk_sql("COALESCE(CAST(FLOOR((run + f + 1)/2) AS BIGINT), f)", "COALESCE(CAST(FLOOR((l + nb)/2) AS BIGINT), l)"),
)
def _(t):
    return I.nonmissing_chunks(_missing(t), size=150, missing_count=6, extend=True)


@query("W15_coordinates", "SELECT iv_id, start + 1 AS one_start, end_ AS one_end, start AS closed_start, end_ - 1 AS closed_end FROM iv_b")
def _(t):
    a = G.to_output_coordinates("start", "end", "one_based")
    b = G.to_output_coordinates("start", "end", "zero_closed")
    return t.iv_b.select("iv_id", a[0].alias("one_start"), a[1].alias("one_end"), b[0].alias("closed_start"), b[1].alias("closed_end"))


# ---- sampling --------------------------------------------------------------------------------------


def lottery(column="iv_id", mult=7919, seed=17, mod=100003):
    """Draw that any engine can repeat: arithmetic on the key instead of a hash function."""
    return ((F.col(column) * mult + seed) % mod) / F.lit(float(mod))


_DRAW = "((iv_id * 7919 + 17) % 100003)"


@query("M01_sample_rows", f"SELECT iv_id, chrom FROM iv_a ORDER BY {_DRAW}, iv_id LIMIT 500")
def _(t):
    return S.sample_rows(t.iv_a, 500, keys=["iv_id"], draw_col=lottery()).select("iv_id", "chrom")


_BINS = {
    "prices": "SELECT o_orderkey AS iv_id, o_totalprice AS x FROM orders",
    "ends": "SELECT MIN(x) AS lo, MAX(x) AS hi FROM prices",
    "binned": "SELECT iv_id, x, LEAST(GREATEST(CAST(CEIL((x - lo) / ((hi - lo) / 8e0)) AS INT), 1), 8) AS bin FROM prices, ends",
}


def _prices(t):
    return t.raw("orders").select(F.col("o_orderkey").alias("iv_id"), F.col("o_totalprice").alias("x"))


@query(
    "M02_sample_uniform_bins",
    f"SELECT iv_id, CAST(bin AS BIGINT) AS bin FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY bin ORDER BY {_DRAW}, iv_id) AS r FROM binned) WHERE r <= 40",
    _BINS,
)
def _(t):
    s = S.sample_uniform_bins(_prices(t), "x", 8, 320, keys=["iv_id"], draw_col=lottery())
    return s.select("iv_id", "bin")


@query("M02_uniform_bins", "SELECT bin, COUNT(*) AS n FROM (SELECT CAST(bin AS BIGINT) AS bin FROM binned) GROUP BY bin", _BINS)
def _(t):
    return S.with_uniform_bins(_prices(t), "x", 8).groupBy("bin").agg(F.count("*").alias("n"))


@query(
    "M03_statistic_column",
    "SELECT chrom, CAST(FLOOR(pos/1000) AS BIGINT) AS bin_start, ROUND(AVG(p_size), 6) AS mean FROM variants GROUP BY chrom, CAST(FLOOR(pos/1000) AS BIGINT)",
)
def _(t):
    bins = t.raw("part").select(
        F.concat(F.lit("chr"), (F.col("p_partkey") % 5 + 1).cast("string")).alias("chrom"),
        F.floor((F.floor(F.col("p_partkey") / 5) * 100 + F.col("p_size")) / 1000).alias("bin_start"),
        "p_size",
    )
    st = bins.groupBy("chrom", "bin_start").agg(F.avg("p_size").alias("MEAN_FST"))
    return st.select("chrom", "bin_start", F.col(S.statistic_column("windowed-weir-fst", st.columns)).alias("mean"))


@query("M04_bed_sample", f"SELECT iv_id FROM iv_b ORDER BY {_DRAW}, iv_id LIMIT 100")
def _(t):
    return S.bed_sample(t.iv_b, 100, keys=["iv_id"], draw_col=lottery()).select("iv_id")


_LOCI_OK = {
    "ok_loci": """SELECT l.iv_id, l.start, COUNT(*) AS n_sites FROM loci l JOIN variants v ON v.chrom = l.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_
      JOIN counts c ON c.variant_id = v.variant_id WHERE v.n_alleles = 2 AND length(v.ref) = 1 AND c.n_missing <= 2 AND LEAST(c.n_ref, c.n_alt) >= 2
      AND l.end_ - l.start >= 1000 GROUP BY l.iv_id, l.start HAVING COUNT(*) >= 5"""
}


@query("A17_informative_loci", "SELECT iv_id, n_sites FROM ok_loci", _LOCI_OK)
def _(t):
    return L.informative_loci(t.v, t.g, t.loci, min_sites=5, remove_missing=2).select("iv_id", "n_sites")


@query(
    "M05_random_informative_loci",
    "SELECT iv_id, n_sites FROM ok_loci ORDER BY (start * 31 + CAST(substr(iv_id, 4, 1) AS BIGINT) * 7 + 5) % 1009, iv_id LIMIT 7",
    _LOCI_OK,
)
def _(t):
    u = ((F.col("start") * 31 + F.substring("chrom", 4, 1).cast("long") * 7 + 5) % 1009) / F.lit(1009.0)
    out = L.informative_loci(t.v, t.g, t.loci, min_sites=5, remove_missing=2, rand_count=7, draw_col=u)
    return out.select("iv_id", "n_sites")


_NUM = "CAST(substr(sample, 2) AS BIGINT)"


@query(
    "M06_sample_pops",
    f"SELECT pop, sample FROM (SELECT pop, sample, ROW_NUMBER() OVER (PARTITION BY pop ORDER BY ({_NUM} * 37 + 11) % 101, sample) AS r FROM m3) WHERE r <= 2",
)
def _(t):
    u = ((F.substring("sample", 2, 9).cast("long") * 37 + 11) % 101) / F.lit(101.0)
    return M.sample_pops(t.m, 2, draw_col=u).select("pop", "sample")


@query(
    "M06_sample_with_replacement",
    """SELECT k, m.pop, m.sample FROM (SELECT pop, COUNT(*) AS size, unnest(range(1, 6)) AS k FROM m3 GROUP BY pop) d
       JOIN m3 m ON m.pop = d.pop AND m.sample_ix = (d.k * 7 + 3) % d.size""",
)
def _(t):
    drawn = M.sample_pops(t.m, 5, replace=True, draw_col=F.col("k") * 7 + 3)
    return drawn.select("k", "pop", "sample")


@query("M07_shuffle_regions", f"SELECT iv_id, chrom, start, {END} FROM iv_b")
def _(t):
    return iv(S.shuffle_regions(t.iv_b, draw_col=lottery()))


@query("M07_shuffle_places", _places_sql(f"(SELECT *, {_DRAW} AS d FROM iv_b)", "d", "d"))
def _(t):
    drawn = t.iv_b.withColumn("d", lottery())
    place = places(S.shuffle_regions(drawn, draw_col=F.col("d")), "d")
    return place.withColumn("d", F.round(F.col("d") * 100003).cast("long"))


# ---- regions to results --------------------------------------------------------------------------------


_BIN_ROWS = "SELECT chrom, CAST(FLOOR((pos - 1)/2500) AS BIGINT)*2500 + 1 AS s, AVG(p_size) AS x FROM variants GROUP BY 1, 2"


@query(
    "J09_statistic_bins",
    f"SELECT concat_ws(':', b.chrom, s, s + 2499) AS iv_id, v.variant_id FROM ({_BIN_ROWS}) b JOIN variants v ON v.chrom = b.chrom AND v.pos BETWEEN s AND s + 2499 WHERE x > 25",
)
def _(t):
    """The records of the bins of a statistic that are above a value."""
    start = (F.floor((F.col("pos") - 1) / 2500) * 2500 + 1).cast("long")
    sized = t.v.join(t.raw("part").select(F.col("p_partkey").alias("variant_id"), "p_size"), "variant_id")
    st = sized.groupBy(F.col("chrom").alias("CHROM"), start.alias("BIN_START")).agg(F.avg("p_size").alias("X"))
    st = st.filter("X > 25").withColumn("BIN_END", F.col("BIN_START") + 2499)
    return CS.extract_regions(t.v, CS.bins_as_regions(st)).select("iv_id", "variant_id")


@query(
    "J09_bucketed_sink",
    """SELECT l.iv_id, v.variant_id, v.pos, 'all' AS part FROM loci l JOIN variants v ON v.chrom = l.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_
       UNION ALL SELECT l.iv_id, v.variant_id, v.pos, 'some' FROM loci l JOIN variants v ON v.chrom = l.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_ WHERE l.iv_id IN ('chr1:0', 'chr3:0')""",
)
def _(t):
    """Written by region, read back as a whole and for two regions."""
    path = new_path(t.spark, "regions")
    CS.write_regions(CS.extract_regions(t.v, t.loci), path, 8)
    some = CS.read_regions(t.spark, path, ["chr1:0", "chr3:0"], 8).select("iv_id", "variant_id", "pos", F.lit("some").alias("part"))
    return t.spark.read.parquet(path).select("iv_id", "variant_id", "pos", F.lit("all").alias("part")).unionByName(some)
