"""Pairwise site operators (L): linkage disequilibrium and four-gamete blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from allelespan.operators import blocks as B
from allelespan.operators import ld as LD
from allelespan.plans.registry import query

_R = "(n*sxy - sx*sy)/NULLIF(SQRT(CAST(n*sxx - sx*sx AS DOUBLE)*CAST(n*syy - sy*sy AS DOUBLE)), 0)"


def _ld_views(near):
    return {
        "ranked": "SELECT *, ROW_NUMBER() OVER (PARTITION BY chrom ORDER BY pos, variant_id) AS rk, pos/1e4 AS cm FROM (SELECT DISTINCT variant_id, chrom, pos FROM genotypes WHERE a1 IS NOT NULL)",
        "near": f"SELECT x.variant_id AS vi, y.variant_id AS vj FROM ranked x JOIN ranked y ON x.chrom = y.chrom AND x.rk < y.rk AND {near}",
        "sums": """SELECT vi, vj, COUNT(*) AS n, SUM(x.a1+x.a2) AS sx, SUM(y.a1+y.a2) AS sy, SUM((x.a1+x.a2)*(x.a1+x.a2)) AS sxx,
            SUM((y.a1+y.a2)*(y.a1+y.a2)) AS syy, SUM((x.a1+x.a2)*(y.a1+y.a2)) AS sxy
          FROM near JOIN genotypes x ON x.variant_id = vi JOIN genotypes y ON y.variant_id = vj AND y.sample = x.sample
          WHERE x.a1 IS NOT NULL AND y.a1 IS NOT NULL GROUP BY vi, vj""",
        "stats": f"SELECT vi, vj, COALESCE(n, 0) AS n, {_R} AS r, sx, sy FROM near LEFT JOIN sums USING (vi, vj)",
    }


_KB = _ld_views("y.pos - x.pos <= 500")
_IJ = ["variant_id_i", "variant_id_j"]


@query("L01_ld_r2", "SELECT vi AS variant_id_i, vj AS variant_id_j, n, ROUND(r*r, 6) AS r2 FROM stats", _KB)
def _(t):
    return LD.ld_pairs(t.g, samples=t.samples, stat="r2", window_kb=0.5).select(*_IJ, "n", "r2")


@query("L01_ld_r", "SELECT vi AS variant_id_i, vj AS variant_id_j, ROUND(r, 6) + 0e0 AS r FROM stats", _KB)
def _(t):
    return LD.ld_pairs(t.g, samples=t.samples, stat="r", window_kb=0.5).select(*_IJ, "r")


@query(
    "L02_ld_window_snps_and_kb",
    "SELECT vi AS variant_id_i, vj AS variant_id_j, ROUND(r*r, 6) AS r2 FROM stats",
    _ld_views("y.rk - x.rk <= 5 AND y.pos - x.pos <= 450"),
)
def _(t):
    return LD.ld_pairs(t.g, samples=t.samples, window_snps=6, window_kb=0.45).select(*_IJ, "r2")


@query(
    "L02_ld_window_cm",
    "SELECT vi AS variant_id_i, vj AS variant_id_j, ROUND(r*r, 6) AS r2 FROM stats",
    _ld_views("y.cm - x.cm <= 3e-2"),
)
def _(t):
    return LD.ld_pairs(t.g, t.v, samples=t.samples, window_cm=0.03).select(*_IJ, "r2")


@query(
    "L03_ld_threshold_and_sites",
    "SELECT vi AS variant_id_i, vj AS variant_id_j, ROUND(r*r, 6) AS r2 FROM stats WHERE r*r >= 2e-1 AND vi IN (SELECT variant_id FROM variants WHERE filter = 'q10')",
    _KB,
)
def _(t):
    chosen = t.v.filter("filter = 'q10'").select("variant_id")
    return LD.ld_pairs(t.g, samples=t.samples, window_kb=0.5, min_r2=0.2, snps=chosen).select(*_IJ, "r2")


_HAPLO = {
    **_KB,
    "haps": "SELECT variant_id, sample, 0 AS hap, a1 AS a FROM genotypes WHERE a1 IS NOT NULL UNION ALL SELECT variant_id, sample, 1, a2 FROM genotypes WHERE a1 IS NOT NULL",
    "hp": "SELECT vi, vj, COUNT(*) AS n, AVG(x.a*y.a) AS pab, AVG(x.a) AS pa, AVG(y.a) AS pb FROM near JOIN haps x ON x.variant_id = vi JOIN haps y ON y.variant_id = vj AND y.sample = x.sample AND y.hap = x.hap GROUP BY vi, vj",
    "dd": "SELECT vi, vj, pab - pa*pb AS d, CASE WHEN pab - pa*pb > 0 THEN LEAST(pa*(1-pb), (1-pa)*pb) ELSE LEAST(pa*pb, (1-pa)*(1-pb)) END AS top FROM hp",
}


@query(
    "L04_ld_d_prime",
    "SELECT vi AS variant_id_i, vj AS variant_id_j, ROUND(d, 6) + 0e0 AS d, ROUND(ABS(d/NULLIF(top, 0)), 6) AS d_prime, ROUND(d/NULLIF(top, 0), 6) + 0e0 AS d_prime_signed FROM near LEFT JOIN dd USING (vi, vj)",
    _HAPLO,
)
def _(t):
    return _d_prime(t, F.lit(True))


def _d_prime(t, phased):
    g = t.g.withColumn("phased", phased)
    return LD.ld_pairs(g, samples=t.samples, window_kb=0.5, d=True).select(*_IJ, "d", "d_prime", "d_prime_signed")


def _em_views(phased):
    """Haplotype counts of unphased calls; double heterozygotes that are not ``phased`` are shared out step by step."""
    known = f"({phased})"
    return {
        **_KB,
        "cells": f"""SELECT vi, vj, COUNT(*) AS n, SUM(gx) AS sx, SUM(gy) AS sy, SUM(CASE WHEN dh THEN CASE WHEN {known} AND c THEN 1 ELSE 0 END WHEN gx = 2 THEN gy WHEN gy = 2 THEN gx ELSE 0 END) AS h11,
             SUM(CASE WHEN dh THEN CASE WHEN {known} AND NOT c THEN 1 ELSE 0 END WHEN gx = 2 THEN 2 - gy WHEN gy = 0 THEN gx ELSE 0 END) AS h10,
             SUM(CASE WHEN dh THEN CASE WHEN {known} AND NOT c THEN 1 ELSE 0 END WHEN gy = 2 THEN 2 - gx WHEN gx = 0 THEN gy ELSE 0 END) AS h01,
             SUM(CASE WHEN dh THEN CASE WHEN {known} AND c THEN 1 ELSE 0 END WHEN gx = 0 THEN 2 - gy WHEN gy = 0 THEN 2 - gx ELSE 0 END) AS h00,
             SUM(CASE WHEN dh AND NOT {known} THEN 1 ELSE 0 END) AS dh
           FROM (SELECT vi, vj, x.sample, x.a1 + x.a2 AS gx, y.a1 + y.a2 AS gy, x.a1 + x.a2 = 1 AND y.a1 + y.a2 = 1 AS dh, x.a1 = y.a1 AS c
             FROM near JOIN genotypes x ON x.variant_id = vi JOIN genotypes y ON y.variant_id = vj AND y.sample = x.sample WHERE x.a1 IS NOT NULL AND y.a1 IS NOT NULL)
           GROUP BY vi, vj""",
        "freqs": f"""SELECT vi, vj, sx/(2e0*n) AS pa, sy/(2e0*n) AS pb, (h11 + x)/(2e0*n) AS pab FROM (
             WITH RECURSIVE em AS (SELECT *, 0 AS k, dh/2e0 AS x FROM cells UNION ALL
               SELECT * REPLACE (k + 1 AS k, COALESCE(dh*(h11 + x)*(h00 + x)/NULLIF((h11 + x)*(h00 + x) + (h10 + dh - x)*(h01 + dh - x), 0), x) AS x) FROM em WHERE k < {LD.EM_STEPS})
             SELECT * FROM em WHERE k = {LD.EM_STEPS})""",
        "dd": "SELECT vi, vj, pab - pa*pb AS d, CASE WHEN pab - pa*pb > 0 THEN LEAST(pa*(1-pb), (1-pa)*pb) ELSE LEAST(pa*pb, (1-pa)*(1-pb)) END AS top FROM freqs",
    }


_D_PRIME = "SELECT vi AS variant_id_i, vj AS variant_id_j, ROUND(d, 6) + 0e0 AS d, ROUND(ABS(d/NULLIF(top, 0)), 6) AS d_prime, ROUND(d/NULLIF(top, 0), 6) + 0e0 AS d_prime_signed FROM near LEFT JOIN dd USING (vi, vj)"


@query("L04_d_prime_unphased", _D_PRIME, _em_views("FALSE"))
def _(t):
    """Calls without phase: haplotypes of double heterozygotes by expectation maximisation."""
    return LD.ld_pairs(t.g, samples=t.samples, window_kb=0.5, d=True).select(*_IJ, "d", "d_prime", "d_prime_signed")


@query("L04_d_prime_partly_phased", _D_PRIME, _em_views("CAST(substr(sample, 2) AS INT) % 2 = 0"))
def _(t):
    """Every second sample is phased."""
    return _d_prime(t, F.substring("sample", 2, 9).cast("int") % 2 == 0)


@query(
    "L05_ld_phase_and_maf",
    """SELECT vi AS variant_id_i, vj AS variant_id_j, CASE WHEN r > 0 THEN concat(x.ref, y.ref, '/', x.alt, y.alt) WHEN r < 0 THEN concat(x.ref, y.alt, '/', x.alt, y.ref) END AS phase,
         ROUND(LEAST(sx/(2e0*n), 1 - sx/(2e0*n)), 6) AS maf_i, ROUND(LEAST(sy/(2e0*n), 1 - sy/(2e0*n)), 6) AS maf_j
       FROM stats JOIN variants x ON x.variant_id = vi JOIN variants y ON y.variant_id = vj WHERE n > 0 AND ABS(r) > 1e-9""",
    _KB,
)
def _(t):
    pairs = LD.ld_pairs(t.g, t.v, samples=t.samples, stat="r", window_kb=0.5, in_phase=True, maf=True)
    return pairs.filter("abs(r) > 1e-9").select(*_IJ, "phase", "maf_i", "maf_j")


@query(
    "L06_ld_matrix_triangle",
    "SELECT y.chrom, y.rk - 1 AS row, COUNT(vi) + 1 AS n_cells, COALESCE(MIN(x.rk), y.rk) - 1 AS first_col FROM ranked y LEFT JOIN near ON vj = y.variant_id LEFT JOIN ranked x ON x.variant_id = vi GROUP BY y.chrom, y.rk",
    _KB,
)
def _(t):
    m = LD.ld_matrix(LD.ld_pairs(t.g, samples=t.samples, window_kb=0.5), _called(t), "triangle")
    return m.select("chrom", "row", "first_col", F.size(F.split("line", "\t")).alias("n_cells"))


def _called(t):
    return t.g.filter("a1 is not null").select("variant_id", "chrom", "pos").distinct()



@query(
    "L06_ld_matrix_square",
    """SELECT chrom, row, COUNT(*) AS n_cells, MIN(c) AS first_col FROM (
         SELECT x.chrom, x.rk - 1 AS row, y.rk - 1 AS c FROM near JOIN ranked x ON x.variant_id = vi JOIN ranked y ON y.variant_id = vj
         UNION ALL SELECT x.chrom, y.rk - 1, x.rk - 1 FROM near JOIN ranked x ON x.variant_id = vi JOIN ranked y ON y.variant_id = vj
         UNION ALL SELECT chrom, rk - 1, rk - 1 FROM ranked) GROUP BY chrom, row""",
    _KB,
)
def _(t):
    m = LD.ld_matrix(LD.ld_pairs(t.g, samples=t.samples, window_kb=0.5), _called(t), "square")
    return m.select("chrom", "row", "first_col", F.size(F.split("line", "\t")).alias("n_cells"))


@query(
    "L06_ld_matrix_threshold",
    """SELECT g.chrom, g.row, g.col, CASE WHEN v IS NOT NULL THEN ROUND(v + 1e-9, 4) WHEN g.col > g.row THEN 0e0 END AS value FROM grid g LEFT JOIN cells USING (chrom, row, col)""",
    {
        **_KB,
        "hits": "SELECT x.chrom, x.rk - 1 AS i, y.rk - 1 AS j, ROUND(r*r, 6) AS r2 FROM stats JOIN ranked x ON x.variant_id = vi JOIN ranked y ON y.variant_id = vj WHERE r*r >= 2.137e-1",
        "cells": "SELECT chrom, j AS row, i AS col, r2 AS v FROM hits UNION ALL SELECT chrom, i, j, 0e0 FROM hits UNION ALL SELECT chrom, rk - 1, rk - 1, 1e0 FROM ranked",
        "grid": "SELECT chrom, row, unnest(generate_series(MIN(col), MAX(col))) AS col FROM cells GROUP BY chrom, row",
    },
)
def _(t):
    """Every value of a thresholded matrix, with its place."""
    pairs = LD.ld_pairs(t.g, samples=t.samples, window_kb=0.5, min_r2=0.2137)
    m = LD.ld_matrix(pairs, _called(t), "square-zero")
    cells = m.select("chrom", "row", "first_col", F.posexplode(F.split("line", "\t")).alias("k", "x"))
    value = F.when(F.col("x") != "nan", F.round(F.col("x").cast("double") + 1e-9, 4))
    return cells.select("chrom", "row", (F.col("first_col") + F.col("k")).alias("col"), value.alias("value"))


# ---- four-gamete blocks ----------------------------------------------------------------------------

_POLY = {
    "haps": "SELECT variant_id, sample, 0 AS hap, a1 AS a FROM genotypes WHERE a1 IS NOT NULL UNION ALL SELECT variant_id, sample, 1, a2 FROM genotypes WHERE a1 IS NOT NULL",
    "stats": """SELECT l.iv_id, v.variant_id, v.pos, c.n_ref, c.n_alt, LEAST(c.n_ref, c.n_alt) > 1 AS informative FROM variants v JOIN counts c USING (variant_id)
       JOIN loci l ON l.chrom = v.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_ WHERE length(v.ref) = 1 AND n_ref > 0 AND n_alt > 0""",
    "inf": "SELECT *, ROW_NUMBER() OVER (PARTITION BY iv_id ORDER BY pos, variant_id) - 1 AS rk FROM stats WHERE informative",
    "gam": """SELECT x.iv_id, x.rk AS i, y.rk AS j, p.a AS ai, q.a AS aj, COUNT(*) AS nij,
          MAX(CASE p.a WHEN 0 THEN x.n_ref ELSE x.n_alt END) AS ni, MAX(CASE q.a WHEN 0 THEN y.n_ref ELSE y.n_alt END) AS nj
        FROM inf x JOIN inf y ON x.iv_id = y.iv_id AND x.rk < y.rk
        JOIN haps p ON p.variant_id = x.variant_id JOIN haps q ON q.variant_id = y.variant_id AND q.sample = p.sample AND q.hap = p.hap
        GROUP BY x.iv_id, x.rk, y.rk, p.a, q.a""",
    "clash": "SELECT iv_id, i, j FROM gam WHERE ni > 1 AND nj > 1 AND nij < ni AND nij < nj GROUP BY iv_id, i, j HAVING COUNT(*) >= 4",
    "f": "SELECT inf.iv_id, inf.rk, inf.pos, MIN(j) AS conflict FROM inf LEFT JOIN clash c ON c.iv_id = inf.iv_id AND c.i = inf.rk GROUP BY inf.iv_id, inf.rk, inf.pos",
    "reach": "SELECT *, MIN(conflict) OVER (PARTITION BY iv_id ORDER BY rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reach, MAX(rk) OVER (PARTITION BY iv_id) AS fin FROM f",
    "ends": "SELECT iv_id, rk AS first, COALESCE(reach - 1, fin) AS last, fin, LAG(COALESCE(reach - 1, fin)) OVER (PARTITION BY iv_id ORDER BY rk) AS before FROM reach",
    "full_blocks": "SELECT iv_id, first, last, fin FROM ends WHERE before IS NULL OR last > before",
    "cut_blocks": "SELECT iv_id, COALESCE(LAG(last) OVER (PARTITION BY iv_id ORDER BY first) + 1, first) AS first, last, fin FROM full_blocks",
}


def _span(src, wide):
    at = "(SELECT pos FROM inf WHERE inf.iv_id = b.iv_id AND inf.rk = {r})"
    first, last, nxt = at.format(r="b.first"), at.format(r="b.last"), at.format(r="b.last + 1")
    prev = at.format(r="b.first - 1")
    if wide:
        start = f"CASE WHEN b.first = 0 THEN {first} ELSE {prev} + 1 END"
        end = f"CASE WHEN b.last = b.fin THEN {last} ELSE {nxt} - 1 END"
    else:
        start = first
        end = f"CASE WHEN b.last = b.fin THEN {last} ELSE {nxt} END - 1"
    return f"SELECT b.iv_id, {start} AS start, {end} AS end_, b.last - b.first + 1 AS n_informative FROM {src} b"


_BLOCKS = {**_POLY, "wide": _span("full_blocks", True), "narrow": _span("cut_blocks", False)}
_OUT = 'iv_id, start, end_ AS "end", n_informative'


def poly(t):
    return B.polymorphic_sites(t.v, t.g, t.loci, t.samples, include_missing=True)


def blocks(t):
    return B.compatible_intervals(poly(t), overlap_inf=True, overlap_noninf=True)


@query("L07_polymorphic_sites", "SELECT iv_id, variant_id, informative FROM stats", _POLY)
def _(t):
    return poly(t).select("iv_id", "variant_id", "informative")


@query(
    "L07_complete_sites",
    "SELECT iv_id, s.variant_id FROM stats s JOIN counts USING (variant_id) WHERE n_called >= 2*(SELECT COUNT(*) FROM m3)",
    _POLY,
)
def _(t):
    return B.polymorphic_sites(t.v, t.g, t.loci, t.samples, only_two=True).select("iv_id", "variant_id")


@query(
    "L08_four_gamete_test",
    "SELECT f.iv_id, x.variant_id AS variant_id_i, y.variant_id AS variant_id_j FROM f JOIN inf x ON x.iv_id = f.iv_id AND x.rk = f.rk JOIN inf y ON y.iv_id = f.iv_id AND y.rk = f.conflict",
    _POLY,
)
def _(t):
    """The first later site of the region that is incompatible, for every site that has one."""
    return B.first_incompatible(poly(t)).select("iv_id", *_IJ)


@query("L09_compatible_intervals", f"SELECT {_OUT} FROM wide", _BLOCKS)
def _(t):
    return blocks(t)


@query("L10_interval_end_rules", f"SELECT {_OUT} FROM narrow", _BLOCKS)
def _(t):
    return B.compatible_intervals(poly(t))


@query(
    "L11_hk_min_intervals",
    """SELECT iv_id, start, end_ AS "end" FROM (
        WITH RECURSIVE minimal AS (SELECT iv_id, rk, conflict FROM f x WHERE conflict IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM f y WHERE y.iv_id = x.iv_id AND y.rk > x.rk AND y.conflict <= x.conflict)),
          chain AS (SELECT iv_id, rk, conflict FROM (SELECT *, MIN(rk) OVER (PARTITION BY iv_id) AS lo FROM minimal) WHERE rk = lo
            UNION ALL SELECT m.iv_id, m.rk, m.conflict FROM chain c JOIN minimal m ON m.iv_id = c.iv_id AND m.rk >= c.conflict
              AND NOT EXISTS (SELECT 1 FROM minimal z WHERE z.iv_id = c.iv_id AND z.rk >= c.conflict AND z.rk < m.rk))
        SELECT c.iv_id, x.pos AS start, y.pos + 1 AS end_ FROM chain c JOIN f x ON x.iv_id = c.iv_id AND x.rk = c.rk JOIN f y ON y.iv_id = c.iv_id AND y.rk = c.conflict)""",
    _POLY,
)
def _(t):
    return B.hk_min_intervals(poly(t))


@query("L12_informative_counts", "SELECT iv_id, n_informative, COUNT(*) AS n FROM wide GROUP BY iv_id, n_informative", _BLOCKS)
def _(t):
    return blocks(t).groupBy("iv_id", "n_informative").agg(F.count("*").alias("n"))


_PICK = {
    **_BLOCKS,
    "left_block": "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY iv_id ORDER BY start, end_) AS r FROM wide WHERE n_informative >= 2) WHERE r = 1",
}


@query(
    "L13_block_records",
    "SELECT b.iv_id, v.variant_id FROM left_block b JOIN loci l ON l.iv_id = b.iv_id JOIN variants v ON v.chrom = l.chrom AND v.pos BETWEEN b.start AND b.end_",
    _PICK,
)
def _(t):
    picked = B.pick_interval(blocks(t), "left", min_inf=2)
    return B.block_records(t.v, picked, t.loci).select("iv_id", "variant_id")


@query("M08_pick_left", f"SELECT {_OUT} FROM left_block", _PICK)
def _(t):
    return B.pick_interval(blocks(t), "left", min_inf=2)


@query(
    "M08_pick_right",
    f"SELECT {_OUT} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY iv_id ORDER BY start DESC, end_ DESC) AS r FROM wide WHERE n_informative >= 2) WHERE r = 1",
    _BLOCKS,
)
def _(t):
    return B.pick_interval(blocks(t), "right", min_inf=2)


_U = "((start * 37 + 11) % 1009)"


@query("M08_pick_random", f"SELECT {_OUT} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY iv_id ORDER BY {_U}, start) AS r FROM wide) WHERE r = 1", _BLOCKS)
def _(t):
    return B.pick_interval(blocks(t), "random", draw_col=((F.col("start") * 37 + 11) % 1009) / F.lit(1009.0))


@query(
    "M08_pick_random_base",
    f"""SELECT {_OUT} FROM (SELECT *, COALESCE(SUM(end_ - start + 1) OVER (PARTITION BY iv_id ORDER BY start, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum,
          CAST(FLOOR(((CAST(split_part(iv_id, ':', 2) AS BIGINT) * 37 + 11) % 1009) / 1009e0 * SUM(end_ - start + 1) OVER (PARTITION BY iv_id)) AS BIGINT) + 1 AS target FROM wide)
        WHERE cum < target AND target <= cum + end_ - start + 1""",
    _BLOCKS,
)
def _(t):
    u = ((F.split("iv_id", ":")[1].cast("long") * 37 + 11) % 1009) / F.lit(1009.0)
    return B.pick_interval(blocks(t), "random_base", draw_col=u)


@query(
    "M08_pick_most_informative",
    f"SELECT {_OUT} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY iv_id ORDER BY n_informative DESC, start) AS r FROM wide) WHERE r = 1",
    _BLOCKS,
)
def _(t):
    return B.pick_interval(blocks(t), "most_informative")
