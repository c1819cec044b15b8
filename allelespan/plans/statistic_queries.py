"""Aggregations and statistics (A) and site-frequency spectra (Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from allelespan.functions import genome as G
from allelespan.functions import predicates as P
from allelespan.operators import blocks as B
from allelespan.operators import counts as C
from allelespan.operators import diversity as D
from allelespan.operators import fstats as FS
from allelespan.operators import loci as L
from allelespan.operators import sequence as Q
from allelespan.operators import sfs as S
from allelespan.operators.siterows import site_rows
from allelespan.plans.registry import query

SNP_PASS = "length(ref) = 1 AND n_alleles = 2 AND filter = 'PASS'"


def snp_calls(t):
    """Calls at biallelic PASS SNPs."""
    keep = t.v.filter(P.only_biallelic() & P.passed()).select("variant_id")
    return t.g.join(keep, "variant_id", "left_semi")


def snp_sites(t):
    """The same as site rows."""
    return t.sites.of_sites(t.v.filter(P.only_biallelic() & P.passed()))


_COLS = "n_called, n_ref, n_alt, n_missing, n_full, n_het, n_hom_ref, n_hom_alt, n_missing_samples"


@query("A01_allele_counts", f"SELECT variant_id, chrom, pos, {_COLS} FROM counts")
def _(t):
    return C.site_counts(t.sites).select("variant_id", "chrom", "pos", *_COLS.split(", "))


@query("A01_allele_counts_by_pop", "SELECT variant_id, pop, 2*n AS n_called, alt AS n_alt, het AS n_het FROM pcounts")
def _(t):
    return C.site_counts(C.with_population(t.sites, t.m), ["pop"]).select("variant_id", "pop", "n_called", "n_alt", "n_het")


@query("A01_allele_copies", "SELECT variant_id, CAST(a AS BIGINT) AS allele, COUNT(*) AS n FROM (SELECT variant_id, a1 AS a FROM genotypes UNION ALL SELECT variant_id, a2 FROM genotypes) GROUP BY variant_id, a")
def _(t):
    return C.allele_counts(t.sites).select("variant_id", "allele", "n")


@query(
    "A02_freq",
    """SELECT variant_id, CAST(n_alleles AS BIGINT) AS n_alleles, COALESCE(n_called, 0) AS n_chr, CAST(ix - 1 AS BIGINT) AS allele_ix,
         list[ix] AS allele, CASE WHEN COALESCE(n_called, 0) > 0 THEN ROUND(CASE ix WHEN 1 THEN n_ref WHEN 2 THEN n_alt ELSE 0 END / CAST(n_called AS DOUBLE), 6) END AS freq
       FROM (SELECT variant_id, n_alleles, list, unnest(range(1, len(list) + 1)) AS ix
             FROM (SELECT variant_id, n_alleles, list_concat([ref], string_split(alts, ',')) AS list FROM variants))
       LEFT JOIN counts USING (variant_id)""",
)
def _(t):
    return D.freq(t.v, t.sites).drop("chrom", "pos")


@query("A03_site_pi", "SELECT variant_id, chrom, pos, CASE WHEN n_called > 0 THEN ROUND(2e0*n_alt*n_ref/(n_called*(n_called-1)), 6) END AS pi FROM counts")
def _(t):
    return D.site_pi(t.sites)


_BINS = """SELECT *, k*{step} + 1 AS bin_start, k*{step} + {size} AS bin_end FROM (
   SELECT *, unnest(range(GREATEST(0, CAST(FLOOR((pos - 1 - {size})/{step}e0) AS BIGINT) + 1), CAST(FLOOR((pos - 1)/{step}) AS BIGINT) + 1)) AS k FROM {src})"""


@query(
    "A04_window_pi",
    f"""SELECT chrom, bin_start, bin_end, COUNT(*) AS n_variants,
          ROUND(SUM(2e0*n_alt*n_ref) / (SUM(1e0*n_called*(n_called-1)) + (2000 - COUNT(*))*nn*(nn-1)), 6) AS pi
        FROM ({_BINS.format(size=2000, step=1000, src='counts')}), (SELECT 2e0*COUNT(*) AS nn FROM m3) GROUP BY chrom, bin_start, bin_end, nn""",
)
def _(t):
    return D.window_pi(t.sites, t.samples, 2000, 1000)


@query(
    "A05_tajima_d",
    """SELECT chrom, bin_start, n_snps, CASE WHEN n_snps > 0 THEN ROUND((het*n/(n-1) - n_snps/a1) / NULLIF(SQRT(e1*n_snps + e2*n_snps*(n_snps-1)), 0), 6) END AS tajima_d
       FROM (SELECT g.chrom, g.bin_start, COALESCE(b.n_snps, 0) AS n_snps, het FROM grid g LEFT JOIN bins b USING (chrom, bin_start)), k""",
    {
        "bins": """SELECT chrom, CAST(FLOOR(pos/1500) AS BIGINT)*1500 AS bin_start, COUNT(*) AS n_snps, SUM(2e0*n_alt*n_ref/(n_called*n_called)) AS het
          FROM counts WHERE n_alt > 0 AND n_ref > 0 GROUP BY chrom, CAST(FLOOR(pos/1500) AS BIGINT)""",
        "grid": "SELECT chrom, unnest(range(lo, hi + 1, 1500)) AS bin_start FROM (SELECT chrom, MIN(bin_start) AS lo, MAX(bin_start) AS hi FROM bins GROUP BY chrom)",
        "sums": "SELECT n, SUM(1e0/i) AS a1, SUM(1e0/(i*i)) AS a2 FROM (SELECT n, unnest(range(1, CAST(n AS BIGINT))) AS i FROM (SELECT 2e0*COUNT(*) AS n FROM m3)) GROUP BY n",
        "k": """SELECT n, a1, ((n+1)/(3*(n-1)) - 1/a1)/a1 AS e1,
           (2*(n*n+n+3)/(9*n*(n-1)) - (n+2)/(a1*n) + a2/(a1*a1))/(a1*a1 + a2) AS e2 FROM sums""",
    },
)
def _(t):
    return D.tajima_d(t.sites, t.samples, 1500)


def _wc(by):
    by_ = "".join(f", {b}" for b in by)
    return f"""
      SELECT variant_id, chrom, pos{by_}, a, b, c, a + b + c AS total, CASE WHEN ABS(a + b + c) > 1e-12 THEN a/(a + b + c) END AS fst FROM (
       SELECT variant_id, chrom, pos{by_}, (nbar/nc)*(s2 - (pbar*(1-pbar) - s2*(r-1)/r - hbar/4)/(nbar-1)) AS a,
        (nbar/(nbar-1))*(pbar*(1-pbar) - s2*(r-1)/r - hbar*(2*nbar-1)/(4*nbar)) AS b, hbar/2 AS c FROM (
        SELECT *, (snpp - sn*pbar*pbar)/((r-1)*nbar) AS s2 FROM (
         SELECT variant_id, chrom, pos{by_}, r, sn, snpp, sn/r AS nbar, (sn - snn/sn)/(r-1) AS nc, snp/sn AS pbar, snh/sn AS hbar FROM (
          SELECT variant_id, chrom, pos{by_}, CAST(COUNT(*) AS DOUBLE) AS r, CAST(SUM(n) AS DOUBLE) AS sn, CAST(SUM(n*n) AS DOUBLE) AS snn,
           SUM(alt/2e0) AS snp, SUM(alt*alt/(4e0*n)) AS snpp, CAST(SUM(het) AS DOUBLE) AS snh
          FROM {{src}} WHERE n > 0 GROUP BY variant_id, chrom, pos{by_}) WHERE r > 1 AND sn > r)))"""


_SNPCOUNTS = {"sp": f"SELECT p.* FROM pcounts p JOIN variants v USING (variant_id) WHERE {SNP_PASS}"}
_FST = {**_SNPCOUNTS, "wc": _wc([]).format(src="sp")}
_PAIRS = {
    **_SNPCOUNTS,
    "pops": "SELECT DISTINCT pop, pop_ix FROM m3",
    "pop_pairs": "SELECT concat(x.pop, '_', y.pop) AS pair, x.pop AS p1, y.pop AS p2 FROM pops x JOIN pops y ON x.pop_ix < y.pop_ix",
    "spp": "SELECT sp.*, pair FROM sp JOIN pop_pairs ON sp.pop = p1 OR sp.pop = p2",
    "wcp": _wc(["pair"]).format(src="spp"),
}


@query("A06_weir_fst", "SELECT variant_id, chrom, pos, ROUND(fst, 6) + 0e0 AS fst FROM wc", _FST)
def _(t):
    return D.weir_fst(snp_sites(t), t.m)


_WFST = "COUNT(*) AS n_variants, ROUND(SUM(a)/SUM(total), 6) + 0e0 AS weighted_fst, ROUND(AVG(fst), 6) + 0e0 AS mean_fst"


@query(
    "A07_windowed_weir_fst",
    f"SELECT chrom, bin_start, bin_end, {_WFST} FROM ({_BINS.format(size=2000, step=2000, src='(SELECT * FROM wc WHERE fst IS NOT NULL)')}) GROUP BY chrom, bin_start, bin_end",
    _FST,
)
def _(t):
    return D.windowed_weir_fst(snp_sites(t), t.m, 2000)


@query("A08_pairwise_fst", "SELECT variant_id, pair, ROUND(fst, 6) + 0e0 AS fst FROM wcp", _PAIRS)
def _(t):
    return D.pairwise_weir_fst(snp_sites(t), t.m).select("variant_id", "pair", "fst")


@query(
    "A08_pairwise_windowed_fst",
    f"SELECT pair, chrom, bin_start, bin_end, {_WFST} FROM ({_BINS.format(size=2000, step=500, src='(SELECT * FROM wcp WHERE fst IS NOT NULL)')}) GROUP BY pair, chrom, bin_start, bin_end",
    _PAIRS,
)
def _(t):
    return D.pairwise_windowed_weir_fst(snp_sites(t), t.m, 2000, 500)


_POOLED = {
    **_PAIRS,
    "pooled": "SELECT variant_id, chrom, pos, pair, CAST(2*SUM(n) AS BIGINT) AS n, CAST(SUM(alt) AS BIGINT) AS c FROM pcounts JOIN pop_pairs ON pop = p1 OR pop = p2 GROUP BY variant_id, chrom, pos, pair",
}


@query("A08_pairwise_site_pi", "SELECT variant_id, pair, CASE WHEN n > 0 THEN ROUND(2e0*c*(n-c)/(n*(n-1)), 6) END AS pi FROM pooled", _POOLED)
def _(t):
    return D.pairwise_site_pi(t.sites, t.m).select("variant_id", "pair", "pi")


@query(
    "A08_pairwise_window_pi",
    f"""SELECT pair, chrom, bin_start, bin_end, COUNT(*) AS n_variants, ROUND(SUM(2e0*c*(n-c)) / (SUM(1e0*n*(n-1)) + (2000 - COUNT(*))*nn*(nn-1)), 6) AS pi
        FROM ({_BINS.format(size=2000, step=2000, src='pooled')}) JOIN (SELECT pair, 2e0*COUNT(*) AS nn FROM m3 JOIN pop_pairs ON pop = p1 OR pop = p2 GROUP BY pair) USING (pair)
        GROUP BY pair, chrom, bin_start, bin_end, nn""",
    _POOLED,
)
def _(t):
    return D.pairwise_window_pi(t.sites, t.m, 2000)


def _het(by):
    part = "variant_id" + "".join(f", {b}" for b in by)
    cols = "sample" + "".join(f", {b}" for b in by)
    return f"""SELECT {cols}, o_hom, ROUND(e_hom, 6) AS e_hom, n_sites, ROUND((o_hom - e_hom)/NULLIF(n_sites - e_hom, 0), 6) + 0e0 AS f FROM (
      SELECT {cols}, COUNT(CASE WHEN a1 = a2 THEN 1 END) AS o_hom, SUM(1 - 2*(c/n)*(1 - c/n)*n/(n-1)) AS e_hom, COUNT(*) AS n_sites FROM (
        SELECT *, 2e0*COUNT(*) OVER (PARTITION BY {part}) AS n, CAST(SUM(a1 + a2) OVER (PARTITION BY {part}) AS DOUBLE) AS c FROM (
          SELECT g.*, pop FROM genotypes g JOIN m3 USING (sample)) WHERE a1 IS NOT NULL) WHERE c > 0 AND c < n GROUP BY {cols})"""


@query("A09_het_fit", _het([]))
def _(t):
    return D.het_fit(t.sites)


@query("A10_het_fis", _het(["pop"]))
def _(t):
    return D.het_fis(t.sites, t.m)


@query(
    "A11_hardy_weinberg",
    """SELECT variant_id, n_hom_ref, n_het, n_hom_alt, ROUND(e0, 6) AS e_hom_ref, ROUND(e1, 6) AS e_het, ROUND(e2, 6) AS e_hom_alt,
         ROUND(COALESCE((n_hom_ref-e0)*(n_hom_ref-e0)/NULLIF(e0,0), 0) + COALESCE((n_het-e1)*(n_het-e1)/NULLIF(e1,0), 0) + COALESCE((n_hom_alt-e2)*(n_hom_alt-e2)/NULLIF(e2,0), 0), 6) AS chisq,
         ROUND(LEAST(p, 1), 6) AS p_exact
       FROM (SELECT *, n_full*q*q AS e0, 2*n_full*(1-q)*q AS e1, n_full*(1-q)*(1-q) AS e2 FROM (SELECT *, n_ref/CAST(n_called AS DOUBLE) AS q FROM counts WHERE n_full > 0))
       JOIN exact_p USING (variant_id)""",
    {
        # P(h) = N! / (hom1! h! hom2!) 2^h / C(2N, n1), straight from the definition
        "logs": """SELECT variant_id, n_het, h, lgamma(n_full+1) - lgamma((n_ref-h)/2+1) - lgamma(h+1) - lgamma((n_alt-h)/2+1) + h*ln(2e0)
             - (lgamma(2*n_full+1) - lgamma(n_ref+1) - lgamma(n_alt+1)) AS l
           FROM (SELECT *, unnest(range(LEAST(n_ref, n_alt) % 2, LEAST(n_ref, n_alt) + 1, 2)) AS h FROM counts WHERE n_full > 0)""",
        "seen": "SELECT variant_id, l AS ls FROM logs WHERE h = n_het",
        "exact_p": "SELECT variant_id, SUM(CASE WHEN l <= ls + 1e-7 THEN exp(l) ELSE 0 END) AS p FROM logs JOIN seen USING (variant_id) GROUP BY variant_id",
    },
)
def _(t):
    return D.hardy_weinberg(t.sites).drop("chrom", "pos")


@query("A01_allele_counts_long", f"SELECT variant_id, chrom, pos, {_COLS} FROM counts")
def _(t):
    return C.site_counts(t.g).select("variant_id", "chrom", "pos", *_COLS.split(", "))


@query("A01_site_rows_and_back", "SELECT variant_id, chrom, pos, sample, CAST(a1 AS BIGINT) AS a1, CAST(a2 AS BIGINT) AS a2 FROM genotypes WHERE sample IN (SELECT sample FROM m2)")
def _(t):
    """Long calls to site rows, some samples of them, and back."""
    return site_rows(t.g, t.sites.who).of_samples(t.m2).long().select("variant_id", "chrom", "pos", "sample", "a1", "a2")


@query("A08_pairwise_fst_long", "SELECT variant_id, pair, ROUND(fst, 6) + 0e0 AS fst FROM wcp", _PAIRS)
def _(t):
    return D.pairwise_weir_fst(snp_calls(t), t.m).select("variant_id", "pair", "fst")


@query("A09_het_fit_long", _het([]))
def _(t):
    return D.het_fit(t.g)


@query("A10_het_fis_long", _het(["pop"]))
def _(t):
    return D.het_fis(t.g, t.m)


@query("F34_drop_undefined", "SELECT chrom, bin_start, pi FROM (SELECT chrom, CAST(FLOOR(pos/1000) AS BIGINT) AS bin_start, ROUND(AVG(CASE WHEN n_called > 0 AND n_missing <= 2 THEN 2e0*n_alt*n_ref/(n_called*(n_called-1)) END), 6) AS pi FROM counts GROUP BY 1, 2) WHERE pi IS NOT NULL")
def _(t):
    c = C.site_counts(t.g)
    pi = D.ratio(D.mismatches(F.col("n_alt"), F.col("n_called")), F.col("n_called") * (F.col("n_called") - 1))
    start = F.floor(F.col("pos") / 1000).cast("long").alias("bin_start")
    st = c.groupBy("chrom", start).agg(F.avg(F.when(F.col("n_missing") <= 2, pi)).alias("pi"))
    return D.drop_undefined(st, "pi")


# ---- admixture statistics ------------------------------------------------------------------------

_FREQS = {
    "pf": """SELECT variant_id, chrom, CAST(FLOOR(pos/4000) AS BIGINT) AS block, pop, 2e0*COUNT(a1) AS n, (2e0*COUNT(a1) - SUM(a1+a2))/NULLIF(2e0*COUNT(a1), 0) AS p
       FROM genotypes JOIN m5 USING (sample) GROUP BY variant_id, chrom, pos, pop""",
    "wide": """SELECT variant_id, chrom, block, MAX(CASE pop WHEN 'P' THEN p END) AS p, MAX(CASE pop WHEN 'Q' THEN p END) AS q, MAX(CASE pop WHEN 'R' THEN p END) AS r,
       MAX(CASE pop WHEN 'S' THEN p END) AS s, MAX(CASE pop WHEN 'T' THEN p END) AS t, MAX(CASE pop WHEN 'P' THEN n END) AS np, MAX(CASE pop WHEN 'Q' THEN n END) AS nq, MAX(CASE pop WHEN 'R' THEN n END) AS nr FROM pf GROUP BY variant_id, chrom, block""",
}


def _jack(terms, labels, extra="", more=""):
    cols = ", ".join(labels)
    return f"""
      SELECT {cols}, ROUND(est, 6) + 0e0 AS estimate, ROUND(se, 6) AS stderr, ROUND(est/NULLIF(se, 0), 6) + 0e0 AS z, n_snps{more} FROM (
       SELECT {cols}, MAX(est) AS est, SQRT(SUM((h*est - (h-1)*loo - centre)*(h*est - (h-1)*loo - centre)/NULLIF(h-1, 0))/MAX(g)) AS se, CAST(MAX(tm) AS BIGINT) AS n_snps{extra} FROM (
        SELECT *, g*est - SUM((1 - m/tm)*loo) OVER (PARTITION BY {cols}) AS centre, tm/m AS h FROM (
         SELECT *, tn/NULLIF(td, 0) AS est, (tn - num)/NULLIF(td - den, 0) AS loo FROM (
          SELECT *, SUM(num) OVER w AS tn, SUM(den) OVER w AS td, CAST(SUM(m) OVER w AS DOUBLE) AS tm, CAST(COUNT(*) OVER w AS DOUBLE) AS g FROM (
           SELECT {cols}, chrom, block, SUM(num) AS num, SUM(den) AS den, COUNT(*) AS m FROM ({terms}) WHERE num IS NOT NULL AND den IS NOT NULL GROUP BY {cols}, chrom, block)
          WINDOW w AS (PARTITION BY {cols})))) GROUP BY {cols})"""


def _four(w, x, y, z, kind):
    num = f"({w}-{x})*({y}-{z})"
    den = f"({w}+{x}-2*{w}*{x})*({y}+{z}-2*{y}*{z})" if kind == "d" else f"{num}*0 + 1"
    names = ", ".join(f"'{v.upper()}' AS pop_{k}" for k, v in zip("wxyz", (w, x, y, z)))
    return f"SELECT {names}, chrom, block, {num} AS num, {den} AS den FROM wide"


_WXYZ = ["pop_w", "pop_x", "pop_y", "pop_z"]


@query(
    "A12_patterson_d",
    _jack(
        _four("p", "q", "r", "t", "d") + " UNION ALL " + _four("p", "q", "s", "t", "d"), _WXYZ,
        ", (SUM(num) + SUM(den))/2 AS baba, (SUM(den) - SUM(num))/2 AS abba", ", ROUND(baba, 6) AS baba, ROUND(abba, 6) AS abba",
    ),
    _FREQS,
)
def _(t):
    return FS.patterson_d(t.g, t.m5, "P", "Q", ["R", "S"], "T", 4000)


@query("A13_f4", _jack(_four("p", "q", "r", "t", "f4"), _WXYZ), _FREQS)
def _(t):
    return FS.f4(t.g, t.m5, "P", "Q", "R", "T", 4000)


@query(
    "A14_f4_ratio",
    _jack("SELECT 'P' AS pop_a, 'Q' AS pop_b, 'R' AS pop_c, 'S' AS pop_x, 'T' AS pop_o, chrom, block, (p-t)*(s-r) AS num, (p-t)*(q-r) AS den FROM wide",
          ["pop_a", "pop_b", "pop_c", "pop_x", "pop_o"]),
    _FREQS,
)
def _(t):
    return FS.f4_ratio(t.g, t.m5, "P", "Q", "R", "S", "T", 4000)


_F3 = "(r-p)*(r-q) - r*(1-r)/NULLIF(nr-1, 0)"


@query(
    "A15_f3",
    _jack(f"SELECT 'P' AS pop_a, 'Q' AS pop_b, 'R' AS pop_c, chrom, block, {_F3} AS num, ({_F3})*0 + 1 AS den FROM wide", ["pop_a", "pop_b", "pop_c"]),
    _FREQS,
)
def _(t):
    return FS.f3(t.g, t.m5, "P", "Q", "R", 4000)


_ALL4 = " UNION ALL ".join(
    _four(w, x, y, "t", "f4")
    for w in ("p", "s")
    for x in ("q", "r")
    for y in ("r", "s", "p")
    if len({w, x, y}) == 3
)


@query("A16_population_combinations", _jack(_ALL4, _WXYZ), _FREQS)
def _(t):
    return FS.f4(t.g, t.m5, ["P", "S"], ["Q", "R"], ["R", "S", "P"], "T", 4000)


@query("A16_unknown_populations", "SELECT pop FROM (SELECT DISTINCT pop FROM m5 UNION SELECT 'Z') WHERE pop NOT IN (SELECT pop FROM m5)")
def _(t):
    return FS.check_populations(t.m5, ["P", "Q", "Z"])


# ---- loci ------------------------------------------------------------------------------------------

_HAPS = {
    "haps": "SELECT variant_id, chrom, pos, sample, 0 AS hap, a1 AS a FROM genotypes UNION ALL SELECT variant_id, chrom, pos, sample, 1, a2 FROM genotypes",
    "site_loci": "SELECT l.iv_id AS locus, s.variant_id, s.ref, s.alt FROM loci l JOIN snps s ON s.chrom = l.chrom AND s.pos - 1 >= l.start AND s.pos - 1 < l.end_",
    "bases": "SELECT sl.locus, m.pop, sl.variant_id, CASE WHEN h.a IS NULL THEN 'N' WHEN h.a = 0 THEN sl.ref ELSE sl.alt END AS b FROM site_loci sl JOIN m3 m ON TRUE JOIN (SELECT 0 AS hap UNION ALL SELECT 1) k ON TRUE LEFT JOIN haps h ON h.variant_id = sl.variant_id AND h.sample = m.sample AND h.hap = k.hap",
    "segs": "SELECT locus, pop, COUNT(*) AS s FROM (SELECT locus, pop, variant_id FROM bases GROUP BY locus, pop, variant_id HAVING MIN(b) <> MAX(b)) GROUP BY locus, pop",
    "pop_n": "SELECT pop, 2*COUNT(*) AS n_seqs, list_sum(list_transform(range(1, GREATEST(2, COUNT(*))), lambda i: 1e0/i)) AS a FROM m3 GROUP BY pop",
    "theta": "SELECT l.iv_id AS locus, p.pop, n_seqs, COALESCE(s, 0) AS segregating, COALESCE(s, 0)/a AS theta FROM loci l JOIN pop_n p ON TRUE LEFT JOIN segs g ON g.locus = l.iv_id AND g.pop = p.pop",
}


def _theta(t):
    seqs = Q.haplotype_sequences(t.snps, t.g, t.loci, t.m)
    return L.watterson_theta(seqs.select(F.col("iv_id").alias("locus"), "pop", "seq"))


@query("A18_watterson_theta", "SELECT locus, pop, n_seqs, segregating, ROUND(theta, 6) AS theta FROM theta", _HAPS)
def _(t):
    return _theta(t)


@query(
    "A19_ima_priors",
    """SELECT ROUND(5*top, 6) AS q, ROUND(2*top, 6) AS t, ROUND(2/top, 6) AS m FROM (SELECT MAX(x) AS top FROM (
         SELECT pop, EXP(AVG(LN(CASE WHEN theta = 0 THEN 1 ELSE theta END))) AS x FROM theta GROUP BY pop))""",
    _HAPS,
)
def _(t):
    return L.ima_priors(_theta(t))


@query(
    "A20_snp_density",
    "SELECT l.iv_id, COUNT(*) AS n_records, ROUND((COUNT(*) - 1)/CAST(MAX(l.end_ - l.start) AS DOUBLE), 6) AS density FROM loci l JOIN variants v ON v.chrom = l.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_ GROUP BY l.iv_id",
)
def _(t):
    return B.snp_density(t.v, t.loci)


@query(
    "A21_locus_length",
    """SELECT l.iv_id, COUNT(v.variant_id) AS n_records, CAST(MAX(l.end_ - l.start) + COALESCE(SUM(GREATEST(length(v.ref), 1) - length(v.ref)), 0) AS BIGINT) AS locus_len, 1e0 AS inheritance,
         ROUND(MAX(l.end_ - l.start)*1e-3 + CASE WHEN COUNT(v.variant_id) > 1 THEN 1e-3*MAX(l.end_ - l.start)/(COUNT(v.variant_id) - 1) ELSE 0 END, 6) AS locus_rate
       FROM loci l LEFT JOIN variants v ON v.chrom = l.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_ GROUP BY l.iv_id""",
)
def _(t):
    density = B.snp_density(t.v, t.loci)
    return Q.locus_length(t.v, t.loci, 1e-3, density=density).drop("chrom", "start", "end")


@query(
    "A22_sample_pca",
    """SELECT o_orderkey, ROUND(ABS(zx + zy)/SQRT(2e0), 6) + 0e0 AS sum_axis, ROUND(ABS(zx - zy)/SQRT(2e0), 6) + 0e0 AS diff_axis FROM (
         SELECT o_orderkey, (o_totalprice - AVG(o_totalprice) OVER ())/STDDEV_POP(o_totalprice) OVER () AS zx,
           (o_custkey - AVG(o_custkey) OVER ())/STDDEV_POP(o_custkey) OVER () AS zy FROM orders)""",
)
def _(t):
    df = t.raw("orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"))
    # with two standardised columns the axes are their sum and difference, in order of correlation
    r = df.agg(F.corr("o_totalprice", "o_custkey")).scalar()
    pcs = L.sample_pca(df, ["o_totalprice", "o_custkey"]).withColumn("r", r)
    first, second = F.abs("pc1"), F.abs("pc2")
    return pcs.select(
        "o_orderkey",
        F.when(F.col("r") >= 0, first).otherwise(second).alias("sum_axis"),
        F.when(F.col("r") >= 0, second).otherwise(first).alias("diff_axis"),
    )


@query("A23_manhattan_points", "SELECT chrom, pos, ROUND(fst, 6) + 0e0 AS fst FROM wc WHERE fst IS NOT NULL", _FST)
def _(t):
    return D.manhattan_points(D.weir_fst(snp_sites(t), t.m))


# ---- spectra -----------------------------------------------------------------------------------------


def spectrum(df):
    return df.select(F.array_join(F.transform("counts", lambda c: c.cast("string")), ",").alias("counts"), "n")


def _gate(model, limit=10, calls="genotypes"):
    """Sites that pass the gate, from the model's calls alone."""
    return f"""SELECT variant_id FROM variants JOIN (
        SELECT variant_id, 2*COUNT(a1) AS nc, SUM(a1+a2) AS na FROM {calls} WHERE sample IN (SELECT sample FROM {model}) GROUP BY variant_id) USING (variant_id)
      WHERE length(ref) = 1 AND 2*(SELECT COUNT(*) FROM {model}) - nc <= {limit}
        AND ((nc - COALESCE(na, 0) > 0)::INT + (COALESCE(na, 0) > 0)::INT + (2*(SELECT COUNT(*) FROM {model}) > nc)::INT) <> 1"""


def _cells(model, limit=10, calls="genotypes"):
    return {
        "gated": _gate(model, limit, calls),
        "sized": f"SELECT pop, pop_ix, 2*COUNT(*) AS size FROM {model} GROUP BY pop, pop_ix",
        "popc": f"SELECT variant_id, m.pop, 2*COUNT(a1) - COALESCE(SUM(a1+a2), 0) AS r, COALESCE(SUM(a1+a2), 0) AS a FROM {calls} JOIN {model} m USING (sample) GROUP BY variant_id, m.pop",
        "cells": "SELECT g.variant_id, s.pop, s.pop_ix, s.size, CAST(COALESCE(r, 0) AS BIGINT) AS r, CAST(COALESCE(a, 0) AS BIGINT) AS a FROM gated g JOIN sized s ON TRUE LEFT JOIN popc p ON p.variant_id = g.variant_id AND p.pop = s.pop",
    }


def _joint(count, source="cells", key="variant_id"):
    return f"SELECT counts, CAST(COUNT(*) AS DOUBLE) AS n FROM (SELECT {key}, string_agg(CAST({count} AS STRING), ',' ORDER BY pop_ix) AS counts, BOOL_AND(r + a >= size) AS ok FROM {source} GROUP BY {key}) WHERE ok GROUP BY counts"


_WHOLE = _cells("m3", calls="complete")


@query("Q01_sfs_unfolded", _joint("a"), _WHOLE)
def _(t):
    return spectrum(S.sfs(t.v, t.complete, t.m))


_OUT = {
    "polar": f"""SELECT c.*, COALESCE(substr(o.seq, v.pos - o.chunk_start, 1) = v.alt, FALSE) AS swap, COALESCE(substr(o.seq, v.pos - o.chunk_start, 1) = v.ref OR contains(v.alts, substr(o.seq, v.pos - o.chunk_start, 1)), FALSE) AS known
       FROM cells c JOIN variants v USING (variant_id) LEFT JOIN outgroup o ON o.chrom = v.chrom AND o.chunk_start = CAST(FLOOR((v.pos - 1)/100) AS BIGINT)*100""",
}


@query("Q01_sfs_polarised", _joint("(CASE WHEN swap THEN r ELSE a END)", "(SELECT * FROM polar WHERE known)"), {**_WHOLE, **_OUT})
def _(t):
    return spectrum(S.sfs(t.v, t.complete, t.m, ref=t.outgroup))


@query("Q02_sfs_folded", _joint("LEAST(r, a)"), _WHOLE)
def _(t):
    return spectrum(S.sfs(t.v, t.complete, t.m, folded=True))


_POOLED = """SELECT counts, CAST(COUNT(*) AS DOUBLE) AS n FROM (
     SELECT variant_id, string_agg(CAST(CASE WHEN 2*ta > total THEN r ELSE a END AS STRING), ',' ORDER BY pop_ix) AS counts, BOOL_AND(r + a >= size) AS ok
     FROM (SELECT *, SUM(a) OVER (PARTITION BY variant_id) AS ta, SUM(size) OVER (PARTITION BY variant_id) AS total FROM cells) GROUP BY variant_id) WHERE ok GROUP BY counts"""


@query("Q02_sfs_folded_together", _POOLED, _WHOLE)
def _(t):
    """The allele that is rarer in all populations together is counted in each."""
    return spectrum(S.sfs(t.v, t.complete, t.m, folded="together"))


def _weights(m, folded):
    lc = "(lgamma({n}+1) - lgamma({k}+1) - lgamma({n}-({k})+1))"

    def w(r):
        return (
            f"CASE WHEN {r} >= 0 AND {r} <= c AND {m} - ({r}) <= size - c AND {r} <= {m} THEN exp("
            + lc.format(n="c", k=r) + " + " + lc.format(n="(size-c)", k=f"({m}-({r}))") + " - " + lc.format(n="size", k=f"CAST({m} AS BIGINT)") + ") ELSE 0 END"
        )

    if not folded:
        return f"(SELECT *, unnest(range(0, {m} + 1)) AS k FROM src)", w("k")
    return (
        f"(SELECT *, unnest(range(0, {m} // 2 + 1)) AS k FROM src)",
        f"({w('k')}) + CASE WHEN 2*k <> {m} THEN {w(f'({m}-k)')} ELSE 0 END",
    )


def _down(m, folded):
    table, weight = _weights(m, folded)
    count = "LEAST(r, a)" if folded else "a"
    return {
        **_cells("m3"),
        "fine": f"SELECT variant_id FROM cells GROUP BY variant_id HAVING BOOL_AND(r + a >= {m})",
        "src": f"SELECT variant_id, pop, size, {count} AS c FROM cells WHERE variant_id IN (SELECT variant_id FROM fine)",
        "w": f"SELECT variant_id, pop, k, {weight} AS w FROM {table}",
        "down": "SELECT concat(x.k, ',', y.k, ',', z.k) AS counts, SUM(x.w*y.w*z.w) AS n FROM w x JOIN w y ON x.variant_id = y.variant_id JOIN w z ON x.variant_id = z.variant_id WHERE x.pop = 'A' AND y.pop = 'B' AND z.pop = 'C' AND x.w > 0 AND y.w > 0 AND z.w > 0 GROUP BY x.k, y.k, z.k",
    }


_TO4 = {"A": 4, "B": 4, "C": 4}


@query("Q03_sfs_downsampled", "SELECT counts, ROUND(n, 6) AS n FROM down", _down(4, False))
def _(t):
    return spectrum(S.sfs(t.v, t.g, t.m, downsample=_TO4, round_int=False))


@query("Q03_sfs_downsampled_folded", "SELECT counts, ROUND(n, 6) AS n FROM down", _down(4, True))
def _(t):
    return spectrum(S.sfs(t.v, t.g, t.m, folded=True, downsample=_TO4, round_int=False))


_ONE = {
    "alts": "SELECT CAST(n_alt AS BIGINT) AS c, COUNT(*) AS n FROM counts WHERE n_called >= 20 GROUP BY n_alt",
    "src": "SELECT c, n, 40 AS size FROM alts",
    "w": "SELECT k, SUM(n*w) AS n FROM (SELECT *, {} AS w FROM {}) WHERE k > 0 AND k < 10 GROUP BY k".format(*reversed(_weights(10, False))),
}


@query("Q04_project_one_population", "SELECT CAST(k AS STRING) AS counts, ROUND(n/(SELECT SUM(n) FROM w), 6) AS n FROM w", _ONE)
def _(t):
    s = C.site_counts(t.g).filter("n_called >= 20").groupBy(F.array(F.col("n_alt").cast("int")).alias("counts"))
    return spectrum(S.sfs_project(s.agg(F.count("*").cast("double").alias("n")), 40, 10))


@query(
    "Q05_sfs_marginal",
    "SELECT split_part(counts, ',', 2) AS counts, ROUND(SUM(n), 6) AS n FROM down GROUP BY split_part(counts, ',', 2)",
    _down(4, False),
)
def _(t):
    return spectrum(S.sfs_marginal(S.sfs(t.v, t.g, t.m, downsample=_TO4, round_int=False), [1]))


_THIN = "((variant_id * 7919 + 5) % 100003)"


@query("Q06_sfs_thinned", _joint("a", f"(SELECT * FROM cells WHERE {_THIN} < 5e-1 * 100003)"), _WHOLE)
def _(t):
    u = ((F.col("variant_id") * 7919 + 5) % 100003) / F.lit(100003.0)
    return spectrum(S.sfs(t.v, t.complete, t.m, prop=0.5, draw_col=u))


@query(
    "Q07_sfs_in_regions",
    _joint("a", "(SELECT c.*, b.iv_id FROM cells c JOIN variants v USING (variant_id) JOIN iv_b b ON b.chrom = v.chrom AND b.start <= v.pos - 1 AND v.pos - 1 < b.end_)", "variant_id, iv_id"),
    _WHOLE,
)
def _(t):
    return spectrum(S.sfs(t.v, t.complete, t.m, iv=t.iv_b))


@query("Q08_site_gate", "SELECT variant_id FROM gated", {"gated": _gate("m3")})
def _(t):
    return S.gated_sites(t.v, t.g, t.m).select("variant_id")


@query(
    "Q09_rejections",
    """SELECT n_sites, too_few, bad_outgroup, missing, invariant FROM (
         SELECT COUNT(*) AS n_sites, COUNT(CASE WHEN NOT ok THEN 1 END) AS too_few, COUNT(CASE WHEN ok AND NOT known THEN 1 END) AS bad_outgroup FROM (
           SELECT variant_id, BOOL_AND(r + a >= need) AS ok, BOOL_AND(known) AS known FROM (SELECT *, 8 AS need FROM polar) GROUP BY variant_id)),
       (SELECT COUNT(CASE WHEN 2*(SELECT COUNT(*) FROM m3) - nc > 14 THEN 1 END) AS missing,
          COUNT(CASE WHEN 2*(SELECT COUNT(*) FROM m3) - nc <= 14 AND ((nc - COALESCE(na, 0) > 0)::INT + (COALESCE(na, 0) > 0)::INT + (2*(SELECT COUNT(*) FROM m3) > nc)::INT) = 1 THEN 1 END) AS invariant
        FROM snp_sites JOIN (SELECT variant_id, 2*COUNT(a1) AS nc, SUM(a1+a2) AS na FROM genotypes WHERE sample IN (SELECT sample FROM m3) GROUP BY variant_id) USING (variant_id))""",
    {**_cells("m3", 14), **_OUT, "snp_sites": "SELECT variant_id FROM variants WHERE length(ref) = 1"},
)
def _(t):
    return S.rejections(t.v, t.g, t.m, ref=t.outgroup, downsample={p: 8 for p in "ABC"}, max_missing=14)


@query(
    "Q10_sfs_layouts",
    """SELECT layout, counts, ROUND(SUM(n), 6) AS n FROM (
         SELECT 'joint' AS layout, counts, n FROM down
         UNION ALL SELECT 'pop0', split_part(counts, ',', 1), n FROM down UNION ALL SELECT 'pop1', split_part(counts, ',', 2), n FROM down
         UNION ALL SELECT 'pop2', split_part(counts, ',', 3), n FROM down
         UNION ALL SELECT 'pop1_0', concat(split_part(counts, ',', 2), ',', split_part(counts, ',', 1)), n FROM down
         UNION ALL SELECT 'pop2_0', concat(split_part(counts, ',', 3), ',', split_part(counts, ',', 1)), n FROM down
         UNION ALL SELECT 'pop2_1', concat(split_part(counts, ',', 3), ',', split_part(counts, ',', 2)), n FROM down) GROUP BY layout, counts""",
    _down(4, False),
)
def _(t):
    out = S.sfs_layouts(S.sfs(t.v, t.g, t.m, downsample=_TO4, round_int=False), 3)
    return out.select("layout", F.array_join(F.transform("counts", lambda c: c.cast("string")), ",").alias("counts"), "n")


@query("Q11_sfs_rounded", "SELECT counts, ROUND_EVEN(n, 0) AS n FROM down WHERE ROUND_EVEN(n, 0) <> 0", _down(4, False))
def _(t):
    return spectrum(S.sfs(t.v, t.g, t.m, downsample=_TO4))


# ---- scalar functions ---------------------------------------------------------------------------------


@query(
    "C06_projection_weights",
    "SELECT c, k, ROUND(w, 6) AS w FROM (SELECT c, k, {} AS w FROM {})".format(*reversed(_weights(6, False))),
    {"src": "SELECT DISTINCT CAST(p_size AS BIGINT) AS c, 50 AS size FROM part"},
)
def _(t):
    a = t.raw("part").select(F.col("p_size").cast("long").alias("c")).distinct()
    grid = a.select("c", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("k"))
    w = G.hypergeometric_weight(F.col("c").cast("int"), F.col("k"), F.lit(50), F.lit(6))
    return grid.select("c", "k", w.alias("w"))


@query(
    "C07_harmonic",
    "SELECT n, (SELECT ROUND(SUM(1e0/i), 6) FROM (SELECT unnest(range(1, GREATEST(2, n))) AS i)) AS a FROM (SELECT DISTINCT CAST(p_size AS BIGINT) AS n FROM part)",
)
def _(t):
    n = t.raw("part").select(F.col("p_size").cast("long").alias("n")).distinct()
    return n.select("n", G.harmonic(F.col("n")).alias("a"))
