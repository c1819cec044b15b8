"""Sequences (X), layouts (K), sources (S), models (D), scalar functions (C) and the stream (T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from allelespan.functions import genome as G
from allelespan.functions import predicates as P
from allelespan.operators import filters as X
from allelespan.operators import loci as L
from allelespan.operators import models as M
from allelespan.operators import sequence as Q
from allelespan.operators import sfs as SFS
from allelespan.plans.registry import query
from allelespan.session import new_path
from allelespan.sinks import layouts as K
from allelespan.sinks.convert import convert, read_callset
from allelespan.sources import genotypes as SG
from allelespan.sources import sequences as SS
from allelespan.sources import tables as ST
from allelespan.sources import vcf as SV
from allelespan.streaming.filters import stream_filter_variants


# ---- sequences --------------------------------------------------------------------------------------


def _seq_views(records="snps"):
    wide = "GREATEST(length(r.ref), 1)"
    letter = "rpad(CASE WHEN h.a IS NULL THEN 'N' WHEN h.a = 0 THEN r.ref ELSE r.alt END, CAST({w} AS INT), '_')".format(w=wide)
    return {
        "haps": "SELECT variant_id, sample, 0 AS hap, a1 AS a FROM genotypes UNION ALL SELECT variant_id, sample, 1, a2 FROM genotypes",
        "texts": """SELECT l.iv_id, l.chrom, l.start, l.end_, string_agg(rpad(COALESCE(r.seq, ''), 100, 'N'), '' ORDER BY r.chunk_start) AS body
           FROM loci l JOIN (SELECT l.iv_id AS k, c.s AS chunk_start, r.seq FROM loci l JOIN (SELECT unnest(range(0, (SELECT MAX(size) FROM sizes) + 100, 100)) AS s) c ON c.s < l.end_ AND c.s + 100 > l.start
             LEFT JOIN ref_chunks r ON r.chrom = l.chrom AND r.chunk_start = c.s) r ON r.k = l.iv_id GROUP BY l.iv_id, l.chrom, l.start, l.end_""",
        "ref_seqs": "SELECT iv_id, chrom, start, end_, substr(body, 1, end_ - start) AS ref_seq FROM texts",
        "recs": f"SELECT l.iv_id, v.* FROM loci l JOIN {records} v ON v.chrom = l.chrom AND v.pos - 1 >= l.start AND v.pos - 1 < l.end_",
        "ends": "SELECT *, COALESCE(LAG(pos - 1 + length(ref)) OVER (PARTITION BY iv_id ORDER BY pos), NULL) AS prev_end FROM recs",
        "who": "SELECT m.*, k.hap FROM m3 m, (SELECT 0 AS hap UNION ALL SELECT 1) k",
        "parts": f"""SELECT r.iv_id, w.pop, w.pop_ix, w.sample, w.sample_ix, w.hap, string_agg(concat(substr(s.ref_seq, COALESCE(r.prev_end, s.start) - s.start + 1, GREATEST(r.pos - 1 - COALESCE(r.prev_end, s.start), 0)), {letter}), '' ORDER BY r.pos) AS t,
              string_agg({letter}, '' ORDER BY r.pos) AS only_alleles, MAX(r.pos - 1 + length(r.ref)) AS tail
            FROM ends r JOIN ref_seqs s USING (iv_id) JOIN who w ON TRUE LEFT JOIN haps h ON h.variant_id = r.variant_id AND h.sample = w.sample AND h.hap = w.hap
            GROUP BY r.iv_id, w.pop, w.pop_ix, w.sample, w.sample_ix, w.hap""",
        "seqs": """SELECT s.iv_id, s.chrom, s.start, s.end_, w.pop, w.pop_ix, w.sample, w.sample_ix, w.hap, COALESCE(only_alleles, '') AS only_alleles,
              concat(COALESCE(t, ''), substr(s.ref_seq, COALESCE(tail, s.start) - s.start + 1)) AS untrimmed, length(ref_seq) AS len,
              substr(concat(COALESCE(t, ''), substr(s.ref_seq, COALESCE(tail, s.start) - s.start + 1)), 1, length(ref_seq)) AS seq
            FROM ref_seqs s JOIN who w ON TRUE LEFT JOIN parts p ON p.iv_id = s.iv_id AND p.sample = w.sample AND p.hap = w.hap""",
    }


_SEQ, _SEQ_ALL = _seq_views(), _seq_views("(SELECT * FROM variants WHERE n_alleles = 2)")
_HAP = "CAST(hap AS BIGINT) AS hap"
_ROW = ["iv_id", "sample", "hap", "seq"]


@query("X01_haplotype_sequences", f"SELECT iv_id, sample, {_HAP}, seq FROM seqs", _SEQ)
def _(t):
    return Q.haplotype_sequences(t.snps, t.g, t.loci, t.m, t.ref).select(*_ROW)


def _two_alleles(t):
    return t.v.filter(P.allele_number(2, 2))


@query("X02_indel_padding", f"SELECT iv_id, sample, {_HAP}, untrimmed AS seq FROM seqs", _SEQ_ALL)
def _(t):
    s = Q.haplotype_sequences(_two_alleles(t), t.g, t.loci, t.m, t.ref, indels=True, trim=False)
    return s.select(*_ROW)


@query("X03_trimmed_length", f"SELECT iv_id, sample, {_HAP}, CAST(length(seq) AS BIGINT) AS n, seq FROM seqs", _SEQ_ALL)
def _(t):
    s = Q.haplotype_sequences(_two_alleles(t), t.g, t.loci, t.m, t.ref, indels=True, trim=True)
    return s.select(*_ROW, F.length("seq").alias("n"))


@query("X04_variants_only", f"SELECT iv_id, sample, {_HAP}, only_alleles AS seq FROM seqs", _SEQ)
def _(t):
    return Q.haplotype_sequences(t.snps, t.g, t.loci, t.m).select(*_ROW)


@query("X05_single_haplotype", f"SELECT iv_id, sample, {_HAP}, seq FROM seqs WHERE hap = 0", _SEQ)
def _(t):
    return Q.haplotype_sequences(t.snps, t.g, t.loci, t.m, t.ref, single=True).select(*_ROW)


@query("X06_region_reference", "SELECT iv_id, ref_seq FROM ref_seqs", _SEQ)
def _(t):
    return Q.region_text(t.loci, t.ref).select("iv_id", "ref_seq")


def _code(x, y):
    cases = " ".join(f"WHEN '{pair}' THEN '{code}'" for pair, code in G.IUPAC_PAIRS.items())
    return f"CASE concat({x}, {y}) {cases} ELSE 'N' END"


_CODED = {
    **_SEQ,
    "snp_codes": f"""SELECT r.iv_id, w.pop_ix, w.sample_ix, w.sample, r.pos, r.ref, r.prev_end, {_code("COALESCE(CASE g.a1 WHEN 0 THEN r.ref WHEN 1 THEN r.alt END, 'N')", "COALESCE(CASE g.a2 WHEN 0 THEN r.ref WHEN 1 THEN r.alt END, 'N')")} AS code
       FROM ends r JOIN m3 w ON TRUE LEFT JOIN (SELECT variant_id, sample, a1, a2 FROM genotypes) g ON g.variant_id = r.variant_id AND g.sample = w.sample""",
    "coded": """SELECT iv_id, sample, string_agg(concat(substr(ref_seq, COALESCE(prev_end, start) - start + 1, GREATEST(pos - 1 - COALESCE(prev_end, start), 0)), code), '' ORDER BY pos) AS t, MAX(pos) AS tail
       FROM snp_codes JOIN ref_seqs USING (iv_id) GROUP BY iv_id, sample""",
    "merged": """SELECT s.iv_id, s.chrom, s.start, s.end_, w.pop_ix, w.sample_ix, w.sample, length(ref_seq) AS len, concat(COALESCE(t, ''), substr(ref_seq, COALESCE(tail, s.start) - s.start + 1)) AS merged
       FROM ref_seqs s JOIN m3 w ON TRUE LEFT JOIN coded c ON c.iv_id = s.iv_id AND c.sample = w.sample""",
}


@query("X07_merge_diploid_iupac", "SELECT iv_id, sample, merged FROM merged", _CODED)
def _(t):
    seqs = Q.region_sequences(t.snps, t.g, t.loci, t.m, t.ref)
    return Q.merge_diploid_iupac(seqs).select("iv_id", "sample", "merged")


@query(
    "X08_drop_incomplete",
    """SELECT iv_id, sample FROM m3 JOIN iv_b b ON TRUE WHERE NOT EXISTS (
         SELECT 1 FROM snps s LEFT JOIN (SELECT variant_id, sample AS who, a1 FROM genotypes) g ON g.variant_id = s.variant_id AND g.who = m3.sample
         WHERE s.chrom = b.chrom AND b.start <= s.pos - 1 AND s.pos - 1 < b.end_ AND g.a1 IS NULL)""",
)
def _(t):
    seqs = Q.region_sequences(t.snps, t.g, t.iv_b, t.m)
    complete = X.complete_samples(t.g, t.snps, t.iv_b, t.samples)
    return Q.drop_incomplete(seqs, complete, t.snps, t.iv_b).select("iv_id", "sample")


_LINE = {
    **_SEQ,
    "pops": "SELECT string_agg(n, ' ' ORDER BY pop_ix) AS n FROM (SELECT pop_ix, CAST(2*COUNT(*) AS STRING) AS n FROM m3 GROUP BY pop_ix)",
    "heads": "SELECT iv_id, concat_ws(' ', concat_ws(':', chrom, start, end_), pops.n, end_ - start, 'I', '1', printf('%.14f', (end_ - start)*1e-9)) AS line FROM loci, pops",
    "places": "SELECT iv_id, ROW_NUMBER() OVER (ORDER BY chrom, start) - 1 AS locus_ix FROM loci",
}


def _loci_lengths(t):
    return Q.locus_length(t.snps, t.loci)


@query("X09_locus_table", "SELECT iv_id, line FROM heads", _LINE)
def _(t):
    seqs = Q.region_sequences(t.snps, t.g, t.loci, t.m)
    return Q.locus_table(_loci_lengths(t), seqs, t.m, with_ref=True)


# ---- layouts ------------------------------------------------------------------------------------------

_VCF = {
    "samples": "SELECT sample, ROW_NUMBER() OVER (ORDER BY sample) AS ix FROM (SELECT DISTINCT sample FROM genotypes)",
    "fields": "SELECT v.variant_id, string_agg(CASE WHEN a1 IS NULL THEN {miss} ELSE {gt} END, {sep} ORDER BY ix) AS f FROM variants v JOIN samples s ON TRUE LEFT JOIN genotypes g ON g.variant_id = v.variant_id AND g.sample = s.sample GROUP BY v.variant_id",
}


def _fields(gt, miss, sep):
    return {**_VCF, "fields": _VCF["fields"].format(gt=gt, miss=miss, sep=sep)}


_GT = _fields("concat(a1, '/', a2)", "'./.'", "chr(9)")


@query("K01_vcf_lines", "SELECT chrom, pos, concat_ws(chr(9), chrom, pos, id, ref, alts, '.', filter, '.', 'GT', f) AS line FROM variants JOIN fields USING (variant_id)", _GT)
def _(t):
    return K.vcf_lines(t.v, t.g).select("chrom", "pos", "line")


def _rich_callset(t):
    """Every column of a VCF in use, each ninth line twice, and haploid calls on chr5."""
    size, key = F.col("p_size"), F.col("variant_id")
    sizes = t.part_sizes.withColumnRenamed("p_partkey", "variant_id").hint("merge")
    v = t.v.drop("cm").join(sizes, "variant_id")
    info = F.map_from_arrays(F.array(F.lit("AC"), F.lit("DB")), F.array(size.cast("string"), F.lit(None).cast("string")))
    v = v.select(
        *[c for c in t.v.columns if c != "cm"], F.when(size % 7 != 0, size / 4).alias("qual"), F.when(size % 5 != 0, info).alias("info"),
        F.split(F.when(size % 2 == 0, "GT:DP").otherwise("GT:DP:GQ"), ":").alias("format"),
    )
    ix = F.substring("sample", 2, 9).cast("int")
    single = (F.col("chrom") == "chr5") & (ix % 4 == 1)
    depth = F.create_map(F.lit("DP"), ((key * 7 + ix) % 50).cast("string"))
    both = F.map_concat(depth, F.create_map(F.lit("GQ"), ix.cast("string")))
    long_form = t.v.join(sizes, "variant_id").select("variant_id", (size % 2 == 1).alias("long"))
    g = t.g.join(long_form.hint("merge"), "variant_id").select(
        "variant_id", "chrom", "pos", "sample", "a1", F.when(~single, F.col("a2")).alias("a2"), (~single & (ix % 2 == 0)).alias("phased"),
        F.when(single, 1).otherwise(2).alias("ploidy"), F.when(F.col("long") & (ix % 3 != 0), both).otherwise(depth).alias("fields"),
    )

    def twice(df):
        return df.unionByName(df.filter(key % 9 == 0).withColumn("variant_id", -key - 1))

    return twice(v), twice(g)


_META = ["##fileformat=VCFv4.2", "##source=made", '##INFO=<ID=AC,Number=1,Type=Integer,Description="count">', "##contig=<ID=chr1>", '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">']
_RICH = {
    "lines": "SELECT variant_id AS line, * FROM variants UNION ALL SELECT -variant_id - 1, * FROM variants WHERE variant_id % 9 = 0",
    "rich": """SELECT line, chrom, pos, id, ref, alts, CASE WHEN p_size % 7 <> 0 THEN p_size/4e0 END AS qual, filter, CASE WHEN p_size % 5 <> 0 THEN concat('AC=', p_size, ';DB') END AS info,
         CASE WHEN p_size % 2 = 0 THEN 'GT:DP' ELSE 'GT:DP:GQ' END AS keys, s.sample, a1, CASE WHEN g.sample IS NULL OR NOT (chrom = 'chr5' AND ix % 4 = 1) THEN a2 END AS a2,
         g.sample IS NOT NULL AND ix % 2 = 0 AND NOT (chrom = 'chr5' AND ix % 4 = 1) AS phased, CASE WHEN g.sample IS NOT NULL AND chrom = 'chr5' AND ix % 4 = 1 THEN 1 ELSE 2 END AS ploidy,
         CASE WHEN g.sample IS NOT NULL THEN CAST((l.variant_id*7 + ix) % 50 AS STRING) END AS dp, CASE WHEN g.sample IS NOT NULL AND p_size % 2 = 1 AND ix % 3 <> 0 THEN CAST(ix AS STRING) END AS gq
       FROM lines l JOIN (SELECT sample, CAST(substr(sample, 2) AS INT) AS ix FROM (SELECT DISTINCT sample FROM genotypes)) s ON TRUE
       LEFT JOIN (SELECT variant_id, sample, a1, a2 FROM genotypes) g ON g.variant_id = l.variant_id AND g.sample = s.sample""",
}


@query(
    "K01_round_trip",
    "SELECT chrom, pos, id, ref, alts, ROUND(qual, 6) AS qual, filter, info, keys, sample, CAST(a1 AS BIGINT) AS a1, CAST(a2 AS BIGINT) AS a2, phased, CAST(ploidy AS BIGINT) AS ploidy, dp, gq, COUNT(*) AS n FROM rich GROUP BY ALL",
    _RICH,
)
def _(t):
    """Written, read, written from that and read again: every field of every call, and how often."""
    v, g = _rich_callset(t)
    header = t.spark.createDataFrame(list(enumerate(_META)), "ord int, line string")
    for _ in range(2):
        path = new_path(t.spark, "vcf")
        K.write_vcf(v, g, path, header=header)
        v, g = SV.read_vcf(t.spark, path)
        header = SV.read_vcf_header(t.spark, path)
    entries = F.transform(F.map_entries("info"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    record = v.select("variant_id", "id", "ref", F.array_join("alts", ",").alias("alts"), "qual", "filter", F.array_join(entries, ";").alias("info"), F.array_join("format", ":").alias("keys"))
    values = [F.try_element_at("fields", F.lit(k)).alias(k.lower()) for k in ("DP", "GQ")]
    calls = g.select("variant_id", "chrom", "pos", "sample", "a1", "a2", "phased", "ploidy", *values).join(record, "variant_id")
    return calls.groupBy(*[c for c in calls.columns if c != "variant_id"]).agg(F.count("*").alias("n"))


@query("K01_header_lines", f"SELECT CAST(i AS BIGINT) AS ord, l AS line FROM (SELECT unnest(range(0, {len(_META)})) AS i, unnest({_META!r}) AS l FROM (SELECT COUNT(*) FROM variants))")
def _(t):
    header = t.spark.createDataFrame(list(enumerate(_META)), "ord int, line string")
    path = new_path(t.spark, "vcf")
    K.write_vcf(t.v, t.g, path, header=header)
    return SV.read_vcf_header(t.spark, path)


@query(
    "S01_repeated_records",
    "SELECT chrom, pos, CAST(COUNT(a1) + COUNT(a2) AS BIGINT) AS n_called, CAST(SUM(CASE WHEN a1 IS NULL THEN 1 ELSE 0 END + CASE WHEN a2 IS NULL AND ploidy = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM rich GROUP BY line, chrom, pos",
    _RICH,
)
def _(t):
    """Lines that repeat are sites of their own."""
    from allelespan.operators.counts import site_counts

    path = new_path(t.spark, "vcf")
    K.write_vcf(*_rich_callset(t), path)
    _, g = SV.read_vcf(t.spark, path)
    return site_counts(g).select("chrom", "pos", "n_called", "n_missing")


@query(
    "S01_haploid_calls",
    "SELECT sample, CAST(ploidy AS BIGINT) AS ploidy, CAST(a1 AS BIGINT) AS a1, COUNT(*) AS n FROM rich WHERE chrom = 'chr5' GROUP BY ALL",
    _RICH,
)
def _(t):
    path = new_path(t.spark, "vcf")
    K.write_vcf(*_rich_callset(t), path)
    _, g = SV.read_vcf(t.spark, path)
    return g.filter("chrom = 'chr5'").groupBy("sample", "ploidy", "a1").agg(F.count("*").alias("n"))


@query("K02_bed_lines", 'SELECT chrom, start, end_ AS "end", concat_ws(chr(9), substr(chrom, 4), start + 1, end_) AS line FROM iv_b')
def _(t):
    return K.bed_lines(t.iv_b, "one_based", remove_prefix=True)


_PI = "SELECT chrom, pos, CASE WHEN n_called > 0 THEN ROUND(2e0*n_alt*n_ref/(n_called*(n_called-1)), 6) END AS PI FROM counts"


@query("K03_stat_lines", f"SELECT chrom, pos, concat_ws(chr(9), chrom, pos, COALESCE(printf('%g', PI), 'nan')) AS line FROM ({_PI})")
def _(t):
    from allelespan.operators.diversity import site_pi

    st = site_pi(t.g).select("chrom", "pos", F.round(F.col("pi") + 1e-9, 6).alias("PI"))
    return K.stat_lines(st).select("chrom", "pos", "line")


@query(
    "K04_write_model",
    """SELECT concat('{"name":"', model, '","tree":"', tree, '","pops":{', string_agg(p, ',' ORDER BY pop_ix), '}}') AS json FROM (
         SELECT model, tree, pop_ix, concat('"', pop, '":{"inds":[', string_agg(concat('"', sample, '"'), ',' ORDER BY sample_ix), ']}') AS p FROM m3 GROUP BY model, tree, pop, pop_ix) GROUP BY model, tree""",
)
def _(t):
    return K.model_json(t.m).select("json")


_DADI = {
    "pc": "SELECT variant_id, m.pop, m.pop_ix, 2*COUNT(a1) - COALESCE(SUM(a1+a2), 0) AS r, COALESCE(SUM(a1+a2), 0) AS a FROM genotypes JOIN m3 m USING (sample) GROUP BY variant_id, m.pop, m.pop_ix",
    "pg": "SELECT v.variant_id, s.pop, s.pop_ix, CAST(COALESCE(r, 0) AS BIGINT) AS r, CAST(COALESCE(a, 0) AS BIGINT) AS a FROM (SELECT DISTINCT variant_id FROM genotypes) v JOIN (SELECT DISTINCT pop, pop_ix FROM m3) s ON TRUE LEFT JOIN pc ON pc.variant_id = v.variant_id AND pc.pop = s.pop",
    "rows_": "SELECT variant_id, string_agg(r, chr(9) ORDER BY pop_ix) AS nr, string_agg(a, chr(9) ORDER BY pop_ix) AS na, string_agg(concat(r, ',', a), ' ' ORDER BY pop_ix) AS line, SUM(r) AS tr, SUM(a) AS ta FROM pg GROUP BY variant_id",
    "ok_rows": "SELECT v.*, x.nr, x.na, x.line FROM rows_ x JOIN variants v USING (variant_id) JOIN full_counts c USING (variant_id) WHERE tr > 0 AND ta > 0 AND length(v.ref) = 1 AND c.n_missing <= 12",
}
_ABC = ["A", "B", "C"]


@query(
    "K05_snp_counts",
    "SELECT concat('-', ref, '-') AS ingroup, concat('-', alt, '-') AS outgroup, ref AS allele1, nr AS n1, alt AS allele2, na AS n2, chrom AS place, pos FROM ok_rows",
    _DADI,
)
def _(t):
    return L.snp_counts(t.v, t.g, t.m, _ABC, max_missing=12)


@query(
    "K05_snp_counts_outgroup",
    """SELECT concat('-', x, '-') AS ingroup, concat('-', y, '-') AS outgroup, x AS allele1, CASE WHEN swap THEN na ELSE nr END AS n1, y AS allele2, CASE WHEN swap THEN nr ELSE na END AS n2, place, pos FROM (
         SELECT *, CASE WHEN swap THEN alt ELSE ref END AS x, CASE WHEN swap THEN ref ELSE alt END AS y FROM (
           SELECT r.*, b = r.alt AS swap, concat(l.chrom, ':', l.start + 1, '-', l.end_) AS place FROM (SELECT r.*, substr(o.seq, r.pos - o.chunk_start, 1) AS b FROM ok_rows r JOIN outgroup o ON o.chrom = r.chrom AND o.chunk_start = CAST(FLOOR((r.pos - 1)/100) AS BIGINT)*100) r
           JOIN iv_b l ON l.chrom = r.chrom AND l.start <= r.pos - 1 AND r.pos - 1 < l.end_ WHERE b = r.ref OR contains(r.alts, b)))""",
    _DADI,
)
def _(t):
    return L.snp_counts(t.v, t.g, t.m, _ABC, iv=t.iv_b, ref=t.outgroup, max_missing=12)


@query("K06_pop_allele_pairs", "SELECT chrom, pos, line FROM ok_rows", _DADI)
def _(t):
    return L.pop_allele_pairs(t.v, t.g, t.m, _ABC, max_missing=12)


@query(
    "K07_block_padding",
    """SELECT iv_id, line, COUNT(*) AS n FROM (
         SELECT l.iv_id, line FROM loci l JOIN ok_rows r ON r.chrom = l.chrom AND l.start <= r.pos - 1 AND r.pos - 1 < l.end_
         UNION ALL SELECT iv_id, (SELECT string_agg(concat(n, ',0'), ' ' ORDER BY pop) FROM (SELECT pop, 2*COUNT(*) AS n FROM m3 GROUP BY pop)) AS line FROM (
           SELECT l.iv_id, unnest(range(COUNT(*), 40)) FROM loci l JOIN ok_rows r ON r.chrom = l.chrom AND l.start <= r.pos - 1 AND r.pos - 1 < l.end_ GROUP BY l.iv_id)) GROUP BY iv_id, line""",
    _DADI,
)
def _(t):
    lines = L.pop_allele_pairs(t.v, t.g, t.m, _ABC, iv=t.loci, kblock=40, max_missing=12)
    return lines.groupBy("iv_id", "line").agg(F.count("*").alias("n"))


@query(
    "K08_gphocs_loci",
    """SELECT locus_ix, line_ix, line FROM (
        SELECT locus_ix, ROW_NUMBER() OVER (PARTITION BY locus_ix ORDER BY pop_ix, sample_ix) AS line_ix, concat(sample, ' ', merged) AS line FROM merged JOIN places USING (iv_id)
        UNION ALL SELECT locus_ix, 0, concat('locus', locus_ix, '_', chrom, ':', start + 1, '-', end_, ' ', COUNT(*), ' ', MAX(len)) FROM merged JOIN places USING (iv_id) GROUP BY locus_ix, chrom, start, end_)""",
    {**_CODED, "places": _LINE["places"]},
)
def _(t):
    return Q.gphocs_loci(Q.region_sequences(t.snps, t.g, t.loci, t.m, t.ref), t.loci)


@query(
    "K09_ima_loci",
    """SELECT locus_ix, line_ix, line FROM (
        SELECT locus_ix, ROW_NUMBER() OVER (PARTITION BY locus_ix ORDER BY pop_ix, sample_ix, hap) AS line_ix, concat(rpad(concat_ws(':', pop_ix, sample_ix, hap), 10, ' '), seq) AS line FROM seqs JOIN places USING (iv_id)
        UNION ALL SELECT locus_ix, 0, line FROM heads JOIN places USING (iv_id))""",
    _LINE,
)
def _(t):
    seqs = Q.region_sequences(t.snps, t.g, t.loci, t.m, t.ref)
    return Q.ima_loci(seqs, _loci_lengths(t), t.loci, t.m)


@query("K10_fasta", "SELECT iv_id, concat('>', sample, '_', hap) AS header, seq FROM seqs", _SEQ)
def _(t):
    return Q.fasta_lines(Q.haplotype_sequences(t.snps, t.g, t.loci, t.m, t.ref))


def _ped(letter):
    return {
        **_VCF,
        "marks": "SELECT *, ROW_NUMBER() OVER (PARTITION BY chrom ORDER BY pos) AS ix FROM variants JOIN counts USING (variant_id, chrom, pos)",
        "lines": f"""SELECT s.sample, m.chrom, concat_ws(' ', s.sample, s.sample, '0', '0', '0', '-9', string_agg(CASE WHEN a1 IS NULL THEN '0 0' ELSE concat({letter('a1')}, ' ', {letter('a2')}) END, ' ' ORDER BY m.ix)) AS line
           FROM samples s JOIN marks m ON TRUE LEFT JOIN genotypes g ON g.variant_id = m.variant_id AND g.sample = s.sample GROUP BY s.sample, m.chrom""",
    }


@query("K11_ped_lines", "SELECT chrom, sample, line FROM lines", _ped(lambda a: f"CASE g.{a} WHEN 0 THEN ref ELSE alt END"))
def _(t):
    return K.ped_lines(t.v, t.g).select("chrom", "sample", "line")


@query("K11_ped12_lines", "SELECT chrom, sample, line FROM lines", _ped(lambda a: f"CASE WHEN (g.{a} = 1) = (n_alt > n_ref) THEN '2' ELSE '1' END"))
def _(t):
    return K.ped_lines(t.v, t.g, recode12=True).select("chrom", "sample", "line")


@query("K11_map_lines", "SELECT chrom, ROW_NUMBER() OVER (PARTITION BY chrom ORDER BY pos) - 1 AS marker_ix, concat_ws(chr(9), substr(chrom, 4), id, '0', pos) AS line FROM variants")
def _(t):
    return K.map_lines(t.v.drop("cm")).select("chrom", "marker_ix", "line")


@query("K12_eigenstrat_geno", "SELECT chrom, pos, f AS line FROM variants JOIN fields USING (variant_id) WHERE variant_id IN (SELECT variant_id FROM genotypes)", _fields("CAST(2 - a1 - a2 AS STRING)", "'9'", "''"))
def _(t):
    return K.eigenstrat_geno_lines(t.v, t.g).select("chrom", "pos", "line")


@query("K12_eigenstrat_snp", "SELECT chrom, pos, concat_ws(' ', id, substr(chrom, 4), '0.0', pos, ref, alt) AS line FROM variants")
def _(t):
    return K.eigenstrat_snp_lines(t.v).select("chrom", "pos", "line")


@query("K12_eigenstrat_ind", "SELECT ROW_NUMBER() OVER (ORDER BY sample) - 1 AS sample_ix, concat_ws(' ', sample, 'U', COALESCE(pop, '???')) AS line FROM (SELECT DISTINCT sample FROM genotypes) LEFT JOIN m2 USING (sample)")
def _(t):
    return K.eigenstrat_ind_lines(K.cohort(t.g), t.m2)


def _grid_views():
    from allelespan.plans.statistic_queries import _cells

    return {
        **_cells("m3", calls="complete"),
        "c3": "SELECT variant_id, MAX(CASE pop WHEN 'A' THEN a END) AS a, MAX(CASE pop WHEN 'B' THEN a END) AS b, MAX(CASE pop WHEN 'C' THEN a END) AS c FROM cells GROUP BY variant_id HAVING BOOL_AND(r + a >= size)",
    }


_DIMS = [15, 15, 13]  # copies of 7, 7 and 6 diploid samples


@query(
    "K13_sfs_matrix",
    "SELECT CAST(i AS BIGINT) AS row, string_agg(CAST(COALESCE(n, 0) AS STRING), chr(9) ORDER BY j) AS line FROM (SELECT unnest(range(0, 15)) AS i) JOIN (SELECT unnest(range(0, 15)) AS j) ON TRUE LEFT JOIN (SELECT a AS i, b AS j, COUNT(*) AS n FROM c3 GROUP BY a, b) USING (i, j) GROUP BY i",
    _grid_views(),
)
def _(t):
    two = SFS.sfs_marginal(SFS.sfs(t.v, t.complete, t.m), [0, 1])
    return K.sfs_lines(SFS.dense(two, _DIMS[:2]), _DIMS[:2])


@query(
    "K13_sfs_flat",
    """SELECT CAST(cell AS BIGINT) AS cell, COALESCE(n, 0) AS n FROM (SELECT unnest(range(0, 2925)) AS cell)
       LEFT JOIN (SELECT (a*15 + b)*13 + c AS cell, COUNT(*) AS n FROM c3 GROUP BY ALL) USING (cell)""",
    _grid_views(),
)
def _(t):
    """The cells of the flat layout, read back by their places."""
    lines = K.sfs_lines(SFS.dense(SFS.sfs(t.v, t.complete, t.m), _DIMS), _DIMS)
    cells = lines.select("row", F.posexplode(F.split("line", "\t")).alias("k", "n"))
    return cells.select((F.col("row") * K.FLAT_CELLS + F.col("k")).alias("cell"), F.col("n").cast("long").alias("n"))


@query("K14_region_lines", "SELECT iv_id, concat(sample, ':', hap, chr(9), seq) AS line FROM seqs", _SEQ)
def _(t):
    return Q.region_lines(Q.haplotype_sequences(t.snps, t.g, t.loci, t.m, t.ref))


# ---- sources: written from the tables, then read back ---------------------------------------------------


def vcf_path(t):
    path = new_path(t.spark, "vcf")
    K.write_vcf(t.v, t.g, path)
    return path


_ALLCALLS = "SELECT chrom, pos, s.sample, CAST(a1 AS BIGINT) AS a1, CAST(a2 AS BIGINT) AS a2 FROM variants v JOIN (SELECT DISTINCT sample FROM genotypes) s ON TRUE LEFT JOIN (SELECT variant_id, sample, a1, a2 FROM genotypes) g ON g.variant_id = v.variant_id AND g.sample = s.sample"
_CALL = ["chrom", "pos", "sample", "a1", "a2"]


@query("S01_read_vcf_variants", "SELECT chrom, pos, id, ref, alts, filter FROM variants")
def _(t):
    v, _ = SV.read_vcf(t.spark, vcf_path(t))
    return v.select("chrom", "pos", "id", "ref", F.array_join("alts", ",").alias("alts"), "filter")


@query("S01_read_vcf_genotypes", _ALLCALLS)
def _(t):
    _, g = SV.read_vcf(t.spark, vcf_path(t))
    return g.select(*_CALL)


@query("S02_read_vcf_samples", f"SELECT * FROM ({_ALLCALLS}) WHERE sample IN ('S1', 'S5')")
def _(t):
    _, g = SV.read_vcf(t.spark, vcf_path(t), samples=["S1", "S5"])
    return g.select(*_CALL)


@query("S02_read_vcf_first_n", f"SELECT * FROM ({_ALLCALLS}) WHERE sample IN (SELECT sample FROM m3 ORDER BY sample LIMIT 3)")
def _(t):
    _, g = SV.read_vcf(t.spark, vcf_path(t), first_n=3)
    return g.select(*_CALL)


@query("S02_read_vcf_model", f"SELECT * FROM ({_ALLCALLS}) WHERE sample IN (SELECT sample FROM m2)")
def _(t):
    """The individuals of a model, one of whom the file lacks."""
    extra = M.model_create(t.spark, "pair", {"A": ["nobody"]}, "(A,B)")
    _, g = SV.read_vcf(t.spark, vcf_path(t), model=t.m2.unionByName(extra))
    return g.select(*_CALL)


@query("S03_match_samples", "SELECT pop, sample FROM m3 WHERE sample IN (SELECT sample FROM genotypes)")
def _(t):
    extra = M.model_create(t.spark, "three", {"A": ["nobody"]}, "((A,B),C)")
    return X.match_samples(t.m.unionByName(extra), t.g).select("pop", "sample")


@query("S03_missing_samples", "SELECT 'nobody' AS sample FROM (SELECT COUNT(*) FROM genotypes)")
def _(t):
    extra = M.model_create(t.spark, "three", {"A": ["nobody"]}, "((A,B),C)")
    return X.missing_samples(t.m.unionByName(extra), t.g).select("sample")


def _bed_file(t):
    path = new_path(t.spark, "bed")
    K.write_bed(t.iv_b, path, header="chromosome first last", mode="one_based")
    return path


@query("S04_read_bed", 'SELECT chrom, start, end_ AS "end" FROM iv_b')
def _(t):
    return ST.read_bed(t.spark, _bed_file(t), one_based=True).select("chrom", "start", "end")


@query("S04_read_bed_one_chromosome", 'SELECT chrom, start, end_ AS "end" FROM iv_b WHERE chrom = \'chr2\'')
def _(t):
    return ST.read_bed(t.spark, _bed_file(t), one_based=True, chrom="chr2").select("chrom", "start", "end")


@query("S05_parse_region", 'SELECT iv_id, chrom, start, end_ AS "end" FROM iv_b')
def _(t):
    text = F.concat_ws(":", "chrom", F.col("start").cast("string"), F.col("end").cast("string"))
    return ST.parse_region(t.iv_b.select("iv_id", text.alias("region")), "region").drop("region")


@query("S06_read_model", "SELECT model, tree, pop, CAST(pop_ix AS BIGINT) AS pop_ix, sample, CAST(sample_ix AS BIGINT) AS sample_ix FROM (SELECT * FROM m3 UNION ALL SELECT * FROM m5)")
def _(t):
    path = new_path(t.spark, "model")
    K.write_model(t.m.unionByName(t.m5), path)
    return ST.read_model(t.spark, path)


@query("S07_read_fasta", "SELECT chrom, chunk_start, seq FROM ref_chunks")
def _(t):
    path = new_path(t.spark, "fasta")
    head = t.sizes.select("chrom", F.lit(-1).cast("long").alias("o"), F.concat(F.lit(">"), "chrom", F.lit(" made")).alias("line"))
    # lines of 50 letters, so that chunks and lines do not line up with the width read back
    half = F.posexplode(F.array(F.substring("seq", 1, 50), F.substring("seq", 51, 50))).alias("h", "line")
    body = t.ref.select("chrom", "chunk_start", half).select("chrom", (2 * F.col("chunk_start") + F.col("h")).alias("o"), "line")
    K.write_lines(head.unionByName(body), path, ["chrom", "o"])
    return SS.read_fasta(t.spark, path, width=100).select("chrom", "chunk_start", "seq")


@query("S08_read_chrom_sizes", "SELECT chrom, size FROM sizes")
def _(t):
    path = new_path(t.spark, "sizes")
    t.sizes.write.option("sep", "\t").csv(path)
    return ST.read_chrom_sizes(t.spark, path)


@query(
    "S09_read_stat",
    """SELECT chrom AS "CHROM", CAST(FLOOR((pos-1)/1000) AS BIGINT)*1000 + 1 AS "BIN_START", CAST(FLOOR((pos-1)/1000) AS BIGINT)*1000 + 1000 AS "BIN_END", ROUND(AVG(p_size), 6) AS "PI" FROM variants GROUP BY 1, 2, 3""",
)
def _(t):
    start = F.floor((F.col("pos") - 1) / 1000) * 1000 + 1
    size = t.raw("part").select(F.col("p_partkey").alias("variant_id"), "p_size")
    st = t.v.join(size, "variant_id").groupBy(F.col("chrom").alias("CHROM"), start.alias("BIN_START"))
    path = new_path(t.spark, "stat")
    K.write_stat(st.agg(F.avg("p_size").alias("PI")), path)
    return ST.read_stat(t.spark, path, window_size=1000)


def _ped_files(t, v, g):
    path = new_path(t.spark, "ped")
    called = v.join(g.filter("a1 is not null").select("variant_id").distinct(), "variant_id", "left_semi")
    K.write_ped(called, g, path)
    return f"{path}/ped", f"{path}/map"


@query(
    "S10_read_ped",
    "SELECT substr(v.chrom, 4) AS chrom, v.pos, s.sample, CASE g.a1 WHEN 0 THEN ref WHEN 1 THEN alt END AS b1, CASE g.a2 WHEN 0 THEN ref WHEN 1 THEN alt END AS b2 FROM snps v JOIN (SELECT DISTINCT sample FROM genotypes) s ON TRUE LEFT JOIN genotypes g ON g.variant_id = v.variant_id AND g.sample = s.sample WHERE v.variant_id IN (SELECT variant_id FROM genotypes)",
)
def _(t):
    paths = _ped_files(t, t.snps.drop("cm"), t.g)
    return SG.read_ped(t.spark, *paths).select("chrom", "pos", "sample", "b1", "b2")


def _eigenstrat_files(t):
    path = new_path(t.spark, "eigenstrat")
    K.write_eigenstrat(t.snps, t.g, path, t.m)
    return path


_BYNUMBER = "SELECT substr(v.chrom, 4) AS chrom, v.pos, s.sample, CAST(LEAST(2 - a1 - a2, 2) AS BIGINT) AS dose FROM snps v JOIN (SELECT DISTINCT sample FROM genotypes) s ON TRUE LEFT JOIN (SELECT variant_id, sample, a1, a2 FROM genotypes) g ON g.variant_id = v.variant_id AND g.sample = s.sample WHERE v.variant_id IN (SELECT variant_id FROM genotypes)"


@query("S11_read_eigenstrat", _BYNUMBER.replace("LEAST(2 - a1 - a2, 2)", "2 - a1 - a2"))
def _(t):
    _, g, _ = SG.read_eigenstrat(t.spark, _eigenstrat_files(t))
    return g.select("chrom", "pos", "sample", (2 - F.col("a1") - F.col("a2")).alias("dose"))


@query("S11_read_eigenstrat_ind", "SELECT sample, pop FROM m3")
def _(t):
    _, _, ind = SG.read_eigenstrat(t.spark, _eigenstrat_files(t))
    return ind.select("sample", "pop")


@query("S12_read_id_list", "SELECT id FROM variants")
def _(t):
    path = new_path(t.spark, "ids")
    t.v.select(F.concat(F.lit(" "), "id")).write.text(path)
    return ST.read_id_list(t.spark, path)


@query("S13_read_ima_loci", f"SELECT concat_ws(':', chrom, start, end_) AS locus, pop, concat_ws(':', pop_ix, sample_ix, hap) AS name, seq FROM seqs", _SEQ)
def _(t):
    path = new_path(t.spark, "ima")
    seqs = Q.region_sequences(t.snps, t.g, t.loci, t.m, t.ref)
    K.write_ima(Q.ima_loci(seqs, _loci_lengths(t), t.loci, t.m), t.m, path, loci_per_file=16)
    return SS.read_ima_loci(t.spark, path).select("locus", "pop", "name", "seq")


@query(
    "S14_read_sites_alignment",
    "SELECT sample AS name, only_alleles AS seq FROM seqs WHERE hap = 0 AND EXISTS (SELECT 1 FROM recs WHERE recs.iv_id = seqs.iv_id)",
    _SEQ,
)
def _(t):
    """One alignment file per locus that has sites."""
    seqs = Q.haplotype_sequences(t.snps, t.g, t.loci, t.m, single=True).filter("seq <> ''")
    rows = seqs.select(
        "iv_id", F.lit(9).alias("o"), "sample", F.concat(F.rpad("sample", 10, " "), "seq").alias("line")
    )
    size = seqs.groupBy("iv_id").agg(F.count("*").cast("string").alias("n"), F.max(F.length("seq")).cast("string").alias("len"))
    top = F.array(
        F.lit("title"), F.lit("# comment"), F.concat_ws(" ", "n", "len"), F.concat_ws(" ", F.lit("1"), "len"), F.lit("All")
    )
    heads = size.select("iv_id", F.posexplode(top).alias("o", "line")).withColumn("sample", F.lit(""))
    path = new_path(t.spark, "sites")
    files = rows.unionByName(heads).repartition("iv_id").sortWithinPartitions("iv_id", "o", "sample")
    files.select("iv_id", "line").write.partitionBy("iv_id").text(path)
    return SS.read_sites_alignment(t.spark, path).select("name", "seq")


@query(
    "K15_convert_vcf_ped_eigenstrat",
    _BYNUMBER.replace("LEAST(2 - a1 - a2, 2)", "(a1 + a2) * (2 - a1 - a2)").replace("AS dose", "AS het"),
)
def _(t):
    """VCF to PED to EIGENSTRAT: heterozygosity survives whatever allele each format calls first."""
    ped, prefix = new_path(t.spark, "ped"), new_path(t.spark, "convert")
    convert(t.spark, vcf_path(t), "vcf", ped, "ped")
    convert(t.spark, ped, "ped", prefix, "eigenstrat")
    _, g = read_callset(t.spark, prefix, "eigenstrat")
    return g.select("chrom", "pos", "sample", ((F.col("a1") + F.col("a2")) * (2 - F.col("a1") - F.col("a2"))).alias("het"))


# ---- models ------------------------------------------------------------------------------------------


@query("D01_create_model", "SELECT pop, sample FROM m3")
def _(t):
    return M.model_from_table(t.m.select("pop", "sample").unionByName(t.m.select("pop", "sample")), "new").select("pop", "sample")


@query("D02_update_individuals", "SELECT pop, sample FROM m3 WHERE NOT (pop = 'A' AND sample IN ('S0', 'S3')) UNION ALL SELECT 'A', unnest(['X1', 'X2'])")
def _(t):
    return M.model_update_inds(t.m, "three", "A", add=["X1", "X2", "S6"], remove=["S0", "S3"]).select("pop", "sample")


@query("D03_update_populations", "SELECT model, pop, CAST(pop_ix - 1 AS BIGINT) AS pop_ix, sample FROM m3 WHERE pop <> 'A' UNION ALL SELECT 'three', 'D', 2, unnest(['X1', 'X2'])")
def _(t):
    out = M.model_update_pops(t.m, "three", add={"D": ["X1", "X2"]}, remove=["A"])
    return out.select("model", "pop", "pop_ix", "sample")


@query("D04_set_tree", "SELECT DISTINCT model, '(A,(B,C))' AS tree FROM m3")
def _(t):
    return M.model_set_tree(t.m, "three", "(A,(B,C))").select("model", "tree").distinct()


@query("D05_copy_model", "SELECT model, pop, sample FROM m3 UNION ALL SELECT 'copy', pop, sample FROM m3")
def _(t):
    return M.model_copy(t.m, "three", "copy").select("model", "pop", "sample")


@query("D06_model_counts", "SELECT model, COUNT(DISTINCT pop) AS n_pops, COUNT(DISTINCT sample) AS n_inds FROM (SELECT * FROM m3 UNION ALL SELECT * FROM m5) GROUP BY model")
def _(t):
    return M.model_counts(t.m.unionByName(t.m5))


@query("D06_population_counts", "SELECT model, pop, COUNT(DISTINCT sample) AS n_inds FROM (SELECT * FROM m3 UNION ALL SELECT * FROM m5) GROUP BY model, pop")
def _(t):
    return M.pop_counts(t.m.unionByName(t.m5))


@query("D07_conflicting_populations", "SELECT pop, COUNT(DISTINCT s) AS n_versions FROM (SELECT model, pop, string_agg(sample, ',' ORDER BY sample) AS s FROM (SELECT * FROM m3 UNION ALL SELECT * FROM m2) GROUP BY model, pop) GROUP BY pop HAVING COUNT(DISTINCT s) > 1")
def _(t):
    return M.model_check(t.m.unionByName(t.m2))


# ---- scalar functions ----------------------------------------------------------------------------------


@query("C02_coordinate_conversion", 'SELECT iv_id, start - 1 AS one_start, end_ AS one_end, start AS closed_start, end_ + 1 AS closed_end FROM iv_b')
def _(t):
    one = G.from_input_coordinates("start", "end", one_based=True)
    closed = G.from_input_coordinates("start", "end", zero_closed=True)
    return t.iv_b.select("iv_id", one[0].alias("one_start"), one[1].alias("one_end"), closed[0].alias("closed_start"), closed[1].alias("closed_end"))


@query("C03_max_allele_length", "SELECT variant_id, CAST(GREATEST(length(ref), 1) AS BIGINT) AS n FROM variants")
def _(t):
    return t.v.select("variant_id", G.max_allele_length().alias("n"))


@query("C04_flip_chrom", "SELECT variant_id, substr(chrom, 4) AS flipped, chrom AS back, TRUE AS same FROM variants")
def _(t):
    bare = G.flip_chr("chrom")
    return t.v.select("variant_id", bare.alias("flipped"), G.flip_chr(bare).alias("back"), P.same_chrom("chrom", bare).alias("same"))


@query("C05_region_name", "SELECT iv_id, concat(chrom, ':', start + 1, '-', end_) AS name FROM iv_b")
def _(t):
    return t.iv_b.select("iv_id", G.region_name("chrom", "start", "end").alias("name"))


@query("C08_iupac", f"SELECT variant_id, {_code('substr(ref, 1, 1)', 'alt')} AS code FROM variants")
def _(t):
    return t.v.select("variant_id", G.iupac_code(F.substring("ref", 1, 1), F.col("alts")[0]).alias("code"))


_CHROMS = "CASE iv_id % 5 WHEN 0 THEN 'X' WHEN 1 THEN 'chrY' WHEN 2 THEN 'MT' ELSE chrom END"


@query("C09_inheritance_scalar", "SELECT iv_id, CASE iv_id % 5 WHEN 0 THEN 75e-2 WHEN 1 THEN 25e-2 WHEN 2 THEN 25e-2 ELSE 1e0 END AS scalar FROM iv_b")
def _(t):
    return t.iv_b.select("iv_id", G.inheritance_scalar(F.expr(_CHROMS)).alias("scalar"))


@query("C10_id_delimiter", "SELECT '-' AS delimiter FROM (SELECT COUNT(*) FROM m3)")
def _(t):
    return K.id_delimiter(t.m.select(F.concat_ws("_", "pop", "sample").alias("sample")))


@query("C11_dna_alphabet", "SELECT chrom, chunk_start, TRUE AS ok, FALSE AS broken FROM ref_chunks")
def _(t):
    return t.ref.select("chrom", "chunk_start", G.is_dna("seq").alias("ok"), G.is_dna(F.concat("seq", F.lit("!"))).alias("broken"))


# ---- stream --------------------------------------------------------------------------------------------


@query(
    "T01_stream_filter_variants",
    "SELECT chrom, pos, id FROM variants WHERE n_alleles = 2 AND length(ref) = 1 AND filter = 'PASS' AND chrom <> 'chr4' AND (chrom <> 'chr2' OR pos >= 3000)",
)
def _(t):
    out, checkpoint = new_path(t.spark, "stream"), new_path(t.spark, "stream-checkpoint")
    tests = [P.only_biallelic(), P.passed(), ~P.chrom_in(["chr4"]), ~P.at_positions(["chr2:1-2999"])]
    running = stream_filter_variants(t.spark, vcf_path(t), out, checkpoint, tests, once=True)
    running.awaitTermination()
    return t.spark.read.parquet(out).select("chrom", "pos", "id")

