import json

import pytest
from pyspark.sql import functions as F

from allelespan.operators import callsets as CS
from allelespan.operators.counts import site_counts, with_absent_missing
from allelespan.operators import sequence as Q
from allelespan.sinks import layouts as K
from allelespan.sources import genotypes as SG
from allelespan.sources import sequences as SS
from allelespan.sources import tables as ST
from allelespan.sources import vcf as SV
from allelespan.operators import models as M

VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB
1\t10\trs1\tA\tC,G\t31.5\tPASS\tDP=4;H2\tGT:DP\t0|2:3\t./.
1\t20\t.\tAT\tA\t.\tq10\t.\tGT\t0/1\t.|1
"""


def test_read_vcf(spark, tmp_path):
    (tmp_path / "x.vcf").write_text(VCF)
    v, g = SV.read_vcf(spark, str(tmp_path / "x.vcf"))
    r = v.orderBy("pos").collect()
    assert (r[0].alts, r[0].qual, r[0].info["DP"], r[1].id, r[1].qual) == (["C", "G"], 31.5, "4", None, None)
    got = {(x.pos, x.sample): (x.a1, x.a2, x.phased) for x in g.collect()}
    assert got[10, "A"] == (0, 2, True) and got[10, "B"] == (None, None, False)
    assert got[20, "A"] == (0, 1, False) and got[20, "B"] == (None, 1, True)
    (tmp_path / "bad.vcf").write_text(VCF + "1\t30\t.\tA\tC\t.\tPASS\t.\tGT\t0/1\n")
    with pytest.raises(Exception, match="wrong number of columns"):
        SV.read_vcf(spark, str(tmp_path / "bad.vcf"))[1].collect()


def test_files_with_other_samples_are_refused(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(VCF)
    (tmp_path / "b.vcf").write_text(VCF.replace("\tA\tB\n", "\tA\tC\n"))
    with pytest.raises(Exception, match="different #CHROM lines"):
        SV.read_vcf(spark, str(tmp_path))[0].collect()


def test_written_vcf_is_one_ordered_document(spark, callset, tmp_path):
    v, g = callset([("chr10", 5, "A", ["C"]), ("chr2", 9, "G", ["T"]), ("chr2", 3, "T", ["A"])], [["0|1", ".|."]] * 3)
    K.write_vcf(v, g, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert lines[0].startswith("##fileformat") and lines[2].endswith("FORMAT\ts00\ts01")
    assert [tuple(x.split("\t")[:2]) for x in lines[3:]] == [("chr2", "3"), ("chr2", "9"), ("chr10", "5")]
    assert lines[3].endswith("GT\t0/1\t./.")


def test_quality_and_info_survive_a_round_trip(spark, tmp_path):
    (tmp_path / "x.vcf").write_text(VCF)
    v, g = SV.read_vcf(spark, str(tmp_path / "x.vcf"))
    lines = {r.pos: r.line.split("\t")[:9] for r in K.vcf_lines(v, g).collect()}
    want = {int(x.split("\t")[1]): x.split("\t")[:9] for x in VCF.splitlines()[2:]}
    assert lines == want


def test_calls_of_one_allele(spark, tmp_path):
    head = VCF.splitlines()[1] + "\n"
    (tmp_path / "x.vcf").write_text(head + "X\t10\t.\tA\tC\t.\tPASS\t.\tGT\t1\t0|1\nX\t20\t.\tA\tC\t.\tPASS\t.\tGT\t.\t0/.\n")
    v, g = SV.read_vcf(spark, str(tmp_path / "x.vcf"))
    people = spark.createDataFrame([("A",), ("B",), ("C",)], "sample string")
    counts = with_absent_missing(site_counts(g), people).orderBy("pos").collect()
    got = [(r.n_called, r.n_alt, r.n_missing, r.n_full, r.n_missing_samples) for r in counts]
    assert got == [(3, 2, 2, 1, 1), (1, 0, 4, 0, 3)]
    lines = [r.line.split("\t")[9:] for r in K.vcf_lines(v, g).orderBy("pos").collect()]
    assert lines == [["1", "0|1"], [".", "0/."]]
    (tmp_path / "y.vcf").write_text(head + "1\t10\t.\tA\tC\t.\tPASS\t.\tGT\t0/1/1\t0|1\n")
    with pytest.raises(Exception, match="more than two alleles"):
        SV.read_vcf(spark, str(tmp_path / "y.vcf"))[1].collect()


def test_region_text_is_cut_to_the_region(spark):
    bases = "ACGTTGCAACTTGACCAGTCAGGT"
    chunks = [("a", i, bases[i : i + 8]) for i in (0, 16)]  # the middle chunk is absent
    ref = spark.createDataFrame(chunks, "chrom string, chunk_start long, seq string")
    text = bases[:8] + "N" * 8 + bases[16:] + "N" * 8
    spans = [(x, y) for x in range(0, 26, 3) for y in range(x, 33)]
    iv = spark.createDataFrame([(f"{x}-{y}", "a", x, y) for x, y in spans], "iv_id string, chrom string, start long, end long")
    got = {(r.start, r.end): r.ref_seq for r in Q.region_text(iv, ref).collect()}
    assert got == {(x, y): text[x:y] for x, y in spans}


def test_fasta_chunks_do_not_follow_lines(spark, tmp_path):
    seq = {"a": "ACGTTGCAAC" * 7 + "GGT", "b": "TTA"}
    text = ""
    for name, s in seq.items():
        text += f">{name} some words\n" + "".join(s[i : i + 11] + "\n" for i in range(0, len(s), 11))
    (tmp_path / "r.fa").write_text(text)
    ref = SS.read_fasta(spark, str(tmp_path / "r.fa"), width=16)
    for name, s in seq.items():
        chunks = ref.filter(F.col("chrom") == name).orderBy("chunk_start").collect()
        assert [c.chunk_start for c in chunks] == list(range(0, len(s), 16))
        assert "".join(c.seq for c in chunks) == s


def test_bed_columns_header_and_negative(spark, tmp_path):
    (tmp_path / "a.bed").write_text("Info start first end last chrom c\nInfo start 100 end 200 chrom 11\n")
    r = ST.read_bed(spark, str(tmp_path / "a.bed"), cols=(2, 4, 6), one_based=True, keep_line=True).first()
    assert (r.chrom, r.start, r.end) == ("11", 99, 200) and r.payload.startswith("Info\tstart")
    (tmp_path / "b.bed").write_text("1\t-4\t6\n")
    with pytest.raises(Exception, match="negative coordinate"):
        ST.read_bed(spark, str(tmp_path / "b.bed")).collect()


def test_call_values_of_any_order(spark, tmp_path):
    calls = ["GT:DP:GQ\t0/1:3:7\t1|0", "GT:DP:GQ\t./1:.:7\t0/0:4", "DP:GT\t5:0/1\t.:1/1", "GT\t0/1\t1", "GQ:DP\t1:2\t3", "GT:DP\t0/1:.\t.:8"]
    lines = [f"1\t{10 + i}\t.\tA\tC\t.\tPASS\t.\t{c}" for i, c in enumerate(calls)]
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n"
    (tmp_path / "x.vcf").write_text(head + "\n".join(lines) + "\n")
    v, g = SV.read_vcf(spark, str(tmp_path / "x.vcf"))
    got = {(x.pos, x.sample): (x.a1, x.a2, x.ploidy, x.fields) for x in g.collect()}
    assert got[10, "A"] == (0, 1, 2, {"DP": "3", "GQ": "7"}) and got[10, "B"] == (1, 0, 2, {})
    assert got[11, "A"] == (None, 1, 2, {"DP": ".", "GQ": "7"}) and got[12, "B"] == (1, 1, 2, {"DP": "."})
    assert got[13, "B"] == (1, None, 1, {}) and got[14, "A"] == (None, None, None, {"GQ": "1", "DP": "2"})
    written = [r.line.split("\t", 8)[8] for r in K.vcf_lines(v, g).orderBy("pos").collect()]
    assert written[:4] == calls[:4] and written[5] == "GT:DP\t0/1:.\t.:8"
    K.write_vcf(v, g, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert [x.split("\t", 8)[8] for x in text.splitlines() if not x.startswith("#")] == written


def test_vcf_lines_are_made_once(spark, tmp_path, callset):
    v, g = callset([("chr1", p, "A", ["C"]) for p in range(1, 40)], [["0|1", "1|1"]] * 39)
    made = spark.sparkContext.accumulator(0)

    def count(x):
        made.add(1)
        return x

    counted = F.udf(count, "string").asNondeterministic()
    K.write_vcf(v.withColumn("id", counted("id")), g, str(tmp_path / "once"))
    assert made.value == 39


def test_loci_of_a_file_are_read_without_a_shuffle(spark, tmp_path):
    text = "title\n#rate\n2\nA B\n((0,1):2)\n2\nx:0:9 1 2 9 I 1 0.1\n0:0:0 ACGT\n\n#note\n1:0:0 AC\n1:0:1 GT\ny:0:9 2 0 9 I 1 0.1\n0:0:0 A\n0:0:1 C\n"
    (tmp_path / "f").write_text(text)
    got = SS.read_ima_loci(spark, str(tmp_path / "f"))
    rows = sorted((r.locus_ix, r.seq_ix, r.locus, r.pop, r.pop_ix, r.name, r.seq) for r in got.collect())
    assert rows == [
        (0, 0, "x:0:9", "A", 0, "0:0:0", "ACGT"), (0, 1, "x:0:9", "B", 1, "1:0:0", "AC"), (0, 2, "x:0:9", "B", 1, "1:0:1", "GT"),
        (1, 0, "y:0:9", "A", 0, "0:0:0", "A"), (1, 1, "y:0:9", "A", 0, "0:0:1", "C"),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_sequences_are_dealt_out_by_the_number_of_loci(spark):
    iv = spark.range(Q.LOCI_A_TASK * 3).select(F.concat(F.lit("r"), "id").alias("iv_id"), F.lit("chr1").alias("chrom"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 10).alias("end"))
    seqs = iv.select("*", F.lit(0).alias("pop_ix"), F.lit("A").alias("pop"), F.lit(0).alias("sample_ix"), F.lit("s").alias("sample"), F.array(F.lit("AC"), F.lit("GT")).alias("seqs"))
    loci = iv.select("iv_id", "chrom", "start", "end", F.lit(0).cast("long").alias("n_records"), F.lit(10).cast("long").alias("locus_len"), F.lit(1.0).alias("inheritance"), F.lit(1e-8).alias("locus_rate"))
    lines = Q.ima_loci(seqs, loci, iv, spark.createDataFrame([("A", 0, "s", 0)], "pop string, pop_ix int, sample string, sample_ix int"))
    assert lines.count() == 3 * iv.count()
    assert "REPARTITION_BY_NUM" in lines._jdf.queryExecution().toString()


def test_bed_header_of_several_part_files(spark, tmp_path):
    rows = [(f"chr{c}", x, x + 5) for c in (2, 10) for x in range(0, 600, 3)]
    iv = spark.createDataFrame(rows, "chrom string, start long, end long").repartition(3)
    # the file with the header is the smallest
    (tmp_path / "parts").mkdir()
    (tmp_path / "parts/part-00000").write_text("chromosome first last\n")
    K.write_bed(iv, str(tmp_path / "out"), mode="one_based")
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).splitlines(keepends=True)
    for i in range(4):
        (tmp_path / f"parts/part-0000{i + 1}").write_text("".join(text[i * 100 : (i + 1) * 100]))
    got = ST.read_bed(spark, str(tmp_path / "parts"), one_based=True).select("chrom", "start", "end").collect()
    assert sorted(map(tuple, got)) == sorted(rows)
    one = ST.read_bed(spark, str(tmp_path / "parts"), one_based=True, chrom="chr10").select("chrom", "start", "end").collect()
    assert sorted(map(tuple, one)) == sorted(r for r in rows if r[0] == "chr10")
    (tmp_path / "parts/part-00003").write_text("chr10\tx\t5\n")
    with pytest.raises(Exception, match="not an interval"):
        ST.read_bed(spark, str(tmp_path / "parts"), one_based=True).collect()


def test_unreadable_lines_raise(spark, tmp_path):
    for i, text in enumerate(["1\t4\t6\n1\tx\t9\n", "1\t4\t6\n1\t7\n", "chrom\tstart\tend\n1\t4\t6\n1\t4\tend\n"]):
        (tmp_path / f"{i}.bed").write_text(text)
        with pytest.raises(Exception, match="not an interval"):
            ST.read_bed(spark, str(tmp_path / f"{i}.bed")).collect()
    (tmp_path / "empty.bed").write_text("# nothing\n")
    assert ST.read_bed(spark, str(tmp_path / "empty.bed")).count() == 0
    (tmp_path / "x.map").write_text("1 a 0 10\n1 b 0 20\n")
    (tmp_path / "x.ped").write_text("f s 0 0 0 0 A C G\n")
    with pytest.raises(Exception, match="wrong number of columns"):
        SG.read_ped(spark, str(tmp_path / "x.ped"), str(tmp_path / "x.map")).collect()


def test_model_file_round_trip(spark, tmp_path):
    text = [{"name": "m", "tree": "", "pops": {"zeta": {"inds": ["b", "a"]}, "eta": {"inds": ["c"]}}}]
    (tmp_path / "m.json").write_text(json.dumps(text, indent=4))
    m = ST.read_model(spark, str(tmp_path / "m.json"))
    assert [tuple(r) for r in m.orderBy("pop_ix", "sample_ix").select("pop", "sample").collect()] == [("zeta", "b"), ("zeta", "a"), ("eta", "c")]
    assert json.loads(K.model_json(m).first().json) == text[0]


def test_ped_markers_do_not_carry_their_line(spark, tmp_path):
    n = 300
    (tmp_path / "x.map").write_text("".join(f"1 m{i} 0 {i + 1}\n" for i in range(n)))
    lines = [" ".join(["f", s, "0", "0", "0", "-9"] + [x] * 2 * n) + "\n" for s, x in (("s", "A"), ("t", "0"))]
    (tmp_path / "x.ped").write_text("".join(lines))
    long = SG.read_ped(spark, str(tmp_path / "x.ped"), str(tmp_path / "x.map"))
    got = {(r.sample, r.pos): (r.b1, r.b2) for r in long.collect()}
    assert got == {(s, i + 1): (x, x) for s, x in (("s", "A"), ("t", None)) for i in range(n)}
    # the line is split once, below the generator, and neither it nor its fields are repeated by marker
    plan = long._jdf.queryExecution().executedPlan().toString().splitlines()
    generate = next(x for x in plan if "Generate" in x)
    assert "transform(" not in generate and "[fileset#" in generate and " t#" not in generate
    assert not any("Filter" in x and "transform(" in x for x in plan)


def test_gphocs_lines_make_sequences_once(spark):
    iv = spark.createDataFrame([("b", "2", 0, 4), ("a", "1", 4, 8), ("c", "1", 0, 4)], "iv_id string, chrom string, start long, end long")
    texts = {"a": ["AC", "AG"], "b": ["AAAA", "AAAT"], "c": ["", ""]}
    people = [(0, 1, "y"), (1, 0, "z"), (0, 0, "x")]
    rows = [(i, pi, "p", si, who, texts[i], c, a, z) for i, c, a, z in map(tuple, iv.collect()) for pi, si, who in people]
    kinds = "iv_id string, pop_ix int, pop string, sample_ix int, sample string, seqs array<string>, chrom string, start long, end long"
    lines = Q.gphocs_loci(spark.createDataFrame(rows, kinds), iv)
    got = [tuple(r) for r in lines.orderBy("locus_ix", "line_ix").collect()]
    want = []
    for ix, (i, place, n) in enumerate([("c", "1:1-4", 1), ("a", "1:5-8", 2), ("b", "2:1-4", 4)]):
        code = {"c": "N", "a": "AS", "b": "AAAW"}[i]
        want += [(ix, 0, f"locus{ix}_{place} 3 {n}")] + [(ix, k + 1, f"{s} {code}") for k, s in enumerate("xyz")]
    assert got == want
    assert "Union" not in lines._jdf.queryExecution().optimizedPlan().toString()


def test_ped_blocks_and_eigenstrat(spark, callset, tmp_path):
    sites = [("1", 10 * i, "A", ["C"]) for i in range(1, 8)]
    v, g = callset(sites, [["0|1", "1|1", ".|."]] * 7)
    K.write_ped(v, g, str(tmp_path / "p"), block=3)
    back = SG.read_ped(spark, str(tmp_path / "p/ped"), str(tmp_path / "p/map"))
    got = {(r.pos, r.sample): (r.b1, r.b2) for r in back.collect()}
    assert len(got) == 21 and got[70, "s00"] == ("A", "C") and got[10, "s02"] == (None, None)
    K.write_eigenstrat(v, g, str(tmp_path / "e"))
    v2, g2, ind = SG.read_eigenstrat(spark, str(tmp_path / "e"))
    assert v2.count() == 7 and [r.sample for r in ind.orderBy("sample_ix").collect()] == ["s00", "s01", "s02"]
    assert {(r.sample, r.a1, r.a2) for r in g2.collect()} == {("s00", 0, 1), ("s01", 1, 1), ("s02", None, None)}


def test_sequences_with_indels_and_trim(spark, callset):
    ref = spark.createDataFrame([("1", 0, "ACGT"), ("1", 4, "ACGT"), ("1", 8, "AC")], "chrom string, chunk_start long, seq string")
    v, g = callset([("1", 3, "G", ["T"]), ("1", 5, "AC", ["A"])], [["0|1"], ["1|."]])
    iv = spark.createDataFrame([("r", "1", 1, 9)], "iv_id string, chrom string, start long, end long")
    m = M.model_create(spark, "m", {"p": ["s00"]})
    seqs = Q.region_sequences(v, g, iv, m, ref, indels=True).first().seqs
    assert seqs == ["CGTA_GTA", "CTTN_GTA"]
    assert Q.region_sequences(v, g, iv, m, ref).first().seqs == ["CGTACGTA", "CTTACGTA"]
    assert Q.region_sequences(v, g, iv, m).first().seqs == ["G", "T"]
    with pytest.raises(Exception, match="missing data"):
        Q.region_sequences(v, g, iv, m, ref, missing="error", indels=True).collect()


def test_merge_extends_indel_alleles(spark, callset):
    one = callset([("1", 5, "A", ["AT"])], [["0|1"]])
    v, g = callset([("1", 5, "AG", ["A"])], [["1|1"]])
    two = (v, g.withColumn("sample", F.lit("other")))
    mv, mg = CS.merge_callsets(one, two, mode="indels")
    r = mv.first()
    assert (r.ref, r.alts) == ("AG", ["ATG", "A"])
    assert {(x.sample, x.a1, x.a2) for x in mg.collect()} == {("s00", 0, 1), ("other", 2, 2)}
    assert CS.merge_callsets(one, two, mode="none")[0].count() == 2


def test_concat_needs_equal_samples(spark, callset):
    one = callset([("1", 5, "A", ["C"])], [["0|1"]])
    v, g = callset([("1", 6, "A", ["C"])], [["0|1", "0|0"]])
    with pytest.raises(Exception, match="different samples"):
        CS.concat_callsets(one, (v, g))[1].collect()


def test_empty_regions_raise(spark, callset):
    v, _ = callset([("1", 5, "A", ["C"])], [["0|1"]])
    iv = spark.createDataFrame([(1, "1", 0, 9), (2, "1", 50, 60)], "iv_id long, chrom string, start long, end long")
    assert CS.extract_regions(v, iv).count() == 1
    with pytest.raises(Exception, match="regions without records"):
        CS.extract_regions(v, iv, allow_empty=False).collect()


def test_stat_formatting(spark):
    st = spark.createDataFrame([("1", 1, 0.000334677), ("1", 2, None), ("1", 3, 2.0)], "CHROM string, POS long, PI double")
    assert [r.line for r in K.stat_lines(st).orderBy("POS").collect()] == ["1\t1\t0.000334677", "1\t2\tnan", "1\t3\t2"]


def test_alignment_as_callset(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">x\nACGT\n>y\nACTT\n>z\nAC\nTN\n")
    aligned = SS.read_aligned_fasta(spark, str(tmp_path / "a.fasta"))
    assert [r.seq for r in aligned.orderBy("seq_ix").collect()] == ["ACGT", "ACTT", "ACTN"]
    v, g, iv = SS.alignment_callset(aligned)
    assert [(r.pos, r.ref, r.alts) for r in v.collect()] == [(3, "G", ["T"])]
    assert sorted((r.a1, -1 if r.a2 is None else r.a2) for r in g.collect()) == [(0, 1), (1, -1)]
    assert iv.first().end == 4


def test_written_callset_never_sends_part_to_the_driver(spark, tmp_path):
    # a file's bytes say nothing of its rows: millions of them were broadcast from a file under the threshold
    from allelespan.plans.layout_queries import _rich_callset
    from allelespan.plans.tables import SCHEMAS, Tables

    spark.createDataFrame([(k, "n", "b", "t", k % 50 + 1, 1.0) for k in range(1, 19)], SCHEMAS["part"]).write.parquet(str(tmp_path / "part.parquet"))
    lines = [(k, k % 20, 3, 1, float(k), 1.0, 0.0, 0.0, "A", "O", None) for k in range(1, 19)]
    cols = ["l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    rows = spark.createDataFrame(lines, "l_partkey long, l_suppkey long, l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    rows.select(*cols).write.parquet(str(tmp_path / "lineitem.parquet"))
    for df in _rich_callset(Tables(spark, str(tmp_path))):
        assert df.count() == 20 and "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
