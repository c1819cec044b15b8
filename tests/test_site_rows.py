"""Site rows against long genotypes, with half, haploid and multiallelic calls, absent ones and samples left out."""

import random

import pytest
from pyspark.sql import functions as F

from allelespan.operators import diversity as D
from allelespan.operators import fstats as FS
from allelespan.operators import intervals as I
from allelespan.operators.counts import allele_counts, of_samples, site_counts, with_population
from allelespan.operators.siterows import site_rows
from allelespan.sources import vcf as SV

RNG = random.Random(3)
SCHEMA = "variant_id long, chrom string, pos long, sample string, a1 int, a2 int, phased boolean, ploidy int"


@pytest.fixture(scope="module")
def calls(spark):
    rows = []
    for site in range(60):
        for s in range(12):
            if RNG.random() < 0.1:
                continue
            ploidy = 1 if s == 5 and site % 3 == 0 else 2
            a1, a2 = (RNG.choice([0, 0, 0, 1, 1, 2, None]) for _ in range(2))
            rows.append((site, "chr1", site * 10 + 1, f"S{s}", a1, None if ploidy == 1 else a2, False, ploidy))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def model(spark):
    return spark.createDataFrame([(f"S{s}", "AB"[s % 2], s % 2) for s in range(9)], "sample string, pop string, pop_ix int")


def same(x, y):
    cols = sorted(x.columns)
    show = lambda r: tuple(round(v, 9) if isinstance(v, float) else v for v in r)
    a, b = (sorted((show(r) for r in df.select(*cols).collect()), key=repr) for df in (x, y))
    assert cols == sorted(y.columns) and a == b and a


def test_counts(calls, model):
    rows = site_rows(calls)
    same(site_counts(rows), site_counts(calls))
    same(site_counts(rows, only=["n_called", "n_het"]), site_counts(calls).select("variant_id", "chrom", "pos", "n_called", "n_het"))
    same(allele_counts(rows), allele_counts(calls))
    same(site_counts(with_population(rows, model), ["pop"]), site_counts(with_population(calls, model), ["pop"]))
    few = model.filter("pop = 'A'")
    same(site_counts(of_samples(rows, few)), site_counts(of_samples(calls, few)))
    same(rows.of_samples(few).long().drop("sample_ix"), of_samples(calls, few))


def test_statistics(calls, model):
    rows = site_rows(calls)
    same(D.het_fit(rows), D.het_fit(calls))
    same(D.het_fis(rows, model), D.het_fis(calls, model))
    same(D.weir_fst(rows, model), D.weir_fst(calls, model))
    same(D.het_fit(of_samples(rows, model)), D.het_fit(of_samples(calls, model)))


def test_calls_are_not_shuffled(spark, calls, tmp_path, model):
    """From a table of site rows, only sums per sample move."""
    path = str(tmp_path / "rows")
    rows = site_rows(calls)
    rows.rows.write.parquet(path)
    stored = type(rows)(spark.read.parquet(path), spark.createDataFrame([(f"S{i}", i) for i in range(12)], "sample string, sample_ix int"))
    plan = D.het_fit(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") == 1


def test_alleles_beyond_63_raise(spark):
    one = spark.createDataFrame([(1, "1", 1, "a", 64, 0, False, 2)], SCHEMA)
    for g in (one, site_rows(one)):
        with pytest.raises(Exception, match="more than 63"):
            site_counts(g).collect()


def test_tiles_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(I, "TILES", 7)
    sizes = spark.createDataFrame([("a", 50), ("b", 1), ("c", 0), ("d", 49)], "chrom string, size long")
    got = sorted((r.chrom, r.start, r.end) for r in I.make_windows(sizes, 5, 2).collect())
    assert got == sorted((c, s, min(s + 5, n)) for c, n in (("a", 50), ("b", 1), ("d", 49)) for s in range(0, n, 2))


def test_many_combinations_are_one_literal(spark, calls):
    names = [f"P{i}" for i in range(8)]
    m = spark.createDataFrame([(f"S{i}", n, i) for i, n in enumerate(names)], "sample string, pop string, pop_ix int")
    out = FS.f4(calls, m, names, names, names, names, 1000)
    assert len(out._jdf.queryExecution().analyzed().toString()) < 200_000
    few = {tuple(r)[:4]: r.n_snps for r in FS.f4(calls, m, "P0", "P1", "P2", "P3", 1000).collect()}
    assert few.items() <= {tuple(r)[:4]: r.n_snps for r in out.collect()}.items()


def test_lines_that_repeat_and_calls_without_gt(spark, tmp_path):
    head = "##fileformat=VCFv4.2\n##source=x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n"
    line = "1\t10\trs1\tA\tC\t.\tPASS\t.\t{}\n"
    body = [line.format(x) for x in ("DP:GT\t3:0/1\t.:1", "DP:GT\t3:0/1\t.:1", "DP\t5\t6")]
    (tmp_path / "x.vcf").write_text(head + "".join(body))
    v, g = SV.read_vcf(spark, str(tmp_path / "x.vcf"))
    assert v.select("variant_id").distinct().count() == 3
    got = sorted(((r["sample"], r.a1, r.a2, r.ploidy, r.fields.get("DP")) for r in g.collect()), key=repr)
    assert got == sorted([("A", 0, 1, 2, "3"), ("B", 1, None, 1, ".")] * 2 + [("A", None, None, None, "5"), ("B", None, None, None, "6")], key=repr)
    assert [r.line for r in SV.read_vcf_header(spark, str(tmp_path)).orderBy("ord").collect()] == ["##fileformat=VCFv4.2", "##source=x"]
