import random

import pytest
from pyspark.sql import functions as F

from allelespan.operators import intervals as I
from allelespan.operators import rangejoin as R
from allelespan.operators.ordered import running


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or ("chrom", "start", "end"))).collect())


def test_gaps_between_golden(intervals):
    iv = intervals([("1", 100, 200), ("1", 300, 399), ("1", 400, 500), ("1", 800, 1000)])
    assert rows(I.gaps_between(iv)) == [("1", 0, 100), ("1", 200, 300), ("1", 399, 400), ("1", 500, 800)]


def test_gaps_leading_only_for_first_chromosome(intervals):
    iv = intervals([("chr10", 50, 60), ("chr2", 30, 40), ("chr2", 50, 60)])
    assert rows(I.gaps_between(iv)) == [("chr2", 0, 30), ("chr2", 40, 50)]


def test_touching_merge_but_do_not_overlap(intervals):
    iv = intervals([("1", 832815, 832816), ("1", 832816, 832817)])
    assert rows(I.bed_merge(iv)) == [("1", 832815, 832817)]
    assert len(rows(I.fix_overlap(iv))) == 2
    assert not I.has_overlap(iv).first()[0]
    assert I.has_overlap(intervals([("1", 1, 5), ("1", 1, 3)])).first()[0]


def test_extend_golden(intervals):
    iv, sizes = intervals([("1", 521942, 521943)]), intervals([("1", 249250621)], "chrom string, size long")
    assert rows(I.bed_extend(iv, sizes, up=1000)) == [("1", 520942, 521943)]
    assert rows(I.bed_extend(iv, sizes, down=1000)) == [("1", 521942, 522943)]
    assert rows(I.bed_extend(iv, sizes, flanks=1000)) == [("1", 520942, 522943)]


def test_complement_twice_is_merge(intervals):
    rng = random.Random(3)
    iv = intervals([("a", s, s + rng.randint(1, 90)) for s in (rng.randint(0, 300000) for _ in range(400))])
    sizes = intervals([("a", 400000), ("b", 10)], "chrom string, size long")
    merged = I.bed_merge(iv)
    twice = I.bed_complement(I.bed_complement(merged, sizes), sizes)
    assert rows(twice.filter("chrom = 'a'")) == rows(merged)
    assert rows(I.bed_complement(merged, sizes).filter("chrom = 'b'")) == [("b", 0, 10)]
    assert rows(I.bed_merge(merged)) == rows(merged)


def test_merge_with_one_hot_start(intervals):
    iv = intervals([("a", 5, 6 + i % 7) for i in range(500)] + [("a", 200000, 200001)])
    assert rows(I.bed_merge(iv)) == [("a", 5, 12), ("a", 200000, 200001)]


@pytest.fixture(scope="module")
def mixed():
    """Lengths from one base to most of a chromosome, so that every bin width is in use."""
    rng = random.Random(11)

    def some(n):
        out = []
        for i in range(n):
            start = rng.randint(0, 3_000_000)
            out.append((i, rng.choice("xy"), start, start + int(10 ** rng.uniform(0, 6.3)) + 1))
        return out

    return some(160), some(140)


SCHEMA = "iv_id long, chrom string, start long, end long"


def brute(a, b):
    return {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3]}


@pytest.mark.parametrize("salts", [1, 3])
def test_overlap_pairs(intervals, mixed, salts):
    a, b = mixed
    got = R.overlap_pairs(intervals(a, SCHEMA), intervals(b, SCHEMA), salts=salts).select("iv_id", "b_iv_id").collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(r) for r in got} == brute(a, b)


def test_semi_and_anti(intervals, mixed):
    a, b = mixed[0], mixed[1][:9]
    hit = {x for x, _ in brute(a, b)}
    da, db = intervals(a, SCHEMA), intervals(b, SCHEMA)
    assert {r[0] for r in R.overlapping(da, db).collect()} == hit
    assert {r[0] for r in R.not_overlapping(da, db).collect()} == {x[0] for x in a} - hit


def test_subtract_leaves_the_uncovered_bases(intervals, mixed):
    a = [(i, c, s, min(e, s + 4000)) for i, c, s, e in mixed[0][:30]]
    b = [(i, c, s, min(e, s + 900)) for i, c, s, e in mixed[1]] + [(900 + x[0], x[1], x[2] + 10, x[2] + 30) for x in a]
    cut = I.bed_subtract(intervals(a, SCHEMA), intervals(b, SCHEMA)).collect()
    left = {}
    for r in cut:
        left.setdefault(r.iv_id, set()).update(range(r.start, r.end))
    for i, c, s, e in a:
        covered = {p for _, bc, bs, be in b if bc == c for p in range(max(s, bs), min(e, be))}
        assert left.get(i, set()) == set(range(s, e)) - covered


def test_running_columns_cross_blocks(spark):
    rng = random.Random(5)
    data = sorted({(k, rng.randint(0, 400)) for k in "pq" for _ in range(60)})
    data = [(k, p, rng.randint(0, 99)) for k, p in data]
    df = spark.createDataFrame(data, "k string, p long, x long")
    specs = {
        "m": ("max_before", "x"), "s": ("sum_before", "x"), "t": ("sum_through", "x"),
        "b": ("prev", "x"), "n": ("next", "x"),
    }
    got = {(r.k, r.p): r for r in running(df, ["k"], "p", specs, width=16).collect()}
    for k in "pq":
        seq = [d for d in data if d[0] == k]
        for i, (_, p, x) in enumerate(seq):
            r, earlier = got[k, p], [d[2] for d in seq[:i]]
            assert r.m == (max(earlier) if earlier else None)
            assert (r.s, r.t) == (sum(earlier), sum(earlier) + x)
            assert r.b == (seq[i - 1][2] if i else None)
            assert r.n == (seq[i + 1][2] if i + 1 < len(seq) else None)


def test_natural_order(intervals):
    names = ["chrX", "chr10", "2", "chr1", "chr2b", "MT"]
    got = [r.chrom for r in I.sort_intervals(intervals([(n, 1, 2) for n in names])).collect()]
    assert got == ["chr1", "2", "chr2b", "chr10", "MT", "chrX"]
    listed = I.sort_intervals(intervals([(n, 1, 2) for n in names]), "list", names[::-1]).collect()
    assert [r.chrom for r in listed] == names[::-1]
    with pytest.raises(Exception, match="sort order"):
        I.sort_intervals(intervals([("zz", 1, 2)]), "list", names).collect()


def test_nonmissing_chunks_rules(spark):
    bad = {100, 900, 2600}
    sites = [("c", p, int(p in bad)) for p in range(100, 3100, 100)]
    df = spark.createDataFrame(sites, "chrom string, pos long, n_missing long")
    assert rows(I.nonmissing_chunks(df, size=500), "first_pos", "last_pos") == [(200, 800), (1000, 2500)]
    wide = I.nonmissing_chunks(df, size=500, extend=True)
    assert rows(wide, "first_pos", "last_pos") == [(150, 850), (950, 2550)]


def test_classify_record(spark):
    v = spark.createDataFrame([("chr2", 11), ("chr2", 10), ("chr2", 21), ("chr1", 15), ("chr10", 15)], "chrom string, pos long")
    got = [r.placement for r in I.classify_record(v, ("chr2", 10, 20)).collect()]
    assert got == ["in", "before", "after", "before", "after"]
    assert I.classify_record(v, ("2", 10, 20)).filter(F.col("placement") == "in").count() == 1
