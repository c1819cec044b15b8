import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from allelespan.functions import genome as G
from allelespan.operators import counts as C
from allelespan.operators import diversity as D
from allelespan.operators import filters as X
from allelespan.operators import ld as LD
from allelespan.operators import models as M
from allelespan.operators import sampling as S
from allelespan.operators import sfs as Q


def random_calls(n_sites, n_samples, seed, missing=0.0):
    rng = random.Random(seed)
    out = []
    for _ in range(n_sites):
        p = rng.random()
        out.append(
            [".|." if rng.random() < missing else f"{int(rng.random() < p)}|{int(rng.random() < p)}" for _ in range(n_samples)]
        )
    return out


def test_half_called_genotypes_count_alleles_one_by_one(callset):
    _, g = callset([("1", 10, "A", ["C"])], [["0|1", ".|1", ".|."]])
    r = C.site_counts(g).first()
    assert (r.n_called, r.n_ref, r.n_alt, r.n_missing, r.n_missing_samples) == (3, 1, 2, 3, 2)


def test_invariant_counts_missing_as_a_key(callset):
    _, g = callset([("1", 1, "A", ["C"]), ("1", 2, "A", ["C"])], [["0|0", "0|0"], ["0|0", ".|."]])
    got = {r.pos: r.i for r in C.site_counts(g).select("pos", C.is_invariant().alias("i")).collect()}
    assert got == {1: True, 2: False}


def test_exact_hardy_weinberg_against_enumeration(callset):
    calls = [["0|1"] * h + ["0|0"] * a + ["1|1"] * b for h, a, b in [(3, 5, 2), (0, 6, 4), (10, 0, 0), (1, 9, 0)]]
    _, g = callset([("1", i + 1, "A", ["C"]) for i in range(4)], calls)
    got = {r.pos: r.p_exact for r in D.hardy_weinberg(g).collect()}

    def chance(h, n, rare):
        a, b = (rare - h) // 2, (2 * n - rare - h) // 2
        ways = math.factorial(n) / (math.factorial(a) * math.factorial(b) * math.factorial(h))
        return ways * 2**h / math.comb(2 * n, rare)

    for i, c in enumerate(calls):
        n, alt = len(c), sum(x.count("1") for x in c)
        rare, seen = min(alt, 2 * n - alt), c.count("0|1")
        all_p = [chance(h, n, rare) for h in range(rare % 2, rare + 1, 2)]
        want = sum(p for p in all_p if p <= chance(seen, n, rare) * (1 + 1e-9))
        assert got[i + 1] == pytest.approx(want)


def test_ld_matches_correlation(callset):
    n = 70  # more than one word of samples
    calls = random_calls(8, n, 4, missing=0.15)
    _, g = callset([("1", 10 * (i + 1), "A", ["C"]) for i in range(8)], calls)
    dose = np.array([[np.nan if "." in c else c.count("1") for c in row] for row in calls], float)
    got = LD.ld_pairs(g, stat="r", window_kb=0.035).collect()
    assert {(r.variant_id_i, r.variant_id_j) for r in got} == {(i, j) for i in range(8) for j in range(i + 1, min(8, i + 4))}
    for r in got:
        x, y = dose[r.variant_id_i], dose[r.variant_id_j]
        ok = ~np.isnan(x) & ~np.isnan(y)
        assert r.n == ok.sum()
        if r.r is not None:
            assert r.r == pytest.approx(np.corrcoef(x[ok], y[ok])[0, 1])


def test_ld_needs_a_window(callset):
    _, g = callset([("1", 1, "A", ["C"])], [["0|1"]])
    with pytest.raises(ValueError, match="window"):
        LD.ld_pairs(g)


def test_sfs_projection_keeps_mass_and_matches_outer_product(spark, callset):
    calls = [r for r in random_calls(40, 6, 9) if "1" in "".join(r) and "0" in "".join(r)]
    v, g = callset([("1", i + 1, "A", ["C"]) for i in range(len(calls))], calls)
    m = M.model_create(spark, "m", {"a": ["s00", "s01", "s02"], "b": ["s03", "s04", "s05"]})
    whole = Q.sfs(v, g, m)
    assert whole.agg(F.sum("n")).first()[0] == len(calls)
    small = Q.sfs(v, g, m, downsample={"a": 4, "b": 2}, round_int=False).collect()
    assert sum(r.n for r in small) == pytest.approx(len(calls))
    want = {}

    def weight(a, r, n, k):
        return math.comb(a, r) * math.comb(n - a, k - r) / math.comb(n, k)

    for row in calls:
        a, b = "".join(row[:3]).count("1"), "".join(row[3:]).count("1")
        for i, j in itertools.product(range(5), range(3)):
            w = weight(a, i, 6, 4) * weight(b, j, 6, 2)
            want[i, j] = want.get((i, j), 0) + w
    got = {tuple(r.counts): r.n for r in small}
    assert all(got.get(k, 0) == pytest.approx(x) for k, x in want.items())
    grid = Q.dense(whole, [7, 7])
    assert (grid.count(), grid.agg(F.sum("n")).first()[0]) == (49, len(calls))
    assert Q.sfs_marginal(whole, [1]).agg(F.sum("n")).first()[0] == len(calls)


def test_f_is_zero_sum_identity(callset):
    _, g = callset([("1", i + 1, "A", ["C"]) for i in range(30)], random_calls(30, 5, 2))
    for r in D.het_fit(g).collect():
        assert r.f == pytest.approx((r.o_hom - r.e_hom) / (r.n_sites - r.e_hom))


def test_take_lowest_is_exact_for_any_n(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3).withColumn("u", ((F.col("id") * 37) % 101) / F.lit(101.0))
    data = [(r.k, r.u, r.id) for r in df.collect()]
    for n in (1, 57, 333, 5000):
        got = {r.id for r in S.take_lowest(df, n, F.col("u"), ["id"], by=["k"], buckets=8).collect()}
        want = set()
        for k in range(3):
            want |= {i for _, _, i in sorted(d for d in data if d[0] == k)[:n]}
        assert got == want


def test_sampling_contract(spark):
    df = spark.range(100)
    one, two = (S.sample_rows(df.repartition(p), 10, seed=4, keys=["id"]) for p in (1, 7))
    assert one.count() == 10 and {r.id for r in one.collect()} == {r.id for r in two.collect()}
    with pytest.raises(Exception, match="larger than the table"):
        S.sample_rows(df, 101, keys=["id"]).collect()
    with pytest.raises(ValueError, match="evenly"):
        S.sample_uniform_bins(df, "id", 3, 10)
    st = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    bins = {r.x: r.bin for r in S.with_uniform_bins(st, "x", 5).collect()}
    assert bins == {0.0: 1, 1.0: 1, 2.0: 1, 3.0: 2, 4.0: 2, 10.0: 5}


def test_unknown_samples_raise_unless_forced(callset):
    _, g = callset([("1", 1, "A", ["C"])], [["0|1", "0|0"]])
    with pytest.raises(Exception, match="unknown sample: zz"):
        X.filter_samples(g, ["s00", "zz"]).collect()
    assert X.filter_samples(g, ["s00", "zz"], force=True).count() == 1


def test_models(spark):
    m = M.model_create(spark, "m", {"a": ["x", "y", "x"], "b": ["z"]})
    assert m.count() == 3
    with pytest.raises(ValueError, match="both added and removed"):
        M.model_update_inds(m, "m", "a", add=["q"], remove=["q"])
    with pytest.raises(Exception, match="not in tree: b"):
        M.model_set_tree(m, "m", "(a,c)").collect()
    assert {r.tree for r in M.model_set_tree(m, "m", "(a,b)").collect()} == {"(a,b)"}
    other = M.model_create(spark, "n", {"a": ["x"]})
    assert [r.pop for r in M.model_check(m.unionByName(other)).collect()] == ["a"]
    assert M.model_rename(m, "m", "k").select("model").distinct().first()[0] == "k"


def test_scalar_functions(spark):
    one = spark.range(1)
    got = one.select(
        G.flip_chr(F.lit("chr1")), G.flip_chr(F.lit("1")), G.merge_iupac(F.lit("ACGTN"), F.lit("AGTTA")),
        G.harmonic(F.lit(1)), G.harmonic(F.lit(4.5)), G.inheritance_scalar(F.lit("chrMT")), G.is_dna(F.lit("ACGTnry")),
        G.is_dna(F.lit("AC-T")), G.region_name(F.lit("1"), F.lit(99), F.lit(200)),
    ).first()
    assert tuple(got) == ("1", "chr1", "ASKTN", 1.0, pytest.approx(1 + 1 / 2 + 1 / 3), 0.25, True, False, "1:100-200")


def test_merged_sequences_look_at_letters_where_they_differ(spark):
    rng = random.Random(5)
    pairs = [("", ""), ("", "AC"), ("ACG", ""), (None, "A"), ("A" * 33, "A" * 32), ("\u00dfaC\u0131", "\u00dfAc\u0131"), ("acgtnACGTN-", "ACGTNacgta-")]
    for n in (1, 31, 32, 33, 64, 500):
        x = "".join(rng.choice("ACGTNacgt") for _ in range(n))
        pairs.append((x, "".join(rng.choice("ACGTN") if rng.random() < 0.05 else b for b in x)))
    rows = spark.createDataFrame(pairs, "x string, y string")
    merged = rows.select("x", "y", G.merge_iupac("x", "y").alias("code"))
    for x, y, code in merged.collect():
        if x is None:
            assert code is None
            continue
        n = max(len(x), len(y), 1)
        both = [(a + b).upper() for a, b in zip(x.ljust(n, "-"), y.ljust(n, "-"), strict=True)]
        assert code == "".join(G.IUPAC_PAIRS.get(p, "N") for p in both)
    # equal stretches are not split into letters
    plan = merged._jdf.queryExecution().analyzed().toString()
    assert "regexp_extract_all" in plan and not re.search(r"split\((x|y)#", plan)


@pytest.mark.parametrize("shape", ["triangle", "square", "square-zero"])
def test_ld_matrix_keeps_the_columns_of_absent_pairs(spark, shape):
    sites = spark.createDataFrame([("1", 10 * i, i) for i in range(6)], "chrom string, pos long, variant_id long")
    r2 = {(0, 3): 0.5, (0, 5): 0.25, (2, 3): 1.0, (4, 5): 0.75}
    rows = [("1", i, j, x) for (i, j), x in r2.items()]
    pairs = spark.createDataFrame(rows, "chrom_i string, variant_id_i long, variant_id_j long, r2 double")
    for r in LD.ld_matrix(pairs, sites, shape).collect():
        for c, x in enumerate(r.line.split("\t"), r.first_col):
            above = "0" if shape == "square-zero" else f"{r2.get((r.row, c), math.nan):g}"
            assert x == ("1" if c == r.row else above if c > r.row else f"{r2.get((c, r.row), math.nan):g}")
        partners = [i for i, j in r2 if j == r.row] + ([] if shape == "triangle" else [j for i, j in r2 if i == r.row])
        assert r.first_col == min([r.row, *partners]) and len(r.line.split("\t")) == max([r.row, *partners]) - r.first_col + 1
