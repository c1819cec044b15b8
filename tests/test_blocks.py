import random

import pytest

from allelespan.operators import blocks as B

SMALL = [
    ("11", 100000, "C", ["A"]), ("11", 100001, "A", ["C"]), ("11", 100002, "T", ["C"]), ("11", 100003, "T", ["C"]),
    ("11", 100004, "G", ["C"]), ("11", 100005, "C", ["T"]), ("11", 100006, "T", ["G"]),
]
CALLS = [["0|1", "0|0", "0|0", "0|1", "0|0"]] + [["0|1", "0|1", "0|0", "0|0", "0|0"]] * 5 + [["1|1", "0|1", "1|1", "1|1", "1|1"]]


def sites_of(spark, callset, sites, calls, **options):
    v, g = callset(sites, calls)
    last = max(s[1] for s in sites)
    iv = spark.createDataFrame([("r", sites[0][0], 0, last + 10)], "iv_id string, chrom string, start long, end long")
    return B.polymorphic_sites(v, g, iv, g.select("sample").distinct(), **options)


def test_consecutive_sites_golden(spark, callset):
    sites = sites_of(spark, callset, SMALL, CALLS)
    blocks = B.compatible_intervals(sites, overlap_inf=True, overlap_noninf=True)
    left = B.pick_interval(blocks, "left", min_inf=2).first()
    assert (left.start, left.end, left.n_informative) == (100001, 100005, 5)


def conflicts(haps):
    """Brute force: all incompatible pairs by the four-gamete rule on 0/1 columns."""
    out = set()
    for i in range(len(haps)):
        for j in range(i + 1, len(haps)):
            count = 0
            for a in "01":
                for b in "01":
                    n = sum(x == a and y == b for x, y in zip(haps[i], haps[j]))
                    na, nb = haps[i].count(a), haps[j].count(b)
                    count += na > 1 and nb > 1 and 0 < n < na and n < nb
            if count >= 4:
                out.add((i, j))
    return out


@pytest.fixture(scope="module")
def rough():
    """A mosaic of a few ancestral haplotypes with rare switches: blocks of many lengths."""
    rng = random.Random(21)
    n, sites = 12, 70
    haps, column = [], [rng.choice("01") for _ in range(n)]
    while len(haps) < sites:
        if rng.random() < 0.06:
            rng.shuffle(column)
        c = list(column)
        if rng.random() < 0.5:
            cut = rng.randint(2, n - 2)
            c = [("1" if k < cut else "0") if column[k] == "1" else "0" for k in range(n)]
        if min(c.count("0"), c.count("1")) > 1:
            haps.append("".join(c))
    return haps


def as_callset(callset, haps):
    sites = [("c", 10 * (i + 1), "A", ["G"]) for i in range(len(haps))]
    return sites, [[f"{h[k]}|{h[k + 1]}" for k in range(0, len(h), 2)] for h in haps]


@pytest.mark.parametrize("window", [1, 3, 64])
def test_blocks_match_brute_force_for_any_window(spark, callset, rough, window):
    sites = sites_of(spark, callset, *as_callset(callset, rough))
    bad, n = conflicts(rough), len(rough)
    state = B.first_conflicts(sites, first_window=window)
    ends = []
    for p in range(n):
        e = p
        while e + 1 < n and not any(p <= i and j <= e + 1 for i, j in bad):
            e += 1
        ends.append(e)
    kept = [(p, e) for p, e in enumerate(ends) if p == 0 or e > ends[p - 1]]
    got = B.compatible_intervals(sites, overlap_inf=True, conflicts=state).collect()
    want = []
    for p, e in kept:
        end = 10 * (n if e == n - 1 else e + 2) - 1
        want.append((10 * (p + 1), end, e - p + 1))
    assert sorted((r.start, r.end, r.n_informative) for r in got) == want

    minimal = [(i, j) for i, j in bad if not any((k, m) != (i, j) and i <= k and m <= j for k, m in bad)]
    chain, upto = [], -1
    for i, j in sorted(minimal):
        if i >= upto:
            chain.append((10 * (i + 1), 10 * (j + 1) + 1))
            upto = j
    hk = B.hk_min_intervals(sites, conflicts=state).collect()
    assert sorted((r.start, r.end) for r in hk) == chain


def test_all_sites_are_used(spark, callset, rough):
    assert sites_of(spark, callset, *as_callset(callset, rough)).filter("informative").count() == len(rough)


def test_missing_data_skips_a_site(spark, callset):
    calls = [list(c) for c in CALLS]
    calls[2][0] = ".|1"
    assert 2 not in {r.variant_id for r in sites_of(spark, callset, SMALL, calls).collect()}
    assert 2 in {r.variant_id for r in sites_of(spark, callset, SMALL, calls, include_missing=True).collect()}
