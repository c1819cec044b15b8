"""Sites with more than one alternate, and sample lists that leave out part of the calls."""

from allelespan.operators import counts, diversity, filters

SITES = [("chr1", 10, "A", ["C", "G"]), ("chr1", 20, "A", ["C", "G"]), ("chr1", 30, "A", ["C"]), ("chr1", 40, "A", ["C"])]
CALLS = [["1|1", "2|2", "2|2"], ["0|0", "1|2", "1|2"], ["0|1", "1|0", ".|."], ["1|1", "1|1", "1|1"]]


def test_alternates_are_told_apart(callset):
    _, g = callset(SITES, CALLS)
    c = counts.site_counts(g)
    rows = c.select("pos", counts.is_invariant().alias("i"), counts.is_informative(2).alias("n")).collect()
    assert {r.pos: (r.i, r.n) for r in rows} == {10: (False, True), 20: (False, False), 30: (False, True), 40: (True, False)}


def test_check_record_keeps_two_alternates(callset):
    v, g = callset(SITES, CALLS)
    kept = {r.pos for r in filters.check_record(v, g, remove_missing=-1).collect()}
    assert kept == {10, 20, 30}


def test_missing_counts_only_listed_samples(spark, callset):
    v, g = callset(SITES, [["0|1", ".|.", "0|0"], [".|.", "0|0", "0|1"], ["0|1", "0|1", ".|."], ["0|1", "1|1", "0|0"]])
    two = spark.createDataFrame([("s00",), ("s02",)], "sample string")
    assert {r.pos for r in filters.filter_missing(v, g, two, max_count=0).collect()} == {10, 40}
    kept = filters.pass_sites(v, g, samples=two, remove_multiallele=False, inform_level=1).collect()
    assert {r.pos for r in kept} == {10, 40}
    listed = g.where("sample != 's01'")
    assert diversity.window_pi(g, two, 100).collect() == diversity.window_pi(listed, two, 100).collect()
