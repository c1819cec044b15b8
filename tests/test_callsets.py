"""Merging callsets that hold several records at one position."""

from allelespan.operators.callsets import merge_callsets

V = "variant_id string, chrom string, pos long, id string, ref string, alts array<string>, filter string"
G = "variant_id string, chrom string, pos long, sample string, a1 int, a2 int"


def test_records_of_one_callset_stay_apart(spark):
    def callset(sample, alts):
        v = [(f"1:5:A:{a}", "1", 5, None, "A", [a], "PASS") for a in alts]
        g = [(f"1:5:A:{a}", "1", 5, sample, 0, i) for i, a in enumerate(alts)]
        return spark.createDataFrame(v, V), spark.createDataFrame(g, G)

    v, g = merge_callsets(callset("s1", ["C", "T"]), callset("s2", ["T"]))
    # T is in both and pairs with itself; C of the first is left alone
    assert sorted((r.variant_id, r.alts) for r in v.collect()) == [("1:5:A:C:2", ["C"]), ("1:5:A:T", ["T"])]
    calls = [(r.variant_id, r["sample"], r.a1, r.a2) for r in g.collect()]
    assert sorted(calls) == [("1:5:A:C:2", "s1", 0, 0), ("1:5:A:T", "s1", 0, 1), ("1:5:A:T", "s2", 0, 0)]


def test_one_record_each_becomes_multiallelic(spark):
    x = spark.createDataFrame([("x", "1", 5, None, "A", ["C"], "PASS")], V), spark.createDataFrame([("x", "1", 5, "s1", 0, 1)], G)
    y = spark.createDataFrame([("y", "1", 5, None, "A", ["T"], "PASS")], V), spark.createDataFrame([("y", "1", 5, "s2", 1, 1)], G)
    v, g = merge_callsets(x, y)
    assert [(r.variant_id, r.alts) for r in v.collect()] == [("1:5:A:C,T", ["C", "T"])]
    assert sorted((r["sample"], r.a1, r.a2) for r in g.collect()) == [("s1", 0, 1), ("s2", 2, 2)]
