import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from allelespan.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"}
    session = build_session("tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("OFF")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def intervals(spark):
    def make(rows, schema="chrom string, start long, end long"):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def callset(spark):
    """``make(sites, calls)``: sites (chrom, pos, ref, alts) and one 'a|b' string per sample."""

    def make(sites, calls):
        v = [(i, c, p, f"rs{i}", r, a, "PASS") for i, (c, p, r, a) in enumerate(sites)]
        g = []
        for i, (c, p, _, _) in enumerate(sites):
            for s, text in enumerate(calls[i]):
                a1, a2 = (None if x == "." else int(x) for x in text.replace("/", "|").split("|"))
                g.append((i, c, p, f"s{s:02d}", a1, a2))
        vs = "variant_id long, chrom string, pos long, id string, ref string, alts array<string>, filter string"
        gs = "variant_id long, chrom string, pos long, sample string, a1 int, a2 int"
        return spark.createDataFrame(v, vs), spark.createDataFrame(g, gs)

    return make
