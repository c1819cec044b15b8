"""Registered queries against their SQL in DuckDB.

By default one query per family runs; set ALLELESPAN_ALL=1 for all of them.
"""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from allelespan.plans.registry import ORACLE, QUERIES

SF = os.environ.get("ALLELESPAN_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["part", "lineitem", "orders", "customer"]
SOME = [
    "A04_window_pi", "A05_tajima_d", "A08_pairwise_windowed_fst", "A10_het_fis", "A12_patterson_d",
    "A18_watterson_theta", "F00_filter_variants", "F21_cpg", "F27_pass_sites", "J04_bed_intersect_pieces",
    "J05_bed_subtract", "J07_subtract_pieces", "J14_merge_multiallelic", "K05_snp_counts_outgroup", "K11_ped12_lines",
    "L04_ld_d_prime", "L10_interval_end_rules", "L11_hk_min_intervals", "M02_sample_uniform_bins", "Q03_sfs_downsampled_folded",
    "S07_read_fasta", "S13_read_ima_loci", "T01_stream_filter_variants", "W05_bed_merge_many", "W14_chunk_extension",
    "X02_indel_padding",
]
NAMES = list(QUERIES) if os.environ.get("ALLELESPAN_ALL") else SOME


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_keys_are_named_after_the_survey():
    assert all(re.match(r"^[A-Z]\d\d_[a-z0-9_]+$", k) for k in QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    cur = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()), key=repr)
    assert got == want
