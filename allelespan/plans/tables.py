"""Genomic views over the given tables.

``part`` rows become variants, ``lineitem`` calls, ``orders`` and ``customer`` intervals, and the
reference sequence follows from ``part``. ``VIEWS`` states the same definitions in SQL for checking.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.operators.intervals import make_windows
from allelespan.operators.siterows import SiteRows

# Given schemas: reading needs no inference job.
SCHEMAS = {
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}
LOCUS = 5000
PATTERN = "GATTACACCT"


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def v(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")

        def base(offset):
            return F.substring(F.lit("ACGT"), (offset % 4 + 1).cast("int"), F.lit(1))

        first, second = base(key + 1 + size % 3), base(key + 1 + (size + 1) % 3)
        pos = F.floor(key / 5).cast("long") * 100 + size
        return self.raw("part").select(
            key.alias("variant_id"),
            F.concat(F.lit("chr"), (key % 5 + 1).cast("string")).alias("chrom"),
            pos.alias("pos"),
            F.concat(F.lit("rs"), key.cast("string")).alias("id"),
            F.concat(base(key), F.when(key % 17 == 0, "A").otherwise("")).alias("ref"),
            F.when(key % 13 == 0, F.array(first, second)).otherwise(F.array(first)).alias("alts"),
            F.when(size % 10 == 0, "q10").otherwise("PASS").alias("filter"),
            (pos / F.lit(10000.0)).alias("cm"),
        )

    @property
    def part_sizes(self) -> DataFrame:
        """``p_partkey, p_size``. Joined with the hint ``merge`` where the other side has calls or variants: Spark takes the
        bytes of the file for its size, and the rows of a small file can fill the driver that broadcasts them."""
        return self.raw("part").select("p_partkey", "p_size")

    @cached_property
    def g(self) -> DataFrame:
        # dealt out by the key of the join: one shuffle for both
        calls = (
            self.raw("lineitem")
            .repartition("l_partkey")
            .groupBy(F.col("l_partkey").alias("p_partkey"), (F.col("l_suppkey") % 20).alias("ix"))
            .agg(F.sum("l_quantity").cast("long").alias("q"))
        )
        x = calls.join(self.part_sizes.hint("merge"), "p_partkey")
        limit = 2 * F.col("p_size") + 25 * (F.col("ix") % 3) - 25

        def allele(kq, ks, ki):
            draw = (F.col("q") * kq + F.col("p_size") * ks + F.col("ix") * ki) % 100
            return F.when(F.col("q") % 11 != 0, (draw < limit).cast("int"))

        return x.select(
            F.col("p_partkey").alias("variant_id"),
            F.concat(F.lit("chr"), (F.col("p_partkey") % 5 + 1).cast("string")).alias("chrom"),
            (F.floor(F.col("p_partkey") / 5).cast("long") * 100 + F.col("p_size")).alias("pos"),
            F.concat(F.lit("S"), F.col("ix").cast("string")).alias("sample"),
            allele(37, 11, 5).alias("a1"),
            allele(53, 29, 17).alias("a2"),
        )

    @cached_property
    def sites(self) -> SiteRows:
        """The calls of ``g`` as site rows."""
        ix = F.col("l_suppkey") % 20
        sums = [F.sum(F.when(ix == k, F.col("l_quantity"))).cast("long") for k in range(20)]
        calls = self.raw("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.array(*sums).alias("q"))
        x = calls.join(self.raw("part").select("p_partkey", "p_size"), "p_partkey")

        def call(q, i):
            limit = 2 * F.col("p_size") + 25 * (i % 3) - 25

            def allele(kq, ks, ki):
                draw = (q * kq + F.col("p_size") * ks + i * ki) % 100
                return F.when(q % 11 != 0, (draw < limit).cast("int"))

            return F.when(q.isNotNull(), F.struct(allele(37, 11, 5).alias("a1"), allele(53, 29, 17).alias("a2")))

        rows = x.select(
            F.col("p_partkey").alias("variant_id"),
            F.concat(F.lit("chr"), (F.col("p_partkey") % 5 + 1).cast("string")).alias("chrom"),
            (F.floor(F.col("p_partkey") / 5).cast("long") * 100 + F.col("p_size")).alias("pos"),
            F.explode(F.array(F.transform("q", call))).alias("calls"),  # made once, as if read from a table
        )
        who = self.samples.select("sample", F.substring("sample", 2, 9).cast("int").alias("sample_ix"))
        return SiteRows(rows, who)

    @cached_property
    def complete(self) -> DataFrame:
        """A call of every sample at every variant, missing ones taken as the reference."""
        names = self.samples.agg(F.array_sort(F.collect_set("sample"))).scalar()
        grid = self.v.select("variant_id", "chrom", "pos", names.alias("names"))
        grid = grid.select("variant_id", "chrom", "pos", F.explode("names").alias("sample"))
        calls = grid.join(self.g.select("variant_id", "sample", "a1", "a2"), ["variant_id", "sample"], "left")
        return calls.select("variant_id", "chrom", "pos", "sample", *[F.coalesce(a, F.lit(0)).alias(a) for a in ("a1", "a2")])

    @cached_property
    def snps(self) -> DataFrame:
        from allelespan.functions import predicates as P

        return self.v.filter(P.only_biallelic())

    def members(self, model: str, k: int, letters: str, tree: str) -> DataFrame:
        ix = self.raw("lineitem").select((F.col("l_suppkey") % 20).alias("ix")).distinct()
        return ix.select(
            F.lit(model).alias("model"),
            F.lit(tree).alias("tree"),
            F.substring(F.lit(letters), (F.col("ix") % k + 1).cast("int"), F.lit(1)).alias("pop"),
            (F.col("ix") % k).cast("int").alias("pop_ix"),
            F.concat(F.lit("S"), F.col("ix").cast("string")).alias("sample"),
            F.floor(F.col("ix") / k).cast("int").alias("sample_ix"),
        )

    @cached_property
    def m(self) -> DataFrame:
        """Three populations over all samples."""
        return self.members("three", 3, "ABC", "((A,B),C)")

    @cached_property
    def m2(self) -> DataFrame:
        """A model of two populations with two individuals each."""
        pair = self.members("pair", 3, "ABC", "(A,B)").filter("pop_ix < 2 AND sample_ix < 2")
        return pair

    @cached_property
    def m5(self) -> DataFrame:
        """Five populations over all samples."""
        return self.members("five", 5, "PQRST", "((((P,Q),R),S),T)")

    @cached_property
    def iv_a(self) -> DataFrame:
        start = F.col("o_custkey") * 25
        return self.raw("orders").select(
            F.col("o_orderkey").alias("iv_id"),
            F.concat(F.lit("chr"), (F.col("o_orderkey") % 5 + 1).cast("string")).alias("chrom"),
            start.alias("start"),
            (start + 1 + F.floor("o_totalprice").cast("long") % 200).alias("end"),
        )

    @cached_property
    def iv_b(self) -> DataFrame:
        start = F.col("c_custkey") * 25
        return self.raw("customer").select(
            F.col("c_custkey").alias("iv_id"),
            F.concat(F.lit("chr"), (F.col("c_nationkey") % 5 + 1).cast("string")).alias("chrom"),
            start.alias("start"),
            (start + 1 + F.floor(F.abs("c_acctbal")).cast("long") % 60).alias("end"),
        )

    @cached_property
    def sizes(self) -> DataFrame:
        return self.v.groupBy("chrom").agg((F.max("pos") + 1000).alias("size"))

    @cached_property
    def loci(self) -> DataFrame:
        tiles = make_windows(self.sizes, LOCUS)
        return tiles.select(
            F.concat_ws(":", "chrom", F.col("start").cast("string")).alias("iv_id"), "chrom", "start", "end"
        )

    @cached_property
    def ref(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        base = F.substring(F.lit("ACGT"), (key % 4 + 1).cast("int"), F.lit(1))
        allele = F.concat(base, F.when(key % 17 == 0, "A").otherwise(""))
        fill = F.substring(F.lit(PATTERN * 12), (key % 10 + 1).cast("int"), F.lit(110))
        left = F.substring(fill, F.lit(1), size - 1)
        right = F.substring(fill, size + F.length(allele), 100 - (size - 1) - F.length(allele))
        return self.raw("part").select(
            F.concat(F.lit("chr"), (key % 5 + 1).cast("string")).alias("chrom"),
            (F.floor(key / 5).cast("long") * 100).alias("chunk_start"),
            F.concat(left, allele, right).alias("seq"),
        )

    @cached_property
    def outgroup(self) -> DataFrame:
        """Another sequence: the reference shifted by one chromosome."""
        other = F.concat(F.lit("chr"), (F.substring("chrom", 4, 9).cast("int") % 5 + 1).cast("string"))
        return self.ref.withColumn("chrom", other)

    @cached_property
    def samples(self) -> DataFrame:
        return self.m.select("sample")


VIEWS = {
    "variants": f"""
      SELECT p_partkey AS variant_id, concat('chr', CAST(p_partkey % 5 + 1 AS STRING)) AS chrom,
       CAST(FLOOR(p_partkey/5) AS BIGINT)*100 + p_size AS pos, concat('rs', CAST(p_partkey AS STRING)) AS id,
       concat(substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1),
              CASE WHEN p_partkey % 17 = 0 THEN 'A' ELSE '' END) AS ref,
       substr('ACGT', CAST((p_partkey + 1 + p_size % 3) % 4 + 1 AS INT), 1) AS alt,
       concat(substr('ACGT', CAST((p_partkey + 1 + p_size % 3) % 4 + 1 AS INT), 1),
              CASE WHEN p_partkey % 13 = 0
                   THEN concat(',', substr('ACGT', CAST((p_partkey + 1 + (p_size + 1) % 3) % 4 + 1 AS INT), 1))
                   ELSE '' END) AS alts,
       CASE WHEN p_partkey % 13 = 0 THEN 3 ELSE 2 END AS n_alleles,
       CASE WHEN p_size % 10 = 0 THEN 'q10' ELSE 'PASS' END AS filter, p_size FROM part""",
    "genotypes": """
      SELECT v.variant_id, v.chrom, v.pos, concat('S', CAST(c.sample_ix AS STRING)) AS sample,
       CASE WHEN c.q % 11 = 0 THEN NULL WHEN (c.q*37 + v.p_size*11 + c.sample_ix*5) % 100
            < 2*v.p_size + 25*(c.sample_ix % 3) - 25 THEN 1 ELSE 0 END AS a1,
       CASE WHEN c.q % 11 = 0 THEN NULL WHEN (c.q*53 + v.p_size*29 + c.sample_ix*17) % 100
            < 2*v.p_size + 25*(c.sample_ix % 3) - 25 THEN 1 ELSE 0 END AS a2
       FROM (SELECT l_partkey, l_suppkey % 20 AS sample_ix, CAST(SUM(l_quantity) AS BIGINT) AS q
             FROM lineitem GROUP BY l_partkey, l_suppkey % 20) c
       JOIN variants v ON v.variant_id = c.l_partkey""",
    "sample_ixs": "SELECT DISTINCT l_suppkey % 20 AS ix FROM lineitem",
    "m3": """
      SELECT 'three' AS model, '((A,B),C)' AS tree, substr('ABC', CAST(ix % 3 + 1 AS INT), 1) AS pop, ix % 3 AS pop_ix,
       concat('S', CAST(ix AS STRING)) AS sample, CAST(FLOOR(ix / 3) AS BIGINT) AS sample_ix FROM sample_ixs""",
    "m2": "SELECT 'pair' AS model, '(A,B)' AS tree, pop, pop_ix, sample, sample_ix FROM m3 WHERE pop_ix < 2 AND sample_ix < 2",
    "m5": """
      SELECT 'five' AS model, '((((P,Q),R),S),T)' AS tree, substr('PQRST', CAST(ix % 5 + 1 AS INT), 1) AS pop,
       ix % 5 AS pop_ix, concat('S', CAST(ix AS STRING)) AS sample, CAST(FLOOR(ix / 5) AS BIGINT) AS sample_ix
      FROM sample_ixs""",
    "complete": """
      SELECT v.variant_id, v.chrom, v.pos, s.sample, COALESCE(a1, 0) AS a1, COALESCE(a2, 0) AS a2 FROM variants v JOIN m3 s ON TRUE
      LEFT JOIN (SELECT variant_id, sample, a1, a2 FROM genotypes) g ON g.variant_id = v.variant_id AND g.sample = s.sample""",
    "iv_a": """
      SELECT o_orderkey AS iv_id, concat('chr', CAST(o_orderkey % 5 + 1 AS STRING)) AS chrom, o_custkey*25 AS start,
       o_custkey*25 + 1 + CAST(FLOOR(o_totalprice) AS BIGINT) % 200 AS end_ FROM orders""",
    "iv_b": """
      SELECT c_custkey AS iv_id, concat('chr', CAST(c_nationkey % 5 + 1 AS STRING)) AS chrom, c_custkey*25 AS start,
       c_custkey*25 + 1 + CAST(FLOOR(ABS(c_acctbal)) AS BIGINT) % 60 AS end_ FROM customer""",
    "sizes": "SELECT chrom, MAX(pos) + 1000 AS size FROM variants GROUP BY chrom",
    "loci": f"""
      SELECT concat(chrom, ':', CAST(s AS STRING)) AS iv_id, chrom, s AS start, LEAST(s + {LOCUS}, size) AS end_
      FROM (SELECT chrom, size, unnest(range(0, size, {LOCUS})) AS s FROM sizes)""",
    "ref_chunks": f"""
      SELECT chrom, k*100 AS chunk_start,
        concat(substr(fill, 1, p_size - 1), ref, substr(fill, p_size + length(ref), 100 - (p_size - 1) - length(ref))) AS seq
      FROM (SELECT chrom, CAST(FLOOR(variant_id/5) AS BIGINT) AS k, ref, p_size,
              substr(repeat('{PATTERN}', 12), CAST(variant_id % 10 + 1 AS INT), 110) AS fill FROM variants)""",
    "outgroup": "SELECT concat('chr', CAST(CAST(substr(chrom, 4) AS INT) % 5 + 1 AS STRING)) AS chrom, chunk_start, seq FROM ref_chunks",
    "snps": "SELECT * FROM variants WHERE length(ref) = 1 AND n_alleles = 2",
    "counts": """
      SELECT variant_id, chrom, pos, CAST(2*COUNT(a1) AS BIGINT) AS n_called,
       CAST(2*COUNT(a1) - COALESCE(SUM(a1 + a2), 0) AS BIGINT) AS n_ref, CAST(COALESCE(SUM(a1 + a2), 0) AS BIGINT) AS n_alt,
       CAST(2*(COUNT(*) - COUNT(a1)) AS BIGINT) AS n_missing, COUNT(a1) AS n_full,
       COUNT(CASE WHEN a1 <> a2 THEN 1 END) AS n_het, COUNT(CASE WHEN a1 + a2 = 0 THEN 1 END) AS n_hom_ref,
       COUNT(CASE WHEN a1 + a2 = 2 THEN 1 END) AS n_hom_alt, COUNT(*) - COUNT(a1) AS n_missing_samples
      FROM genotypes GROUP BY variant_id, chrom, pos""",
    "total": "SELECT COUNT(*) AS n_total FROM m3",
    "full_counts": """
      SELECT c.variant_id, c.chrom, c.pos, n_called, n_ref, n_alt, n_full, n_total,
       n_missing + 2*(n_total - n_full - n_missing_samples) AS n_missing, n_total - n_full AS n_missing_samples
      FROM counts c, total""",
    "pcounts": """
      SELECT variant_id, chrom, pos, pop, pop_ix, COUNT(a1) AS n, CAST(COALESCE(SUM(a1 + a2), 0) AS BIGINT) AS alt,
       COUNT(CASE WHEN a1 <> a2 THEN 1 END) AS het
      FROM genotypes JOIN m3 USING (sample) GROUP BY variant_id, chrom, pos, pop, pop_ix""",
}
