"""Admixture statistics with a weighted delete-one-block jackknife.

Population combinations are given as name lists; they are expanded inside the row of a site, so no table
is crossed and each site is read once for all of them.
"""

from __future__ import annotations

import json
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.operators.counts import SITE, site_counts, with_population


def combinations(m: DataFrame | None, **labels: str | list[str]) -> list[dict[str, str]]:
    """Every combination of the populations given per label, each population used once."""
    lists = {k: [x] if isinstance(x, str) else list(x) for k, x in labels.items()}
    out = [dict(zip(lists, combo)) for combo in product(*lists.values())]
    return [c for c in out if len(set(c.values())) == len(c)]


def check_populations(m: DataFrame, names: list[str]) -> DataFrame:
    """Names that are not populations of the model (``pop``)."""
    wanted = m.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], "pop string")
    return wanted.join(m.select("pop").distinct(), "pop", "left_anti")


def frequencies(g: DataFrame, m: DataFrame, pops: list[str]) -> DataFrame:
    """One row per site with ``p_<i>`` (reference frequency) and ``n_<i>`` per listed population."""
    aggs = []
    a1, a2, pop = F.col("a1"), F.col("a2"), F.col("pop")
    for i, name in enumerate(pops):
        here = pop == name
        called = F.sum(F.when(here, a1.isNotNull().cast("long") + a2.isNotNull().cast("long")))
        refs = F.sum(
            F.when(
                here,
                F.coalesce((a1 == 0).cast("long"), F.lit(0)) + F.coalesce((a2 == 0).cast("long"), F.lit(0)),
            )
        )
        aggs += [called.alias(f"n_{i}"), refs.alias(f"r_{i}")]
    members = m.filter(F.col("pop").isin(pops))
    out = with_population(g, members).groupBy(*SITE).agg(*aggs)
    for i in range(len(pops)):
        p = F.col(f"r_{i}").cast("double") / F.nullif(F.col(f"n_{i}").cast("double"), F.lit(0.0))
        out = out.withColumn(f"p_{i}", p)
    return out


def _terms(sites: DataFrame, combos, pops, term, block: int) -> DataFrame:
    """Sum numerators and denominators per combination and block, in one pass over the sites.

    The combinations are one literal array of places in ``pops``, whatever their number.
    """
    at = {name: i for i, name in enumerate(pops)}
    labels = list(combos[0])
    places = F.from_json(F.lit(json.dumps([[at[c[k]] for k in labels] for c in combos])), "array<array<int>>")
    rows = sites.select(
        "chrom", F.floor(F.col("pos") / block).cast("long").alias("block"), F.array(*[F.col(f"p_{i}") for i in range(len(pops))]).alias("ps"),
        F.array(*[F.col(f"n_{i}").cast("double") for i in range(len(pops))]).alias("ns"),
    )

    def sums(c: Column) -> Column:
        p, n = ({k: F.get(x, F.get(c, F.lit(j))) for j, k in enumerate(labels)} for x in ("ps", "ns"))
        num, den = term(p, n)
        return F.struct(num.alias("num"), den.alias("den"))

    long = rows.select("chrom", "block", F.posexplode(F.transform(places, sums)).alias("combo", "t")).select("chrom", "block", "combo", "t.*")
    out = (
        long.filter(F.col("num").isNotNull() & F.col("den").isNotNull())
        .groupBy("combo", "chrom", "block")
        .agg(F.sum("num").alias("num"), F.sum("den").alias("den"), F.count("*").alias("m"))
    )
    names, own = F.array(*[F.lit(x) for x in pops]), F.get(places, F.col("combo"))
    return out.select(*[F.get(names, F.get(own, F.lit(j))).alias(k) for j, k in enumerate(labels)], "chrom", "block", "num", "den", "m")


def jackknife(blocks: DataFrame, labels: list[str]) -> DataFrame:
    """Ratio of sums, weighted block-jackknife error and Z.

    The window holds one row per block (genome length / block size), never the sites.
    """
    w = W.partitionBy(*labels)
    tn, td, tm = F.sum("num").over(w), F.sum("den").over(w), F.sum("m").over(w)
    b = blocks.select(*labels, "num", "den", "m", tn.alias("tn"), td.alias("td"), tm.alias("tm"))
    b = b.withColumn("g", F.count("*").over(w).cast("double"))

    def over(x: Column, y: Column) -> Column:
        return x / F.nullif(y, F.lit(0.0))

    b = b.withColumn("est", over(F.col("tn"), F.col("td"))).withColumn(
        "loo", over(F.col("tn") - F.col("num"), F.col("td") - F.col("den"))
    )
    h, mm, g = F.col("tm").cast("double") / F.col("m"), F.col("m").cast("double"), F.col("g")
    shrink = F.sum((1 - mm / F.col("tm")) * F.col("loo")).over(w)
    b = b.withColumn("h", h).withColumn("centre", g * F.col("est") - shrink)
    dev = F.col("h") * F.col("est") - (F.col("h") - 1) * F.col("loo") - F.col("centre")
    out = b.groupBy(*labels).agg(
        F.max("est").alias("estimate"),
        F.sum(dev * dev / F.nullif(F.col("h") - 1, F.lit(0.0))).alias("ss"),
        F.max("g").alias("g"),
        F.max("tm").alias("n_snps"),
    )
    se = F.sqrt(F.col("ss") / F.col("g"))
    return out.select(
        *labels, "estimate", se.alias("stderr"), over(F.col("estimate"), se).alias("z"), "n_snps"
    )


def _run(g, m, term, block, labels) -> tuple[DataFrame, list[str]]:
    combos = combinations(m, **labels)
    if not combos:
        raise ValueError("no combination of distinct populations")
    pops = sorted({x for c in combos for x in c.values()})
    return _terms(frequencies(g, m, pops), combos, pops, term, block), list(labels)


def patterson_d(g: DataFrame, m: DataFrame, w, x, y, z, block: int) -> DataFrame:
    """D with the ABBA and BABA sums; label columns are ``pop_w`` to ``pop_z``."""
    labels = {"w": w, "x": x, "y": y, "z": z}

    def term(p, n):
        num = (p["w"] - p["x"]) * (p["y"] - p["z"])
        den = (p["w"] + p["x"] - 2 * p["w"] * p["x"]) * (p["y"] + p["z"] - 2 * p["y"] * p["z"])
        return num, den

    return _finish(*_run(g, m, term, block, labels), patterns=True)


def _finish(blocks: DataFrame, names: list[str], patterns: bool = False) -> DataFrame:
    safe = [f"pop_{n}" for n in names]
    for n, s in zip(names, safe):
        blocks = blocks.withColumnRenamed(n, s)
    out = jackknife(blocks, safe)
    if patterns:
        # den = baba + abba and num = baba - abba per site, both sums follow
        sums = blocks.groupBy(*safe).agg(
            (F.sum(F.col("den") + F.col("num")) / 2).alias("baba"),
            (F.sum(F.col("den") - F.col("num")) / 2).alias("abba"),
        )
        out = out.join(sums, safe)
    return out


def f4(g: DataFrame, m: DataFrame, w, x, y, z, block: int) -> DataFrame:
    def term(p, n):
        num = (p["w"] - p["x"]) * (p["y"] - p["z"])
        return num, num * 0 + 1

    return _finish(*_run(g, m, term, block, {"w": w, "x": x, "y": y, "z": z}))


def f4_ratio(g: DataFrame, m: DataFrame, a, b, c, x, o, block: int) -> DataFrame:
    def term(p, n):
        ao = p["a"] - p["o"]
        return ao * (p["x"] - p["c"]), ao * (p["b"] - p["c"])

    return _finish(*_run(g, m, term, block, {"a": a, "b": b, "c": c, "x": x, "o": o}))


def f3(g: DataFrame, m: DataFrame, a, b, c, block: int) -> DataFrame:
    def term(p, n):
        own = p["c"] * (1 - p["c"]) / F.nullif(n["c"] - 1, F.lit(0.0))
        num = (p["c"] - p["a"]) * (p["c"] - p["b"]) - own
        return num, num * 0 + 1

    return _finish(*_run(g, m, term, block, {"a": a, "b": b, "c": c}))
