"""Site-frequency spectra in sparse long form.

A spectrum is ``counts array<int>`` (one entry per population, in model order) and ``n double``.
Only cells that occur are rows; the dense grid exists only in the text layouts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespan.functions.genome import hypergeometric_weight
from allelespan.operators.counts import SITE, copies, is_invariant, site_counts, with_absent_missing, with_population
from allelespan.functions import predicates as P
from allelespan.operators.rangejoin import sites_with_regions
from allelespan.operators.sampling import thin

MAX_MISSING = 10  # default of ``max_missing``: missing alleles a site may have; raise it with the cohort


def gated_sites(v: DataFrame, g: DataFrame, m: DataFrame, max_missing: int = MAX_MISSING) -> DataFrame:
    """SNPs that vary among the model's samples and miss at most ``max_missing`` alleles there."""
    sub = g.join(m.select("sample").distinct(), "sample", "left_semi")
    c = with_absent_missing(site_counts(sub), m)
    ok = c.filter((F.col("n_missing") <= max_missing) & ~is_invariant()).select("variant_id")
    return v.filter(P.is_snp()).join(ok, "variant_id", "left_semi")


def ancestral_base(v: DataFrame, ref: DataFrame) -> DataFrame:
    """Add ``outgroup``: the base of another reference at each record's position (null = unknown)."""
    width = ref.agg(F.max(F.length("seq")).cast("long")).scalar()
    at = v.withColumn("__w", width).withColumn(
        "chunk_start", F.floor((F.col("pos") - 1) / F.col("__w")).cast("long") * F.col("__w")
    )
    near = at.join(ref.select("chrom", "chunk_start", "seq"), ["chrom", "chunk_start"], "left")
    base = F.upper(F.substring("seq", (F.col("pos") - F.col("chunk_start")).cast("int"), 1))
    return near.withColumn("outgroup", base).select(*v.columns, "outgroup")


def polarise(v: DataFrame, ref: DataFrame) -> DataFrame:
    """Add ``swap`` (the outgroup carries the first alternate) and ``known`` (it carries any allele)."""
    alts = F.transform("alts", lambda a: F.upper(a))
    with_base = ancestral_base(v, ref)
    return with_base.withColumn("swap", F.coalesce(F.col("outgroup") == alts[0], F.lit(False))).withColumn(
        "known",
        F.coalesce(
            (F.col("outgroup") == F.upper("ref")) | F.array_contains(alts, F.col("outgroup")), F.lit(False)
        ),
    )


def pop_sizes(m: DataFrame) -> DataFrame:
    """``pop, pop_ix, size``: chromosomes per population."""
    return m.groupBy("pop", "pop_ix").agg((2 * F.countDistinct("sample")).cast("int").alias("size"))


def model_pops(m: DataFrame, downsample: dict[str, int] | None = None) -> Column:
    """Scalar array ``struct<pop_ix, size, need>`` in model order, as small as the model."""
    need = F.col("size")
    if downsample is not None:
        table = F.create_map(*[F.lit(x) for kv in downsample.items() for x in kv])
        need = F.element_at(table, F.col("pop"))
    entry = F.struct("pop_ix", "size", need.alias("need"))
    return pop_sizes(m).agg(F.array_sort(F.collect_list(entry))).scalar()


def pop_cells(
    v: DataFrame,
    g: DataFrame,
    m: DataFrame,
    iv: DataFrame | None = None,
    ref: DataFrame | None = None,
    folded: bool | str = False,
    downsample: dict[str, int] | None = None,
    prop: float | None = None,
    seed: int = 0,
    draw_col: Column | None = None,
    max_missing: int = MAX_MISSING,
    gate: bool = True,
) -> DataFrame:
    """One row per gated SNP (and region that holds it): ``c`` copies of the counted allele per
    population in model order, ``pops``, ``ok`` when every population has enough called alleles and
    ``known`` when the outgroup is usable. Without ``gate`` all SNPs with calls, and ``out`` with what the
    gate has against them.

    The genotypes are aggregated once, by site and population; the site gate and the counts both
    come from those partial rows.
    """
    per_pop = site_counts(with_population(g, m), ["pop_ix"])
    sites = per_pop.groupBy("variant_id").agg(
        F.map_from_entries(F.collect_list(F.struct("pop_ix", F.struct("n_ref", "n_alt")))).alias("by_pop"),
        *[F.sum(c).alias(c) for c in ("n_ref", "n_alt", "n_missing", "n_missing_samples", "n_rows")],
    )
    reason = F.when(F.col("n_missing") > max_missing, "missing").when(is_invariant(pooled=True), "invariant")
    sites = with_absent_missing(sites, m).withColumn("out", reason)
    if gate:
        sites = sites.filter(F.col("out").isNull())
    records = v.filter(P.is_snp())
    if prop is not None:
        records = thin(records, prop, seed, draw_col=draw_col)
    if ref is not None and not folded:
        records = polarise(records, ref)
    else:
        records = records.withColumn("swap", F.lit(False)).withColumn("known", F.lit(True))
    rows = records.select(*SITE, "swap", "known").join(sites.select("variant_id", "by_pop", "out"), "variant_id")
    if iv is not None:  # a SNP in two overlapping regions counts twice
        rows = sites_with_regions(rows, iv.select("chrom", "start", "end"))
    rows = rows.withColumn("pops", model_pops(m, downsample))
    none = F.struct(F.lit(0).cast("long").alias("n_ref"), F.lit(0).cast("long").alias("n_alt"))
    at = F.transform("pops", lambda p: F.coalesce(F.try_element_at("by_pop", p["pop_ix"]), none))
    rows = rows.withColumn("at", at)

    swap = F.col("swap")
    if folded == "together":
        if downsample is not None:
            raise ValueError("a spectrum folded over all populations together is not projected")
        surplus = F.aggregate("at", F.lit(0).cast("long"), lambda n, x: n + x["n_alt"] - x["n_ref"])
        swap = surplus > 0

    def counted(x):
        n = F.least(x["n_ref"], x["n_alt"]) if folded is True else F.when(swap, x["n_ref"]).otherwise(x["n_alt"])
        return n.cast("int")

    enough = F.zip_with("at", "pops", lambda x, p: x["n_ref"] + x["n_alt"] >= p["need"])
    return rows.select(
        *SITE, "pops", "known", F.transform("at", counted).alias("c"), F.forall(enough, lambda x: x).alias("ok"), "out"
    )


def _weights(a: Column, size: Column, need: Column, top: Column, folded: bool) -> Column:
    """Chance of r = 0..top copies among ``need`` chromosomes, both allele labels if ``folded``."""

    def weight(r):
        w = hypergeometric_weight(a, r, size, need)
        if not folded:
            return w
        return w + F.when(need != 2 * r, hypergeometric_weight(a, need - r, size, need)).otherwise(0.0)

    return F.transform(F.sequence(F.lit(0), top), weight)


def sfs(
    v: DataFrame,
    g: DataFrame,
    m: DataFrame,
    iv: DataFrame | None = None,
    ref: DataFrame | None = None,
    folded: bool | str = False,
    downsample: dict[str, int] | None = None,
    prop: float | None = None,
    seed: int = 0,
    round_int: bool = True,
    draw_col: Column | None = None,
    max_missing: int = MAX_MISSING,
) -> DataFrame:
    """Joint spectrum over the model's populations.

    ``folded`` counts the minor allele of each population on its own, or, if ``"together"``, in every
    population the allele that is rarer in all of them. ``downsample`` maps each
    population to a smaller number of chromosomes and projects hypergeometrically: sites with equal
    counts project alike and are added up first, then the outer product over populations is a chain
    of explodes of per-population weights.
    """
    rows = pop_cells(v, g, m, iv, ref, folded, downsample, prop, seed, draw_col, max_missing).filter("ok AND known")
    if downsample is None:
        out = rows.groupBy(F.col("c").alias("counts")).agg(F.count("*").cast("double").alias("n"))
    else:
        cells = rows.groupBy("c").agg(F.first("pops").alias("pops"), F.count("*").cast("double").alias("w"))
        # all weights of a row first, then the outer product is explodes and multiplications only
        for i in range(len(downsample)):
            p, a = F.col("pops")[i], F.col("c")[i]
            top = F.floor(p["need"] / 2).cast("int") if folded else p["need"]
            cells = cells.withColumn(f"w{i}", _weights(a, p["size"], p["need"], top, folded))
        cells = cells.withColumn("counts", F.array().cast("array<int>"))
        for i in range(len(downsample)):
            cells = (
                cells.select("*", F.posexplode(f"w{i}").alias("r", "x"))
                .filter(F.col("x") > 0)
                .withColumn("w", F.col("w") * F.col("x"))
                .withColumn("counts", F.array_append("counts", F.col("r")))
                .drop("r", "x", f"w{i}")
            )
        out = cells.groupBy("counts").agg(F.sum("w").alias("n"))
    if round_int:
        out = out.withColumn("n", F.rint("n"))
    return out.filter(F.col("n") != 0)


def rejections(v, g, m, iv=None, ref=None, folded=False, downsample=None, max_missing=MAX_MISSING) -> DataFrame:
    """Why SNPs are not in the spectrum: more than ``max_missing`` alleles ``missing``, ``invariant``, and of
    the ``n_sites`` others those with too few alleles or an unusable outgroup."""
    gated = F.col("out").isNull()
    return pop_cells(v, g, m, iv, ref, folded, downsample, max_missing=max_missing, gate=False).agg(
        copies(gated).alias("n_sites"),
        copies(gated & ~F.col("ok")).alias("too_few"),
        copies(gated & F.col("ok") & ~F.col("known")).alias("bad_outgroup"),
        *[copies(F.col("out") == x).alias(x) for x in ("missing", "invariant")],
    )


def sfs_marginal(s: DataFrame, keep: Sequence[int]) -> DataFrame:
    """Sum out all populations but those at the kept positions (zero-based, in order)."""
    kept = F.array(*[F.element_at("counts", i + 1) for i in keep])
    return s.groupBy(kept.alias("counts")).agg(F.sum("n").alias("n"))


def sfs_project(s: DataFrame, size: int, to: int) -> DataFrame:
    """One-population projection from ``size`` to ``to`` chromosomes, end cells dropped, summing to 1."""
    a, r = F.element_at("counts", 1), F.col("r")
    # cells beyond the ends carry no weight, so only 1..to-1 are produced
    cells = s.select("counts", "n", F.explode(F.sequence(F.lit(1), F.lit(to - 1))).alias("r"))
    w = F.col("n") * hypergeometric_weight(a, r, F.lit(size), F.lit(to))
    out = cells.select("r", w.alias("w")).groupBy(F.array("r").alias("counts")).agg(F.sum("w").alias("n"))
    return out.select("counts", (F.col("n") / out.agg(F.sum("n")).scalar()).alias("n"))


def sfs_layouts(s: DataFrame, n_pops: int) -> DataFrame:
    """Every one-population, pairwise and joint marginal: ``layout, counts, n``.

    One pass: each cell is expanded to its marginals (a number fixed by the model) and summed.
    """
    entries = []
    for i in range(n_pops):
        entries.append((f"pop{i}", [i]))
        for j in range(i + 1, n_pops):
            entries.append((f"pop{j}_{i}", [j, i]))
    if n_pops > 2:
        entries.append(("joint", list(range(n_pops))))
    marginals = F.array(
        *[
            F.struct(
                F.lit(name).alias("layout"),
                F.array(*[F.element_at("counts", k + 1) for k in ix]).alias("counts"),
            )
            for name, ix in entries
        ]
    )
    return (
        s.select(F.explode(marginals).alias("e"), "n")
        .groupBy("e.layout", "e.counts")
        .agg(F.sum("n").alias("n"))
    )


def dense(s: DataFrame, dims: Sequence[int]) -> DataFrame:
    """Fill the full grid: ``cell`` (row-major index, last population fastest), ``counts``, ``n``.

    The grid is prod(dims) rows, generated by ``range`` and joined by cell index.
    """
    total = 1
    for d in dims:
        total *= d
    index, stride = F.lit(0).cast("long"), total
    grid = s.sparkSession.range(total).withColumnRenamed("id", "cell")
    coords, rest = [], F.col("cell")
    for i, d in enumerate(dims):
        stride //= d
        index = index + F.element_at("counts", i + 1).cast("long") * stride
        coords.append(F.floor(rest / stride).cast("int"))
        rest = rest % stride
    cells = s.groupBy(index.alias("cell")).agg(F.sum("n").alias("n"))
    return (
        grid.select("cell", F.array(*coords).alias("counts"))
        .join(cells, "cell", "left")
        .select("cell", "counts", F.coalesce("n", F.lit(0.0)).alias("n"))
    )
