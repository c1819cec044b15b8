"""Linkage disequilibrium of site pairs inside a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespan.functions.genome import general_format
from allelespan.operators.counts import SITE
from allelespan.operators.ordered import ordinal
from allelespan.operators.packed import both, pack_dosages

EM_STEPS = 50


def _over(x: Column, y: Column) -> Column:
    return x.cast("double") / F.nullif(y.cast("double"), F.lit(0.0))


def window_pairs(
    sites: DataFrame, coord: str, span: float, by: str = "chrom", extra: Column | None = None
) -> DataFrame:
    """Ordered pairs (``i`` before ``j``) no further apart than ``span`` on ``coord``.

    Sites are binned by the span; a site looks for partners in its own bin and the next, so the
    join is an equi-join whose bins hold one window of sites each.
    """
    width = F.lit(span if span > 0 else 1)
    cols = sites.columns
    b = F.floor(F.col(coord) / width).cast("long")
    left = sites.select(*[F.col(c).alias(f"{c}_i") for c in cols], F.explode(F.array(b, b + 1)).alias("__bin"))
    right = sites.select(*[F.col(c).alias(f"{c}_j") for c in cols], b.alias("__bin_j"))
    ci, cj = F.col(f"{coord}_i"), F.col(f"{coord}_j")
    later = F.struct(cj, F.col("variant_id_j")) > F.struct(ci, F.col("variant_id_i"))
    cond = (F.col(f"{by}_i") == F.col(f"{by}_j")) & (F.col("__bin") == F.col("__bin_j"))
    cond = cond & later & (cj - ci <= span)
    if extra is not None:
        cond = cond & extra
    return left.join(right, cond).drop("__bin", "__bin_j")


def ld_pairs(
    g: DataFrame,
    v: DataFrame | None = None,
    stat: str = "r2",
    window_snps: int | None = None,
    window_kb: float | None = None,
    window_cm: float | None = None,
    min_r2: float | None = None,
    snps: DataFrame | None = None,
    d: bool = False,
    in_phase: bool = False,
    maf: bool = False,
    samples: DataFrame | None = None,
    em_steps: int = EM_STEPS,
) -> DataFrame:
    """Genotype correlation of site pairs: ``r`` or ``r2`` over samples called at both.

    At least one window is required. ``window_snps = k`` keeps pairs with fewer than ``k - 1`` sites
    between them; ``window_cm`` needs a ``cm`` column on ``v``. ``snps`` (``variant_id``) restricts
    the first site of a pair. ``d`` adds D, D' and its sign, ``in_phase`` the allele pairs that go
    together (needs ``v``), ``maf`` both minor frequencies. ``samples`` spares a scan of ``g`` for the list
    of samples.

    D comes from haplotype counts of the samples called at both sites, alternates pooled. Only samples
    heterozygous at both sites leave them open: where ``g`` says that both calls are ``phased`` the
    haplotypes are read off, the others are shared out by ``em_steps`` steps of expectation
    maximisation. Calls without a ``phased`` column are not phased.
    """
    packed = pack_dosages(g, samples)
    if window_snps is not None:
        called = g.filter(F.col("a1").isNotNull() & F.col("a2").isNotNull())
        sites = called.select(*SITE).dropDuplicates(["variant_id"])  # ranks need the narrow columns only
        ranks = ordinal(sites, ["chrom"], "pos", ["variant_id"], "rank").select("variant_id", "rank")
        packed = packed.join(ranks, "variant_id")
    extra_cols = []
    if v is not None:
        extra_cols = [c for c in ("ref", "alts", "cm") if c in v.columns]
        packed = packed.join(v.select("variant_id", *extra_cols), "variant_id")
    limits = []  # (column, span), the first one drives the join
    if window_snps is not None:
        limits.append(("rank", window_snps - 1))
    if window_kb is not None:
        limits.append(("pos", int(window_kb * 1000)))
    if window_cm is not None:
        limits.append(("cm", float(window_cm)))
    if not limits:
        raise ValueError("LD needs a window: window_snps, window_kb or window_cm")
    extra = None
    for c, span in limits[1:]:
        near = F.abs(F.col(f"{c}_j") - F.col(f"{c}_i")) <= span
        extra = near if extra is None else extra & near
    pairs = window_pairs(packed, limits[0][0], limits[0][1], extra=extra)
    if snps is not None:
        pairs = pairs.join(
            snps.select(F.col("variant_id").alias("variant_id_i")).distinct(), "variant_id_i", "left_semi"
        )

    def k(x, y):
        return both(F.col(f"{x}_i"), F.col(f"{y}_j"))

    n = k("called", "called")
    hi, mi, hj, mj = k("het", "called"), k("hom", "called"), k("called", "het"), k("called", "hom")
    hh, hm, mh, mm = k("het", "het"), k("het", "hom"), k("hom", "het"), k("hom", "hom")
    keep = [f"{c}_{s}" for s in "ij" for c in SITE]
    stats = pairs.select(
        "*", n.alias("n"), (hi + 2 * mi).alias("sx"), (hi + 4 * mi).alias("sxx"),
        (hj + 2 * mj).alias("sy"), (hj + 4 * mj).alias("syy"),
        (hh + 2 * (hm + mh) + 4 * mm).alias("sxy"),
    )
    nn = F.col("n").cast("double")
    cov = nn * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = nn * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = nn * F.col("syy") - F.col("sy") * F.col("sy")
    stats = stats.withColumn("r", _over(cov, F.sqrt(vx * vy)))
    out = [*keep, "n"]
    if stat == "r2":
        stats = stats.withColumn("r2", F.col("r") * F.col("r"))
    elif stat != "r":
        raise ValueError("stat is 'r' or 'r2'")
    if min_r2 is not None:
        stats = stats.filter(F.col("r") * F.col("r") >= min_r2)
    out.append(stat)
    if d:
        cells = {"hh": hh, "hm": hm, "mh": mh, "mm": mm, "h_": hi, "m_": mi, "_h": hj, "_m": mj}
        cells["cis"] = k("first", "first") + k("second", "second")
        cells["trans"] = k("first", "second") + k("second", "first")
        stats = _with_d(stats.withColumn("__c", F.struct(*[c.alias(x) for x, c in cells.items()])), em_steps)
        out += ["d", "d_prime", "d_prime_signed"]
    if in_phase:
        ai, aj = F.element_at("alts_i", 1), F.element_at("alts_j", 1)
        stats = stats.withColumn(
            "phase",
            F.when(F.col("r") > 0, F.concat("ref_i", "ref_j", F.lit("/"), ai, aj)).when(
                F.col("r") < 0, F.concat("ref_i", aj, F.lit("/"), ai, F.col("ref_j"))
            ),
        )
        out.append("phase")
    if maf:
        for s, x in (("i", "sx"), ("j", "sy")):
            p = _over(F.col(x), 2 * F.col("n"))
            stats = stats.withColumn(f"maf_{s}", F.least(p, 1 - p))
        out += ["maf_i", "maf_j"]
    return stats.select(*out)


def double_het_share(c: dict[str, Column], open_: Column, steps: int) -> Column:
    """Of ``open_`` double heterozygotes, how many carry both alternates on one haplotype.

    ``c`` counts the known haplotypes by their two alleles (1 for alternate). Each step shares the open
    ones out by the products of the haplotype counts that the last step gave; the first takes half.
    """

    def step(x: Column, _: Column) -> Column:
        together = (c["11"] + x) * (c["00"] + x)
        apart = (c["10"] + open_ - x) * (c["01"] + open_ - x)
        return F.coalesce(open_ * together / F.nullif(together + apart, F.lit(0.0)), x)

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), open_ / 2, step)
    return F.when(open_ > 0, found).otherwise(F.lit(0.0))


def _with_d(pairs: DataFrame, steps: int) -> DataFrame:
    x = {name: F.col(f"__c.{name}") for name in ("hh", "hm", "mh", "mm", "h_", "m_", "_h", "_m", "cis", "trans")}
    het_ref, ref_het = x["h_"] - x["hh"] - x["hm"], x["_h"] - x["hh"] - x["mh"]
    hom_ref, ref_hom = x["m_"] - x["mh"] - x["mm"], x["_m"] - x["hm"] - x["mm"]
    refs = F.col("n") - x["h_"] - x["m_"] - ref_het - ref_hom
    known = {
        "11": 2 * x["mm"] + x["hm"] + x["mh"] + x["cis"], "10": 2 * hom_ref + x["mh"] + het_ref + x["trans"],
        "01": 2 * ref_hom + x["hm"] + ref_het + x["trans"], "00": 2 * refs + het_ref + ref_het + x["cis"],
    }
    p = pairs.select("*", *[c.cast("double").alias(f"__{a}") for a, c in known.items()], (x["hh"] - x["cis"] - x["trans"]).cast("double").alias("__open"))
    both_alt = F.col("__11") + double_het_share({a: F.col(f"__{a}") for a in known}, F.col("__open"), steps)
    total = 2 * F.col("n")
    p = p.withColumn("__pa", _over(F.col("sx"), total)).withColumn("__pb", _over(F.col("sy"), total))
    pa, pb, d = F.col("__pa"), F.col("__pb"), F.col("d")
    p = p.withColumn("d", _over(both_alt, total) - pa * pb)
    top = F.when(d > 0, F.least(pa * (1 - pb), (1 - pa) * pb)).otherwise(
        F.least(pa * pb, (1 - pa) * (1 - pb))
    )
    signed = d / F.nullif(top, F.lit(0.0))
    return p.withColumn("d_prime", F.abs(signed)).withColumn("d_prime_signed", signed)


def ld_matrix(pairs: DataFrame, sites: DataFrame, shape: str, value: str = "r2") -> DataFrame:
    """Matrix rows per chromosome: ``chrom, row, first_col, line``.

    ``triangle`` lists a site's earlier partners, ``square`` all, ``square-zero`` puts 0 above the
    diagonal. A row spans only the columns of the window, starting at ``first_col``; outside the
    window the matrix is not computed. Inside it, cells without a pair, such as those below a threshold,
    are ``nan`` (0 above the diagonal of ``square-zero``), so every value stays in its column. ``sites``
    has ``chrom, pos, variant_id``.
    """
    ranked = ordinal(sites.select(*SITE), ["chrom"], "pos", ["variant_id"], "rank").select("variant_id", "rank")
    both_ranks = (
        pairs.select("chrom_i", "variant_id_i", "variant_id_j", value)
        .join(ranked.toDF("variant_id_i", "ri"), "variant_id_i")
        .join(ranked.toDF("variant_id_j", "rj"), "variant_id_j")
    )
    val = F.coalesce(general_format(F.round(value, 6)), F.lit("nan"))
    lower = F.struct(F.col("rj").alias("row"), F.col("ri").alias("c"), val.alias("x"))
    upper = F.struct(
        F.col("ri").alias("row"),
        F.col("rj").alias("c"),
        (F.lit("0") if shape == "square-zero" else val).alias("x"),
    )
    if shape == "triangle":
        cells = F.array(lower)
    elif shape in ("square", "square-zero"):
        cells = F.array(lower, upper)
    else:
        raise ValueError(shape)
    flat = both_ranks.select(F.col("chrom_i").alias("chrom"), F.explode(cells).alias("e")).select("chrom", "e.*")
    diagonal = ordinal(sites.select(*SITE), ["chrom"], "pos", ["variant_id"], "row").select(
        "chrom", "row", F.col("row").alias("c"), F.lit("1").alias("x")
    )

    def placed(cell: Column, i: Column) -> Column:
        column = cell["c"]
        before = F.when(i > 0, F.get("cells", i - 1)["c"]).otherwise(column - 1)
        gap = F.lit("nan\t")
        if shape == "square-zero":  # the diagonal is a cell, so a gap lies on one side of it
            gap = F.when(column > F.col("row"), F.lit("0\t")).otherwise(gap)
        return F.concat(F.repeat(gap, (column - before - 1).cast("int")), cell["x"])

    return (
        flat.unionByName(diagonal)
        .groupBy("chrom", "row")
        .agg(F.array_sort(F.collect_list(F.struct("c", "x"))).alias("cells"))
        .select(
            "chrom",
            "row",
            F.element_at("cells", 1)["c"].alias("first_col"),
            F.array_join(F.transform("cells", placed), "\t").alias("line"),
        )
    )
