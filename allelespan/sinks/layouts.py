"""Text layouts: each is a DataFrame of lines first, files second.

Line tables carry ``ord`` columns; ``write_lines`` range-partitions by them, so the concatenated
part files are one ordered document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespan.functions.genome import (
    ID_DELIMITERS,
    add_chr,
    general_format,
    natural_key,
    strip_chr,
    to_output_coordinates,
)
from allelespan.operators.counts import site_counts
from allelespan.operators.ordered import ordinal
from allelespan.operators.sequence import LOCI_A_TASK
from allelespan.session import discard, materialise

MARKER_BLOCK = 1 << 16


def write_lines(lines: DataFrame, path: str, order: list[str], compression: str = "none", mode="error") -> None:
    """Write column ``line`` in ``order`` across the part files."""
    lines.orderBy(*order).select("line").write.mode(mode).option("compression", compression).text(path)


def cohort(g: DataFrame) -> DataFrame:
    """``sample, sample_ix``: the callset's header order, or by name."""
    if "sample_ix" in g.columns:
        return g.groupBy("sample").agg(F.min("sample_ix").cast("int").alias("sample_ix"))
    from allelespan.operators.packed import sample_index

    return sample_index(g).withColumnRenamed("six", "sample_ix")


def dense_join(entries: Column, n: Column, filler: str, sep: str) -> Column:
    """Join ``struct(ix, text)`` sorted by ix into n fields, with a filler where an ix is absent."""
    whole = (n > 0) & (entries["ix"] == F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1))
    return F.when(whole, F.array_join(entries["text"], sep)).otherwise(_with_fillers(entries, n, filler, sep))


def _with_fillers(entries: Column, n: Column, filler: str, sep: str) -> Column:
    before = F.concat(F.array(F.lit(-1)), F.transform(entries, lambda e: e["ix"]))
    gap = lambda k: F.repeat(F.lit(sep + filler), k)
    parts = F.zip_with(
        entries,
        F.slice(before, F.lit(1), F.size(entries)),
        lambda e, p: F.concat(gap(e["ix"] - p - 1), F.lit(sep), e["text"]),
    )
    tail = gap(n - 1 - F.element_at(before, -1))
    return F.substring(F.concat(F.array_join(parts, ""), tail), 1 + len(sep), 1 << 30)


def _per_site(g: DataFrame, text: Column, filler: str, sep: str, samples: DataFrame | None) -> DataFrame:
    """``variant_id, fields``: one text per sample in cohort order; a row holds one site."""
    who = cohort(g) if samples is None else samples
    n = who.agg(F.count("*").cast("int")).scalar()
    x = g.drop("sample_ix").join(who.select("sample", "sample_ix"), "sample")
    # made before a generator: an aggregate would take the text in and interpret it
    x = x.select("variant_id", F.col("sample_ix").alias("ix"), text.alias("text"))
    x = x.select("variant_id", F.explode(F.array(F.struct("ix", "text"))).alias("e"))
    x = x.groupBy("variant_id").agg(F.sort_array(F.collect_list("e")).alias("e"))
    return x.withColumn("n", n).select("variant_id", dense_join(F.col("e"), F.col("n"), filler, sep).alias("fields"))


def vcf_lines(v: DataFrame, g: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """``chrom, pos, variant_id, line`` record lines; absent calls are ``./.``.

    QUAL and INFO are written where ``v`` has ``qual`` and ``info``; six decimals of QUAL are kept. Calls
    have the keys of ``v``'s ``format`` with the values of ``g``'s ``fields`` as far as both have them, or GT.
    """
    bar = F.when(F.col("phased"), F.lit("|")).otherwise(F.lit("/")) if "phased" in g.columns else F.lit("/")

    def letter(a):
        return F.coalesce(F.col(a).cast("string"), F.lit("."))

    call = F.concat(letter("a1"), bar, letter("a2"))
    if "ploidy" in g.columns:
        call = F.when(F.col("ploidy") == 1, letter("a1")).otherwise(call)
    keys = F.lit("GT")
    if "format" in v.columns and "fields" in g.columns:
        call, keys = _call_values(call), F.coalesce(F.array_join("format", ":"), F.lit("GT"))
        later = F.slice("format", F.lit(2), F.greatest(F.size("format"), F.lit(0)))
        first = (F.try_element_at("format", F.lit(1)) == "GT") & ~F.array_contains(later, "GT")
        g = g.join(v.select("variant_id", "format", first.alias("__first")), "variant_id")
    fields = _per_site(g, call, "./.", "\t", samples)
    n = (cohort(g) if samples is None else samples).agg(F.count("*").cast("int")).scalar()
    empty = F.substring(F.repeat(F.lit("\t./."), F.col("__n")), 2, 1 << 30)
    qual = info = F.lit(".")
    if "qual" in v.columns:
        digits = F.regexp_replace(F.format_string("%.6f", F.col("qual").cast("double")), r"\.?0+$", "")
        qual = F.when(F.col("qual").isNull(), ".").otherwise(digits)
    if "info" in v.columns:
        entries = F.transform(F.map_entries("info"), lambda e: F.concat_ws("=", e["key"], e["value"]))
        info = F.when(F.size(entries) > 0, F.array_join(entries, ";")).otherwise(F.lit("."))
    line = F.concat_ws(
        "\t",
        "chrom",
        F.col("pos").cast("string"),
        F.coalesce("id", F.lit(".")),
        "ref",
        F.when(F.size("alts") > 0, F.array_join("alts", ",")).otherwise(F.lit(".")),
        qual,
        F.coalesce("filter", F.lit(".")),
        info,
        keys,
        F.coalesce(fields["fields"], empty),
    )
    return v.join(fields, "variant_id", "left").withColumn("__n", n).select("chrom", "pos", "variant_id", line.alias("line"))


def _call_values(gt: Column) -> Column:
    """The values of a call in the order of ``format``, without those missing at its end.

    Where GT comes first (``__first``) and the fields are the keys behind it, in order, they are written as they are.
    """
    n, values = F.size("fields"), F.map_values("fields")
    same = F.map_keys("fields") == F.slice("format", F.lit(2), F.greatest(n, F.lit(0)))
    plain = F.col("__first") & F.try_element_at(values, F.lit(-1)).isNotNull() & same
    text = F.when(plain, F.concat(gt, F.lit(":"), F.array_join(values, ":", ".")))
    return text.when(F.col("__first") & (n == 0), gt).otherwise(_values_by_key(gt))


def _values_by_key(gt: Column) -> Column:
    format_ = F.coalesce("format", F.array(F.lit("GT")))
    values = F.transform(format_, lambda k: F.when(k == "GT", gt).otherwise(F.try_element_at("fields", k)))
    last = F.array_max(F.transform(values, lambda x, i: F.when(x.isNotNull(), i + 1).otherwise(0)))
    return F.when(last > 0, F.array_join(F.slice(values, F.lit(1), last), ":", ".")).otherwise(F.lit("."))


def vcf_header(g: DataFrame, samples: DataFrame | None = None, header: DataFrame | None = None) -> DataFrame:
    """Header lines ``ord, line``: those of ``header`` (``ord, line``), or the two that a file needs, and the columns."""
    who = cohort(g) if samples is None else samples
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sample_ix", "sample"))), lambda s: s["sample"]), "\t")
    fixed = ["##fileformat=VCFv4.2", '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">']
    columns = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"])
    one = who.agg(F.concat_ws("\t", F.lit(columns), names).alias("chrom_line"))
    if header is not None:
        top = header.select(F.col("ord").cast("int").alias("ord"), "line")
        return top.unionByName(one.select(F.lit((1 << 31) - 1).alias("ord"), F.col("chrom_line").alias("line")))
    lines = F.array(*[F.lit(x) for x in fixed], F.col("chrom_line"))
    return one.select(F.posexplode(lines).alias("ord", "line"))


def write_vcf(
    v: DataFrame, g: DataFrame, path: str, samples: DataFrame | None = None, compression="none", header: DataFrame | None = None
) -> None:
    """Ordered VCF text; the header, perhaps that of ``read_vcf_header``, is the start of the first part file.

    The samples are looked up once, and the lines are made once: ordering reads its input twice, here what was shuffled.
    """
    found = None if samples is not None else materialise(cohort(g), "cohort")
    samples = samples if found is None else found
    head = vcf_header(g, samples, header).select(
        F.lit("").alias("k"), F.col("ord").cast("long").alias("pos"), F.lit("").alias("vid"), "line"
    )
    body = vcf_lines(v, g, samples).select(
        F.concat(F.lit("1"), natural_key("chrom")).alias("k"), "pos", F.col("variant_id").cast("string").alias("vid"), "line"
    )
    order = ["k", "pos", "vid"]
    write_lines(head.unionByName(body.repartition(*order)), path, order, compression)
    if found is not None:
        discard(found)


def bed_lines(iv: DataFrame, mode: str = "half_open", add_prefix=False, remove_prefix=False, keep_line=False) -> DataFrame:
    """``chrom, start, end, line``; ``keep_line`` writes the original line (``payload``)."""
    if keep_line:
        return iv.select("chrom", "start", "end", F.col("payload").alias("line"))
    start, end = to_output_coordinates("start", "end", mode)
    chrom = add_chr("chrom") if add_prefix else strip_chr("chrom") if remove_prefix else F.col("chrom")
    line = F.concat_ws("\t", chrom, start.cast("string"), end.cast("string"))
    return iv.select("chrom", "start", "end", line.alias("line"))


def write_bed(iv: DataFrame, path: str, header: str | None = None, **options) -> None:
    lines = bed_lines(iv, **options).select(
        F.concat(F.lit("1"), natural_key("chrom")).alias("k"), "start", "end", "line"
    )
    if header is not None:
        zero = F.lit(0).cast("long")
        first = iv.sparkSession.range(1).select(F.lit("").alias("k"), zero.alias("start"), zero.alias("end"), F.lit(header).alias("line"))
        lines = first.unionByName(lines)
    write_lines(lines, path, ["k", "start", "end"])


def stat_lines(st: DataFrame) -> DataFrame:
    """Tab-separated statistic rows; doubles with six significant digits, undefined as ``nan``."""
    cells = []
    for name, kind in st.dtypes:
        c = F.col(name)
        text = general_format(c) if kind in ("double", "float") else c.cast("string")
        cells.append(F.coalesce(text, F.lit("nan")))
    return st.select("*", F.concat_ws("\t", *cells).alias("line"))


def write_stat(st: DataFrame, path: str) -> None:
    st.write.option("sep", "\t").option("header", True).option("nullValue", "nan").csv(path)


def model_json(m: DataFrame) -> DataFrame:
    """One row per model, ``model, json``: name, tree, populations with their individuals."""
    pops = m.groupBy("model", "tree", "pop", "pop_ix").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("sample_ix", "sample"))), lambda s: s["sample"]).alias("inds")
    )
    ordered = F.array_sort(F.collect_list(F.struct("pop_ix", "pop", F.struct("inds").alias("p"))))
    models = pops.groupBy("model", "tree").agg(ordered.alias("o"))
    entries = F.map_from_entries(F.transform("o", lambda e: F.struct(e["pop"], e["p"])))
    body = F.struct(F.col("model").alias("name"), F.coalesce("tree", F.lit("")).alias("tree"), entries.alias("pops"))
    return models.select("model", F.to_json(body).alias("json"))


def write_model(m: DataFrame, path: str) -> None:
    """Model file as a JSON array; a model file is as small as its cohort."""
    whole = model_json(m).agg(F.array_join(F.array_sort(F.collect_list("json")), ",").alias("j"))
    whole.select(F.concat(F.lit("["), "j", F.lit("]")).alias("line")).write.text(path)


# ---- PLINK text ---------------------------------------------------------------------------------


def marker_blocks(v: DataFrame, block: int = MARKER_BLOCK) -> DataFrame:
    """Add ``marker_ix`` (genome order) and ``marker_block``, so that no PED line is longer than
    ``block`` markers; each block is a fileset of its own."""
    ranked = ordinal(v, ["chrom"], "pos", ["variant_id"], "__r")
    return ranked.withColumn("marker_block", F.floor(F.col("__r") / block).cast("long")).withColumn(
        "marker_ix", F.col("__r") % block
    ).drop("__r")


def map_lines(v: DataFrame, block: int = MARKER_BLOCK) -> DataFrame:
    cm = F.col("cm").cast("string") if "cm" in v.columns else F.lit("0")
    line = F.concat_ws("\t", strip_chr("chrom"), "id", cm, F.col("pos").cast("string"))
    return marker_blocks(v, block).select("chrom", "marker_block", "marker_ix", line.alias("line"))


def ped_lines(
    v: DataFrame, g: DataFrame, recode12: bool = False, fid: Column | None = None,
    block: int = MARKER_BLOCK, sep: str = " ",
) -> DataFrame:
    """``chrom, marker_block, sample, line``: six leading columns, then two alleles per marker.

    ``recode12`` writes 1 for the rarer allele of a site and 2 for the other. ``fid`` defaults to
    the sample name.
    """
    marks = marker_blocks(v, block).select("variant_id", "chrom", "marker_block", "marker_ix", "ref", "alts")
    calls = g.select("variant_id", "sample", "a1", "a2")
    if recode12:
        flips = site_counts(g).select("variant_id", (F.col("n_alt") > F.col("n_ref")).alias("alt_major"))
        marks = marks.join(flips, "variant_id", "left")

        def letter(a):
            major = (F.col(a) > 0) == F.coalesce("alt_major", F.lit(False))
            return F.when(F.col(a).isNull(), "0").when(major, "2").otherwise("1")

    else:

        def letter(a):
            base = F.try_element_at(F.concat(F.array("ref"), "alts"), F.col(a).cast("int") + 1)
            return F.coalesce(base, F.lit("0"))

    x = marks.join(calls, "variant_id").select(
        "chrom", "marker_block", "sample",
        F.struct(
            F.col("marker_ix").cast("int").alias("ix"), F.concat(letter("a1"), F.lit(sep), letter("a2")).alias("text")
        ).alias("e"),
    )
    sizes = marks.groupBy("chrom", "marker_block").agg(F.count("*").cast("int").alias("n"))
    rows = x.groupBy("chrom", "marker_block", "sample").agg(F.array_sort(F.collect_list("e")).alias("e"))
    alleles = dense_join(F.col("e"), F.col("n"), f"0{sep}0", sep)
    family = F.col("sample") if fid is None else fid
    line = F.concat_ws(sep, family, "sample", F.lit("0"), F.lit("0"), F.lit("0"), F.lit("-9"), alleles)
    return rows.join(sizes, ["chrom", "marker_block"]).select("chrom", "marker_block", "sample", line.alias("line"))


def write_ped(v: DataFrame, g: DataFrame, path: str, **options) -> None:
    """``path/ped`` and ``path/map``, one folder per chromosome and marker block."""
    block = options.get("block", MARKER_BLOCK)
    keys = ["chrom", "marker_block"]
    ped_lines(v, g, **options).select(*keys, "line").write.partitionBy(*keys).text(f"{path}/ped")
    lines = map_lines(v, block).repartition(*keys).sortWithinPartitions(*keys, "marker_ix")
    lines.select(*keys, "line").write.partitionBy(*keys).text(f"{path}/map")


def id_delimiter(samples: DataFrame) -> DataFrame:
    """One row ``delimiter``: the first candidate that no sample name contains."""
    used = samples.agg(F.max(F.lit("")).alias("_"), *[
        F.bool_or(F.col("sample").contains(d)).alias(f"u{i}") for i, d in enumerate(ID_DELIMITERS)
    ])
    free = F.coalesce(*[F.when(~F.col(f"u{i}"), F.lit(d)) for i, d in enumerate(ID_DELIMITERS)])
    none = F.raise_error(F.lit("every delimiter occurs in a sample name")).cast("string")
    return used.select(F.coalesce(free, none).alias("delimiter"))


# ---- EIGENSTRAT -----------------------------------------------------------------------------------


def eigenstrat_geno_lines(v: DataFrame, g: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """``chrom, pos, variant_id, line``: reference copies per sample, 9 = missing."""
    dose = F.when(F.col("a1").isNull() | F.col("a2").isNull(), F.lit("9")).otherwise(
        ((F.col("a1") == 0).cast("int") + (F.col("a2") == 0).cast("int")).cast("string")
    )
    fields = _per_site(g, dose, "9", "", samples)
    return v.join(fields, "variant_id").select("chrom", "pos", "variant_id", F.col("fields").alias("line"))


def eigenstrat_snp_lines(v: DataFrame) -> DataFrame:
    line = F.concat_ws(" ", "id", strip_chr("chrom"), F.lit("0.0"), F.col("pos").cast("string"), "ref", F.element_at("alts", 1))
    return v.select("chrom", "pos", "variant_id", line.alias("line"))


def eigenstrat_ind_lines(samples: DataFrame, m: DataFrame | None = None) -> DataFrame:
    from allelespan.operators.models import assign_population

    who = assign_population(samples, m, "???") if m is not None else samples.withColumn("pop", F.lit("???"))
    return who.select("sample_ix", F.concat_ws(" ", "sample", F.lit("U"), "pop").alias("line"))


def write_eigenstrat(v: DataFrame, g: DataFrame, prefix: str, m: DataFrame | None = None) -> None:
    """``prefix.geno``, ``prefix.snp`` and ``prefix.ind`` folders in the same site order."""
    called = v.join(g.select("variant_id").distinct(), "variant_id", "left_semi")
    order = ["k", "pos", "variant_id"]
    key = natural_key("chrom")
    write_lines(eigenstrat_geno_lines(called, g).withColumn("k", key), f"{prefix}.geno", order)
    write_lines(eigenstrat_snp_lines(called).withColumn("k", key), f"{prefix}.snp", order)
    write_lines(eigenstrat_ind_lines(cohort(g), m), f"{prefix}.ind", ["sample_ix"])


# ---- spectra ----------------------------------------------------------------------------------------


FLAT_CELLS = 1 << 12


def sfs_lines(dense: DataFrame, dims: list[int]) -> DataFrame:
    """``row, line``: a line per row of the first axis for up to two populations.

    Beyond, the layout is one flat line of prod(dims) numbers; it comes in parts of ``FLAT_CELLS``,
    which ``write_sfs`` sets one behind the other.
    """
    text = F.format_string("%.0f", "n")
    per_row = dims[1] if len(dims) == 2 else 1 if len(dims) == 1 else FLAT_CELLS
    cells = F.array_sort(F.collect_list(F.struct("cell", text.alias("t"))))
    row = F.floor(F.col("cell") / per_row).cast("long")
    return dense.groupBy(row.alias("row")).agg(F.array_join(F.transform(cells, lambda c: c["t"]), "\t").alias("line"))


def write_sfs(dense: DataFrame, dims: list[int], path: str, mode="error") -> None:
    """The lines of a spectrum in order; the part files of a flat one together are its line."""
    out = sfs_lines(dense, dims).orderBy("row").select("line").write.mode(mode)
    out.option("lineSep", "\t" if len(dims) > 2 else "\n").text(path)


# ---- locus files --------------------------------------------------------------------------------------


def ima_files(lines: DataFrame, m: DataFrame, mutrate: float = 1e-9, loci_per_file: int = 1000) -> DataFrame:
    """Complete documents from the lines of ``ima_loci``: ``file_ix, locus_ix, line_ix, line``.

    Every file has its own header with title, rate, populations and its number of loci.
    """
    body = lines.withColumn("file_ix", F.floor(F.col("locus_ix") / loci_per_file).cast("long"))
    n = body.groupBy("file_ix").agg(F.countDistinct("locus_ix").cast("string").alias("n"))
    pops = m.select("pop", "pop_ix").distinct()
    names = pops.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pop_ix", "pop"))), lambda p: p["pop"]), " ")
    ).scalar()
    k = pops.agg(F.count("*").cast("string")).scalar()
    title, rate = F.lit("IMa input"), F.lit(f"#Mutation rate: {mutrate}")
    heads = n.withColumn("names", names).withColumn("k", k)
    heads = heads.select("file_ix", F.posexplode(F.array(title, rate, "k", "names", "n")).alias("line_ix", "line"))
    heads = heads.withColumn("locus_ix", F.lit(-1).cast("long")).withColumn("line_ix", F.col("line_ix").cast("long"))
    return body.unionByName(heads)


def write_ima(lines: DataFrame, m: DataFrame, path: str, **options) -> None:
    """One folder with one file per ``loci_per_file`` loci.

    Sequences compress so well that partitions of a usual size hold many times their bytes when sorted, so the
    files are dealt out by the number of loci.
    """
    kept = materialise(lines, "ima")
    top = kept.agg(F.max("locus_ix")).first()[0]
    n = 1 if top is None else top // LOCI_A_TASK + 1
    files = ima_files(kept, m, **options).repartition(n, "file_ix")
    files = files.sortWithinPartitions("file_ix", "locus_ix", "line_ix")
    files.select("file_ix", "line").write.partitionBy("file_ix").text(path)
    discard(kept)
