"""Per-individual sequences of genomic regions and the locus layouts built from them.

A result row holds one locus sequence, so a locus must fit a row; tile longer stretches with
``make_windows`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.functions import predicates as P
from allelespan.functions.genome import (
    alleles,
    inheritance_scalar,
    max_allele_length,
    merge_iupac,
    natural_key,
    region_name,
)
from allelespan.operators.ordered import ordinal
from allelespan.operators.rangejoin import sites_with_regions

NAME_WIDTH = 10  # fixed value: sequence names are padded to this many characters
LOCI_A_TASK = 64  # loci whose sequences a task sorts, about


def region_text(iv: DataFrame, ref: DataFrame) -> DataFrame:
    """Reference bases of each region: ``iv`` plus ``ref_seq``; absent chunks read as N.

    Chunks are joined by their start, so a region touches length / chunk width rows, and cut to the region
    before the pieces are grouped: what moves after the join is the bases asked for.
    """
    w = ref.agg(F.max(F.length("seq")).cast("long")).scalar()
    r = iv.withColumn("__w", w)
    r = r.withColumn(
        "chunk_start",
        F.explode(
            F.sequence(
                F.floor(F.col("start") / F.col("__w")).cast("long") * F.col("__w"),
                F.floor(F.greatest(F.col("end") - 1, F.col("start")) / F.col("__w")).cast("long") * F.col("__w"),
                F.col("__w"),
            )
        ),
    )
    chunks = ref.select("chrom", "chunk_start", "seq")
    skipped = F.greatest(F.col("start") - F.col("chunk_start"), F.lit(0).cast("long")).cast("int")
    n = F.least(F.col("end") - F.col("chunk_start"), F.col("__w")).cast("int") - skipped
    piece = F.rpad(F.substring(F.coalesce("seq", F.lit("")), skipped + 1, n), n, F.lit("N"))
    joined = r.join(chunks, ["chrom", "chunk_start"], "left").withColumn("__t", piece)
    whole = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("chunk_start", "__t"))), lambda x: x["__t"]), ""
    )
    return joined.groupBy("iv_id", "chrom", "start", "end").agg(whole.alias("ref_seq"))


def check_ref(v: DataFrame, ref: DataFrame) -> DataFrame:
    """Records whose reference allele differs from the reference sequence (case ignored)."""
    spans = v.select(
        F.col("variant_id").alias("iv_id"),
        "chrom",
        (F.col("pos") - 1).alias("start"),
        (F.col("pos") - 1 + F.length("ref")).alias("end"),
        "ref",
    )
    text = region_text(spans.select("iv_id", "chrom", "start", "end"), ref)
    return (
        spans.select("iv_id", "ref", "chrom", (F.col("start") + 1).alias("pos"))
        .join(text.select("iv_id", "ref_seq"), "iv_id")
        .filter(F.upper("ref") != F.upper("ref_seq"))
        .withColumnRenamed("iv_id", "variant_id")
    )


def region_sequences(
    v: DataFrame,
    g: DataFrame,
    iv: DataFrame,
    m: DataFrame,
    ref: DataFrame | None = None,
    missing: str = "N",
    indels: bool = False,
    trim: bool = True,
) -> DataFrame:
    """One row per (region, sample): ``seqs`` holds the two haplotype sequences.

    Each record contributes the reference text since the record before it plus the allele, right-padded
    with ``_`` to the longest allele for indels; the rest of the reference follows. Without ``ref`` only
    the alleles are written. ``missing``: a letter to write, or ``error``.

    A region's text with the missing letter at every record is cut once. A sample brings the list of
    its present calls by the record's rank, which replace their letters; what is not called is no row.
    """
    records = v if indels else v.filter(P.is_snp())
    records = records.select("variant_id", "chrom", "pos", "ref", "alts")
    regions = iv.select("iv_id", "chrom", "start", "end")
    hits = sites_with_regions(records, regions).select(
        F.col("r_iv_id").alias("iv_id"),
        (F.col("pos") - 1 - F.col("r_start")).alias("off"),
        "variant_id",
        F.length("ref").alias("ref_len"),
        F.when(P.is_snp(), 1).otherwise(max_allele_length()).alias("width"),
        alleles().alias("alleles"),
    )
    spot = F.struct(*[c for c in hits.columns if c != "iv_id"])
    spots = hits.groupBy("iv_id").agg(F.array_sort(F.collect_list(spot)).alias("spots"))
    cohort = m.select("pop_ix", "pop", "sample_ix", "sample").distinct()
    called = F.col("a1").isNotNull() | F.col("a2").isNotNull()
    present = g.filter(called).select("variant_id", "sample", "a1", "a2").join(cohort.select("sample"), "sample", "left_semi")
    placed = spots.select("iv_id", F.posexplode("spots").alias("rank", "s")).select("iv_id", "rank", "s.variant_id", "s.width", "s.alleles")

    def letters(a: str) -> Column:
        return F.rpad(F.try_element_at("alleles", F.col(a).cast("int") + 1), F.col("width"), F.lit("_"))

    calls = placed.join(present, "variant_id").groupBy("iv_id", "sample").agg(
        F.array_sort(F.collect_list(F.struct("rank", letters("a1").alias("t1"), letters("a2").alias("t2")))).alias("calls")
    )
    people = cohort.agg(F.collect_list(F.struct("*"))).scalar()
    rows = regions.select("iv_id", F.explode(people).alias("who")).select("iv_id", "who.*")
    rows = rows.join(calls, ["iv_id", "sample"], "left").join(_region_parts(regions, spots, ref, missing), "iv_id")
    return rows.withColumn("seqs", F.array(*[_laid_over(t, missing, trim and ref is not None) for t in ("t1", "t2")])).select(
        "iv_id", "pop_ix", "pop", "sample_ix", "sample", "seqs", "chrom", "start", "end"
    )


def _region_parts(regions: DataFrame, spots: DataFrame, ref: DataFrame | None, missing: str) -> DataFrame:
    """``regions`` with ``parts``: text before the first record, its missing letter, text up to the second record
    and so on, the rest last; and ``len``, the bases of the region."""
    if ref is None:
        text = regions.join(spots, "iv_id", "left").withColumn("ref_seq", F.lit(""))
    else:
        text = region_text(regions, ref).join(spots, "iv_id", "left")
    nothing = F.array().cast("array<bigint>")
    starts = F.coalesce(F.transform("spots", lambda s: s["off"]), nothing)
    ends = F.coalesce(F.transform("spots", lambda s: s["off"] + s["ref_len"]), nothing)
    letter = F.lit("N" if missing == "error" else missing)
    gaps = F.coalesce(F.transform("spots", lambda s: F.rpad(letter, s["width"], F.lit("_"))), F.array().cast("array<string>"))
    text = text.select(
        *regions.columns, F.length("ref_seq").alias("len"), "ref_seq", F.concat(F.array(F.lit(0).cast("long")), ends).alias("__from"),
        F.concat(starts, F.array(F.length("ref_seq").cast("long"))).alias("__to"), gaps.alias("__gaps"),
    )

    def piece(x: Column, y: Column) -> Column:
        n = F.greatest(y - x, F.lit(0).cast("long")).cast("int")
        return F.substring(F.col("ref_seq"), (x + 1).cast("int"), n)

    pieces = F.zip_with("__from", "__to", piece)
    # one piece more than letters: the last pair is (rest, nothing)
    pairs = F.zip_with(pieces, "__gaps", lambda p, x: F.when(x.isNull(), F.array(p)).otherwise(F.array(p, x)))
    return text.select(*regions.columns, "len", F.flatten(pairs).alias("parts"))


def _laid_over(allele: str, missing: str, trim: bool) -> Column:
    """The parts of a region with the letters of a sample's calls in place of the missing ones."""
    calls = F.filter("calls", lambda c: c[allele].isNotNull())
    calls = F.coalesce(calls, F.array().cast("array<struct<rank:int,t1:string,t2:string>>"))
    before = F.concat(F.array(F.lit(-1)), F.transform(calls, lambda c: c["rank"]))

    def upto(c: Column, last: Column) -> Column:
        """Parts behind the last call, and this one."""
        first = 2 * last + 3
        return F.concat(F.slice("parts", first, 2 * c["rank"] + 2 - first), F.array(c[allele]))

    body = F.flatten(F.zip_with(calls, F.slice(before, F.lit(1), F.size(calls)), upto))
    behind = 2 * F.element_at(before, -1) + 3
    seq = F.array_join(F.concat(body, F.slice("parts", behind, F.size("parts") + 1 - behind)), "")
    seq = F.substring(seq, F.lit(1), F.col("len")) if trim else seq
    if missing == "error":
        lacks = F.raise_error(F.concat(F.lit("missing data: "), "sample")).cast("string")
        seq = F.when(2 * F.size(calls) + 1 < F.size("parts"), lacks).otherwise(seq)
    return seq


def haplotype_sequences(v, g, iv, m, ref=None, single: bool = False, **options) -> DataFrame:
    """Long form: one row per (region, sample, haplotype); ``single`` keeps haplotype 0."""
    wide = region_sequences(v, g, iv, m, ref, **options)
    cols = [c for c in wide.columns if c != "seqs"]
    long = wide.select(*cols, F.posexplode("seqs").alias("hap", "seq"))
    return long.filter("hap = 0") if single else long


def merge_diploid_iupac(seqs: DataFrame) -> DataFrame:
    """Add ``merged``: ambiguity codes of the two haplotypes, N where either is not a plain base."""
    return seqs.withColumn("merged", merge_iupac(F.col("seqs")[0], F.col("seqs")[1]))


def drop_incomplete(seqs: DataFrame, complete: DataFrame, v: DataFrame, iv: DataFrame) -> DataFrame:
    """Keep the (region, sample) pairs listed in ``complete``; a region without records of ``v``
    keeps all."""
    records = sites_with_regions(v.select("chrom", "pos"), iv.select("iv_id", "chrom", "start", "end"))
    with_records = records.select(F.col("r_iv_id").alias("iv_id")).distinct()
    full = seqs.join(complete.select("iv_id", "sample"), ["iv_id", "sample"], "left_semi")
    empty = seqs.join(with_records, "iv_id", "left_anti")
    return full.unionByName(empty.select(*full.columns))


def region_lines(seqs_long: DataFrame) -> DataFrame:
    """``iv_id, line``: ``sample:haplotype<TAB>sequence``."""
    line = F.concat_ws("", "sample", F.lit(":"), F.col("hap").cast("string"), F.lit("\t"), "seq")
    return seqs_long.select("iv_id", line.alias("line"))


def fasta_lines(seqs_long: DataFrame) -> DataFrame:
    """``iv_id, header, seq`` with one header per individual and haplotype."""
    header = F.concat_ws("", F.lit(">"), "sample", F.lit("_"), F.col("hap").cast("string"))
    return seqs_long.select("iv_id", header.alias("header"), "seq")


def locus_index(iv: DataFrame) -> DataFrame:
    """Add ``locus_ix``: zero-based place in natural chromosome order, then start.

    Ranks inside a chromosome are two-level; offsets come from one row per chromosome.
    """
    ranked = ordinal(iv, ["chrom"], "start", ["end", "iv_id"], "__rank")
    w = W.orderBy(natural_key("chrom"), "chrom").rowsBetween(W.unboundedPreceding, -1)
    offsets = iv.groupBy("chrom").agg(F.count("*").alias("n"))
    offsets = offsets.select("chrom", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("__off"))
    return (
        ranked.join(offsets, "chrom")
        .withColumn("locus_ix", F.col("__rank") + F.col("__off"))
        .select(*iv.columns, "locus_ix")
    )


def gphocs_loci(seqs: DataFrame, iv: DataFrame, diploid: bool = True, nloci: int | None = None) -> DataFrame:
    """Lines of the layout: ``locus_ix, line_ix, line``; the file starts with the number of loci.

    ``nloci`` keeps the first loci of the interval order.
    """
    ix = locus_index(iv.select("iv_id", "chrom", "start", "end")).select("iv_id", "locus_ix")
    if nloci is not None:
        ix = ix.filter(F.col("locus_ix") < nloci)
    s = seqs.join(ix, "iv_id")
    text = merge_iupac(F.col("seqs")[0], F.col("seqs")[1]) if diploid else F.col("seqs")[0]
    s = s.withColumn("text", text)
    # a locus has one iv_id, by which the rows are dealt out already; the head goes out with a first row, so that
    # sequences are made once
    who = W.partitionBy("iv_id", "locus_ix").orderBy("pop_ix", "sample_ix")
    region = W.partitionBy("iv_id", "locus_ix", "chrom", "start", "end")
    s = s.withColumn("line_ix", F.row_number().over(who).cast("long"))
    s = s.withColumn("n", F.count("*").over(region)).withColumn("len", F.max(F.length("text")).over(region))
    s = s.withColumn("first", F.min("line_ix").over(region))
    name = F.concat_ws("", F.lit("locus"), F.col("locus_ix").cast("string"), F.lit("_"), region_name("chrom", "start", "end"))
    head = F.struct(F.lit(0).cast("long").alias("line_ix"), F.concat_ws(" ", name, F.col("n").cast("string"), F.col("len").cast("string")).alias("line"))
    line = F.struct("line_ix", F.concat_ws(" ", "sample", "text").alias("line"))
    return s.select("locus_ix", F.inline(F.when(F.col("line_ix") == F.col("first"), F.array(head, line)).otherwise(F.array(line))))


def locus_length(v: DataFrame, iv: DataFrame, mutrate: float = 1e-9, scalar: float | None = None,
                 density: DataFrame | None = None) -> DataFrame:
    """``iv_id, n_records, locus_len, inheritance, locus_rate`` per region.

    The length grows by the longest allele minus the reference of every record; with ``density``
    (``iv_id, density``) the rate gains ``mutrate / density``.
    """
    hits = sites_with_regions(v, iv.select("iv_id", "chrom", "start", "end"))
    extra = hits.groupBy(F.col("r_iv_id").alias("iv_id")).agg(
        F.count("*").alias("n_records"),
        F.sum(max_allele_length() - F.length("ref")).alias("extra"),
    )
    out = iv.select("iv_id", "chrom", "start", "end").join(extra, "iv_id", "left")
    length = F.col("end") - F.col("start") + F.coalesce("extra", F.lit(0))
    out = out.select(
        "iv_id", "chrom", "start", "end",
        F.coalesce("n_records", F.lit(0)).cast("long").alias("n_records"),
        length.cast("long").alias("locus_len"),
        (inheritance_scalar("chrom") if scalar is None else F.lit(float(scalar))).alias("inheritance"),
    )
    rate = F.col("locus_len") * F.lit(float(mutrate))
    if density is not None:
        out = out.join(density.select("iv_id", "density"), "iv_id", "left")
        rate = rate + F.coalesce(F.lit(float(mutrate)) / F.nullif("density", F.lit(0.0)), F.lit(0.0))
    return out.withColumn("locus_rate", rate).drop("density")


def locus_table(loci: DataFrame, seqs: DataFrame, m: DataFrame, with_ref: bool) -> DataFrame:
    """Locus header line: name, sequences per population in model order, length, model, scalar, rate."""
    pops = m.select("pop", "pop_ix").distinct()
    order = pops.agg(F.array_sort(F.collect_list("pop_ix"))).scalar()
    per_pop = seqs.groupBy("iv_id", "pop_ix").agg((2 * F.count("*")).alias("n"))
    have = per_pop.groupBy("iv_id").agg(F.map_from_entries(F.collect_list(F.struct("pop_ix", "n"))).alias("n"))
    counts = F.array_join(
        F.transform("pops", lambda p: F.coalesce(F.try_element_at("n", p), F.lit(0).cast("long")).cast("string")),
        " ",
    )
    length = F.col("locus_len") if with_ref else F.col("n_records")
    scalar = F.when(F.col("inheritance") == 1, "1").otherwise(F.col("inheritance").cast("string"))
    header = F.concat_ws(
        " ",
        F.concat_ws(":", "chrom", F.col("start").cast("string"), F.col("end").cast("string")),
        counts,
        length.cast("string"),
        F.lit("I"),
        scalar,
        F.format_string("%.14f", "locus_rate"),
    )
    counted = loci.join(have, "iv_id", "left").withColumn("pops", order)
    return counted.select("iv_id", header.alias("line"))


def ima_loci(seqs: DataFrame, loci: DataFrame, iv: DataFrame, m: DataFrame, with_ref: bool = True) -> DataFrame:
    """Locus headers and padded sequence lines: ``locus_ix, line_ix, line``.

    Loci are counted first: sequences are dealt out by their number, as their compressed size says little
    about the memory that a sort takes.
    """
    n = iv.count() // LOCI_A_TASK + 1
    ix = locus_index(iv.select("iv_id", "chrom", "start", "end")).select("iv_id", "locus_ix")
    heads = locus_table(loci, seqs, m, with_ref).join(ix, "iv_id").select(
        "locus_ix", F.lit(0).cast("long").alias("line_ix"), "line"
    )
    long = seqs.select("iv_id", "pop_ix", "sample_ix", F.posexplode("seqs").alias("hap", "seq")).join(ix, "iv_id").repartition(n, "locus_ix")
    name = F.concat_ws(":", *[F.col(c).cast("string") for c in ("pop_ix", "sample_ix", "hap")])
    order = W.partitionBy("locus_ix").orderBy("pop_ix", "sample_ix", "hap")
    lines = long.select(
        "locus_ix",
        F.row_number().over(order).cast("long").alias("line_ix"),
        F.concat(F.rpad(name, F.greatest(F.lit(NAME_WIDTH), F.length(name)), F.lit(" ")), "seq").alias("line"),
    )
    return heads.unionByName(lines)
