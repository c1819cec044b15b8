"""Sites as bit sets over samples or haplotypes.

Pairwise operators compare two sites by AND and bit counts on arrays of 64-bit words, so a pair is
one row of (samples / 64) words instead of one row per sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.operators.counts import SITE


def sample_index(samples: DataFrame) -> DataFrame:
    """``sample, six``: dense order of the cohort. One row per sample, so one ordered task is fine."""
    names = samples.select("sample").distinct()
    return names.select("sample", (F.row_number().over(W.orderBy("sample")) - 1).cast("int").alias("six"))


def _dense(words: str, field: str) -> Column:
    """Array of words without holes from a list of (word, ...) sorted by word."""
    w = F.col(words)
    before = F.concat(F.array(F.lit(-1)), F.transform(w, lambda x: x["word"]))
    pieces = F.zip_with(
        w,
        F.slice(before, 1, F.size(w)),
        lambda x, p: F.concat(F.array_repeat(F.lit(0).cast("long"), x["word"] - p - 1), F.array(x[field])),
    )
    return F.flatten(pieces)


def both(x: Column, y: Column) -> Column:
    """Number of members two bit sets share; a shorter array stands for trailing zeros."""
    hits = F.zip_with(x, y, lambda a, b: F.coalesce(F.bit_count(a.bitwiseAND(b)), F.lit(0)))
    return F.aggregate(hits, F.lit(0).cast("long"), lambda s, n: s + n)


def members(x: Column) -> Column:
    return F.aggregate(x, F.lit(0).cast("long"), lambda s, b: s + F.bit_count(b))


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (position % 64).cast("int"))


def _word(position: Column) -> Column:
    return F.floor(position / 64).cast("int")


def pack_dosages(g: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Per site the samples that are ``called``, ``het`` and homozygous alternate (``hom``), and of the
    heterozygotes those with the alternate on the ``first`` or ``second`` haplotype, as far as ``g`` has
    ``phased`` and it is true.

    A given ``samples`` table spares the scan of the genotypes that would list them.
    """
    a1, a2 = F.col("a1"), F.col("a2")
    index = sample_index(g if samples is None else samples)
    x = g.filter(a1.isNotNull() & a2.isNotNull()).join(index, "sample")
    bit, none = _bit(F.col("six")), F.lit(0).cast("long")
    alts = (a1 > 0).cast("int") + (a2 > 0).cast("int")
    known = F.coalesce(F.col("phased"), F.lit(False)) if "phased" in g.columns else F.lit(False)
    planes = {
        "called": F.lit(True), "het": alts == 1, "hom": alts == 2,
        "first": known & (alts == 1) & (a1 > 0), "second": known & (alts == 1) & (a2 > 0),
    }
    words = x.groupBy("variant_id", _word(F.col("six")).alias("word")).agg(
        F.first("chrom").alias("chrom"),
        F.first("pos").alias("pos"),
        *[F.bit_or(F.when(test, bit).otherwise(none)).alias(name) for name, test in planes.items()],
    )
    packed = words.groupBy("variant_id").agg(
        F.first("chrom").alias("chrom"),
        F.first("pos").alias("pos"),
        F.array_sort(F.collect_list(F.struct("word", *planes))).alias("w"),
    )
    return packed.select(*SITE, *[_dense("w", f).alias(f) for f in planes])


def pack_haplotypes(g: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """``variant_id`` with one entry per allele present: ``carriers array<struct<allele, n, bits>>``,
    plus ``n_haps`` called. Haplotype ``2 * sample + h`` carries ``a1`` (h = 0) or ``a2`` (h = 1)."""
    x = g.join(sample_index(g if samples is None else samples), "sample").select(
        "variant_id",
        F.explode(
            F.array(
                F.struct((2 * F.col("six")).alias("hap"), F.col("a1").alias("allele")),
                F.struct((2 * F.col("six") + 1).alias("hap"), F.col("a2").alias("allele")),
            )
        ).alias("h"),
    )
    x = x.select("variant_id", "h.*").filter(F.col("allele").isNotNull())
    words = x.groupBy("variant_id", "allele", _word(F.col("hap")).alias("word")).agg(
        F.bit_or(_bit(F.col("hap"))).alias("bits")
    )
    per_allele = words.groupBy("variant_id", "allele").agg(
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"),
        F.sum(F.bit_count("bits")).alias("n"),
    )
    per_allele = per_allele.select("variant_id", F.struct("allele", "n", _dense("w", "bits").alias("bits")).alias("e"))
    return per_allele.groupBy("variant_id").agg(
        F.array_sort(F.collect_list("e")).alias("carriers"), F.sum("e.n").alias("n_haps")
    )
