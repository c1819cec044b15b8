"""Conversion between genotype formats: a reader and a writer of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.functions import predicates as P
from allelespan.sinks import layouts as K
from allelespan.sources import genotypes as SG
from allelespan.sources import vcf as SV

FORMATS = ("vcf", "ped", "eigenstrat")


def read_callset(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """``(v, g)`` of a VCF, of the ``ped`` and ``map`` of a folder, or of ``path.geno``, ``.snp`` and ``.ind``."""
    if kind == "vcf":
        return SV.read_vcf(spark, path)
    if kind == "ped":
        return SG.letters_to_callset(SG.read_ped(spark, f"{path}/ped", f"{path}/map"))
    if kind == "eigenstrat":
        return SG.read_eigenstrat(spark, path)[:2]
    raise ValueError(f"format {kind} is none of {FORMATS}")


def write_callset(v: DataFrame, g: DataFrame, path: str, kind: str) -> None:
    """The places ``read_callset`` reads. PED and EIGENSTRAT have no place for more than two alleles or longer ones:
    only biallelic SNPs are written there, to PED those that are called at all; a site without an alternate gets ``N``."""
    if kind == "vcf":
        return K.write_vcf(v, g, path)
    if kind not in FORMATS:
        raise ValueError(f"format {kind} is none of {FORMATS}")
    v = v.filter(P.only_biallelic() | ((F.size("alts") == 0) & (F.length("ref") == 1)))
    if kind == "ped":
        called = g.filter(F.col("a1").isNotNull() | F.col("a2").isNotNull()).select("variant_id").distinct()
        return K.write_ped(v.join(called, "variant_id", "left_semi"), g, path)
    two = v.withColumn("alts", F.when(F.size("alts") > 0, F.col("alts")).otherwise(F.array(F.lit("N"))))
    return K.write_eigenstrat(two, g, path)


def convert(spark: SparkSession, source: str, source_kind: str, target: str, target_kind: str) -> None:
    """Read ``source`` and write it to ``target`` in another format."""
    write_callset(*read_callset(spark, source, source_kind), target, target_kind)
