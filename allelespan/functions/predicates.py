"""Per-record predicates on the variants table.

Each returns a Column, so batch filters and the streaming filter share one definition and the
simple ones reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from allelespan.functions.genome import alleles, strip_chr

SEX_CHROMOSOMES = ["X", "Y", "chrX", "chrY"]  # fixed values


def n_alleles() -> Column:
    return F.lit(1) + F.coalesce(F.size("alts"), F.lit(0))


def is_snp() -> Column:
    """Single-base reference and alternates; a record without alternates is not a SNP."""
    return (
        (F.length("ref") == 1)
        & (F.size("alts") > 0)
        & F.forall("alts", lambda a: F.length(a) == 1)
    )


def has_indel() -> Column:
    return F.exists("alts", lambda a: F.length(a) != F.length("ref"))


def has_snp() -> Column:
    return (F.length("ref") == 1) & F.exists("alts", lambda a: F.length(a) == 1)


def only_biallelic() -> Column:
    return (n_alleles() == 2) & is_snp()


def allele_number(at_least: int | None = None, at_most: int | None = None) -> Column:
    ok = F.lit(True)
    if at_least is not None:
        ok = ok & (n_alleles() >= at_least)
    if at_most is not None:
        ok = ok & (n_alleles() <= at_most)
    return ok


def of_type(indels=False, snps=False) -> Column:
    """True if the record has one of the wanted types."""
    wanted = [p for p, on in ((has_indel(), indels), (has_snp(), snps)) if on]
    if not wanted:
        raise ValueError("choose indels, snps or both")
    return reduce(lambda x, y: x | y, wanted)


def passed() -> Column:
    return F.col("filter") == "PASS"


def flagged(flags: list[str]) -> Column:
    return F.col("filter").isin(list(flags))


def id_in(ids: list[str]) -> Column:
    return F.col("id").isin(list(ids))


def chrom_in(chroms: list[str]) -> Column:
    return F.col("chrom").isin(list(chroms))


def not_sex_chromosome() -> Column:
    return ~F.col("chrom").isin(SEX_CHROMOSOMES)


_POSITION = re.compile(r"^(?P<chrom>[^:]+)(?::(?P<start>\d+)(?P<dash>-(?P<end>\d*))?)?$")


def parse_position(spec: str) -> tuple[str, int, int | None]:
    """``chr``, ``chr:pos``, ``chr:start-end`` or ``chr:start-`` to one-based inclusive bounds."""
    found = _POSITION.match(spec.strip())
    if not found:
        raise ValueError(f"bad position {spec!r}")
    chrom, start, dash, end = found.group("chrom", "start", "dash", "end")
    if start is None:
        return chrom, 1, None
    if dash is None:
        return chrom, int(start), int(start)
    return chrom, int(start), int(end) if end else None


def at_positions(specs: list[str]) -> Column:
    tests = []
    for spec in specs:
        chrom, start, end = parse_position(spec)
        test = (F.col("chrom") == chrom) & (F.col("pos") >= start)
        tests.append(test if end is None else test & (F.col("pos") <= end))
    return reduce(lambda x, y: x | y, tests)


def same_chrom(a, b) -> Column:
    """Chromosome equality that ignores a ``chr`` prefix."""
    return strip_chr(a) == strip_chr(b)


def all_alleles_plain() -> Column:
    """Every allele is exactly one of A, C, G, T."""
    return F.forall(alleles(), lambda a: a.isin("A", "C", "G", "T"))
