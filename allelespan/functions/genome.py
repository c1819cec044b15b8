"""Scalar column functions on chromosomes, coordinates, alleles and sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nucleotide ambiguity codes for an unordered pair of bases.
IUPAC_PAIRS = {
    "AA": "A", "AC": "M", "AG": "R", "AT": "W",
    "CA": "M", "CC": "C", "CG": "S", "CT": "Y",
    "GA": "R", "GC": "S", "GG": "G", "GT": "K",
    "TA": "W", "TC": "Y", "TG": "K", "TT": "T",
}

# Inheritance scalars of the sex and mitochondrial chromosomes.
INHERITANCE = {"X": 0.75, "chrX": 0.75, "Y": 0.25, "chrY": 0.25, "MT": 0.25, "chrMT": 0.25}

# Letters of two sequences that are compared at once.
STRETCH = 32

# Letters allowed in a reference sequence.
DNA_LETTERS = "ACGTYRWSKMDVHBXN"

# Characters tried, in this order, to join family and individual identifiers.
ID_DELIMITERS = ("_", "-", "|", "/", "@", "&", "*", "^", "%", "$")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_chr(chrom) -> Column:
    return F.regexp_replace(col(chrom), "^chr", "")


def add_chr(chrom) -> Column:
    chrom = col(chrom)
    return F.when(chrom.startswith("chr"), chrom).otherwise(F.concat(F.lit("chr"), chrom))


def flip_chr(chrom) -> Column:
    """``chr7`` becomes ``7`` and ``7`` becomes ``chr7``."""
    chrom = col(chrom)
    return F.when(chrom.startswith("chr"), strip_chr(chrom)).otherwise(add_chr(chrom))


def natural_key(chrom) -> Column:
    """String that sorts chromosomes naturally.

    Digit runs are left-padded to a fixed width so that they compare as numbers; digits sort
    before letters in ASCII, which gives "numbers before text". Case is ignored.
    """
    runs = F.regexp_extract_all(F.lower(strip_chr(chrom)), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.lpad(r, F.greatest(F.lit(20), F.length(r)), "0")).otherwise(r)),
        "",
    )


def region_name(chrom, start, end) -> Column:
    """One-based inclusive ``chrom:start-end`` of a half-open zero-based interval."""
    return F.concat_ws(
        "", col(chrom), F.lit(":"), (col(start) + 1).cast("string"), F.lit("-"), col(end).cast("string")
    )


def to_output_coordinates(start, end, mode: str) -> tuple[Column, Column]:
    """Half-open zero-based bounds to ``half_open``, ``one_based`` or ``zero_closed``."""
    start, end = col(start), col(end)
    if mode == "half_open":
        return start, end
    if mode == "one_based":
        return start + 1, end
    if mode == "zero_closed":
        return start, end - 1
    raise ValueError(f"unknown coordinate mode {mode!r}")


def from_input_coordinates(start, end, one_based=False, zero_closed=False) -> tuple[Column, Column]:
    start, end = col(start), col(end)
    if one_based:
        return start - 1, end
    if zero_closed:
        return start, end + 1
    return start, end


def alleles(ref="ref", alts="alts") -> Column:
    return F.concat(F.array(col(ref)), F.coalesce(col(alts), F.array().cast("array<string>")))


def max_allele_length(ref="ref", alts="alts") -> Column:
    return F.array_max(F.transform(alleles(ref, alts), lambda a: F.length(a)))


def harmonic(limit: Column) -> Column:
    """Sum of 1/i for i below ``max(2, floor(limit))``."""
    top = F.greatest(F.lit(2), F.floor(limit).cast("int")) - 1
    return F.aggregate(F.sequence(F.lit(1), top), F.lit(0.0), lambda s, i: s + F.lit(1.0) / i)


def power_sum(top: Column, power: int) -> Column:
    """Sum of 1/i**power for i from 1 to ``top`` (0 when ``top`` is below 1)."""
    term = F.aggregate(
        F.sequence(F.lit(1), F.greatest(top.cast("int"), F.lit(1))),
        F.lit(0.0),
        lambda s, i: s + F.lit(1.0) / F.pow(i.cast("double"), F.lit(float(power))),
    )
    return F.when(top >= 1, term).otherwise(F.lit(0.0))


def log_choose(n: Column, k: Column) -> Column:
    """ln C(n, k) for 0 <= k <= n as a sum of logarithms."""
    terms = F.when(k > 0, F.sequence(F.lit(1), F.greatest(k, F.lit(1)).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(
        terms, F.lit(0.0), lambda s, i: s + F.log((n - k + i).cast("double") / i.cast("double"))
    )


def hypergeometric_weight(a: Column, r: Column, n: Column, m: Column) -> Column:
    """Chance of r copies in a sub-sample of m when a of n chromosomes carry the allele."""
    possible = (r >= 0) & (r <= a) & (m - r <= n - a) & (r <= m)
    weight = F.exp(log_choose(a, r) + log_choose(n - a, m - r) - log_choose(n, m))
    return F.when(possible, weight).otherwise(F.lit(0.0))


def iupac_code(x: Column, y: Column) -> Column:
    """Ambiguity code of two bases, ``N`` when either is not a plain base."""
    table = F.create_map(*[F.lit(t) for pair in IUPAC_PAIRS.items() for t in pair])
    return F.coalesce(F.try_element_at(table, F.concat(F.upper(x), F.upper(y))), F.lit("N"))


def merge_iupac(seq0, seq1) -> Column:
    """Position-wise ambiguity codes of two aligned sequences.

    Both are compared stretch by stretch, equal ones are their own codes; letters are looked at in the others only.
    """
    x, y = (F.upper(F.regexp_replace(col(s), "[^ACGTacgt]", "N")) for s in (seq0, seq1))

    def letters(a: Column, b: Column) -> Column:
        a, b = (F.split(F.coalesce(t, F.lit("")), "") for t in (a, b))
        return F.array_join(F.zip_with(a, b, iupac_code), "")

    stretches = [F.regexp_extract_all(t, F.lit(f".{{1,{STRETCH}}}"), F.lit(0)) for t in (x, y)]
    codes = F.zip_with(*stretches, lambda a, b: F.when(a == b, a).otherwise(letters(a, b)))
    return F.when((col(seq0) == "") & (col(seq1) == ""), "N").otherwise(F.array_join(codes, ""))


def inheritance_scalar(chrom) -> Column:
    table = F.create_map(*[F.lit(t) for pair in INHERITANCE.items() for t in pair])
    return F.coalesce(F.try_element_at(table, col(chrom)), F.lit(1.0))


def is_dna(seq) -> Column:
    return col(seq).rlike(f"^(?i)[{DNA_LETTERS}]*$")


def general_format(x) -> Column:
    """Six significant digits without trailing zeros; null stays null."""
    value = F.col(x) if isinstance(x, str) else x
    text = F.when(value.isNotNull(), F.format_string("%.6g", value))
    trimmed = F.when(text.contains("."), F.regexp_replace(text, r"(\.\d*?)0+(e|$)", "$1$2")).otherwise(text)
    return F.regexp_replace(trimmed, r"\.(e|$)", "$1")
