"""Seeded draws that do not depend on row order or partitioning.

A draw is a number in [0, 1) computed from the row's key. "The n lowest draws" is exact for any n:
draws are counted per bucket (a table of fixed size), whole buckets below the cut are kept, and
only the rows of the cut bucket are ranked, so neither the driver nor one task sees all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKETS = 1 << 16

# Statistic name to the column holding it.
STATISTIC_COLUMNS = {"windowed-weir-fst": "MEAN_FST", "TajimaD": "TajimaD", "window-pi": "PI"}


def draw(seed: int, *keys: str) -> Column:
    """Uniform number in [0, 1) from a hash of the key columns and the seed."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 52)) / F.lit(float(1 << 52))


def take_lowest(
    df: DataFrame,
    n: int | Column,
    draw_col: Column,
    tie: Sequence[str],
    by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """The ``n`` rows with the lowest draws, per ``by`` group; ``tie`` breaks equal draws."""
    by = list(by)
    n = F.lit(n).cast("long") if isinstance(n, int) else n
    rows = df.withColumn("__draw", draw_col)
    rows = rows.withColumn("__bucket", F.floor(F.col("__draw") * buckets).cast("int"))
    counts = rows.groupBy(*by, "__bucket").agg(F.count("*").alias("__n"))
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = F.coalesce(
        F.sum("__n").over(w.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    cut = counts.select(*by, "__bucket", before.alias("__before")).filter(F.col("__before") < n)
    rows = rows.join(cut, [*by, "__bucket"])
    rank = F.row_number().over(
        W.partitionBy(*by, "__bucket").orderBy("__draw", *[F.col(t) for t in tie])
    )
    return (
        rows.withColumn("__rank", rank)
        .filter(F.col("__before") + F.col("__rank") <= n)
        .select(*df.columns)
    )


def sample_rows(st: DataFrame, n: int, seed: int = 0, keys: Sequence[str] = (), draw_col=None) -> DataFrame:
    """Exactly ``n`` rows without replacement; asking for more rows than there are is an error."""
    keys = list(keys) or st.columns
    draw_col = draw(seed, *keys) if draw_col is None else draw_col
    total = st.agg(F.count("*")).scalar()
    too_large = F.raise_error(F.lit(f"sample of {n} is larger than the table")).cast("boolean")
    enough = F.when(total < n, too_large).otherwise(F.lit(True))
    return take_lowest(st, n, draw_col, keys).filter(enough)


def bed_sample(iv: DataFrame, n: int, seed: int = 0, keys=("chrom", "start", "end"), draw_col=None):
    return sample_rows(iv, n, seed, keys, draw_col)


def statistic_column(statistic: str, columns: Sequence[str]) -> str:
    name = STATISTIC_COLUMNS.get(statistic)
    if name is None or name not in columns:
        raise ValueError(f"no column for statistic {statistic!r}")
    return name


def uniform_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width right-closed bins numbered from 1; the minimum belongs to bin 1."""
    width = (high - low) / F.lit(float(bins))
    place = F.when(width > 0, F.ceil((x - low) / F.nullif(width, F.lit(0.0)))).otherwise(F.lit(1))
    return F.least(F.greatest(place.cast("int"), F.lit(1)), F.lit(bins))


def with_uniform_bins(st: DataFrame, col: str, bins: int) -> DataFrame:
    ends = st.agg(F.struct(F.min(col).alias("low"), F.max(col).alias("high"))).scalar()
    return st.withColumn("bin", uniform_bin(F.col(col), ends["low"], ends["high"], bins))


def sample_uniform_bins(
    st: DataFrame, col: str, bins: int, n: int, seed: int = 0, keys: Sequence[str] = (), draw_col=None
) -> DataFrame:
    """``n / bins`` rows from each equal-width bin of ``col``; short bins give all they have."""
    if n % bins:
        raise ValueError("the sample size must divide evenly into the bins")
    keys = list(keys) or st.columns
    draw_col = draw(seed, *keys) if draw_col is None else draw_col
    defined = st.filter(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    return take_lowest(with_uniform_bins(defined, col, bins), n // bins, draw_col, keys, by=["bin"])


def shuffle_regions(iv: DataFrame, seed: int = 0, draw_col=None) -> DataFrame:
    draw_col = draw(seed, *iv.columns) if draw_col is None else draw_col
    return iv.orderBy(draw_col)


def thin(df: DataFrame, prop: float, seed: int = 0, keys=("chrom", "pos"), draw_col=None) -> DataFrame:
    """Keep each row with chance ``prop``."""
    draw_col = draw(seed, *keys) if draw_col is None else draw_col
    return df.filter(draw_col < prop)
