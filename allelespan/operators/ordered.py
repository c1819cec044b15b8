"""Order-dependent columns along a chromosome without one window task per chromosome.

Rows are cut into blocks of ``width`` positions. Windows run inside ``(by, block)``; a summary
with one row per non-empty block carries totals across blocks. The only window that spans a whole
chromosome is over that summary (genome length / width rows), so no task ever sorts all rows of a
chromosome, even when one chromosome holds a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 1 << 16

_BLK = "__block"


def running(
    df: DataFrame,
    by: Sequence[str],
    pos: str,
    specs: dict[str, tuple[str, str | Column]],
    tie: Sequence[str] = (),
    width: int = BLOCK,
) -> DataFrame:
    """Add one column per spec ``name: (kind, value)`` in ``(pos, *tie)`` order within ``by``.

    Kinds: ``max_before`` / ``sum_before`` over strictly earlier rows, ``sum_through`` including
    the current row, ``prev`` / ``next`` the value on the neighbouring row (null at the ends).
    """
    by, order = list(by), [pos, *tie]
    values = {name: f"__v_{name}" for name in specs}
    base = df.withColumn(_BLK, F.floor(F.col(pos) / F.lit(width)).cast("long"))
    for name, (_, value) in specs.items():
        base = base.withColumn(values[name], F.col(value) if isinstance(value, str) else value)

    inner = W.partitionBy(*by, _BLK).orderBy(*order)
    before = inner.rowsBetween(W.unboundedPreceding, -1)
    through = inner.rowsBetween(W.unboundedPreceding, 0)
    key = F.struct(*order)
    local, summary = [], []
    for name, (kind, _) in specs.items():
        v = F.col(values[name])
        if kind == "max_before":
            local.append(F.max(v).over(before).alias(f"__l_{name}"))
            summary.append(F.max(v).alias(f"__s_{name}"))
        elif kind in ("sum_before", "sum_through"):
            frame = before if kind == "sum_before" else through
            local.append(F.coalesce(F.sum(v).over(frame), F.lit(0)).alias(f"__l_{name}"))
            summary.append(F.sum(v).alias(f"__s_{name}"))
        elif kind == "prev":
            local.append(F.lag(v).over(inner).alias(f"__l_{name}"))
            summary.append(F.max_by(F.struct(v.alias("x")), key).alias(f"__s_{name}"))
        elif kind == "next":
            local.append(F.lead(v).over(inner).alias(f"__l_{name}"))
            summary.append(F.min_by(F.struct(v.alias("x")), key).alias(f"__s_{name}"))
        else:
            raise ValueError(kind)

    blocks = W.partitionBy(*by).orderBy(_BLK)
    earlier = blocks.rowsBetween(W.unboundedPreceding, -1)
    carried = []
    for name, (kind, _) in specs.items():
        s = F.col(f"__s_{name}")
        if kind == "max_before":
            carried.append(F.max(s).over(earlier).alias(f"__c_{name}"))
        elif kind in ("sum_before", "sum_through"):
            carried.append(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"__c_{name}"))
        elif kind == "prev":
            carried.append(F.lag(s).over(blocks)["x"].alias(f"__c_{name}"))
        else:
            carried.append(F.lead(s).over(blocks)["x"].alias(f"__c_{name}"))
    totals = base.groupBy(*by, _BLK).agg(*summary).select(*by, _BLK, *carried)

    # first / last row of the block decide whether the neighbour lies in another block
    edges = []
    if any(kind == "prev" for kind, _ in specs.values()):
        edges.append(F.row_number().over(inner).alias("__first"))
    if any(kind == "next" for kind, _ in specs.values()):
        edges.append(F.lead(F.lit(1)).over(inner).alias("__more"))
    # every row has its block's totals; a left join adds no null filter to one side only, so both
    # sides read the same shuffle of the input
    rows = base.select("*", *local, *edges).join(totals, [*by, _BLK], "left")

    out = [F.col(c) for c in df.columns if c not in specs]
    for name, (kind, _) in specs.items():
        here, carry = F.col(f"__l_{name}"), F.col(f"__c_{name}")
        if kind == "max_before":
            out.append(F.greatest(here, carry).alias(name))
        elif kind in ("sum_before", "sum_through"):
            out.append((here + carry).alias(name))
        elif kind == "prev":
            out.append(F.when(F.col("__first") == 1, carry).otherwise(here).alias(name))
        else:
            out.append(F.when(F.col("__more").isNull(), carry).otherwise(here).alias(name))
    return rows.select(*out)


def ordinal(df: DataFrame, by, pos="pos", tie=(), name="ordinal", width: int = BLOCK) -> DataFrame:
    """Zero-based rank of each row in ``(pos, *tie)`` order within ``by``."""
    return running(df, by, pos, {name: ("sum_before", F.lit(1).cast("long"))}, tie, width)
