"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelespan.plans.tables import VIEWS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6
# Added before rounding on both sides, so that values such as n/128 are not on a rounding edge.
NUDGE = "1e-9"


def plain(df: DataFrame) -> DataFrame:
    """Comparable columns: integers as bigint, doubles rounded."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # + 0.0 turns a negative zero into zero
            c = F.round(c.cast("double") + F.lit(float(NUDGE)), DIGITS) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the views that ``body`` uses, directly or through another view."""
    views = {**VIEWS, **(extra or {})}
    names = list(views)

    def uses(sql: str) -> set[str]:
        return {n for n in names if re.search(rf"\b{n}\b", sql)}

    needed, todo = set(), uses(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= uses(views[name]) - needed - {name}
    ctes = [f"{n} AS ({views[n].strip()})" for n in names if n in needed]
    return f"WITH {', '.join(ctes)} {body.strip()}" if ctes else body.strip()


def nudged(sql: str) -> str:
    """``ROUND(x, 6)`` to ``ROUND(x + 1e-9, 6)``."""
    out, at = [], 0
    for found in re.finditer(r"ROUND\(", sql):
        depth, i = 1, found.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            i += 1
        tail = f", {DIGITS})"
        if sql[i - len(tail) : i] == tail:
            out += [sql[at : i - len(tail)], f" + {NUDGE}"]
            at = i - len(tail)
    return "".join(out) + sql[at:]


def query(key: str, sql: str | None = None, views: dict[str, str] | None = None):
    """Register a function of ``Tables`` under ``key`` with its checking SQL."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Tables(spark, sf_dir)))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = nudged(with_views(sql, views))
        return fn

    return wrap
