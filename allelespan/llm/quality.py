"""Quality rules with thresholds learned from the data.

Per document a few integer signals are measured. Their distribution in every language and source is held
in a mergeable sketch: counts by bin, where a bin keeps the six highest bits of a value, so sketches merge
by adding counts, quantiles are within 1/32, and the outcome depends on neither order nor partitioning.
Fences around the quartiles replace fixed cutoffs. A group too small for quartiles of its own uses the
merged sketch of its language, or that of all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.llm.common import SHINGLE, Stage, find_words

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MEASURED = f"doc_id long, lang string, source string, {BASE}, n_lines long, n_upper long, n_short long"
MIN_GROUP = 200
REACH = 4
#: Least width of the middle half of a signal, in its unit, so that a constant signal allows some play.
LEAST = {"symbols": 5, "upper": 50, "dup_lines": 125, "word_length": 25, "short": 25}
#: Signals by 1000 characters, 1000 lines or 1000 words; word_length in hundredths of a character.
SIGNALS = {
    "symbols": "1000 * n_symbols div word_chars",
    "upper": "1000 * n_upper div word_chars",
    "dup_lines": "1000 * n_dup_lines div n_lines",
    "word_length": "100 * word_chars div n_words",
    "short": "1000 * n_short div n_words",
}
_symbols = re.compile(r"[#*$%&|<>]").findall
_upper = re.compile(r"[A-Z]").findall


def repeated_words(words: list[str], size: int = SHINGLE) -> int:
    """Words inside windows of ``size`` words that are found twice or more, the first one included."""
    if len(words) <= size:
        return 0
    codes: dict[str, int] = {}
    at = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    if len(codes) == len(words):
        return 0
    n = len(at) - size + 1
    rank, width = at, 1
    # equal windows get equal numbers, doubling the window as far as it fits
    while width < size:
        step = min(width, size - width)
        m = len(at) - (width + step) + 1
        pair = rank[:m] * len(at) + rank[step : step + m]
        rank, width = np.unique(pair, return_inverse=True)[1], width + step
    again = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(at) + 1, np.int64)
    starts = np.flatnonzero(again[:n])
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    words = find_words(text) if text else []
    if not words:
        return (0, 0, len(_symbols(text or "")), 0, 0, 0, 0, 0)
    lines = [x for x in text.split("\n") if find_words(x)]
    chars = list(map(len, words))
    return (
        len(words), sum(chars), len(_symbols(text)), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), len(_upper(text)), sum(c <= 3 for c in chars),
    )


def measure(docs: DataFrame) -> DataFrame:
    """Counts per row of ``docs``; a null text counts as empty and has zeros."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in MEASURED.split(", ")]
        for f in frames:
            out = pd.DataFrame([measure_text(t) for t in f.text], columns=names[3:])
            for i, c in enumerate(names[:3]):
                out.insert(i, c, f[c].astype("Int64").to_numpy() if c == "doc_id" else f[c].to_numpy())
            yield out

    return docs.select("doc_id", "lang", "source", "text").mapInPandas(run, MEASURED)


def sketch(signals: DataFrame, *keys: str) -> DataFrame:
    """``keys, signal, bin, n`` from ``keys, signal, value``."""
    cut = F.greatest(F.lit(0), F.length(F.bin("value")) - 6)
    binned = F.expr("shiftleft(shiftright(value, cut), cut)")
    return signals.withColumn("cut", cut).groupBy(*keys, "signal", binned.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, *keys: str) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*keys, "signal", "bin").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, *keys: str) -> DataFrame:
    """One row per group: its documents, and the lowest and highest value of each signal that passes."""
    group = W.partitionBy(*keys, "signal")
    c = sketches.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
    quartile = [F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("bin"))).alias(f"q{k}") for k in (1, 3)]
    q = c.groupBy(*keys, "signal").agg(F.max("all").alias("docs"), *quartile)
    least = F.create_map(*[F.lit(x) for kv in LEAST.items() for x in kv])[F.col("signal")]
    q = q.withColumn("reach", REACH * F.greatest(F.col("q3") - F.col("q1"), least))
    one = [
        F.max(F.when(F.col("signal") == s, F.col("q1") - F.col("reach") if low else F.col("q3") + F.col("reach"))).alias(f"{s}_{'low' if low else 'high'}")
        for s in SIGNALS
        for low in (True, False)
    ]
    return q.groupBy(*keys).agg(F.max("docs").alias("docs"), *one)


def judge(docs: DataFrame, *, min_group: int = MIN_GROUP) -> DataFrame:
    """Counts and verdict per row of ``docs`` (``doc_id, text, lang, source``; other columns are ignored).

    ``base_failed``: fewer than 10 words, or more than a fifth of the words in repeated windows. ``kept``:
    not base_failed, and inside the fences of its language and source: symbols, capitals and repeated
    lines may not be above theirs; the mean word length and the share of short words may not both be
    outside. Sketches cover all documents that pass the base rules. Null languages and sources are groups
    of their own. Null and empty texts fail. Repeated rows count each. An empty table gives an empty result.
    """
    stage = Stage(docs.sparkSession)
    rows = stage.write(measure(docs), "quality")
    rows = rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    for name in ("lang", "source"):
        rows = rows.withColumn(f"{name}_key", F.when(F.col(name).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), name)))
    rows = rows.withColumns({s: F.when(~F.col("base_failed"), F.expr(e)) for s, e in SIGNALS.items()})
    long = ", ".join(f"'{s}', {s}" for s in SIGNALS)
    signals = rows.where(~F.col("base_failed")).selectExpr("lang_key", "source_key", f"stack({len(SIGNALS)}, {long}) as (signal, value)")
    fine = stage.write(sketch(signals, "lang_key", "source_key"), "quality-sketch")
    by_lang = merge(fine, "lang_key")
    limits = [
        fences(fine, "lang_key", "source_key"),
        fences(by_lang, "lang_key"),
        fences(merge(fine.withColumn("every", F.lit(0)), "every"), "every"),
    ]
    bounds = [f"{s}_{side}" for s in SIGNALS for side in ("low", "high")]
    for i, level in enumerate(limits):
        level = level.withColumn("use", F.lit(True) if i == 2 else F.col("docs") >= min_group)
        limits[i] = level.select(*[c for c in level.columns if c.endswith("_key")], F.struct("use", *bounds).alias(f"at{i}"))
    # one row per language and source; the last table has a single row
    chosen = limits[0].join(limits[1], "lang_key").withColumn("one", F.lit(1)).join(limits[2].withColumn("one", F.lit(1)), "one")
    pick = F.when(F.col("at0.use"), F.col("at0")).when(F.col("at1.use"), F.col("at1")).otherwise(F.col("at2"))
    chosen = stage.write(chosen.select("lang_key", "source_key", pick.alias("limit")), "quality-limits")
    out = rows.join(chosen, ["lang_key", "source_key"], "left")
    above = {s: F.col(s) > F.col(f"limit.{s}_high") for s in SIGNALS}
    outside = {s: above[s] | (F.col(s) < F.col(f"limit.{s}_low")) for s in ("word_length", "short")}
    bad = above["symbols"] | above["upper"] | above["dup_lines"] | (outside["word_length"] & outside["short"])
    kept = ~F.col("base_failed") & ~F.coalesce(bad, F.lit(False))
    base = [x.split()[0] for x in BASE.split(", ")]
    return out.select("doc_id", *base, "base_failed", kept.alias("kept"))
