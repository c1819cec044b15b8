"""Mixing sources to target weights.

Documents of a source are ordered by a hash of their id; copies are counted first. Word counts are summed per hash range, the
ranges are added up within the source, and only then single documents are added up inside their range,
so no task ever sees a whole source. A source with a target above its size is repeated in whole epochs;
the rest is cut at the exact word.
"""

from __future__ import annotations

import re
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelespan.llm.common import WORD, Stage

WORDS = re.compile(r"[^ \t-\r]+").finditer
WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``src, source_size`` to ``src, source_size, target``.

    Sources by code point, null last, take the weights in turn. The words of all sources times ``share``
    are dealt by weight; a source gets at most ``epochs`` times its size and the excess goes to the others
    by weight. With sources ordered by (cap / weight) the capped ones come first, so the level at which
    the rest is dealt follows from running sums, one row per source.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    w = w.withColumn("cap", F.lit(epochs) * F.col("source_size"))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    all_rows = W.partitionBy()
    w = w.select(
        "*",
        (F.sum("source_size").over(all_rows) * F.lit(share)).alias("total"),
        F.sum("weight").over(all_rows).alias("all_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    # a source is capped if dealing what is left at its place would give it its cap or more
    share_here = (F.col("total") - F.col("cap_before")) * F.col("weight") / (F.col("all_weight") - F.col("weight_before"))
    w = w.withColumn("capped", share_here >= F.col("cap"))
    w = w.select(
        "*",
        F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(all_rows).alias("cap_sum"),
        F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(all_rows).alias("rest"),
    )
    level = (F.col("total") - F.col("cap_sum")) * F.col("weight") / F.col("rest")
    return w.select("src", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level).alias("target"))


#: Copies of a row are dealt out, and ranked, in blocks of this size.
BLOCK = 1 << 12


def _class_columns(seed: str) -> list:
    """``doc_id, source, src, size, key, digest`` of a row; rows that agree in them are copies of each other."""
    unnamed = F.concat(F.lit("null|"), F.md5(F.coalesce("text", F.lit(""))))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), unnamed)))
    return [
        F.col("doc_id"),
        F.col("source"),
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")).alias("src"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("key"),
        F.xxhash64("text").alias("digest"),
    ]


def _plan(docs: DataFrame, stage: Stage, seed: str, weights, share: float, epochs: int) -> DataFrame:
    """A row per class of copies: ``src, key, doc_id, digest, size, copies, source_size, target``, the whole epochs
    ``full``, and ``rest``, the words that the epoch after them takes from all its copies together.

    Copies are counted before anything is ordered, so a row that is repeated many times is one row here; rows without
    an id are spread by their texts.
    """
    rows = docs.select(*_class_columns(seed)).withColumn("range", F.substring("key", 1, 3))
    classes = rows.groupBy("src", "range", "key", "doc_id", "size", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.first("source", True).alias("source")
    )
    classes = stage.write(classes.withColumn("words", F.col("size") * F.col("copies")), "mix")
    ranges = classes.groupBy("src", "range").agg(F.sum("words").alias("range_size"), F.first("source", True).alias("source"))
    goal = targets(ranges.groupBy("src").agg(F.sum("range_size").alias("source_size"), F.max("source").alias("source")), weights, share, epochs)
    before = W.partitionBy("src").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("range_before", F.coalesce(F.sum("range_size").over(before), F.lit(0))).drop("range_size", "source")
    within = W.partitionBy("src", "range").orderBy("key", "doc_id", "size", "digest").rowsBetween(W.unboundedPreceding, -1)
    budget = F.floor("target")
    full = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    out = classes.drop("source").withColumn("inside", F.coalesce(F.sum("words").over(within), F.lit(0)))
    out = out.join(ranges, ["src", "range"]).join(goal, "src").withColumn("full", full)
    due = budget - F.col("full") * F.col("source_size") - F.col("range_before") - F.col("inside")
    rest = F.greatest(F.lit(0), F.least(F.col("words"), due)).cast("long")
    return out.select("src", "key", "doc_id", "digest", "size", "copies", "source_size", "target", "full", rest.alias("rest"))


def _extra(rank, size, rest):
    """Words of the last epoch that the copy of this rank gives."""
    return F.greatest(F.lit(0), F.least(size, rest - rank * size))


def mix(docs: DataFrame, *, seed: str = "mix", weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Words that a mix takes from each document.

    ``docs`` has ``doc_id, text, source``; other columns are ignored. Result per row of ``docs``:
    ``doc_id, size`` (words), ``source_size, target`` (of its source), ``taken`` (repeats counted, at most
    ``epochs`` times the size). The words taken from a source are its target rounded down. The same seed
    gives the same mix, however the rows are partitioned. A null text has size 0 and takes nothing; a null
    source is a source of its own; rows that share a doc_id are ordered by size, rows without one by a hash of
    their text, and copies are taken one after another. An empty table gives an empty result.
    """
    plan = _plan(docs, Stage(docs.sparkSession), seed, weights, share, epochs)
    last = F.col("copies") - 1
    plan = plan.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(BLOCK).cast("long"))))
    plan = plan.withColumn("rank", F.explode(F.sequence("block", F.least(last, F.col("block") + (BLOCK - 1)))))
    taken = F.col("full") * F.col("size") + _extra(F.col("rank"), F.col("size"), F.col("rest"))
    return plan.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


@F.pandas_udf(T.StringType())
def cut_after(texts: pd.Series, words: pd.Series) -> pd.Series:
    """``texts`` up to the end of their n-th word; whole where n is null."""

    def cut(text: str, n: float) -> str:
        if text is None or pd.isna(n):
            return text
        found = next(islice(WORDS(text), int(n) - 1, None), None)
        return text if found is None else text[: found.end()]

    return pd.Series([cut(t, n) for t, n in zip(texts, words, strict=True)], dtype=object)


def mixed_documents(docs: DataFrame, *, seed: str = "mix", weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """The documents of the mix with all their columns: a row per repeat, the last one cut after the
    words that are still due. Rows without a taken word are left out, and so null and empty texts.

    Every row is taken as ``mix`` says: also rows that share a doc_id, or have none, add up to the target of
    their source. Which of the copies (equal doc_id, source and text) goes last follows the order they are
    written in, as their other columns may differ. An empty table gives an empty result.
    """
    stage = Stage(docs.sparkSession)
    plan = _plan(docs, stage, seed, weights, share, epochs).where("size > 0 and (full > 0 or rest > 0)")
    plan = plan.select(
        F.col("src").alias("__src"), F.col("key").alias("__key"), F.col("digest").alias("__digest"), F.col("size").alias("__size"),
        F.col("copies").alias("__copies"), F.col("full").alias("__full"), F.col("rest").alias("__rest"),
    )
    plan = stage.write(plan, "plan")
    cls = ["__src", "__key", "__digest"]
    marks = {f"__{n}": c for n, c in zip(("doc_id", "source", "src", "size", "key", "digest"), _class_columns(seed), strict=True)}
    marked = docs.select(*docs.columns, *[marks[c].alias(c) for c in cls])
    # of a source only the class that its budget ends in has copies that differ in what they give
    parted = (F.col("__copies") > 1) & (F.col("__rest") > 0) & (F.col("__rest") < F.col("__size") * F.col("__copies"))
    out = marked.join(plan.where(~parted), cls).withColumn("__extra", _extra(F.lit(0), F.col("__size"), F.col("__rest")))
    if not plan.where(parted).isEmpty():
        out = out.unionByName(_ranked_copies(stage.write(marked.join(plan.where(parted), cls), "copies"), cls))
    whole = F.array_repeat(F.lit(None).cast("long"), (F.col("__full") + (F.col("__extra") == F.col("__size")).cast("long")).cast("int"))
    part = (F.col("__extra") > 0) & (F.col("__extra") < F.col("__size"))
    out = out.withColumn("__words", F.explode(F.when(part, F.concat(whole, F.array("__extra"))).otherwise(whole)))
    return out.withColumn("text", cut_after("text", "__words")).select(*docs.columns)


def _ranked_copies(written: DataFrame, cls: list[str]) -> DataFrame:
    """A written table of copies with ``__extra``: they are ranked by their place in its files, in blocks of rows."""
    at = F.col("_metadata.row_index")
    rows = written.select("*", F.col("_metadata.file_path").alias("__file"), at.alias("__at"), F.floor(at / BLOCK).alias("__block"))
    block = [*cls, "__file", "__block"]
    before = W.partitionBy(*cls).orderBy("__file", "__block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("__n"))
    blocks = blocks.select(*block, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rank = F.col("__before") + F.row_number().over(W.partitionBy(*block).orderBy("__at")) - 1
    rows = rows.join(blocks, block).withColumn("__extra", _extra(rank, F.col("__size"), F.col("__rest")))
    return rows.drop("__file", "__at", "__block", "__before")
