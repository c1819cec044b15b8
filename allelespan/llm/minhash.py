"""Near duplicates by fast similarity sketches, banding and exact verification.

A sketch fills its bins in rounds: in each of the first rounds every element of the set is thrown into one
bin by a hash of its own, in each later round all elements go to one fixed bin, and a bin keeps the least
(round, hash) it ever got. So every bin is filled whatever the size of the set, large sets need about one
round, and the share of equal bins of two sketches is concentrated around the similarity of the sets.
Bands of the sketch give candidates, and the full shingle sets decide.

Copies with equal sets are one class from the start. In a bucket of classes with an equal band, all are
first compared with one of them, the hub; what has been joined that way needs no pair of its own, so a
group of n near copies costs about n comparisons. Of the pairs of a bucket that are in different
components after that, all are compared that can be alike by the number of shingles they share with
anyone at all.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespan.llm.common import Stage, mix64, shingle_set

BANDS = 32
ROWS = 5
BINS = BANDS * ROWS
#: Links need this share of common shingles, in hundredths.
PERCENT = 85
#: Ids are broadcast up to so many rows (8 MB), which are counted first.
SMALL = 1_000_000
_CHUNK = 200_000


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """Sketches (one row of ``bins`` values each) of non-empty sets of 64-bit hashes."""
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets)
    out = np.full(len(sets) * bins, np.uint64(2**64 - 1))
    for i in range(2 * bins):
        h = mix64(elements ^ mix64(np.array([i + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        value = (np.uint64(i) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        bin_ = (((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(out, doc * bins + bin_, value)
        empty = (out.reshape(-1, bins) == np.uint64(2**64 - 1)).any(axis=1)
        if not empty.any():
            break
        on = empty[doc]
        if not on.all():
            doc, elements = doc[on], elements[on]
    return out.reshape(-1, bins)


def bands_of(rows: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band."""
    parts = rows.reshape(len(rows), bands, -1)
    key = np.arange(bands, dtype=np.uint64)[None, :] + np.zeros((len(rows), 1), np.uint64)
    for r in range(parts.shape[2]):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def bands_for(percent: int) -> int:
    """Bands, in steps of 16, so that a pair of this similarity is missed with a probability below 1e-5."""
    if percent >= 100:
        return 16
    needed = math.log(1e-5) / math.log1p(-((percent / 100) ** ROWS))
    return 16 * math.ceil(needed / 16)


def sketched(docs: DataFrame, bands: int = BANDS) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands``; without shingles the last two are null."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ids = f.doc_id.astype("Int64").to_numpy()
            at, held, size = 0, [], 0
            for i, text in enumerate(f.text):
                held.append(shingle_set(text))
                size += len(held[-1])
                if size > _CHUNK or i + 1 == len(f):
                    full = [s for s in held if len(s)]
                    keys = iter(bands_of(sketches(full, bands * ROWS), bands).tolist() if full else ())
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(ids[at : i + 1], "Int64"),
                            "n_shingles": [len(s) for s in held],
                            "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in held],
                            "bands": [next(keys) if len(s) else None for s in held],
                        }
                    )
                    at, held, size = i + 1, [], 0

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_shingles long, set_key string, bands array<long>")


def alike(n: int, m: int, common: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (n + m - common)


def compared(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b, common, linked`` of pairs ``a, b`` of doc_ids: common shingles of the full sets, and whether
    these are alike enough."""
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come sorted by b, the hub of many pairs
        of = lru_cache(maxsize=8)(shingle_set)
        for f in frames:
            sets = [(of(x), of(y)) for x, y in zip(f.text_a, f.text_b, strict=True)]
            common = [len(np.intersect1d(x, y, True)) for x, y in sets]
            linked = [alike(len(x), len(y), c, percent) for (x, y), c in zip(sets, common, strict=True)]
            yield pd.DataFrame({"a": f.a, "b": f.b, "common": common, "linked": linked})

    return both.select("a", "b", "text_a", "text_b").mapInPandas(run, "a long, b long, common long, linked boolean")


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """``node, label``: the smallest node that each node of ``edges`` (a, b) can reach.

    Large and small stars in turn: neighbours are hung onto the smallest neighbour until nothing changes.
    Only minima are aggregated, so a node with any number of neighbours is no group in memory.
    """

    def tally(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stage.write(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    before = tally(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        new = stage.write(small, "edges")
        stage.drop(edges)
        edges, now = new, tally(new)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def shared_shingles(reps: DataFrame, texts: DataFrame, stage: Stage) -> DataFrame:
    """``rep, f``: how many shingles of each document occur in any other of them. No two of them have
    more in common than the smaller of their counts, which rules out most pairs of a group of copies with
    many edits of their own. Hashes are cut to 32 bits: a collision can only raise a count."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            cut = [shingle_set(t).astype(np.uint32).view(np.int32) for t in f.text]
            yield pd.DataFrame({"rep": f.doc_id, "shingles": [np.unique(c).tolist() for c in cut], "lost": [len(c) - len(np.unique(c)) for c in cut]})

    texts = texts.join(reps.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
    sets = stage.write(texts.mapInPandas(run, "rep long, shingles array<int>, lost long"), "shingles")
    each = sets.select("rep", F.explode("shingles").alias("s"))
    often = each.groupBy("s").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low != high").select("s")
    counts = each.join(often, "s", "left_semi").groupBy("rep").agg(F.count(F.lit(1)).alias("c"))
    return sets.groupBy("rep").agg(F.max("lost").alias("lost")).join(counts, "rep", "left").select("rep", (F.coalesce("c", F.lit(0)) + F.col("lost")).alias("f"))


def _classes(rows: DataFrame) -> DataFrame:
    """``set_key, rep, copies, n, bands`` of equal sets."""
    with_set = rows.where("set_key is not null and doc_id is not null")
    return with_set.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )


def _small(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if it has ``SMALL`` rows or fewer; otherwise both sides are dealt out."""
    return F.broadcast(ids) if ids.count() <= SMALL else ids


def near_duplicates(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """Component of every row of ``docs`` (``doc_id, text``; other columns are ignored).

    ``n_shingles``: distinct shingles of five words, A-Z lower-cased; with fewer words the whole sequence
    is one. Documents are linked from ``percent`` hundredths of common shingles on. ``component_id``: the
    smallest doc_id that links lead to; ``kept``: it is the document's own. Null and empty texts, and rows
    without a doc_id, are linked with nothing; rows that share a doc_id form one document each in the
    result, and their links add up. An empty table gives an empty result.

    A pair of the least similarity shares no band with a probability below 1e-5 (32 bands of 5 for 85 and 80: 8e-9
    and 3e-6).
    """
    stage = Stage(docs.sparkSession)
    rows = stage.write(sketched(docs, bands_for(percent)), "sketches")
    classes = _classes(rows)
    buckets = classes.select("rep", "n", "bands", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    buckets = stage.write(buckets.drop("bands").join(shared, "key", "left_semi"), "buckets")
    # texts move once: those that have to be compared are kept aside
    inside = buckets.select(F.col("rep").alias("doc_id")).distinct()
    texts = stage.write(docs.select("doc_id", "text").join(_small(stage.write(inside, "inside")), "doc_id", "left_semi"), "texts")
    fits = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (F.col("a") != F.col("b"))
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]

    def member(d: DataFrame, a: str, n: str, *more) -> DataFrame:
        return d.select("key", F.col("rep").alias(a), F.col("n").alias(n), *more)

    # a star per bucket
    hubs = buckets.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("h")).select("key", F.col("h.rep").alias("hub"), F.col("h.n").alias("m"))
    star = member(buckets, "a", "n").join(hubs.withColumnRenamed("hub", "b"), "key").where(fits).select(*pair).distinct()
    star = stage.write(compared(star, texts, percent), "star")
    labels = stage.write(components(star.where("linked"), stage), "labels")
    # what is still in different components of a bucket
    now = buckets.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("key")
    open_ = stage.write(now.join(mixed, "key", "left_semi"), "open")
    reps = open_.select("rep").distinct()
    open_ = open_.join(shared_shingles(reps, texts, stage), "rep").join(hubs.drop("m"), "key")
    with_hub = star.select(F.col("a").alias("rep"), F.col("b").alias("hub"), F.col("common").alias("i"))
    open_ = open_.join(with_hub, ["rep", "hub"], "left").withColumn("i", F.when(F.col("rep") == F.col("hub"), F.col("n")).otherwise(F.col("i")))
    open_ = stage.write(open_.drop("hub"), "open")
    stage.drop_others(rows, texts, star, open_)
    left = member(open_, "a", "n", "label", "f", "i")
    right = member(open_, "b", "m", F.col("label").alias("label_b"), F.col("f").alias("g"), F.col("i").alias("j"))
    # common shingles are at most those shared with anyone, and at most those shared with the hub and those
    # outside the hub that are shared with anyone
    by_all = F.least("f", "g")
    by_hub = F.least("i", "j") + F.least(F.col("f") - F.col("i"), F.col("g") - F.col("j"))
    bound = F.least(by_all, F.coalesce(by_hub, by_all))
    can_be = 100 * bound >= percent * (F.col("n") + F.col("m") - bound)
    rest = left.join(right, "key").where("label > label_b").where(fits).where(can_be).select(*pair).distinct()
    rest = stage.write(rest.join(star, ["a", "b"], "left_anti"), "pairs")
    links = star.unionByName(stage.write(compared(rest, texts, percent), "rest")).where("linked")
    labels = components(links, stage)
    classes = _classes(rows).drop("bands")
    # copies and components are few: a third table brings them to the rows, any other row is its own component
    found = classes.select("set_key", "rep", "copies").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.where("copies > 1 or label is not null").select("set_key", F.coalesce("label", "rep").alias("found"))
    found = stage.write(found, "components")
    stage.drop_others(rows, found)
    out = rows.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """One row per component of near duplicates, with all columns; rows without a doc_id stay.

    Of rows that share the kept doc_id one stays. Only these are grouped with their texts; all other rows
    just pass by the ids that go.
    """
    stage = Stage(docs.sparkSession)
    found = near_duplicates(docs, percent=percent).where("doc_id is not null")
    per_id = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    marked = stage.write(per_id.where("rows > 1 or not kept"), "marked")
    one = docs.join(_small(marked.select("doc_id")), "doc_id", "left_anti")
    more = docs.join(_small(marked.where("kept").select("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.select(*docs.columns).unionByName(more.select(*docs.columns))
