"""Document fingerprints by a threshold-scaled sketch.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range, so its size follows the
document, the union of two fingerprints is the fingerprint of the joined documents, and containment can be
estimated between documents of very different lengths. The smallest hash is kept as well: it merges the
same way and speaks for texts too short to have a hash below the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.llm.common import id_columns, partitions, shingle_set

FRACTION = 1 / 8
#: A block is read in order by one task: about this many rows, more where that made more than ``BLOCKS`` blocks.
#: So one row per block is a table of a known size.
BLOCK = 256
BLOCKS = 65_536
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, containment_edited double, containment_next double"
)


def sketch(text: str | None, fraction: float = FRACTION) -> np.ndarray:
    """Sorted shingle hashes below ``fraction`` of the range, and the smallest one."""
    hashes = shingle_set(text)
    if not len(hashes):
        return hashes
    return hashes[: max(1, int(np.searchsorted(hashes, np.uint64(int(fraction * 2**64)))))]


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of the union of two shingle sets."""
    both = np.union1d(a, b)
    return both[: max(1, int(np.searchsorted(both, np.uint64(int(fraction * 2**64)))))] if len(both) else both


def written(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def resemblance(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> float:
    """Estimated Jaccard similarity. Two empty sketches are alike, an empty and another one are not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, fraction)
    return len(np.intersect1d(np.intersect1d(a, b, True), union, True)) / len(union)


def containment(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has; empty is in everything.

    Without a hash of ``a`` below the threshold its smallest hash decides, if ``b`` keeps that range.
    """
    if not len(a):
        return 1.0
    return len(np.intersect1d(a, b, True)) / len(a)


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as many first characters of ``following``, or all of them."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compare(rows: Iterator[tuple[int, str | None, str | None]], fraction: float) -> pd.DataFrame:
    out = []
    seen, known = None, None  # the text that followed last, mostly the next one, and its sketch
    for doc_id, text, following in rows:
        a = known if text is not None and text is seen else sketch(text, fraction)
        seen, known = following, sketch(following, fraction)
        text, following = text or "", following or ""
        new = edited(text, following)
        b = sketch(new, fraction)
        sha = hashlib.sha256(new.encode()).hexdigest()
        out.append(
            (doc_id, len(text), sha, written(a), written(b), resemblance(a, b, fraction), resemblance(a, known, fraction))
            + (containment(a, b, fraction), containment(a, known, fraction))
        )
    names = [x.split()[0] for x in RESULT.split(", ")]
    frame = pd.DataFrame(out, columns=names)
    frame["doc_id"] = pd.array([row[0] for row in out], "Int64")
    return frame


def fingerprints(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """``doc_id, fingerprint`` of every row; a null text counts as empty and has the empty fingerprint."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([written(sketch(t, fraction)) for t in texts], dtype=object)

    return docs.select("doc_id", of("text").alias("fingerprint"))


def in_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``hash`` of the text) with ``block``, which ascends as ``doc_id`` descends, nulls last.

    Blocks are cut at quantiles of the ids, so gaps between ids do not matter. An id of many blocks' rows, or
    null, has blocks of its own, cut by the hash. All cuts, at most a few per block, are on the driver.
    """
    turned = F.bitwise_not("doc_id")  # ascends as the id descends, without overflow
    total = rows.count()
    size = max(BLOCK, -(-total // BLOCKS))
    n = -(-total // size)
    shares = [i / n for i in range(1, n)]
    cuts = rows.agg(F.percentile_approx(turned, shares, max(10_000, 10 * n)).alias("c")).first().c if shares else None
    often = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > 2 * size).collect()
    parts = {r.doc_id: -(-r.n // size) for r in often}
    own = {~i for i in parts if i is not None}
    edges = np.array(sorted({*(cuts or ()), *own, *(i + 1 for i in own if i < 2**63 - 1)}), np.int64)
    of_null = parts.get(None, 1)

    @F.pandas_udf("long")
    def block(ids: pd.Series, nulls: pd.Series, hashes: pd.Series) -> pd.Series:
        part = (hashes.to_numpy(np.int64) >> 32) + 2**31  # the upper half, from 0 to 2**32
        null, key = nulls.to_numpy(bool), ~ids.to_numpy(np.int64)
        many = np.ones(len(key), np.int64)
        for i, k in parts.items():
            if i is not None:
                many[key == ~i] = k
        many[null] = of_null
        at = np.where(null, len(edges) + 1, np.searchsorted(edges, key, "right"))
        return pd.Series((at << 20) + (part * many >> 32))

    # nulls apart: a column with both would lose digits of large ids
    return rows.withColumn("block", block(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "hash"))


def compare_with_next(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness.

    The next document has the next smaller doc_id, and the first follows the last; a null id counts as the
    smallest. Rows with equal ids follow each other by a hash of their text, then the text. A null text counts
    as empty. A single document is its own next one. An empty table gives an empty result.

    Texts move once: a block of rows that follow each other goes to one partition in order, together with a
    copy of the row that follows its last one, and is read as a stream of rows. The broadcast heads of
    blocks are at most some ``BLOCKS`` rows of four numbers.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("hash"))
    rows = in_blocks(rows)
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash"), F.col("text").asc_nulls_first()]
    # one row per block, so this window stays small: the head of each block also ends the block before it
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("turned"), F.col("hash").alias("first"))
    heads = rows.groupBy("block").agg(F.min(place).alias("h"))
    up = W.orderBy("block")
    last_to_first = F.max("block").over(W.partitionBy())
    heads = heads.select(F.col("block").alias("of"), "h", F.coalesce(F.lag("block").over(up), last_to_first).alias("ends"))
    same = F.col("h.turned").eqNullSafe(F.bitwise_not("doc_id")) & (F.col("h.first") == F.col("hash"))
    copies = rows.join(F.broadcast(heads), (F.col("block") == F.col("of")) & same)
    # of several rows with the head's id and hash only the first one by text is needed
    copies = copies.groupBy("ends").agg(F.min(F.struct(F.col("text").isNotNull(), "text")).alias("t"))
    none = F.lit(None).cast("long")
    copies = copies.select(none.alias("doc_id"), F.col("t.text").alias("text"), none.alias("hash"), F.col("ends").alias("block"), F.lit(1).alias("copy"))
    all_rows = rows.withColumn("copy", F.lit(0)).unionByName(copies)
    n = partitions(docs.sparkSession)
    all_rows = all_rows.repartition(n, "block").sortWithinPartitions("block", "copy", *order)

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pairs():
            held = None
            for frame in frames:
                for doc_id, no_id, text, block, copy in frame.itertuples(index=False, name=None):
                    if held is not None and held[2] == block:
                        yield held[0], held[1], text
                    held = None if copy else (None if no_id else int(doc_id), text, block)

        def flush(batch):
            return _compare(iter(batch), fraction)

        batch, size = [], 0
        for pair in pairs():
            batch.append(pair)
            size += len(pair[1] or "")
            if size > 1 << 22 or len(batch) >= 2000:
                yield flush(batch)
                batch, size = [], 0
        if batch:
            yield flush(batch)

    return all_rows.select(*id_columns("text", "block", "copy")).mapInPandas(walk, RESULT)
