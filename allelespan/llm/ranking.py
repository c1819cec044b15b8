"""Ranked lexical search over a term-partitioned index, in a pipeline of term owners.

One pass over the documents writes the postings of the terms that the items ask for: a row per term and
block of documents. Terms are dealt to owners, rare ones to the first, frequent ones to the last. A bundle of
items travels, block by block, through the owners one after the other: at each, its sparse accumulators (one per
item and document met so far) are cogrouped with the owner's postings and get their integer
contributions. The last owner leaves the best documents of each block, of which the best of all remain.

A term that ``df`` of ``N`` documents with terms hold weighs ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``. In a
document of ``n`` terms, of ``L`` in all, where it occurs ``tf`` times, it gives
``w * (10**9 * tf div (1000 * tf + 20 * m))`` with ``m = 50 + 50 * n * N div L``.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.llm.common import Stage, id_columns, ids_of

TOP = 50
OWNERS = 4
#: Items of a bundle, and of a pass over the documents.
BUNDLE, PASS = 128, 4096
#: Documents of a block; a block also ends at so many terms with repeats.
BLOCK, BLOCK_TERMS = 2048, 4_000_000

_TERM = bytearray(b" " * 128 + bytes(range(128, 256)))
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _TERM[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TERM[_c] = _c + 32
_BYTES = bytes(_TERM)
SCALE = 1_000_000_000

def terms(text: str | None) -> list[bytes]:
    """Terms of ``text``: runs of digits, ASCII letters and characters above ASCII; only A-Z are lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if text else []


class Numbers(dict):
    """Numbers of the wanted terms; -1 for any other."""

    def __missing__(self, term: bytes) -> int:
        return -1


def _small(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint16 if a.max(initial=0) < 1 << 16 else np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, 5))


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def index(docs: DataFrame, wanted: list[bytes]) -> tuple[DataFrame, DataFrame]:
    """``(blocks, postings)`` for the ``wanted`` terms, which are known by their places in the list.

    A block is known by its task and its number there, a document by its place in the block. Blocks carry
    the ids and sizes of their documents, postings the documents of a term and its occurrences there.
    """
    numbers = Numbers((t, i) for i, t in enumerate(wanted))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, block = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        sizes: list[int] = []
        found: list[np.ndarray] = []
        hits = 0

        def flush() -> pd.DataFrame:
            keys, tf = np.unique(np.concatenate(found), return_counts=True)
            term, doc = keys >> 32, keys & 0xFFFFFFFF
            cuts = np.flatnonzero(np.diff(term, prepend=-1, append=-1)) if len(term) else np.zeros(1, int)
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            head = (task, block, None, None, pickle.dumps(ids), sizes, sum(map(bool, sizes)))
            rows = [(task, block, int(term[a]), _pack(_small(doc[a:b]), _small(tf[a:b])), None, None, int(b - a)) for a, b in spans]
            return pd.DataFrame([head, *rows], columns=["task", "block", "term", "hits", "doc_ids", "sizes", "n_docs"]).astype({"term": "Int32"})

        for frame in frames:
            for doc_id, text in zip(ids_of(frame), frame.text, strict=True):
                own = terms(text)
                at = np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))
                found.append(at[at >= 0] << 32 | len(ids))
                ids.append(None if doc_id is pd.NA else int(doc_id))
                sizes.append(len(own))
                hits += len(found[-1])
                if len(ids) == BLOCK or hits > BLOCK_TERMS:
                    yield flush()
                    ids, sizes, found, hits, block = [], [], [], 0, block + 1
        if ids:
            yield flush()

    schema = "task int, block int, term int, hits binary, doc_ids binary, sizes array<long>, n_docs long"
    both = Stage(docs.sparkSession).write(docs.select(*id_columns("text")).mapInPandas(run, schema), "postings")
    return both.where("term IS NULL").drop("term", "hits"), both.where("term IS NOT NULL").drop("doc_ids", "sizes")


def owners_of(df: dict[int, int], owners: int) -> dict[int, int]:
    """Owner by term: rare terms first, and each owner gets about four times the postings of those before it,
    so that accumulators are sparse while they travel."""
    total, upto, out = sum(df.values()), 0, {}
    for term, n in sorted(df.items(), key=lambda x: (x[1], x[0])):
        upto += n
        left = total / upto
        out[term] = max(0, owners - 1 - int(math.log(left, 4) + 1e-9))
    return out


def add(scores: np.ndarray, hits: Iterable[tuple[int, bytes]], norm: np.ndarray, asked: dict[int, tuple[int, np.ndarray]]) -> None:
    """Add what the postings ``hits`` give to ``scores`` (items by documents). ``asked``: weight and items by term."""
    for term, data in hits:
        docs, tf = _unpack(data)
        weight, items = asked[term]
        tf = tf.astype(np.int64)
        gain = weight * (SCALE * tf // (1000 * tf + 20 * norm[docs]))
        for item in items:
            scores[item, docs] += gain


def best(scores: np.ndarray, ids: list[int | None], top: int) -> Iterator[tuple[int, int | None, int]]:
    """``(item, doc_id, score)`` of the ``top`` documents of a block for each item, null ids last among equals."""
    for item, row in enumerate(scores):
        docs = np.flatnonzero(row)
        if len(docs) > top:
            docs = docs[row[docs] >= np.partition(row[docs], -top)[-top]]
        found = sorted((-int(row[d]), ids[d] is None, ids[d] or 0, d) for d in docs.tolist())
        yield from ((item, ids[d], -score) for score, _, _, d in found[:top])


def _search(docs: DataFrame, items: list[list[bytes]], top: int, owners: int) -> DataFrame | None:
    """``item, doc_id, score`` for the items of one pass: the best documents of each block."""
    wanted = sorted(set().union(*items))
    blocks, postings = index(docs, wanted)
    held = blocks.select("n_docs", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).agg(F.sum("n_docs").alias("n"), F.sum("n").alias("l")).first()
    df = {r.term: r.df for r in postings.groupBy("term").agg(F.sum("n_docs").alias("df")).collect()}
    if not df:
        return None
    total, length = held.n, held.l
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for t, n in df.items()}
    owner = owners_of(df, owners)
    place = {t: i for i, t in enumerate(wanted)}
    bundles = [items[i : i + BUNDLE] for i in range(0, len(items), BUNDLE)]
    asked: list[dict[int, tuple[int, np.ndarray]]] = []
    for bundle in bundles:
        by_term: dict[int, list[int]] = {}
        for i, own in enumerate(bundle):
            for t in own:
                by_term.setdefault(place[t], []).append(i)
        asked.append({t: (weight[t], np.array(i)) for t, i in by_term.items() if weight.get(t)})
    spark = docs.sparkSession
    plan = spark.createDataFrame([(t, b, owner[t]) for b, own in enumerate(asked) for t in own] or [(-1, 0, 0)], "term int, bundle int, owner int")
    dealt = postings.drop("n_docs").join(plan, "term")
    dealt = dealt.toDF(*dealt.columns)  # blocks and postings are read from one table, their columns must not pass for the same
    state = "task int, block int, bundle int, doc_ids binary, sizes array<long>, found binary"
    travelling = blocks.drop("n_docs").withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(len(bundles) - 1))))
    travelling = travelling.withColumn("found", F.lit(None).cast("binary")).select("task", "block", "bundle", "doc_ids", "sizes", "found")

    def owned(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> tuple[int, np.ndarray, list[int | None]]:
        bundle = int(key[2])
        ids = pickle.loads(left.doc_ids[0])
        norm = 50 + 50 * np.asarray(left.sizes[0], dtype=object) * total // length
        scores = np.zeros((len(bundles[bundle]), len(ids)), np.int64)
        if left.found[0] is not None:
            cells, values = _unpack(left.found[0])
            scores.ravel()[cells] = values
        add(scores, zip(right.term, right.hits, strict=True), norm.astype(np.int64), asked[bundle])
        return bundle, scores, ids

    def passed_on(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        _, scores, _ = owned(key, left, right)
        flat = scores.ravel()
        cells = np.flatnonzero(flat)
        return left.assign(found=[_pack(cells.astype(np.uint32), flat[cells])])

    def ranked(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        bundle, scores, ids = owned(key, left, right)
        found = list(best(scores, ids, top))
        out = pd.DataFrame({"item": [i + bundle * BUNDLE for i, _, _ in found]})
        return out.assign(doc_id=pd.array([d for _, d, _ in found], "Int64"), score=[s for _, _, s in found])

    key = ["task", "block", "bundle"]
    for o in range(owners):
        own = dealt.where(F.col("owner") == o).select(*key, "term", "hits")
        step, schema = (ranked, "item int, doc_id long, score long") if o == owners - 1 else (passed_on, state)
        travelling = travelling.groupBy(*key).cogroup(own.groupBy(*key)).applyInPandas(step, schema)
    return travelling


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, owners: int = OWNERS) -> DataFrame:
    """The ``top`` documents of each item by a sum over its terms: ``item_id, rank, doc_id, score``.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``; other columns are ignored. Weights and sums are
    whole numbers; a document without a score above 0 is not in the result,
    equal scores go by ascending doc_id, rows without one last. A null or empty text has no terms: such a
    document is found by no item and such an item finds none. Each row is a document or an item of its own,
    also where rows or ids repeat. Texts may be of any length. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for part in batched(items.select("item_id", "text").toLocalIterator(), PASS):
        found = _search(docs, [list(Counter(terms(r.text))) for r in part], top, owners)
        if found is None:
            continue
        order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(part)], f"item int, item_id {kind}")
        out = out.unionByName(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
