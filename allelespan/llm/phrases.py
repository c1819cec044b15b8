"""Collocations: phrases of two to four words that are more frequent than their parts let expect.

Every word position gives one record, the up to four words that start there within its piece. Map tasks
sort and combine the records of some million words and cut them at range boundaries in prefix order
(language, then word by word). A range sorts the records it gets and reads the counts of all phrases of one
to four words off one walk, since a phrase is a run of records with a common beginning. Runs at the ends of
a range may go on in its neighbours; only these are summed once more.

The counts are then merge-joined: in prefix order every phrase meets the counts of its beginnings and the
phrases that extend it to the right, in suffix order those of its ends and the extensions to the left.
"""

from __future__ import annotations

import pickle
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.llm.common import Stage

LONGEST = 4
LEAST = 30
#: A candidate goes if a longer one has this share, in percent, of its count.
COVERED = 80
TOP = 2000
#: Words that a map task sorts at a time, and records that a range gets, about.
FLUSH = 3_000_000
RANGE = 1_500_000
#: Range boundaries are drawn from so many documents for each range, at every so many words of them.
SAMPLE_DOCS, STRIDE = 32, 256
#: Boundaries keep so many bytes of a word; any string is a valid boundary.
EDGE_BYTES = 64

_BREAK = b"\xff"
_BYTES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r" + b"\t" + bytes(range(65, 91)), _BREAK * 10 + b" " + bytes(range(97, 123)))
_TEXT_BYTES = 6
COUNTED = "lang string, n int, phrase string, f long, edge boolean"


def tokens(text: str) -> list[bytes]:
    """Words of ``text``, A-Z lower-cased; a 0xFF byte stands between two pieces."""
    data = text.encode("utf-8", "surrogatepass").translate(_BYTES)
    return data.replace(_BREAK, b" \xff ").split()


class Words(dict):
    """Numbers by word, in order of first use; the break between pieces is 0."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def grams(ids: np.ndarray) -> list[np.ndarray]:
    """Columns of the words at, and after, each word; 0 from the end of its piece on."""
    at = np.flatnonzero(ids)
    padded = np.concatenate([ids, np.zeros(LONGEST, ids.dtype)])
    out = [ids[at]]
    for k in range(1, LONGEST):
        out.append(np.where(out[-1] == 0, 0, padded[at + k]))
    return out


def _ordered(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the records by their words, and where in it a record differs from the one before."""
    bits = [int(c.max(initial=0)).bit_length() for c in cols]
    keys, room = [np.zeros(len(cols[0]), np.uint64)], 64
    for c, b in zip(cols, bits, strict=True):
        if b > room:
            keys.append(np.zeros(len(c), np.uint64))
            room = 64
        keys[-1] = keys[-1] << np.uint64(b) | c.astype(np.uint64)
        room -= b
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    return order, new


def _split(cols: list[np.ndarray], words: list[bytes], edge: tuple[bytes, ...]) -> int:
    """The first of the ordered records that is not before ``edge``; word numbers are places in ``words`` plus 1."""
    lo, hi = 0, len(cols[0])
    for col, word in zip(cols, edge, strict=False):
        place = bisect_left(words, word)
        start = lo + int(np.searchsorted(col[lo:hi], np.uint32(place + 1)))
        if place == len(words) or words[place] != word:
            return start
        hi = lo + int(np.searchsorted(col[lo:hi], np.uint32(place + 2)))
        lo = start
    return lo


def pack(cols: list[np.ndarray], counts: np.ndarray, words: list[bytes]) -> bytes:
    """A block of records with the words that occur in it."""
    used = np.zeros(len(words) + 1, bool)
    for c in cols:
        used[c] = True
    used[0] = True
    number = np.cumsum(used) - 1
    kind = np.uint16 if number[-1] < 1 << 16 else np.uint32
    own = b" ".join(words[i - 1] for i in np.flatnonzero(used)[1:])
    small = np.uint8 if counts.max() < 1 << 8 else np.int64
    body = (own, [number[c].astype(kind).tobytes() for c in cols], kind, counts.astype(small).tobytes(), small)
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(body, 5))


def unpack(data: bytes) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    own, cols, kind, counts, small = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
    return own.split(b" "), [np.frombuffer(c, kind) for c in cols], np.frombuffer(counts, small).astype(np.int64)


def sorted_blocks(ids: np.ndarray, seen: Words, edges: list[tuple[bytes, ...]]) -> Iterator[tuple[int, bytes]]:
    """``(range, block)`` of the combined records of ``ids``."""
    words = sorted(w for w in seen if w != _BREAK)
    number = np.zeros(len(seen), np.uint32)
    for i, w in enumerate(words):
        number[seen[w]] = i + 1
    cols = grams(number[ids])
    if not len(cols[0]):
        return
    order, new = _ordered(cols)
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(order)))
    first = order[starts]
    cols = [c[first] for c in cols]
    cuts = [0, *(_split(cols, words, e) for e in edges), len(first)]
    for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            yield r, pack([c[a:b] for c in cols], counts[a:b], words)


def range_counts(blocks: list[bytes], least: int) -> tuple[int, list[tuple[int, str, int, bool]]]:
    """The records of a range, and ``(n, phrase, f, edge)`` of its phrases with ``f`` of ``least`` or more.

    The first and the last phrase of each length have ``edge``, whatever their count: they may go on in
    the neighbouring ranges.
    """
    parts = [unpack(b) for b in blocks]
    words = sorted(set().union(*(p[0] for p in parts)))
    number = {w: i + 1 for i, w in enumerate(words)}
    luts = [np.fromiter((0, *map(number.__getitem__, p[0])), np.uint32, len(p[0]) + 1) for p in parts]
    cols = [np.concatenate([lut[p[1][k]] for lut, p in zip(luts, parts, strict=True)]) for k in range(LONGEST)]
    counts = np.concatenate([p[2] for p in parts])
    del parts
    heads, cols[0] = np.unique(cols[0], return_inverse=True)  # few words begin a range: fewer bits to sort by
    order, _ = _ordered(cols)
    cols, counts = [c[order] for c in cols], counts[order]
    cols[0] = heads[cols[0]]
    new = np.zeros(len(order), bool)
    new[0] = True
    out = []
    for k, c in enumerate(cols):
        new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(counts, starts)
        edge = np.zeros(len(starts), bool)
        edge[[0, -1]] = True
        for g in np.flatnonzero((c[starts] > 0) & (edge | (sums >= least))):
            row = starts[g]
            phrase = b" ".join(words[cols[j][row] - 1] for j in range(k + 1)).decode("utf-8", "surrogatepass")
            out.append((k + 1, phrase, int(sums[g]), bool(edge[g])))
    return int(counts.sum()), out


def boundaries(rows: DataFrame, records: int) -> dict[str, list[tuple[bytes, ...]]]:
    """By language, where the ranges begin (but for the first). They only balance the ranges.

    Drawn from ``SAMPLE_DOCS`` documents a range, so what reaches the driver grows with the number of ranges.
    """
    size = rows.agg(F.count("*").alias("docs"), F.sum(F.octet_length("text")).alias("bytes")).first()
    ranges = -(-(size.bytes or 0) // (_TEXT_BYTES * records))
    if ranges < 2:
        return {}
    share = min(1.0, SAMPLE_DOCS * ranges / size.docs)

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for lang, text in zip(frame.lang, frame.text, strict=True):
                words = tokens(text)
                for i in range(zlib.crc32(text.encode("utf-8", "surrogatepass")) % STRIDE, len(words), STRIDE):
                    piece = words[i : i + LONGEST]
                    piece = piece[: piece.index(_BREAK)] if _BREAK in piece else piece
                    if piece:
                        out.append((lang, b" ".join(w[:EDGE_BYTES] for w in piece)))
            yield pd.DataFrame(out, columns=["lang", "at"])

    drawn: dict[str, list[tuple[bytes, ...]]] = {}
    for r in rows.sample(share, seed=7).mapInPandas(draw, "lang string, at binary").collect():
        drawn.setdefault(r.lang, []).append(tuple(bytes(r["at"]).split(b" ")))
    total = sum(map(len, drawn.values()))
    out = {}
    for lang, found in drawn.items():
        found.sort()
        n = max(1, round(ranges * len(found) / total))
        out[lang] = sorted({found[len(found) * i // n] for i in range(1, n)})
    return out


def phrase_counts(docs: DataFrame, *, least: int = LEAST, records: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """``lang, n, phrase, f`` of all phrases of one to four words that occur ``least`` times or more in
    their language, and ``lang, n`` with the word occurrences of each language that has any.

    ``docs`` has ``text, lang``; a null language is ``und``, a null text is empty.
    """
    stage = Stage(docs.sparkSession)
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    edges = boundaries(rows, records)

    def streams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[Words, list[np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pd.DataFrame]:
            for lang in sorted(held):
                seen, parts = held.pop(lang)
                for r, block in sorted_blocks(np.concatenate(parts), seen, edges.get(lang, [])):
                    yield pd.DataFrame([(lang, r, block)], columns=["lang", "range", "block"])

        for frame in frames:
            for lang, text in zip(frame.lang, frame.text, strict=True):
                if lang not in held:
                    held[lang] = Words({_BREAK: 0}), []
                found = tokens(text)
                found.append(_BREAK)
                held[lang][1].append(np.fromiter(map(held[lang][0].__getitem__, found), np.uint32, len(found)))
                size += len(found)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    def count(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        size, found = range_counts(list(frame.block), least)
        out = pd.DataFrame([(0, "", size, True), *found], columns=["n", "phrase", "f", "edge"])
        out.insert(0, "lang", key[0])
        return out

    blocks = rows.mapInPandas(streams, "lang string, range int, block binary")
    counted = stage.write(blocks.groupBy("lang", "range").applyInPandas(count, COUNTED), "phrases")
    summed = counted.where("edge").groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
    inner = counted.where("NOT edge").select("lang", "n", "phrase", "f")
    return inner.unionByName(summed.where((F.col("n") > 0) & (F.col("f") >= least))), summed.where("n = 0").select("lang", F.col("f").alias("n"))


def score(a: Column, left: Column, right: Column) -> Column:
    """``floor(2000000 * a / (left + right))``, exact for counts of up to 63 bits."""
    return F.call_function("div", F.lit(2_000_000).cast("decimal(8,0)") * _wide(a), _wide(left) + _wide(right))


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, *, least: int = LEAST, covered: int = COVERED, top: int = TOP, records: int = RANGE) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line ends into pieces, these at blanks and tabs
    into words. A candidate is a phrase of 2 to 4 words with ``a`` occurrences, ``least`` or more; of its cuts
    into two parts with ``l`` and ``r`` occurrences the one of lowest score counts, the first of equal ones.
    A candidate goes if a longer candidate around it has ``covered`` percent of its count. Ordered by score,
    count, both descending, and phrase. A null language is ``und``, a null or empty text has no words,
    repeated rows count as often as they occur, other columns are ignored. An empty table, or one
    without candidates, gives an empty result. Words may be of any length.
    """
    counts, totals = phrase_counts(docs, least=least, records=records)
    counts = Stage(docs.sparkSession).write(counts, "counts")
    cuts = counts.where("n > 1").withColumnRenamed("f", "a").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    cuts = cuts.withColumn("head", F.call_function("substring_index", "phrase", F.lit(" "), F.col("k")))
    cuts = cuts.withColumn("tail", F.expr("substring(phrase, char_length(head) + 2)"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    met = cuts.join(heads.hint("merge"), ["lang", "head"]).join(tails.hint("merge"), ["lang", "tail"])
    best = F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "a", "l", "r")).alias("c")
    scored = met.groupBy("lang", "phrase").agg(best).select("lang", "phrase", "c.score", "c.a", "c.l", "c.r")
    # a longer phrase is nowhere more frequent than the one-word extension that it contains
    longer = cuts.where("n > 2")
    right = longer.where(F.col("k") == F.col("n") - 1).select("lang", F.col("head").alias("phrase"), "a")
    left = longer.where("k = 1").select("lang", F.col("tail").alias("phrase"), "a")
    extended = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(extended.hint("merge"), ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_wide(F.col("longer")) * F.lit(100) < _wide(F.col("a")) * F.lit(covered))
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
