"""Removal of repeated byte strings by suffix sorting, bucket by bucket.

Strings of ``WIDTH`` bytes are what counts, so a suffix is sorted by that many bytes. Every string belongs to
the bucket of its smallest 8-byte piece (by a scramble of its value), wherever it occurs, and consecutive
strings with the same smallest piece travel as one stretch of text: a bucket gets all it has to sort as
text, at about three bytes per byte of the corpus, and buckets are sorted one at a time, each in bounded
memory. Within a bucket equal stretches are one class; suffixes of the classes that can have a string in
common are sorted by their first bytes, and long ties are settled by ranks of a difference-cover sample:
two positions have a common offset below the period at which both are in the sample.

A piece that is frequent in ever other surroundings would gather a bucket that grows with the corpus. So pieces
are counted first, by a hash, over all texts or a sample of them, and the order of pieces begins with all that
are too rare to fill a bucket; the others follow by powers of two of their count. A string with a rare piece
goes by one, any other by one of its rarest, which depends on the string alone, so that equal strings still meet.
One count is enough, whatever the size: no order is tried out. What stays together are strings made of frequent
pieces only.

What a task sends is cut by bucket, so pieces of it are as many as tasks times buckets: both are kept few by
gathering much text before it is cut, and verdicts are gathered by groups of documents larger than buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespan.llm.common import mix64

WIDTH = 50
#: Text of one bucket and of one group of documents, in bytes, on average.
BUCKET, GROUP = 4 << 20, 32 << 20
#: Bytes of stretches that a piece may gather before it comes later in the order of pieces.
HEAVY = 2 * BUCKET
#: Text that pieces are counted in, at most, and text for each counter and each task of the count. It only balances the buckets.
SAMPLE, COUNTED, COUNT_TASK = 256 << 20, 64, 16 << 20
#: Letters of a text that are in the sample or not as a whole.
SLICE = 1 << 16
#: Text that a task gathers before it writes to the buckets, and works on at once.
FLUSH, CHUNK = 16 << 20, 1 << 17
_PIECE = 8
#: The longest stretch around one place of a piece.
_AROUND = 2 * WIDTH - _PIECE
_TOP = np.uint64(2**64 - 1)
_R = np.uint64(0x9E3779B97F4A7C15)
_PERIOD = 31


def eights(x: np.ndarray) -> np.ndarray:
    """The big-endian number of the eight bytes from each position; shorter by seven."""
    v = x.astype(np.uint64)
    for step in (1, 2, 4):
        v = (v[:-step] << np.uint64(8 * step)) | v[step:]
    return v


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        v, size = np.minimum(v[:-size], v[size:]), size * 2
    return np.minimum(v[: len(v) - (width - size)], v[width - size :])


def place_of(piece: np.ndarray, last: np.ndarray | None) -> np.ndarray:
    """Places of pieces in the order of pieces: by the class (under 31) of their counter in ``last``, then scrambled."""
    place = mix64(piece) >> np.uint64(5)
    if last is not None:
        n = len(last)
        counter = place & np.uint64(n - 1) if n & (n - 1) == 0 else place % np.uint64(n)
        place |= last[counter.view(np.int64)].astype(np.uint64) << np.uint64(59)
    return place


def stretches(x: np.ndarray, begins: np.ndarray, lengths: np.ndarray, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, strings, place of the smallest piece) of the stretches of texts that lie one after another in ``x``.

    All texts have ``WIDTH`` bytes at least. A stretch ends with its text.
    """
    least = sliding_min(place_of(eights(x), last), WIDTH - _PIECE + 1)
    # strings that start in the last WIDTH - 1 bytes of a text would cross its end
    ends = begins + lengths
    edge = np.zeros(len(x) + 1, np.int32)
    np.add.at(edge, ends - WIDTH + 1, 1)
    np.add.at(edge, ends, -1)
    valid = (np.cumsum(edge)[: len(least)] == 0)
    first = np.ones(len(least), bool)
    first[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
    first[begins[begins < len(first)]] = True
    first &= valid
    start = np.flatnonzero(first)
    total = np.cumsum(valid)
    upto = np.append(start[1:], len(least))
    strings = total[upto - 1] - total[start] + 1
    return start, strings, least[start]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``_R`` and of its inverse."""
    factors = np.ones((2, n), np.uint64)
    factors[0, 1:], factors[1, 1:] = _R, np.uint64(pow(int(_R), -1, 2**64))
    return tuple(np.multiply.accumulate(factors, axis=1))


def content_hashes(x: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of ``x``: sums of scrambled pieces times powers, from running sums."""
    power, inverse = _powers(1 << len(x).bit_length())
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(eights(x)) * power[: len(x) - 7], dtype=np.uint64)])
    return mix64((run[start + size - 7] - run[start]) * inverse[start] + size.astype(np.uint64))


def difference_cover(period: int) -> np.ndarray:
    """A set of residues whose differences give every number below ``period``, grown greedily."""
    cover, missing = [0], set(range(1, period))
    while missing:
        gain = {c: len({(c - d) % period for d in cover} & missing | {(d - c) % period for d in cover} & missing) for c in range(period) if c not in cover}
        best = max(gain, key=lambda c: (gain[c], -c))
        missing -= {(best - d) % period for d in cover} | {(d - best) % period for d in cover}
        cover.append(best)
    return np.array(sorted(cover))


def common_offsets(cover: np.ndarray, period: int) -> np.ndarray:
    """The least offset that takes positions of residues i and j into the cover, by (i, j)."""
    inside = np.zeros(period, bool)
    inside[cover] = True
    i = np.arange(period)
    both = inside[(i[:, None, None] + i) % period] & inside[(i[None, :, None] + i) % period]
    return both.argmax(axis=2)


_COVER = difference_cover(_PERIOD)
_OFFSETS = common_offsets(_COVER, _PERIOD)


def _regroup(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (group, key), and the number of each new group in that order."""
    order = np.argsort(key)
    if len(group) and group.min() < group.max():
        order = order[np.argsort(group[order], kind="stable")]
    g, k = group[order], key[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
    return order, np.cumsum(new) - 1


def cover_ranks(v: np.ndarray) -> np.ndarray:
    """Ranks of the texts of twice the period from each sampled position (other positions are 0).

    ``v`` has the eight bytes from each position, padded. A text of one period is ranked by its bytes; two
    of them by the pair of ranks, as a sampled position stays sampled one period on.
    """
    n = len(v) - 4 * _PERIOD
    p = (np.arange(0, n, _PERIOD)[:, None] + _COVER).ravel()
    p = p[p < n]
    rank = np.zeros(len(v), np.int64)
    at, group = p, np.zeros(len(p), np.int64)
    for step in (0, 8, 16, 23):  # the last one overlaps: 31 bytes
        order, group = _regroup(group, v[at + step])
        at = at[order]
    rank[at] = group + 1
    order, group = _regroup(rank[p], rank[p + _PERIOD])
    out = np.zeros(len(v), np.int64)
    out[p[order]] = group + 1
    return out


def sort_bucket(x: np.ndarray, at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``at`` of ``x`` that share their string of ``WIDTH`` bytes with another owner, in the order
    of their suffixes, and a number per string."""
    v = eights(np.concatenate([x, np.zeros(8 * _PERIOD, np.uint8)]))
    group = np.zeros(len(at), np.int64)

    def prune(at, owner, group):
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        if not len(starts):
            return at, owner, group
        several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
        on = np.repeat(several, np.diff(np.append(starts, len(group))))
        return at[on], owner[on], group[on]

    for step in (0, 8, 16, 24):
        order, group = _regroup(group, v[at + step])
        at, owner, group = prune(at[order], owner[order], group)
        if not len(at):
            return at, group
    # ties of 32 bytes: three-way partitions around a pivot, compared by sample ranks at the common offset
    rank = cover_ranks(v)
    active = np.arange(len(at))
    place = np.arange(len(at))
    while len(active):
        g = group[active]
        starts = np.flatnonzero(np.diff(g, prepend=-1))
        sizes = np.diff(np.append(starts, len(g)))
        pivot = np.repeat(at[active][starts + sizes // 2], sizes)
        here = at[active]
        offset = _OFFSETS[here % _PERIOD, pivot % _PERIOD]
        side = np.sign(rank[here + offset] - rank[pivot + offset])
        order = np.lexsort((side, g))
        at[active], owner[active] = here[order], owner[active][order]
        g, side = g[order], side[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (side[1:] != side[:-1])
        # a group is named by the place of its first member, which keeps names in order
        group[active] = place[active][np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))]
        active = active[side != 0]
    # neighbours in suffix order that agree in the rest of the string are the same string
    same = np.ones(len(at), bool)
    for step in (0, 8, 16, 24, 32, 40, WIDTH - 8):
        same[1:] &= v[at[1:] + step] == v[at[:-1] + step]
    same[:1] = False
    return at, np.cumsum(~same) - 1


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value."""
    head = np.array([len(arrays), *[x for a in arrays for x in (len(a), ord(a.dtype.char))]], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8).reshape(n, 2)
    out, at = [], 8 + 16 * n
    for size, code in head:
        kind = np.dtype(chr(code))
        out.append(np.frombuffer(raw, kind, size, at))
        at += size * kind.itemsize
    return out


def _gather(x: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``x`` one after another."""
    if not len(start):
        return x[:0]
    begin = np.cumsum(size) - size
    return x[np.repeat(start - begin, size) + np.arange(int(size.sum()))]


def _group_of(doc: np.ndarray, mark: np.ndarray, groups: int) -> np.ndarray:
    """Group of documents that a row's verdict is made in."""
    return (mix64(doc.view(np.uint64) ^ mix64(mark.astype(np.uint64))) % np.uint64(groups)).astype(np.int64)


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of ``WIDTH`` bytes at least in chunks, long ones in parts whose strings do not overlap: (bytes,
    begins, lengths, number of the text, start in the text)."""
    parts = [(i, s) for i, t in enumerate(texts) for s in range(0, len(t) - WIDTH + 1, CHUNK)]
    k = 0
    while k < len(parts):
        some, size, first = [], 0, k
        while k < len(parts) and (size < CHUNK or k == first):
            i, s = parts[k]
            some.append(texts[i][s : s + CHUNK + WIDTH - 1])
            size += len(some[-1])
            k += 1
        lengths = np.array([len(t) for t in some])
        numbers, starts = np.array(parts[first:k]).T
        yield np.frombuffer(b"".join(some), np.uint8), np.cumsum(lengths) - lengths, lengths, numbers, starts


def _count_pieces(texts: list[bytes], counts: np.ndarray) -> None:
    """Add the pieces of the texts to the counts by counter."""
    for x, *_ in _chunks([t for t in texts if len(t) >= WIDTH]):
        np.add.at(counts, (place_of(eights(x), None) % np.uint64(len(counts))).view(np.int64), 1)


def _to_buckets(rows: list[tuple[int, int, bytes]], buckets: int, last: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
    """Stretches of the given (doc_id, mark, text) by bucket. Of equal stretches only those of the smallest
    document travel as text; for the others it is settled here that they go, and only their place travels."""
    rows = sorted((r for r in rows if len(r[2]) >= WIDTH), key=lambda r: r[:2])
    if not rows:
        return
    doc, mark = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.uint32)
    found, texts, base = [], [], 0
    for x, begins, lengths, numbers, starts in _chunks([r[2] for r in rows]):
        start, strings, least = stretches(x, begins, lengths, last)
        part = np.searchsorted(begins, start, "right") - 1
        found.append((numbers[part], starts[part] + start - begins[part], strings, least, content_hashes(x, start, strings + WIDTH - 1), start + base))
        texts.append(x)
        base += len(x)
    x = np.concatenate(texts)
    owner, offset, strings, least, content, start = (np.concatenate(c) for c in zip(*found, strict=True))
    del found, texts
    _, first_of, of = np.unique(content, return_index=True, return_inverse=True)
    travels = doc[owner] == doc[owner[first_of[of]]]
    del content, first_of, of
    bucket = (mix64(least ^ _R) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for mine in np.split(order, cuts[1:]):
        text = mine[travels[mine]]
        used, at = np.unique(owner[mine], return_inverse=True)
        blob = pack(
            doc[used], mark[used], at.astype(np.int32), offset[mine], strings[mine].astype(np.int32), travels[mine],
            _gather(x, start[text], strings[text] + WIDTH - 1),
        )
        yield int(bucket[mine[0]]), blob


def _contested(x: np.ndarray, begin: np.ndarray, size: np.ndarray, last: np.ndarray | None = None) -> np.ndarray:
    """Which of the different stretches may have a string in common with another one.

    A common string holds the smallest piece, and either the 24 bytes from its start on or the 24 bytes up
    to its end lie inside the string: one of these must be shared.
    """
    keys, owners = [], []
    n, k = len(begin), 0
    while k < n:
        upto = max(k + 1, int(np.searchsorted(begin, begin[k] + CHUNK)))
        b = begin[k:upto] - begin[k]
        s = size[k:upto]
        part = x[begin[k] : begin[k] + int(b[-1] + s[-1])]
        v = eights(part)
        h = place_of(v, last)
        owner = np.repeat(np.arange(upto - k), s)[: len(h)]
        at = np.arange(len(h)) - b[owner]
        h[at + _PIECE > s[owner]] = _TOP
        least = np.minimum.reduceat(h, b)
        p = np.flatnonzero(h == least[owner])
        o = owner[p]
        right, left = p[at[p] + 24 <= s[o]], p[at[p] >= 16]
        for q, step, salt in ((right, 8, 1), (left, -8, 2)):
            keys.append(mix64(mix64(mix64(v[q] + np.uint64(salt)) ^ v[q + step]) ^ v[q + 2 * step]))
            owners.append(owner[q] + k)
        k = upto
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key)  # owners in any order: a run with several has different neighbours
    key, owner = key[order], owner[order]
    again = np.zeros(len(key), bool)
    again[1:] = (key[1:] == key[:-1]) & (owner[1:] != owner[:-1])
    out = np.zeros(n, bool)
    # all members of a run of equal keys with several owners
    runs = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
    several = np.zeros(runs[-1] + 1 if len(runs) else 0, bool)
    several[runs[again]] = True
    out[owner[several[runs]]] = True
    return out


def settle_bucket(blobs: list[bytes], last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, mark, start, strings): runs of strings of a bucket that a smaller document has as well."""
    parts = [unpack(b) for b in blobs]
    doc = np.concatenate([p[0][p[2]] for p in parts])
    mark = np.concatenate([p[1][p[2]] for p in parts])
    start, strings, travels = (np.concatenate([p[i] for p in parts]) for i in (3, 4, 5))
    x = np.concatenate([p[6] for p in parts])
    gone = ~travels
    text = np.flatnonzero(travels)
    size = strings[text].astype(np.int64) + WIDTH - 1
    begin = np.cumsum(size) - size
    content, k = np.empty(len(text), np.uint64), 0
    while k < len(text):
        upto = max(k + 1, int(np.searchsorted(begin, begin[k] + CHUNK)))
        piece = x[begin[k] : begin[upto - 1] + size[upto - 1]]
        content[k:upto] = content_hashes(piece, begin[k:upto] - begin[k], size[k:upto])
        k = upto
    order = np.lexsort((doc[text], content))
    new = np.ones(len(order), bool)
    new[1:] = content[order][1:] != content[order][:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    class_of = np.empty(len(order), np.int64)
    class_of[order] = first  # the member of the smallest document stands for the class
    lowest = doc[text[class_of]]
    gone[text] = doc[text] > lowest
    out = [(doc[gone], mark[gone], start[gone], strings[gone].astype(np.int64))]
    heads = np.unique(class_of)
    if len(heads) > 1:
        heads = heads[_contested_of(x, begin, size, heads, last)]
    if len(heads) > 1:
        y = _gather(x, begin[heads], size[heads])
        count = size[heads] - WIDTH + 1
        base = np.cumsum(size[heads]) - size[heads]
        owner = np.repeat(np.arange(len(heads)), count)
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + base[owner]
        ranked, string = sort_bucket(y, at, owner)
        if len(ranked):
            owner = np.searchsorted(base, ranked, "right") - 1
            owned = doc[text[heads[owner]]]
            least = np.minimum.reduceat(owned, np.flatnonzero(np.diff(string, prepend=-1)))
            hit = least[string] < owned
            p = np.sort(ranked[hit])
            if len(p):
                o = np.searchsorted(base, p, "right") - 1
                opens = np.ones(len(p), bool)
                opens[1:] = (p[1:] != p[:-1] + 1) | (o[1:] != o[:-1])
                s = np.flatnonzero(opens)
                run, head, offset = np.diff(np.append(s, len(p))), heads[o[s]], p[s] - base[o[s]]
                # every member of the class in its smallest document
                members = np.flatnonzero(doc[text] == lowest)
                members = members[np.argsort(class_of[members], kind="stable")]
                low = np.searchsorted(class_of[members], head, "left")
                many = np.searchsorted(class_of[members], head, "right") - low
                pick = members[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
                t = text[pick]
                out.append((doc[t], mark[t], start[t] + np.repeat(offset, many), np.repeat(run, many)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _contested_of(x: np.ndarray, begin: np.ndarray, size: np.ndarray, heads: np.ndarray, last: np.ndarray | None) -> np.ndarray:
    y = _gather(x, begin[heads], size[heads])
    s = size[heads]
    return _contested(y, np.cumsum(s) - s, s, last)


def _verdicts(texts: list[bytes], replies: list[bytes]) -> Iterator[tuple]:
    """(doc_id or None, text, removed mask) of the documents of a group."""
    runs = [np.concatenate(c) for c in zip(*[unpack(b) for b in replies], strict=True)] if replies else [np.zeros(0, np.int64)] * 4
    doc, mark, start, strings = runs
    order = np.lexsort((mark, doc))
    doc, mark, start, strings = doc[order], mark[order], start[order], strings[order]
    for blob in texts:
        known, ids, marks, lengths, x = unpack(blob)
        at = 0
        for has, i, m, n in zip(known, ids, marks, lengths, strict=True):
            edge = np.zeros(n + 1, np.int32)
            if has:
                a, b = np.searchsorted(doc, i, "left"), np.searchsorted(doc, i, "right")
                if a < b:
                    mine = slice(a + np.searchsorted(mark[a:b], m, "left"), a + np.searchsorted(mark[a:b], m, "right"))
                    np.add.at(edge, start[mine], 1)
                    np.add.at(edge, start[mine] + strings[mine] + WIDTH - 1, -1)
            yield int(i) if has else None, x[at : at + n], np.cumsum(edge[:n]) > 0
            at += n


def _sample(rows: DataFrame, rate: int) -> DataFrame:
    """``text``: of each ``rate`` slices of texts about one, by a hash of doc_id and place."""
    n = F.greatest(F.ceil(F.length("text") / F.lit(SLICE)), F.lit(1)).cast("int")
    taken = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.pmod(F.xxhash64("doc_id", i), F.lit(rate)) == 0)
    return rows.select(F.explode(F.transform(taken, lambda i: F.substring("text", i * SLICE + 1, F.lit(SLICE)))).alias("text"))


def heavy_counters(rows: DataFrame, total: int, counters: int, heavy: int) -> np.ndarray | None:
    """Classes of pieces by counter, None if all are 0: in class 0 no piece can gather more than ``heavy`` bytes of
    stretches, those of class k are up to 2 ** k times as frequent.

    Texts beyond ``SAMPLE`` bytes are counted by a sample of that size. What comes to the driver are the counters of
    frequent pieces, at most 92 times all bytes by ``heavy`` of them.
    """
    # no string is in two stretches, so none of them can be heavy in a small table
    if total * WIDTH <= heavy:
        return None
    rate = -(-total // SAMPLE)
    some = rows.filter("doc_id IS NOT NULL")
    some = some.select("text") if rate == 1 else _sample(some, rate)
    tasks = -(-total // rate // COUNT_TASK)
    limit = max(1, heavy // _AROUND // rate)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(counters, np.int64)
        for f in frames:
            _count_pieces([(t or "").encode() for t in f.text], counts)
        # a counter over the limit has its share of it in some task; what is left out of it is an eighth at most
        found = np.flatnonzero(counts > limit // (8 * tasks))
        yield pd.DataFrame({"counter": found, "n": counts[found]})

    sums = some.repartition(tasks).mapInPandas(count, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    found = sums.filter(F.col("n") > limit).toPandas()
    if not len(found):
        return None
    last = np.zeros(counters, np.uint8)
    last[found.counter] = np.minimum(np.ceil(np.log2(found.n / limit)), 30)
    return last


def _removal(docs: DataFrame, finish, schema: str, heavy: int) -> DataFrame:
    rows = docs.select("doc_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, groups = max(64, total // BUCKET), max(64, total // GROUP)
    last = heavy_counters(rows, total, 1 << (min(total, SAMPLE) // COUNTED).bit_length(), heavy)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[list[tuple[int | None, int, bytes]]]:
        held, size = [], 0
        for f in frames:
            for doc_id, text in zip(f.doc_id.astype("Int64"), f.text, strict=True):
                data = (text or "").encode()
                held.append((None if doc_id is pd.NA else int(doc_id), xxhash.xxh32_intdigest(data), data))
                size += len(data)
                if size >= FLUSH or len(held) >= 100_000:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def scatter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in read(frames):
            out = list(_to_buckets([r for r in held if r[0] is not None], parts, last))
            if out:
                yield pd.DataFrame(out, columns=["bucket", "blob"])

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        doc, mark, start, strings = settle_bucket(list(frame.blob), last)
        group = _group_of(doc, mark, groups)
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
        out = [(int(group[i[0]]), False, pack(doc[i], mark[i], start[i], strings[i])) for i in np.split(order, cuts[1:]) if len(i)]
        return pd.DataFrame(out, columns=["part", "is_text", "blob"])

    def texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in read(frames):
            known = np.array([r[0] is not None for r in held])
            ids = np.array([r[0] or 0 for r in held], np.int64)
            marks = np.array([r[1] for r in held], np.uint32)
            group = _group_of(ids, marks, groups)
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
            out = []
            for i in np.split(order, cuts[1:]):
                x = np.frombuffer(b"".join(held[k][2] for k in i), np.uint8)
                out.append((int(group[i[0]]), True, pack(known[i], ids[i], marks[i], np.array([len(held[k][2]) for k in i], np.int64), x)))
            yield pd.DataFrame(out, columns=["part", "is_text", "blob"])

    def apply(frame: pd.DataFrame) -> pd.DataFrame:
        given = list(frame.blob[frame.is_text])
        return finish(_verdicts(given, list(frame.blob[~frame.is_text])))

    replies = rows.mapInPandas(scatter, "bucket long, blob binary").groupBy("bucket").applyInPandas(settle, "part long, is_text boolean, blob binary")
    return rows.mapInPandas(texts, "part long, is_text boolean, blob binary").unionByName(replies).groupBy("part").applyInPandas(apply, schema)


def _spans(gone: np.ndarray) -> np.ndarray:
    edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
    return edge.reshape(-1, 2)


def remove_repeats(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``doc_id, kept binary, spans array<struct<start, end>>`` of every row of ``docs`` (``doc_id, text``).

    A byte goes if a string of 50 bytes around it also starts in a document with a smaller doc_id. Strings
    are those of the whole input texts as UTF-8 and lie within one document. A null text counts as empty,
    texts under 50 bytes stay whole. Rows without a doc_id lose nothing and make no other row lose
    anything; rows that share a doc_id lose nothing to each other. Equal rows have equal results, an empty table
    has an empty one. Pieces that could have over ``heavy`` bytes of stretches come later in the order; the result does not depend on it.
    """

    def finish(rows) -> pd.DataFrame:
        out = [(i, x[~gone].tobytes(), [{"start": int(a), "end": int(b)} for a, b in _spans(gone)]) for i, x, gone in rows]
        return pd.DataFrame(out, columns=["doc_id", "kept", "spans"]).astype({"doc_id": "Int64"})

    return _removal(docs, finish, "doc_id long, kept binary, spans array<struct<start: long, end: long>>", heavy)


def removal_digests(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``remove_repeats`` by its sizes and the digest of what is kept."""

    def finish(rows) -> pd.DataFrame:
        out = [(i, len(x), int(gone.sum()), len(_spans(gone)), sha256(x[~gone].tobytes()).hexdigest()) for i, x, gone in rows]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return _removal(docs, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", heavy)
