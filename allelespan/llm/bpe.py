"""Byte-level BPE encoding and decoding by a table over prefixes.

For every prefix of a piece there is exactly one token that ends its encoding. It is the one token that
ends there and forms a valid pair with the last token of the prefix before it, so a left-to-right table
of last tokens encodes in linear time, an append only extends the table, and an edit only redoes the
entries from the edit on until they meet the old ones again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame

RANKS = "byte_bpe_50k.tiktoken"
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_NEVER = 1 << 60


class Vocabulary:
    """Ranks of a byte-level BPE file and what the prefix table needs of them."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.bytes_of = {r: b for b, r in self.ranks.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.left: dict[int, tuple[int, ...]] = {}
        self.right: dict[int, tuple[int, ...]] = {}
        self.ends: dict[bytes, int] = {}
        self.longest = 1
        self._valid: dict[int, bool] = {}
        # by rank, so the halves of a token are known before the token
        for token in sorted(self.bytes_of):
            data = self.bytes_of[token]
            if len(data) == 1:
                self.left[token] = self.right[token] = (token,)
            else:
                halves = self._merged(data, token)
                if len(halves) != 2:
                    continue  # merging never makes this token; only a whole piece can be it
                a, b = halves
                self.pair[a, b] = token
                # the tokens at its left and right border while it grows, the smallest first
                self.left[token] = (*self.left[a], token)
                self.right[token] = (*self.right[b], token)
            self.ends[data] = token
            self.longest = max(self.longest, len(data))

    def _merged(self, data: bytes, below: int) -> list[int]:
        """Plain merging of ``data`` with ranks under ``below``."""
        parts = [self.ranks[data[i : i + 1]] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.pair.get(p, _NEVER), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if best >= below:
                break
            parts[at : at + 2] = [best]
        return parts

    def valid(self, a: int, b: int) -> bool:
        """Whether merging leaves ``a`` and ``b`` next to each other.

        Merges happen by rank. The tokens that touch at the border grow step by step; a merge across the
        border happens if its rank comes before the next step of either side, the left side first on ties.
        """
        known = self._valid.get(a << 32 | b)
        if known is None:
            left, right, i, j, known = self.right[a], self.left[b], 0, 0, True
            while True:
                next_a = left[i + 1] if i + 1 < len(left) else _NEVER
                next_b = right[j + 1] if j + 1 < len(right) else _NEVER
                across = self.pair.get((left[i], right[j]), _NEVER)
                if across < next_a and across <= next_b and across < _NEVER:
                    known = False
                    break
                if next_a == next_b == _NEVER:
                    break
                if next_a <= next_b:
                    i += 1
                else:
                    j += 1
            if len(self._valid) > 1_000_000:
                self._valid.clear()
            self._valid[a << 32 | b] = known
        return known

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> list[int]:
        """Fill ``last`` (last[i]: the last token of data[:i], last[0] = -1) up to ``upto`` or the end."""
        ends, known, valid = self.ends.get, self._valid.get, self.valid
        for i in range(len(last), (len(data) if upto is None else upto) + 1):
            # one size fits; short tokens are the most frequent
            for size in range(1, i + 1):
                token = ends(data[i - size : i])
                if token is None:
                    continue
                before = last[i - size]
                ok = size == i or known(before << 32 | token)
                if ok or (ok is None and valid(before, token)):
                    last.append(token)
                    break
        return last

    def walk_back(self, last: list[int]) -> list[int]:
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= len(self.bytes_of[last[i]])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.walk_back(self.extend(data, [-1]))


class PieceTable:
    """The table of one piece, for appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data = vocabulary, data
        self.last = vocabulary.extend(data, [-1])

    def append(self, more: bytes) -> PieceTable:
        self.data += more
        self.v.extend(self.data, self.last)
        return self

    def replace(self, start: int, end: int, new: bytes) -> PieceTable:
        """Put ``new`` in place of data[start:end]; entries before it stay, and as soon as as many entries as
        the longest token has bytes are as before, so are all that follow."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        same, n = 0, self.v.longest
        while len(self.last) <= len(self.data):
            self.v.extend(self.data, self.last, len(self.last))
            at = len(self.last) - 1
            after_edit = at - start - len(new) >= 1
            same = same + 1 if after_edit and old[at - shift] == self.last[at] else 0
            if same >= n:
                self.last += old[at - shift + 1 :]
                break
        return self

    def ids(self) -> list[int]:
        whole = self.v.ranks.get(self.data)
        return [whole] if whole is not None else self.v.walk_back(self.last)


class Codec:
    """Encodes and decodes texts; remembers the tokens of up to ``limit`` short pieces."""

    limit = 500_000

    def __init__(self, path: str, pattern: str):
        self.v = Vocabulary(path)
        self.split = regex.compile(pattern).findall
        self.cache: dict[str, tuple[int, ...]] = {}
        self.digits = [str(i) for i in range(max(self.v.bytes_of) + 1)]

    def piece(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.v.encode_piece(piece.encode()))
        if len(piece) <= 64:
            if len(self.cache) >= self.limit:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        get, piece = self.cache.get, self.piece
        return list(chain.from_iterable([get(p) or piece(p) for p in self.split(text)]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.bytes_of.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, ids: bool = True) -> DataFrame:
    """``doc_id, ids array<int>`` of every row. A null text counts as empty and has no ids.

    Texts are encoded whole and row by row, so nothing is shuffled. ``path`` names a rank file that every
    executor can read.
    """
    path, pattern = path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern)
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame.doc_id.astype("Int64"), "ids": [c.encode(t or "") for t in frame.text]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, ids array<int>")


def token_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Token counts and digests of the ids and of the bytes decoded from them, a row per row of ``docs``.

    A null or empty text has no tokens and the digests of the empty string. Rows may repeat.
    """
    path, pattern = path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN

    def digest(c: Codec, text: str) -> tuple[int, str, str]:
        ids = c.encode(text)
        line = " ".join(map(c.digits.__getitem__, ids))
        return len(ids), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern)
        for frame in frames:
            rows = [digest(c, t or "") for t in frame.text]
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", frame.doc_id.astype("Int64").to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, RESULT)
