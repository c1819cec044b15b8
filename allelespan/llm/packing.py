"""Packing token sequences by bounded-space best fit.

Documents are cut into pieces of at most one sequence. Only their lengths are dealt out, by a hash, to
tasks that pack some ten thousand of them each: a piece goes to the open bin with the least room that is
still enough. Open bins stand in stacks by free space, and a bit set of the stacks that are not empty
finds the best one with a shift and a lowest bit. Only ``OPEN`` bins are open at a time; if one more is
needed, the fullest is closed.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from allelespan.llm.common import Stage, id_columns, ids_of

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
OPEN = 1024
#: Pieces that one task packs, about, and those of it that arrive longest first; then the next ones do. Within
#: a wave of not many more pieces than open bins, short pieces come while the bins of the long ones are open.
PIECES, WAVE = 100_000, 2000
#: Id behind each document.
END = 0

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ENDS = re.compile(rb"(?<=[a-z])([.,;:!?]+)(?=[ \n]|$)")
_SPACES = bytes.maketrans(b"\t\r\x0b\x0c", b"    ")


class WordTokens(dict):
    """Numbers of words, and the ids of all words one after the other.

    The tokenizer never joins what white space parts, nor a letter and a mark behind it, and ignores
    case, so the ids of a text are those of its words. It gets the new words of some texts at once. At
    ``limit`` bytes of words or ids the memory starts anew.
    """

    limit = 24 << 20

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.ids = np.zeros(1 << 16, np.uint16 if self.tokenizer.get_vocab_size() < 1 << 16 else np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = self.bytes = 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        self.bytes += len(word)
        return n

    def _learn(self) -> None:
        texts = [w.decode("utf-8", "surrogatepass") for w in self.new]
        done = len(self) - len(self.new)
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.new = []
        while len(self.start) < len(self) + 1:
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        ends = self.size + np.cumsum([len(x) for x in found])
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.size : ends[-1]] = np.fromiter((i for x in found for i in x), self.ids.dtype, ends[-1] - self.size)
        self.start[done + 1 : len(self) + 1] = ends
        self.size = int(ends[-1])

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """The ids of each text."""
        numbers = []
        for text in texts:
            data = text.encode("utf-8", "surrogatepass").translate(_LOWER).translate(_SPACES)
            words = _ENDS.sub(rb" \1", data).split()
            numbers.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        if self.new:
            self._learn()
        out = []
        for n in numbers:
            begin = self.start[n]
            length = self.start[n + 1] - begin
            shift = np.repeat(begin - np.cumsum(length) + length, length)
            out.append(self.ids[shift + np.arange(len(shift))].astype("<u4"))
        if max(self.bytes, self.ids.nbytes) > self.limit:
            self.forget()
        return out


_TOKENS: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One per Python worker."""
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def cut(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of the pieces of every row of ``docs``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = word_tokens(path)
        for frame in frames:
            out = []
            for row, ids in enumerate(tokenizer.encode(t or "" for t in frame.text)):
                ids = np.append(ids, np.array([END], "<u4"))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out.append((row, piece, start, len(part), zlib.crc32(part.tobytes())))
            found = pd.DataFrame(out, columns=["row", "piece", "start", "length", "ids_crc32"])
            found.insert(0, "doc_id", ids_of(frame).take(found.pop("row").to_numpy()))
            yield found

    return docs.select(*id_columns("text")).mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: Iterable[int], capacity: int = CAPACITY, open_bins: int = OPEN) -> Iterator[tuple[int, int]]:
    """``(bin, offset)`` of each length, in order; at most ``open_bins`` bins with room left are open."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    rooms = 0  # bit f is set if a bin with free space f is open
    held = made = 0
    for length in lengths:
        fits = rooms >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = stacks[free].pop()
            if not stacks[free]:
                rooms ^= 1 << free
            held -= 1
        else:
            free, number = capacity, made
            made += 1
        yield number, capacity - free
        left = free - length
        if not left:
            continue
        if held == open_bins:
            fullest = (rooms & -rooms).bit_length() - 1
            if left <= fullest:
                continue
            stacks[fullest].pop()
            if not stacks[fullest]:
                rooms ^= 1 << fullest
            held -= 1
        stacks[left].append(number)
        rooms |= 1 << left
        held += 1


def pack(docs: DataFrame, *, path: str | None = None, capacity: int = CAPACITY, open_bins: int = OPEN, pieces: int = PIECES) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``capacity`` tokens.

    ``docs`` has ``doc_id, text``; other columns are ignored. A document is its ids and the id ``END``; a longer
    one is cut, every piece but its last fills a sequence. Result per piece: ``doc_id, piece, start, length,
    ids_crc32`` (of its ids, little-endian, 32 bits each), ``sequence_id, offset``. The pieces of a sequence
    stand one behind the other from 0 on. A null or empty text is the one id ``END``, rows may repeat and
    share or lack a doc_id, texts may be of any length, an empty table gives an empty result. A
    task that is run again packs alike: pieces come in waves that a hash deals out, the longest first.
    """
    found = Stage(docs.sparkSession).write(cut(docs, path or public_tokenizers.path(VOCABULARY), capacity), "pieces")
    tasks = -(-found.count() // pieces) or 1
    columns = ["doc_id", "no_id", "piece", "start", "length", "ids_crc32"]
    found = found.select(*id_columns(*columns[2:]))
    dealt = found.withColumn("__key", F.xxhash64(*columns, F.monotonically_increasing_id())).repartition(tasks, "__key")
    wave = F.pmod(F.shiftrightunsigned("__key", 20), F.lit(-(-pieces // WAVE)))
    dealt = dealt.sortWithinPartitions(wave, F.desc("length"), "__key").withColumn("__task", F.spark_partition_id())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []

        def lengths() -> Iterator[int]:
            for frame in frames:
                waiting.append(frame)
                yield from frame.length.tolist()

        places = best_fit(lengths(), capacity, open_bins)
        for first in places:
            frame = waiting.pop()
            at = np.array([first, *(next(places) for _ in range(len(frame) - 1))], np.int64)
            out = frame[columns[2:]].copy()
            out.insert(0, "doc_id", ids_of(frame))
            out["sequence_id"], out["offset"] = frame["__task"].to_numpy(np.int64) << 40 | at[:, 0], at[:, 1]
            yield out

    return dealt.drop("__key").mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
