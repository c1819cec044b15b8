"""Secret scans: fixed formats, and formats inferred from the credentials they find.

The credentials that the fixed formats label are written as strings of character classes. Per kind a
prefix tree counts them, and states whose outgoing frequencies are compatible by Hoeffding's bound are
merged, from the root outwards, into a probabilistic automaton. Every other long run of credential
characters is then scored by its likelihood under these automata against one learned from ordinary runs.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.llm.common import Stage

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
# a run is matched from its start to its end, so a least length gives the same as dropping shorter runs
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Least length of a run that is scored.
LONG = 16
RUN = re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{LONG},}}")
#: A run of letters that counts as ordinary beside those of the documents.
PLAIN = "ordinaryrunofplainletters"
#: Labelled credentials of a kind, and ordinary runs, that the automata are fitted on at most.
SAMPLE = 600
#: Hoeffding's bound for merging states: a lower value merges more.
ALPHA = 0.05
#: Least log likelihood ratio of a credential against an ordinary run.
LEAST = 14.0
_UNSEEN = math.log(1e-3)
_CLASS = (
    {c: "d" for c in "0123456789"}
    | {c: "a" for c in "abcdef"}
    | {c: "g" for c in "ghijklmnopqrstuvwxyz"}
    | {c: "A" for c in "ABCDEF"}
    | {c: "G" for c in "GHIJKLMNOPQRSTUVWXYZ"}
    | {c: c for c in "+/_.=-"}
)
_TO_CLASS = str.maketrans(_CLASS)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed formats, by start, then kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def open_runs(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Long runs of credential characters, each with its stretches outside ``taken``, if there are any."""
    at, reach = 0, 0
    for m in RUN.finditer(text):
        free, gaps = max(reach, m.start()), []
        while at < len(taken) and taken[at][0] < m.end():
            start, end, _ = taken[at]
            if start > free:
                gaps.append((free, start))
            free, reach = max(free, end), max(reach, end)
            at += 1
        if free < m.end():
            gaps.append((free, m.end()))
        if gaps:
            yield m.start(), m.end(), gaps


class Automaton:
    """A probabilistic automaton from a sample of strings by state merging."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.count, self.final, self.next, self.pass_ = [0], [0], [{}], [{}]
        for s in sorted(strings):
            at = 0
            for symbol in s:
                self.count[at] += 1
                self.pass_[at][symbol] = self.pass_[at].get(symbol, 0) + 1
                if symbol not in self.next[at]:
                    self.next[at][symbol] = len(self.count)
                    for x, new in ((self.count, 0), (self.final, 0), (self.next, {}), (self.pass_, {})):
                        x.append(new)
                at = self.next[at][symbol]
            self.count[at] += 1
            self.final[at] += 1
        self._merge_states()
        self._to_logs()

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.count[a], self.count[b]
            if not n or not m:
                continue
            if self._differ(self.final[a], n, self.final[b], m):
                return False
            for symbol in {*self.pass_[a], *self.pass_[b]}:
                if self._differ(self.pass_[a].get(symbol, 0), n, self.pass_[b].get(symbol, 0), m):
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    x, y = self.next[a][symbol], self.next[b][symbol]
                    # the side of b is a tree, so this ends
                    if x != y:
                        todo.append((x, y))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.final[a] += self.final[b]
            for symbol, n in self.pass_[b].items():
                self.pass_[a][symbol] = self.pass_[a].get(symbol, 0) + n
            for symbol, y in self.next[b].items():
                x = self.next[a].get(symbol)
                if x is None:
                    self.next[a][symbol] = y
                else:
                    todo.append((x, y))

    def _merge_states(self) -> None:
        """Settled states are kept; a state one step off them is folded into the first compatible one."""
        settled = [0]
        while True:
            known = set(settled)
            edge = [(self.next[q][s], q, s) for q in settled for s in self.next[q] if self.next[q][s] not in known]
            if not edge:
                break
            new, q, symbol = min(edge, key=lambda e: (-self.count[e[0]], e[0]))
            for old in settled:
                if self._compatible(old, new):
                    self.next[q][symbol] = old
                    self._fold(old, new)
                    break
            else:
                settled.append(new)
        self.states = settled

    def _to_logs(self) -> None:
        kinds = len(set(_CLASS.values())) + 1
        place = {q: i for i, q in enumerate(self.states)}
        self.table, self.stop = [], []
        for q in self.states:
            total = self.count[q] + 0.1 * kinds
            self.table.append({s: (math.log((n + 0.1) / total), place[self.next[q][s]]) for s, n in self.pass_[q].items()})
            self.stop.append(math.log((self.final[q] + 0.1) / total))

    def log_likelihood(self, classes: str) -> float:
        at, out = 0, 0.0
        for symbol in classes:
            step = self.table[at].get(symbol)
            if step is None:
                out += _UNSEEN
            else:
                out += step[0]
                at = step[1]
        return out + self.stop[at]


def classes_of(value: str) -> str:
    return value.translate(_TO_CLASS)


def _half(value: str) -> int:
    return hashlib.blake2b(value.encode(), digest_size=1).digest()[0] & 1


class Scorer:
    """Log likelihood ratio of a run: the best credential automaton against that of ordinary runs.

    Runs without a label may be credentials all the same. Ordinary runs are therefore learned in two halves, and a
    run is scored by the half it is not in, so that no run counts as ordinary because of itself.
    """

    def __init__(self, credentials: dict[str, list[str]], ordinary: list[str], alpha: float = ALPHA):
        self.kinds = [Automaton([classes_of(s) for s in v], alpha) for _, v in sorted(credentials.items()) if v]
        halves: tuple[list[str], list[str]] = ([], [])
        for s in ordinary:
            halves[1 - _half(s)].append(classes_of(s))
        self.ordinary = [Automaton([classes_of(PLAIN), *h], alpha) for h in halves]

    def score(self, value: str) -> float:
        if not self.kinds:
            return -math.inf
        c = classes_of(value)
        return max(k.log_likelihood(c) for k in self.kinds) - self.ordinary[_half(value)].log_likelihood(c)


def labelled(docs: DataFrame) -> DataFrame:
    """``kind, value`` of every credential the fixed formats find, and as ``ordinary`` the runs outside them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = set()
            for text in f.text:
                if not text:
                    continue
                spans = base_spans(text)
                for start, end, kind in spans:
                    value = text[start:end]
                    out.add((kind, ASSIGN.match(value)[2] if kind == "assign" else value))
                for start, end, gaps in open_runs(text, spans):
                    value = text[start:end]
                    if gaps == [(start, end)]:
                        out.add(("ordinary", value))
            yield pd.DataFrame([x for x in out if len(x[1]) <= 200], columns=["kind", "value"], dtype=object)

    return docs.select("text").mapInPandas(run, "kind string, value string")


def fit(docs: DataFrame, *, sample: int = SAMPLE, alpha: float = ALPHA) -> Scorer:
    """Automata from at most ``sample`` distinct credentials of a kind (those of the lowest hash, up to 200
    characters), whatever the size of ``docs``. Ordinary runs are sampled the same
    way, beside one plain run of letters."""
    stage = Stage(docs.sparkSession)
    found = stage.write(labelled(docs).distinct(), "secrets")
    # only rows with a low hash are ranked: their number is about twice the sample however many there are
    sized = found.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    draw = F.pmod(F.xxhash64("value"), F.lit(1 << 30)) / float(1 << 30)
    low = found.join(sized, "kind").withColumn("draw", draw).where(F.col("draw") * F.col("n") < 2 * sample)
    ranked = low.withColumn("k", F.row_number().over(W.partitionBy("kind").orderBy("draw", "value"))).where(F.col("k") <= sample)
    chosen: dict[str, list[str]] = {}
    for row in ranked.select("kind", "value").collect():
        chosen.setdefault(row.kind, []).append(row.value)
    stage.drop(found)
    return Scorer(chosen, chosen.pop("ordinary", []), alpha)


def all_spans(text: str, scorer: Scorer, least: float = LEAST) -> list[tuple[int, int, str]]:
    """The fixed formats, and as ``format`` every other run that scores like a credential. A run of which fixed
    formats leave something is scored whole, then by its long rests."""
    base, more = base_spans(text), []
    for start, end, gaps in open_runs(text, base):
        if scorer.score(text[start:end]) >= least:
            more.append((start, end, "format"))
        elif gaps != [(start, end)]:
            more += [(a, b, "format") for a, b in gaps if b - a >= LONG and scorer.score(text[a:b]) >= least]
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, scorer: Scorer | None = None, *, least: float = LEAST) -> DataFrame:
    """Secrets of every row of ``docs`` (``doc_id, text``; other columns are ignored).

    ``n_assign, n_access, n_hex``: spans of the fixed formats; ``base_sha256``: their digest; ``spans``:
    these and the ones of kind ``format`` that the automata add. Spans are of the whole match, in code
    points. A null text counts as empty: no spans, the digest of the empty string. Without ``scorer`` the
    automata are fitted on ``docs``. Equal rows have equal results; an empty table has an empty one.
    """
    scorer = scorer or fit(docs)
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc_id, text in zip(f.doc_id.astype("Int64"), f.text, strict=True):
                spans = all_spans(text or "", scorer, least)
                base = [s for s in spans if s[2] != "format"]
                n = [sum(s[2] == k for s in base) for k in KINDS[:3]]
                rows.append((doc_id, *n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, schema)


def redact(docs: DataFrame, scorer: Scorer | None = None, *, least: float = LEAST, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark``; overlapping spans become one mark.
    Null and empty texts stay as they are."""
    scorer = scorer or fit(docs)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        def clean(text: str) -> str:
            out, at = [], 0
            for start, end, _ in all_spans(text, scorer, least):
                if start >= at:
                    out += [text[at:start], mark]
                at = max(at, end)
            return "".join([*out, text[at:]]) if out else text

        return pd.Series([t if t is None else clean(t) for t in texts], dtype=object)

    return docs.withColumn("text", cleaned("text")).select(*docs.columns)
