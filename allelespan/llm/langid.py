"""Language identification by a linear-chain conditional random field over words.

Word features (affixes, character n-grams, a lexicon) give each word a weight per language, transitions
between languages are learned with them, and forward-backward gives every word of a text, which may
switch languages, its probabilities. A text is labelled by their sum.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.llm.common import Stage

find_letters = re.compile(r"[^\W\d_]+").findall
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"
#: Documents per language, and stretches per document, that the model is fitted on at most.
SAMPLE_DOCS = 500
STRETCHES = 3
LENGTH = 40
#: Features seen with fewer distinct words of the sample are left out, but for the lexicon.
LEAST = 3
ROUNDS = 30
#: Words that a text is taken to have besides its own when it is told from random letters.
DOUBT = 3
_LONGEST = 40
_BLOCK = 32


def words_of(text: str | None) -> list[str]:
    """Lower-case letter runs, those over 40 letters in consecutive pieces; empty if the text is null or has no letter."""
    words = find_letters(text.lower()) if text else []
    if any(len(w) > _LONGEST for w in words):
        words = [w[i : i + _LONGEST] for w in words for i in range(0, len(w), _LONGEST)]
    return words if any(any(map(str.isalpha, w)) for w in words) else []


def features(word: str) -> list[str]:
    w = word[:_LONGEST]
    out = ["=" + w, *set(w), *[w[i : i + 3] for i in range(len(w) - 2)]]
    for n in range(1, min(4, len(w) + 1)):
        out += ("^" + w[:n], w[-n:] + "$")
    return out


class _Places(dict):
    """Numbers words as they come; ``new`` lists those it had not seen."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n


def _segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of rows, none of them empty."""
    return np.add.reduceat(values, np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0)


class Model:
    """Feature weights and transitions; ``fit`` makes one, ``posteriors`` applies it."""

    limit = 60_000

    def __init__(self, langs: list[str], index: dict[str, int], weights: np.ndarray, transitions: np.ndarray, start: np.ndarray, often: np.ndarray | None = None, usual=(1.0, 0.0)):
        self.langs, self.index, self.weights, self.transitions, self.start = langs, index, weights, transitions, start
        #: Logarithm of how often each feature is in the sample, and its mean over the features of words of the
        #: languages, and of words of their letters at random.
        self.often, self.usual = np.zeros(len(weights), np.float32) if often is None else often, usual
        self.forget()

    def forget(self) -> None:
        """Free the words seen; tasks do so at their end, as workers outlive them."""
        self.place = _Places()
        self.emission = np.zeros((1024, len(self.langs)), np.float32)
        self.strength = np.zeros(1024, np.float32)

    def __getstate__(self):
        return self.langs, self.index, self.weights, self.transitions, self.start, self.often, self.usual

    def __setstate__(self, state):
        self.__init__(*state)

    def rows(self, words: list[str]) -> np.ndarray:
        """Row of each word in ``emission``; new words are added."""
        if len(self.place) > self.limit:
            self.forget()
        out = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        if new := self.place.new:
            get = self.index.get
            flat, lengths, all_of = [], [], []
            for w in new:
                of = features(w)
                found = [i for i in map(get, of) if i is not None]
                flat += found or [0]
                lengths.append(len(found) or 1)
                all_of.append(len(of))
            upto = len(self.place)
            while upto > len(self.emission):
                self.emission = np.concatenate([self.emission, np.zeros_like(self.emission)])
                self.strength = np.concatenate([self.strength, np.zeros_like(self.strength)])
            self.strength[upto - len(new) : upto] = _segment_sums(self.often[flat], np.array(lengths)) / all_of
            self.emission[upto - len(new) : upto] = _segment_sums(self.weights[flat], np.array(lengths)) + self.weights[0]
            self.place.new = []
        return out

    def read(self, docs: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray]:
        """Language probabilities of every word of the given non-empty word lists, and how far each list is from random
        letters: how often its features are in the sample (mean logarithm), on a scale on which words like those of the
        sample have 1 and words of random letters 0. ``DOUBT`` words of the first kind are added, so that a few rare
        names make no text foreign."""
        lengths = np.array([len(d) for d in docs])
        rows = self.rows([w for d in docs for w in d])
        probabilities = forward_backward(self.emission[rows], lengths, self.transitions, self.start)
        likely, random = self.usual
        known = np.ones(len(docs))
        if likely > random:
            mean = (_segment_sums(self.strength[rows].astype(np.float64), lengths) + DOUBT * likely) / (lengths + DOUBT)
            known = (mean - random) / (likely - random)
        return np.split(probabilities, np.cumsum(lengths)[:-1]), known

    def posteriors(self, docs: list[list[str]]) -> list[np.ndarray]:
        return self.read(docs)[0]


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginals of all words of several documents at once; ``scores`` are theirs, one after another.

    Documents are cut into blocks of 32 words. Products of the step matrices of each block are made for
    all blocks together, then messages are passed from block to block, and last inside the blocks, so the
    number of numpy steps does not follow the length of the texts, only the number of their blocks does.
    """
    k = scores.shape[1]
    step = np.exp(transitions - transitions.max())
    per_doc = -(-lengths // _BLOCK)
    blocks, first = int(per_doc.sum()), np.concatenate([[0], np.cumsum(per_doc)[:-1]])
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    doc = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(scores)) - begin[doc]
    block, t_in = first[doc] + at // _BLOCK, at % _BLOCK
    # states and steps first, blocks last: every numpy operation runs along the blocks
    e = np.ones((_BLOCK, k, blocks))
    e[t_in, :, block] = np.exp(scores - scores.max(axis=1, keepdims=True))
    used = np.zeros((_BLOCK, blocks), bool)
    used[t_in, block] = True

    def normal(x):
        return x / x.sum(axis=0)

    # product of (transition, emission) over each block; the first word of a document has no transition
    product = np.repeat(np.eye(k)[:, :, None], blocks, axis=2)  # (from, to, block)
    for t in range(_BLOCK):
        moved = np.einsum("ijb,jl->ilb", product, step, optimize=True)
        if t == 0:
            moved[:, :, first] = product[:, :, first]
        moved *= e[t]
        if t % 8 == 7:
            moved /= moved.max(axis=(0, 1))
        product = moved if used[t].all() else np.where(used[t], moved, product)
    into, out_of = np.empty((k, blocks)), np.empty((k, blocks))
    into[:, first] = normal(np.exp(start - start.max()))[:, None]
    last = first + per_doc - 1
    out_of[:, last] = 1 / k
    for b in range(1, int(per_doc.max())):
        on = first[per_doc > b] + b
        into[:, on] = normal(np.einsum("ib,ijb->jb", into[:, on - 1], product[:, :, on - 1]))
        back = last[per_doc > b] - b
        out_of[:, back] = normal(np.einsum("ijb,jb->ib", product[:, :, back + 1], out_of[:, back + 1]))
    alpha, now = np.empty((_BLOCK, k, blocks)), into
    for t in range(_BLOCK):
        moved = step.T @ now
        if t == 0:
            moved[:, first] = now[:, first]
        now = np.where(used[t], normal(moved * e[t]), now)
        alpha[t] = now
    now = out_of
    for t in range(_BLOCK - 1, -1, -1):
        alpha[t] *= now
        now = np.where(used[t], normal(step @ (e[t] * now)), now)
    out = alpha[t_in, :, block]
    return out / out.sum(axis=1, keepdims=True)


def _learn(sequences: list[tuple[list[str], np.ndarray]], langs: list[str], rounds: int) -> Model:
    """Conditional likelihood of labelled word sequences, all of the same length or shorter, by
    gradient steps scaled per weight."""
    k, n = len(langs), len(sequences)
    length = max(len(w) for w, _ in sequences)
    vocabulary = {w: i for i, w in enumerate(sorted({w for ws, _ in sequences for w in ws}))}
    table = [features(w) for w in vocabulary]
    often = Counter(f for fs in table for f in fs)
    seen = Counter(w for ws, _ in sequences for w in ws)
    names = sorted(f for f, c in often.items() if c >= LEAST or (f[0] == "=" and seen[f[1:]] >= LEAST))
    index = {f: i + 1 for i, f in enumerate(names)}
    flat, sizes = [], []
    for fs in table:
        found = [index[f] for f in fs if f in index] or [0]
        flat += found
        sizes.append(len(found))
    flat, sizes = np.array(flat), np.array(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ids, gold = np.zeros((n, length), np.int64), np.zeros((n, length), np.int64)
    used = np.zeros((n, length), bool)
    for i, (ws, labels) in enumerate(sequences):
        ids[i, : len(ws)] = [vocabulary[w] for w in ws]
        gold[i, : len(ws)] = labels
        used[i, : len(ws)] = True
    one = np.eye(k)[gold] * used[:, :, None]
    weights, transitions, start = np.zeros((len(index) + 1, k)), np.zeros((k, k)), np.zeros(k)
    both = used[:, 1:] & used[:, :-1]
    gold_pairs = np.einsum("nti,ntj->ij", one[:, :-1] * both[:, :, None], one[:, 1:])
    sums = [np.full_like(x, 1e-8) for x in (weights, transitions, start)]
    for _ in range(rounds):
        scores = _segment_sums(weights[flat], sizes) + weights[0]
        e = np.exp(scores - scores.max(axis=1, keepdims=True))[ids]
        e[~used] = 1.0
        step = np.exp(transitions - transitions.max())
        alpha, beta = np.empty((n, length, k)), np.empty((n, length, k))
        a = np.exp(start - start.max()) * e[:, 0]
        alpha[:, 0] = a / a.sum(1, keepdims=True)
        for t in range(1, length):
            a = (alpha[:, t - 1] @ step) * e[:, t]
            alpha[:, t] = np.where(used[:, t, None], a / a.sum(1, keepdims=True), alpha[:, t - 1])
        beta[:, -1] = 1.0
        for t in range(length - 2, -1, -1):
            b = (e[:, t + 1] * beta[:, t + 1]) @ step.T
            beta[:, t] = np.where(used[:, t + 1, None], b / b.sum(1, keepdims=True), beta[:, t + 1])
        p = alpha * beta
        p /= p.sum(2, keepdims=True)
        # sums of the pair marginals, without an array of all pairs at every word
        left, right = alpha[:, :-1][both], (e[:, 1:] * beta[:, 1:])[both]
        pairs = step * ((left / ((left @ step) * right).sum(1, keepdims=True)).T @ right)
        by_word = np.zeros((len(sizes), k))
        np.add.at(by_word, ids[used], (one - p)[used])
        by_feature = np.zeros_like(weights)
        for lang in range(k):
            by_feature[:, lang] = np.bincount(flat, by_word[owner, lang], len(weights))
        by_feature[0] = by_word.sum(0)
        gradients = [by_feature - 0.01 * weights, gold_pairs - pairs - 0.01 * transitions, (one[:, 0] - p[:, 0]).sum(0) - 0.01 * start]
        for x, g, s in zip((weights, transitions, start), gradients, sums, strict=True):
            s += g * g
            x += 0.3 * g / np.sqrt(s)
    return Model(langs, index, weights.astype(np.float32), transitions, start, *_usual(sequences, langs, index))


def _usual(sequences, langs: list[str], index: dict[str, int]) -> tuple[np.ndarray, tuple[float, float]]:
    """Logarithm of one more than the count of each feature in the words of the sample; its mean over the features of
    these words, each without what the word itself adds, and over as many words of random letters of the same language.
    Counts are of words as often as they occur, so junk in the sample, which hardly repeats, weighs little."""
    words = Counter((w, int(g)) for ws, gold in sequences for w, g in zip(ws, gold, strict=True))
    count = np.zeros(len(index) + 1)
    letters: list[set[str]] = [set() for _ in langs]
    places = {}
    for (w, g), n in words.items():
        letters[g].update(w)
        if w not in places:
            of = features(w)
            places[w] = [i for i in map(index.get, of) if i is not None], len(of)
        count[places[w][0]] += n
    random = np.random.default_rng(2)
    alphabet = [sorted(x) for x in letters]
    strength, less = np.log1p(count), np.log1p(np.maximum(count - 1, 0))
    likely = noise = 0.0
    for (w, g), n in words.items():
        found, size = places[w]
        likely += n * less[found].sum() / size
        of = features("".join(random.choice(alphabet[g], len(w))))
        noise += n * sum(strength[i] for i in map(index.get, of) if i is not None) / len(of)
    total = max(1, sum(words.values()))
    return strength.astype(np.float32), (likely / total, noise / total)


def held_out() -> F.Column:
    """Whether crc32 of the id as text leaves no remainder by 5; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, *, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> Model | None:
    """A model from the texts and non-null languages of documents that are not held out.

    At most ``sample_docs`` documents of a language, those of the lowest hash, give up to three stretches
    of 40 words spread over the whole text, so the fit grows with the languages only. Half of the
    training sequences join stretches of two languages in the middle: that is where transitions come from.
    None if there is nothing to learn from.
    """
    stage = Stage(docs.sparkSession)
    rows = docs.select("doc_id", "lang", "text").where("lang is not null and text is not null").where(~held_out())
    draw = F.pmod(F.xxhash64("doc_id", F.md5("text")), F.lit(1 << 30)) / float(1 << 30)
    sized = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    if not sized:
        return None
    share = F.create_map(*[F.lit(x) for r in sized for x in (r.lang, min(1.0, 2 * sample_docs / r.n))])
    low = rows.withColumn("draw", draw).where(F.col("draw") < share[F.col("lang")])

    def stretches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for lang, draw, text in zip(f.lang, f.draw, f.text, strict=True):
                words = words_of(text)
                room = max(1, len(words) // LENGTH)
                starts = {LENGTH * (room * i // STRETCHES) for i in range(STRETCHES)}
                out += [(lang, draw, i, " ".join(words[s : s + LENGTH])) for i, s in enumerate(sorted(starts)) if words]
            yield pd.DataFrame(out, columns=["lang", "draw", "part", "words"])

    low = low.select("lang", "draw", "text").mapInPandas(stretches, "lang string, draw double, part int, words string")
    ranked = low.withColumn("k", F.dense_rank().over(W.partitionBy("lang").orderBy("draw"))).where(F.col("k") <= sample_docs)
    found = stage.write(ranked, "langid")
    chosen = found.orderBy("lang", "draw", "part", "words").collect()
    stage.drop(found)
    langs = sorted({r.lang for r in chosen})
    if not langs:
        return None
    code = {x: i for i, x in enumerate(langs)}
    parts = [(r.words.split(" "), code[r.lang]) for r in chosen]
    random = np.random.default_rng(1)
    order = random.permutation(len(parts))
    sequences = [(w, np.full(len(w), c)) for w, c in parts]
    for i, j in zip(order[::2], order[1::2], strict=False):
        (a, x), (b, y) = parts[i], parts[j]
        a, b = a[: LENGTH // 2], b[-(LENGTH // 2) :]
        sequences.append((a + b, np.array([x] * len(a) + [y] * len(b))))
    return _learn(sequences, langs, rounds)


_BATCH_WORDS = 40_000


def _batches(texts) -> Iterator[tuple[list[int], list[list[str]]]]:
    places, lists, size = [], [], 0
    for i, text in enumerate(texts):
        words = words_of(text)
        if words:
            places.append(i)
            lists.append(words)
            size += len(words)
        if size > _BATCH_WORDS:
            yield places, lists
            places, lists, size = [], [], 0
    if places:
        yield places, lists


def label_words(model: Model, text: str) -> list[tuple[str, str]]:
    """Every word of a text with its language."""
    words = words_of(text)
    return [(w, model.langs[i]) for w, i in zip(words, model.posteriors([words])[0].argmax(1), strict=True)] if words else []


def read_texts(model: Model | None, texts) -> tuple[list[str], list[float], list[float], list[float]]:
    """Leading language, its mean probability, how sure the words are (the mean of each word's largest
    probability, whatever the language), and how much they are like words of any language (``Model.read``)."""
    langs, scores, sure, known = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    if model is not None:
        for places, lists in _batches(texts):
            for i, p, like in zip(places, *model.read(lists), strict=True):
                mean = p.mean(axis=0)
                best = int(mean.argmax())
                langs[i], scores[i] = model.langs[best], float(min(1.0, mean[best]))
                sure[i] = float(p.max(axis=1).mean())
                known[i] = float(like)
    return langs, scores, sure, known


def identify_texts(model: Model | None, texts) -> tuple[list[str], list[float]]:
    return read_texts(model, texts)[:2]


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Language of every row of ``docs`` (``doc_id, text, lang``; other columns are ignored).

    ``lang_pred`` is the language with the largest mean probability over all words and ``score`` that mean;
    ``und`` and 0 if the text is null or has no letter, or if there was nothing to learn from. Only the text
    is an input of a prediction. Without ``model`` one is fitted on ``docs``.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(model or fit(docs))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = known.value
        for f in frames:
            langs, scores = identify_texts(m, list(f.text))
            yield pd.DataFrame({"doc_id": f.doc_id.astype("Int64"), "held_out": f.held_out, "lang_pred": langs, "score": scores})
        if m is not None:
            m.forget()

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInPandas(run, RESULT)


def keep_identified(docs: DataFrame, *, least: float = 0.5, like: float = 0.5, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` whose words are told with a mean certainty of ``least`` or more and are words of the known
    languages rather than random letters (``like`` on the scale of ``Model.read``), with all columns.

    A text that switches between languages is as certain as its words are; its share of the leading language does not
    matter. Where ``lang`` is null it becomes the leading language. Null and empty texts, and those without a letter, go.
    If there was nothing to learn from, all rows with a letter stay as they are. Repeated rows are judged alike, a null
    ``doc_id`` is as good as any, and an empty table gives an empty result.
    """
    known = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    @F.pandas_udf("string")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """Leading language of texts that stay, '' if there is no model; null for those that go."""
        m = known.value
        for texts in batches:
            if m is None:
                yield pd.Series(["" if words_of(t) else None for t in texts], dtype=object)
            else:
                found = zip(*read_texts(m, list(texts)), strict=True)
                yield pd.Series([x if sure >= least and words >= like else None for x, _, sure, words in found], dtype=object)
        if m is not None:
            m.forget()

    # not deterministic to Catalyst, so that the filter does not call it a second time
    out = docs.withColumn("__lang", language.asNondeterministic()("text")).where("__lang is not null")
    return out.withColumn("lang", F.coalesce("lang", F.nullif("__lang", F.lit("")))).select(*docs.columns)
