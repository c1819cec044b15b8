"""URL filters: rules by host and path, and a learned verdict for urls without a rule.

Host names are split into words by the most probable segmentation under a unigram model of words seen
apart (in paths and between hyphens); naive Bayes over the words of host and path gives the verdict. Its examples are the
urls that a rule decides. Both models come from counts over all urls and stay whole tables; only their most frequent rows are broadcast, the others are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespan.llm.common import Stage

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Host labels that say how a site is reached, not what it is.
PLAIN = ("www", "m", "blog", "com", "net", "org", "example")
#: Rows of each model that are broadcast, the most frequent ones; the rest takes part by joins.
HEAD = 50_000
#: A host label has no more letters, by the rules for domain names.
LONGEST = 63
#: Weights are whole multiples of 1 / UNIT, so that their sums do not depend on their order.
UNIT = 1 << 32
_PAIR = "host string, path string"


def parts(url: str = "url") -> list:
    """``host`` and ``path`` columns of a url column; both empty without ``://`` or for null."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return [host.alias("host"), path.alias("path")]


def rule_of(rules=RULES):
    """The longest rule that fits ``host`` and ``path``: host equal or a subdomain, path starting alike."""
    best = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, path = rule.split("/", 1)
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        best = F.when(fits & F.col("path").startswith(f"/{path}"), F.lit(rule)).otherwise(best)
    return best


def word_counts(urls: DataFrame, plain=PLAIN) -> DataFrame:
    """``word, n``: counts of the words of all paths and of the parts of hyphenated host labels. A label
    without a hyphen is what has to be split, so it is no evidence for itself.
    Plain labels are in the counts at least once.
    """
    in_names = F.regexp_extract_all("host", F.lit(r"(?:(?<=-)[a-z]+|[a-z]+(?=-))"), 0)
    in_paths = F.regexp_extract_all(F.lower("path"), F.lit(r"[a-z]+"), 0)
    words = urls.select(F.explode(F.concat(in_names, in_paths)).alias("word"), F.lit(1).alias("n"))
    words = words.where((F.length("word") <= LONGEST) & (F.length("word") > 1))
    always = urls.sparkSession.createDataFrame([(w, 0) for w in sorted(plain)], "word string, n int")
    return words.unionByName(always).groupBy("word").agg(F.greatest(F.sum("n"), F.lit(1)).cast("long").alias("n"))


def segmenter(counts: dict[str, int], total: int):
    """The most probable split of a name into words; ``total`` is the sum of all counts, ``more`` are words
    beyond ``counts``. An unknown word costs more than any known one, and more with every letter."""
    cost = {w: math.log(total / n) for w, n in counts.items()}
    unknown = math.log(total) + math.log(10)

    def best_split(name: str, more: dict[str, float]) -> tuple[str, ...]:
        best = [(0.0, 0)]
        for i in range(1, len(name) + 1):
            options = []
            for size in range(1, min(i, LONGEST) + 1):
                word = name[i - size : i]
                c = cost.get(word, more.get(word, unknown + math.log(10) * size))
                options.append((best[i - size][0] + c, size))
            best.append(min(options))
        out, i = [], len(name)
        while i:
            out.append(name[i - best[i][1] : i])
            i -= best[i][1]
        return tuple(out[::-1])

    @lru_cache(maxsize=100_000)
    def from_head(name: str) -> tuple[str, ...]:
        return best_split(name, {})

    def with_more(more):
        if more is None or not len(more):
            return from_head
        costs = {w: math.log(total / int(n)) for w, n in (x.split(" ") for x in more)}
        return lambda name: best_split(name, costs)

    return with_more


def _names(host: str, path: str, plain) -> tuple[list[str], list[str]]:
    """Labels of the host without plain ones, and alphanumeric runs of the path."""
    labels = "".join(c if c.isalnum() else " " for c in host).split()
    return [x for x in labels if x not in plain], "".join(c if c.isalnum() else " " for c in path.lower()).split()


def tokens_of(host: str, path: str, split, plain=PLAIN) -> list[str]:
    """Words of the host labels, marked as such, and the words of the path; numbers are one token."""
    labels, runs = _names(host, path, plain)
    out = [f"h:{w}" for label in labels for w in split(label)]
    for word in runs:
        out += ["p:#"] if word.isdigit() else [f"p:{w}" for w in (split(word) if word.isalpha() else (word,))]
    return out


def _with_rare_words(pairs: DataFrame, rare: DataFrame, head, plain) -> DataFrame:
    """``pairs`` with ``more``: the words of ``rare`` that occur in names to split, as 'word count'."""

    def names(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for host, path in zip(f.host, f.path, strict=True):
                labels, runs = _names(host, path, plain)
                rows += [(host, path, x) for x in {*labels, *(r for r in runs if r.isalpha())}]
            yield pd.DataFrame(rows, columns=["host", "path", "name"], dtype=object)

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = head.value[0]
        for f in frames:
            for name in f.name:
                found = {name[i : i + n] for i in range(len(name) - 1) for n in range(2, min(LONGEST, len(name) - i) + 1)}
                found = [w for w in found if w not in known and w.isascii() and w.isalpha()]
                if found:
                    yield pd.DataFrame({"name": [name] * len(found), "word": found})

    named = pairs.select("host", "path").mapInPandas(names, f"{_PAIR}, name string")
    cut = named.select("name").distinct().mapInPandas(pieces, "name string, word string")
    found = cut.join(rare, "word").groupBy("name").agg(F.collect_list(F.concat_ws(" ", "word", F.col("n").cast("string"))).alias("more"))
    found = named.join(found, "name").groupBy("host", "path").agg(F.array_distinct(F.flatten(F.collect_list("more"))).alias("more"))
    return pairs.join(found, ["host", "path"], "left")


def judge_urls(pages: DataFrame, rules=RULES, plain=PLAIN) -> DataFrame:
    """Rule and verdict per row of ``pages`` (``page_id, url``; other columns are ignored).

    Rules win. Other urls are judged by naive Bayes. It is fitted on all distinct (host, path) pairs that a rule decides,
    each weighted by its urls; a token that no such pair has is no evidence. A null url, or one without ``://``, has empty
    host and path, no rule, and the verdict of the priors, as has every url if no rule fits any; a tie is allowed.
    Repeated rows are judged alike and each counts as an example. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    stage = Stage(spark)
    rows = pages.select("page_id", *parts())
    rows = rows.withColumn("rule", rule_of(rules))
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in r])
    pairs = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.first(verdicts[F.col("rule")]).alias("label"))
    pairs = stage.write(pairs, "pairs")
    words = stage.write(word_counts(rows, plain), "words")
    n_words, total = words.agg(F.count(F.lit(1)), F.sum("n")).first()
    top = words.orderBy(F.col("n").desc(), "word").limit(HEAD).collect()
    model_words = spark.sparkContext.broadcast(({r.word: r.n for r in top}, total))
    if n_words > HEAD:
        rare = words.where((F.col("n") < top[-1].n) | ((F.col("n") == top[-1].n) & (F.col("word") > top[-1].word)))
        pairs = stage.write(_with_rare_words(pairs, rare, model_words, plain), "pairs")
    else:
        pairs = pairs.withColumn("more", F.lit(None).cast("array<string>"))

    def tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split = segmenter(*model_words.value)
        for f in frames:
            rows = [
                (t, n, n * (label == "allow"), n * (label == "block"))
                for host, path, n, label, more in zip(f.host, f.path, f.n, f.label, f.more, strict=True)
                for t in [*tokens_of(host, path, split(more), plain), ""]
            ]
            yield pd.DataFrame(rows, columns=["token", "n", "allow", "block"])

    # urls without a rule add nothing to a class, but their tokens are in the table
    seen = pairs.mapInPandas(tokens, "token string, n long, allow long, block long")
    seen = seen.groupBy("token").agg(F.sum("n").alias("n"), F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    weights, prior, n_tokens = naive_bayes(stage.write(seen, "tokens"))
    top = weights.orderBy(F.col("seen").desc(), "token").limit(HEAD).collect()
    model = spark.sparkContext.broadcast({r.token: r.weight for r in top})

    def judged(score) -> Column:
        by_model = F.when(score + F.lit(prior) > 0, F.lit("block")).otherwise(F.lit("allow"))
        return F.coalesce(verdicts[F.col("rule")], by_model).alias("verdict")

    if max(n_words, n_tokens) <= HEAD:
        # both models fit the broadcast ones: rows are judged where they are read

        @F.pandas_udf("long")
        def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
            split, w = segmenter(*model_words.value)(None), model.value
            ready: dict[str, int] = {}

            def of(host: str, path: str) -> int:
                if host not in ready:
                    if len(ready) > 200_000:
                        ready.clear()
                    ready[host] = sum(w[t] for t in tokens_of(host, "", split, plain))
                return ready[host] + sum(w[t] for t in tokens_of("", path, split, plain))

            return pd.Series([of(h, p) for h, p in zip(hosts, paths, strict=True)], dtype="int64")

        return rows.select("page_id", "host", "path", "rule", judged(score("host", "path")))

    def frequent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, w = segmenter(*model_words.value), model.value
        for f in frames:
            out = []
            for host, path, more in zip(f.host, f.path, f.more, strict=True):
                ts = tokens_of(host, path, split(more), plain)
                out.append((host, path, sum(w.get(t, 0) for t in ts), [t for t in ts if t not in w]))
            yield pd.DataFrame(out, columns=["host", "path", "score", "rare"])

    # a token outside the broadcast head has at most 1 / HEAD of all counts, so none of the joined ones is hot
    scored = stage.write(pairs.select("host", "path", "more").mapInPandas(frequent, f"{_PAIR}, score long, rare array<string>"), "scored")
    more = scored.select("host", "path", F.explode("rare").alias("token")).groupBy("host", "path", "token").agg(F.count(F.lit(1)).alias("times"))
    more = more.join(weights, "token").groupBy("host", "path").agg(F.sum(F.col("weight") * F.col("times")).alias("more"))
    scored = scored.join(more, ["host", "path"], "left").select("host", "path", (F.col("score") + F.coalesce("more", F.lit(0))).alias("score"))
    scored = rows.join(scored, ["host", "path"], "left")
    return scored.select("page_id", "host", "path", "rule", judged(F.col("score")))


def naive_bayes(seen: DataFrame) -> tuple[DataFrame, int, int]:
    """Log odds of block against allow per token, add-one smoothed, 0 for tokens without an example, in units of
    1 / UNIT (``token, seen, weight``); the prior from the count of examples at ''; and the number of tokens."""
    words = seen.where("token != ''")
    both = F.col("allow") + F.col("block")
    n, known, allow, block = words.agg(
        F.count(F.lit(1)), F.count_if(both > 0), F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0))
    ).first()
    odds = F.log((F.col("block") + 1) / float(block + known + 1)) - F.log((F.col("allow") + 1) / float(allow + known + 1))
    weight = F.when(both > 0, F.round(odds * UNIT).cast("long")).otherwise(0)
    weights = words.select("token", F.col("n").alias("seen"), weight.alias("weight"))
    examples = seen.where("token = ''").first()
    a, b = (examples.allow, examples.block) if examples else (0, 0)
    return weights, round((math.log(b + 1) - math.log(a + 1)) * UNIT), n
