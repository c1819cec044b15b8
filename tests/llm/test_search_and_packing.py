"""Phrases, ranked search and packing against brute force, with nulls, ties, repeated rows and very long texts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from allelespan.llm import packing, phrases, ranking

SCHEMA = "doc_id long, text string, lang string, item_id string, phrase string, block int"
RNG = random.Random(11)


def prose(n, words="a b c d the The of x1 éa É ñ"):
    return "".join(RNG.choice(words.split()) + RNG.choice([" "] * 12 + [", ", ".", "\n", "\t", "  ", "!", "\x0b", "\x01", "\x1d"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Null, empty, very long and repeated texts; null ids and languages; clashing columns."""
    texts = [None, "", " .\n", "the of " * 40, "w" * 20000 + " the of", prose(6000)] + [prose(RNG.randint(1, 200)) for _ in range(60)]
    out = [(i * 3, t, RNG.choice(["en", "en", "de", None]), "k", "p", 7) for i, t in enumerate(texts)]
    return [*out, out[3], out[3], (None, texts[5], "en", None, "p", 7), (None, "the of", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def counted(rows):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(w)
            f[lang or "und"].update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    return f, n


def best_phrases(rows, least, top):
    f, n = counted(rows)
    out = set()
    for lang, c in f.items():
        big = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in big.items():
            around = [q for q in big if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * big[q] >= 80 * a for q in around):
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, le, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, le, r, n[lang], -s))
    return out


@pytest.mark.parametrize("records", [phrases.RANGE, 900])
def test_phrases_are_those_of_brute_force(docs, rows, records):
    for least, top in ((5, 2000), (12, 7)):
        got = phrases.collocations(docs, least=least, top=top, records=records)
        assert {tuple(r) for r in got.collect()} == best_phrases(rows, least, top)


def test_counts_are_whole_wherever_ranges_are_cut():
    """Blocks of several tasks cut at arbitrary boundaries, also unknown, short and truncated ones."""
    texts = [prose(400) for _ in range(6)]
    edges = sorted({(b"a",), (b"b", b"b", b"b"), (b"b", b"bb"), (b"the", b"of"), (b"the", b"of", b"the", b"\xc3"), (b"zz",)})
    ranges = defaultdict(list)
    for some in (texts[:2], texts[2:3], texts[3:]):
        seen, ids = phrases.Words({phrases._BREAK: 0}), []
        for t in some:
            ids += [seen[w] for w in [*phrases.tokens(t), phrases._BREAK]]
        for r, block in phrases.sorted_blocks(np.array(ids, np.uint32), seen, edges):
            ranges[r].append(block)
    total, found = 0, Counter()
    for blocks in ranges.values():
        size, part = phrases.range_counts(blocks, 4)
        total += size
        for _, phrase, f, _ in part:
            found[phrase] += f
    f, n = counted([(0, t, None) for t in texts])
    assert len(ranges) > 3 and total == n["und"]
    assert {p: c for p, c in found.items() if c >= 4} == {" ".join(p): c for p, c in f["und"].items() if c >= 4}


def test_scores_beyond_64_bits(spark):
    rows = [(2**62, 2**62 + 5, 2**62 + 11), (2**61 - 1, 2**62, 2**63 - 1), (30, 30, 31), (1, 2**63 - 1, 2**63 - 1)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", phrases.score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert [r.s for r in got.collect()] == [2000000 * a // (le + r) for a, le, r in rows]


def term_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def scores(docs, items, top):
    docs = [(i, Counter(term_list(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for doc_id, c in docs:
            m = 50 + 50 * c.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(term_list(text)) if c[t])
            if s > 0:
                found.append((-s, doc_id is None, doc_id or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("owners", [1, 4])
def test_search_is_that_of_brute_force(spark, docs, rows, owners):
    items = [("q1", "The ÉA x1, of"), ("q2", prose(300)), ("q2", "x1"), (None, "a b"), ("q3", None), ("q4", ""), ("q5", "nowhere"), ("q6", "w" * 20000), ("q7", "ñ X1")]
    table = spark.createDataFrame([(i, t, 1, 1) for i, t in items], "item_id string, text string, doc_id int, rank int")
    for top in (3, 1000):
        got = sorted((tuple(r) for r in ranking.search(docs, table, top=top, owners=owners).collect()), key=repr)
        assert got == scores([(r[0], r[1]) for r in rows], items, top)


def test_search_in_several_bundles_passes_and_blocks(spark, monkeypatch):
    """Blocks are closed in tasks, which do not see a changed module: more documents than a block holds."""
    monkeypatch.setattr(ranking, "BUNDLE", 3)
    monkeypatch.setattr(ranking, "PASS", 5)
    docs = [(i, prose(4, "a b c d e f g h i j k l m n")) for i in range(ranking.BLOCK + 300)]
    items = [(i, prose(5, "a b c d e f g h i j k l m n zz")) for i in range(7)]
    got = ranking.search(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.createDataFrame(items, "item_id int, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == scores(docs, items, ranking.TOP)


def test_frequent_terms_come_last():
    owner = ranking.owners_of({t: n for t, n in enumerate([1, 1, 2, 3, 60, 70, 500, 900])}, 3)
    assert owner[7] == 2 and owner[0] == 0 and [owner[t] for t in range(8)] == sorted(owner.values())
    assert set(ranking.owners_of({4: 10}, 4).values()) == {3}


def test_packed_sequences(docs, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    capacity = 256
    got = packing.pack(docs, capacity=capacity, pieces=40).collect()
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for places in used.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(places[-1]) <= capacity
    assert len(used) <= 1.1 * sum(r.length for r in got) / capacity + 3


def plain_best_fit(lengths, capacity, most):
    bins = []  # [free, number], oldest first
    made = 0
    for n in lengths:
        fit = min((b for b in bins if b[0] >= n), key=lambda b: b[0], default=None)
        if fit is None:
            fit = [capacity, made]
            made += 1
        else:
            bins.remove(fit)
        yield fit[0]
        fit[0] -= n
        if fit[0]:
            bins.append(fit)
        if len(bins) > most:
            bins.remove(min(bins, key=lambda b: b[0]))


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_best_fit_takes_the_fullest_bin_that_fits(most):
    lengths = [RNG.choice([1, 2, 3, 30, 40, 60, 99, 100]) for _ in range(3000)]
    free = [100 - offset for _, offset in packing.best_fit(lengths, 100, most)]
    assert free == list(plain_best_fit(lengths, 100, most))


def test_words_give_the_ids_of_the_whole_text():
    tokens = packing.WordTokens(public_tokenizers.path(packing.VOCABULARY))
    tokens.limit = 4000
    texts = ["it's DON'T we're'x 3.5.. a.b, c!? İ ΣΣ é,\x0bz\x85q r s t <|endoftext|>a, x́. ́b 'S", "", "\n", *(prose(50) + "".join(chr(RNG.randrange(32, 0x3000)) for _ in range(200)) for _ in range(40))]
    for start in range(0, len(texts), 7):
        some = texts[start : start + 7]
        for text, ids in zip(some, tokens.encode(some), strict=True):
            assert ids.tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, None, None, "q", None, None)], SCHEMA)
    assert phrases.collocations(none).count() == phrases.collocations(one).count() == 0
    assert [ranking.search(d, i).count() for d, i in ((none, one), (one, none), (one, one))] == [0, 0, 0]
    assert packing.pack(none).count() == 0
    assert [(r.length, r.offset) for r in packing.pack(one).collect()] == [(1, 0)]


def test_fingerprints_with_gaps_hot_and_null_ids(spark, monkeypatch):
    """Ids far apart, one id of many rows and many rows without one: blocks stay small and the order whole."""
    from allelespan.llm import fingerprint

    monkeypatch.setattr(fingerprint, "BLOCK", 8)
    ids = [*range(40), 2**60, 2**63 - 1, -(2**63), *[7] * 50, *[None] * 60]
    rows = [(i, prose(RNG.randint(0, 40))) for i in ids]
    RNG.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashed = df.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    sizes = [r["count"] for r in fingerprint.in_blocks(hashed).groupBy("block").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 40
    hash_of = {r.text: r.hash for r in hashed.select("text", "hash").collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hash_of[r[1]], r[1]))
    want = Counter()
    for (i, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        new = fingerprint.edited(text, following)
        sets = [fingerprint.shingle_set(x) for x in (text, new, following)]
        low = [s[s < np.uint64(2**61)] if (s < np.uint64(2**61)).any() else s[:1] for s in sets]

        def like(x, y):
            union = sorted({*x.tolist(), *y.tolist()})
            kept = [h for h in union if h < 2**61] or union[:1]
            return float(len(x) == len(y)) if not len(x) or not len(y) else len([h for h in kept if h in x and h in y]) / len(kept)

        want[i, len(text), fingerprint.written(low[0]), fingerprint.written(low[1]), round(like(low[0], low[1]), 9), round(like(low[0], low[2]), 9)] += 1
    got = fingerprint.compare_with_next(df).collect()
    assert Counter((r.doc_id, r.n_chars, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want


def test_many_documents_just_below_the_threshold_share_a_bucket(spark):
    """No pair is lost or linked wrongly among near copies from 0.6 to 0.9."""
    from allelespan.llm import minhash

    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for j in RNG.sample(range(120), RNG.choice([1, 2, 3, 4, 5, 6])):
            words[j] = f"v{RNG.randrange(9)}"
        rows.append((i, " ".join(words)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(116)} for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=80)
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: root(i) for i in sets}
