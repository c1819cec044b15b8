"""Each operator against a brute-force version on small texts, with nulls, empty and repeated rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from allelespan.llm import bpe, fingerprint, langid, minhash, mixing, pages, quality, secrets, suffixes, urls

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, text_a string, key string"
RNG = random.Random(5)


def words(n, letters="abcdefgh"):
    return " ".join("".join(RNG.choice(letters) for _ in range(RNG.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Null, empty, blank, very long and repeated texts; near copies; null ids, languages and sources."""
    base = words(120)
    near = base.replace(base.split()[60], "changed", 1)
    texts = [None, "", " \n\t", "one", base, base, near, near + " more", words(4000), "x" * 30000, words(3), base.upper()]
    texts += [words(RNG.randint(1, 60)) for _ in range(30)] + [words(40) + base[:200] + words(30) for _ in range(6)]
    out = [(i * 7, t, RNG.choice(["en", "de", None]), RNG.choice(["a", "b", None]), "t", "k") for i, t in enumerate(texts)]
    return [*out, (None, base, None, None, "t", "k")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA + ", page_id long, url string, html string")


def by_id(df, *names):
    return {r.doc_id: tuple(r[n] for n in names) for r in df.collect()}


def split(text):
    return re.findall(r"[^ \t-\r]+", text or "")


def shingles(text):
    w = split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_empty_tables(none):
    for run in (
        quality.judge, minhash.near_duplicates, secrets.scan, pages.extract, fingerprint.compare_with_next, langid.identify,
        bpe.token_digests, suffixes.removal_digests, urls.judge_urls, mixing.mix,
    ):
        assert run(none).count() == 0


def test_quality_counts(docs, rows):
    got = by_id(quality.judge(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for doc_id, text, *_ in rows:
        w = split(text)
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {i + j for i in range(len(w) - 4) for j in range(5) if windows[tuple(w[i : i + 5])] > 1}
        lines = [x for x in (text or "").split("\n") if split(x)]
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        assert got[doc_id][:6] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)
        assert not (failed and got[doc_id][6])


def test_quality_fences_drop_outliers(spark):
    clean = [(i, words(80), "en", f"s{i % 3}", "", "") for i in range(900)]
    junk = [(1000 + i, " ".join(f"{w}###" for w in words(60).split()), "en", f"s{i % 3}", "", "") for i in range(30)]
    got = by_id(quality.judge(spark.createDataFrame(clean + junk, SCHEMA)), "kept")
    assert not any(got[r[0]][0] for r in junk)
    assert sum(got[r[0]][0] for r in clean) >= 890


def components(rows):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def test_near_duplicates(docs, rows):
    got = by_id(minhash.near_duplicates(docs), "n_shingles", "component_id", "kept")
    assert got.pop(None)[1] is None
    assert got == components(rows)


def test_near_duplicates_with_edits_around_the_threshold(spark):
    base = words(150, "abcdefghijklmnop").split()
    many = []
    for i in range(60):
        text = list(base)
        for _ in range(i % 6):
            text[RNG.randrange(len(text))] = f"w{RNG.randrange(40)}"
        many.append((i, " ".join(text), "", "", "", ""))
    got = by_id(minhash.near_duplicates(spark.createDataFrame(many, SCHEMA)), "n_shingles", "component_id", "kept")
    assert got == components(many)


def test_one_row_of_each_group_stays(spark, docs, rows):
    kept = by_id(minhash.near_duplicates(docs).where("kept"), "kept")
    got = minhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted((r for r in rows if r[0] is None or r[0] in kept), key=repr)
    twice = spark.createDataFrame([*rows, rows[13], rows[13], rows[4], rows[0]], SCHEMA)  # repeated rows stay once
    assert sorted((tuple(r) for r in minhash.keep_one(twice).collect()), key=repr) == sorted((tuple(r) for r in got.collect()), key=repr)


def test_sketch_fills_every_bin_and_estimates():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 900).astype(np.uint64))
    b = np.concatenate([a[:600], a[:300] + np.uint64(1)])
    s = minhash.sketches([a, b, a[:1]], 512)
    assert (s != 2**64 - 1).all()
    assert abs((s[0] == s[1]).mean() - 600 / 1200) < 0.08


def test_secrets(spark):
    texts = [
        None, "", 'token = "abc" password: hunter2xyz', "API-KEY=x api_key='abcdef' APIKEY:abcde", "AKIA" + "A1" * 8 + " AKIASHORT",
        "0123456789abcdef01234567 0123456789abcdef", "token=token=abcdefgh ſecret=abcdefgh",
    ]
    labelled = [f"id {''.join(RNG.choice('0123456789abcdef') for _ in range(40))} and {words(20)} {'abcdefgh' * 3}" for _ in range(80)]
    data = [(i, t, "", "", "", "") for i, t in enumerate([*texts, *labelled, "key b7db7aa4a5fcc7830599 here, plainwordofmanyletters"])]
    got = by_id(secrets.scan(spark.createDataFrame(data, SCHEMA)), "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert got[0] == got[1] == (0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    assert got[2][:3] == (1, 0, 0) and got[2][4] == "assign:14:34"
    assert got[3][:3] == (1, 0, 0)
    assert got[4][:3] == (0, 1, 0) and got[4][4].startswith("access:0:20")
    assert got[5][:3] == (0, 0, 1)
    assert got[6][:3] == (1, 0, 0)
    assert got[len(data) - 1][4] == "format:4:24"
    clean = secrets.redact(spark.createDataFrame(data, SCHEMA))
    assert clean.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert by_id(clean, "text")[2] == ('token = "abc" [secret]',)


def test_secrets_without_digits_and_rests_of_runs():
    rng = random.Random(11)
    app = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=16)) for _ in range(200)]
    hexes = ["".join(rng.choices("0123456789abcdef", k=32)) + "".join(rng.choices("GHIJKLMN0123456789", k=12)) for _ in range(200)]
    plain = ["/".join(rng.choices(["Usr", "Lib", "Share", "Doc"], k=6)) + ".TXT" for _ in range(200)]
    scorer = secrets.Scorer({"assign": app, "hex": hexes}, plain)
    # letters only
    assert secrets.all_spans("see qwmzkfhtrbplvxoe here", scorer) == [(4, 20, "format")]
    assert secrets.all_spans("see Usr/Lib/Share/Doc/Usr/Lib.TXT here", scorer) == []
    # 32 hex digits open a longer key
    key = "0123456789abcdef0123456789abcdef" + "GH1JK2LM3N4G"
    assert secrets.all_spans(f"a {key} b", scorer) == [(2, 34, "hex"), (2, 46, "format")]
    # a rest that is a credential beside a fixed format, in a run that is none as a whole
    spans = [(2, 5, "hex"), (9, 60, "hex")]
    assert list(secrets.open_runs("x " + "a" * 20 + " " + "b" * 20, spans)) == [(2, 22, [(5, 9)])]


def test_base_spans_against_a_plain_scan():
    names = ["password", "passwd", "secret", "token", "apikey", "api_key"]
    value = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-")

    def while_in(t, i, letters):
        while i < len(t) and t[i] in letters:
            i += 1
        return i

    def spaces(t, i):
        return while_in(t, i, " ")

    def quote(t, i):
        return i + (t[i : i + 1] in ("'", '"') and i < len(t))

    def assign(t, i):
        for n in names:
            if t[i : i + len(n)].lower() == n and t[i : i + len(n)].isascii():
                j = spaces(t, quote(t, i + len(n)))
                if t[j : j + 1] in (":", "=") and j < len(t):
                    k = quote(t, spaces(t, j + 1))
                    end = while_in(t, k, value)
                    if end > k:
                        return end, end - k >= 6
        return None

    def access(t, i):
        end = while_in(t, i + 4, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        return (end, end - i >= 20) if t[i : i + 4] == "AKIA" and end > i + 4 else None

    def hexes(t, i):
        end = while_in(t, i, "0123456789abcdef")
        return (end, end - i >= 24) if end > i else None

    def scan(t):
        out = []
        for kind, match in (("assign", assign), ("access", access), ("hex", hexes)):
            i = 0
            while i < len(t):
                m = match(t, i)
                if m and m[1]:
                    out.append((i, m[0], kind))
                i = m[0] if m else i + 1
        return sorted(out, key=lambda s: (s[0], ("assign", "access", "hex").index(s[2])))

    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "\u017fecret", "AKIA", "AKIAAKIA", '"', "'", " ", ":", "=", "==", "x", "deadbeef", "0123456789ab", "ABCDEFGH", "\n", "é", "-/+"]
    for _ in range(4000):
        text = "".join(RNG.choice(bits) for _ in range(RNG.randint(0, 14)))
        assert secrets.base_spans(text) == scan(text), text


def test_held_out_credentials_and_ordinary_runs(spark):
    """Credentials and runs of the given documents: four fifths are learned, the others must be told apart."""
    found = secrets.labelled(spark.read.parquet(f"{SF}/documents.parquet")).distinct().collect()
    held = [r for r in found if zlib.crc32(r.value.encode()) % 5 == 0 and len(r.value) >= secrets.LONG]
    known = {k: [r.value for r in found if r.kind == k and r not in held][: secrets.SAMPLE] for k in ("assign", "hex", "ordinary")}
    scorer = secrets.Scorer(known, known.pop("ordinary"))
    hit = [r.kind for r in held if scorer.score(r.value) >= secrets.LEAST]
    there = [r.kind != "ordinary" for r in held]
    assert sum(there) > 5
    assert len(there) - sum(there) > 15
    assert sum(k != "ordinary" for k in hit) >= 0.95 * sum(there)  # recall
    assert hit.count("ordinary") <= 0.05 * len(hit)  # precision
    # runs of kinds that the documents hardly have
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(RNG.choice(letters) for _ in range(RNG.randint(4, 9)))
    made = ["/".join(word() for _ in range(5)) for _ in range(100)] + ["".join(word() for _ in range(4)) for _ in range(100)]
    made += ["".join(RNG.choice("0123456789") for _ in range(16)) for _ in range(100)] + [".".join([word(), word(), word(), "com"]) for _ in range(100)]
    assert sum(scorer.score(x) >= secrets.LEAST for x in made) <= 12


def test_automaton_compares_all_successors():
    # as often 'a' as 'd' at the root and after every 'a', but only the root's own 'd' goes on
    strings = ["dg"] * 512 + [x for k in range(1, 8) for x in ["a" * k + "d"] * (512 >> k)]
    fitted = secrets.Automaton(strings)
    assert fitted.log_likelihood("ad") - fitted.log_likelihood("adg") > 5
    assert fitted.log_likelihood("dg") - fitted.log_likelihood("d") > 5


def test_automaton_merges_states():
    strings = ["d" * RNG.randint(10, 20) for _ in range(200)]
    fitted = secrets.Automaton(strings)
    assert len(fitted.states) < 20
    assert fitted.log_likelihood("d" * 15) > fitted.log_likelihood("g" * 15)


def test_pages():
    article = "<h1>Title</h1><p>First  para &amp; <b>bold</b> text of some length.<p>Second<br>para with words, too."
    html = (
        "<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body class=no-sidebar><nav><a href=/>Home</a></nav>"
        f'<div class="cookie-notice">We use cookies</div><div id=main><article>{article}</article></div><script>var t="</p>";</script>'
        '<form><input><button>Go</button></form><section id="comments"><p>Nice long comment of a reader here</p></section>'
        "<footer>&copy; me</footer></body></html>"
    )
    assert pages.main_text(html) == "Title First para & bold text of some length. Second para with words, too."
    assert pages.main_text(html.replace("<article>", "<div>").replace("</article>", "</div>")) == pages.main_text(html)
    for odd in (None, "", "<", "</p></div>", "<div" * 50, "<p title='x>" * 3, "<!-- open", "<script>x"):
        assert isinstance(pages.main_text(odd), str)
    assert pages.main_text("<div>" * 3000 + "deep &lt;text") == "deep <text"


def test_pages_rows(spark):
    data = [(1, "u", None, 0), (2, None, "<body><p>a b</p></body>", 0), (2, None, "<body><p>a b</p></body>", 0)]
    got = pages.extract(spark.createDataFrame(data, "page_id long, url string, html string, n_chars int")).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, "", 0), (2, "a b", 3), (2, "a b", 3)]


def test_fingerprints(docs, rows):
    got = by_id(fingerprint.compare_with_next(docs), "n_chars", "edited_sha256", "near_edited", "near_next", "fingerprint")
    ordered = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -1))
    prints = {}
    for row, after in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        t, n = row[1] or "", after[1] or ""
        k = len(t) // 3
        assert got[row[0]][:2] == (len(t), hashlib.sha256((t[: len(t) - k] + n[:k]).encode()).hexdigest())
        assert all(0 <= x <= 1 for x in got[row[0]][2:4])
        assert prints.setdefault(t, got[row[0]][4]) == got[row[0]][4]
        assert (got[row[0]][4] == "") == (not split(t))


def test_fingerprints_merge_and_estimate():
    a, b = words(6000, "abcdefghijklmnop"), words(300, "abcdefghijklmnop")
    both = fingerprint.sketch(a + " " + b)
    joined = fingerprint.merge(fingerprint.sketch(a), fingerprint.sketch(b))
    assert len(np.setdiff1d(joined, both)) == 0
    assert fingerprint.containment(fingerprint.sketch(b), both) > 0.9
    assert np.array_equal(fingerprint.read(fingerprint.written(both)), both)


def test_forward_backward_is_exact():
    r = np.random.default_rng(0)
    lengths = np.array([1, 70, 32, 33, 64])
    scores, step, start = r.normal(0, 3, (200, 3)), r.normal(0, 1, (3, 3)), r.normal(0, 1, 3)
    got, at = langid.forward_backward(scores, lengths, step, start), 0
    for n in lengths:
        e = np.exp(scores[at : at + n])
        a, b = np.zeros((n, 3)), np.ones((n, 3))
        a[0] = np.exp(start) * e[0]
        for i in range(1, n):
            a[i] = (a[i - 1] @ np.exp(step)) * e[i]
        for i in range(n - 2, -1, -1):
            b[i] = np.exp(step) @ (e[i + 1] * b[i + 1])
        p = a * b
        assert np.allclose(got[at : at + n], p / p.sum(1, keepdims=True))
        at += n


def test_language_of_held_out_documents(spark):
    parts = {"en": "the of and ing tion that with".split(), "de": "der die und ung keit schen nicht".split()}
    text = {k: lambda v=v: " ".join("".join(RNG.choices(v, k=RNG.randint(1, 3))) for _ in range(50)) for k, v in parts.items()}
    data = [(i, text[k](), k, "", "", "") for i in range(200) for k in (RNG.choice(["en", "de"]),)]
    data += [(900, None, "en", "", "", ""), (901, "12 --", "de", "", "", ""), (902, text["de"](), None, "", "", "")]
    frame = spark.createDataFrame(data, SCHEMA)
    model = langid.fit(frame)
    got = by_id(langid.identify(frame, model), "held_out", "lang_pred", "score")
    for doc_id, (held, lang, score) in got.items():
        assert held == (zlib.crc32(str(doc_id).encode()) % 5 == 0) and 0 <= score <= 1
    assert np.mean([got[r[0]][1] == r[2] for r in data[:200] if got[r[0]][0]]) >= 0.95
    assert got[900][1:] == got[901][1:] == ("und", 0.0) and got[902][1] == "de"
    switched = langid.label_words(model, text["en"]() + " " + text["de"]())
    assert np.mean([x == ("en" if i < 50 else "de") for i, (_, x) in enumerate(switched)]) > 0.85


def test_tokens_are_those_of_the_library(docs, rows):
    path = public_tokenizers.path(bpe.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(bpe.token_digests(docs), "n_tokens", "ids_sha256", "decoded_sha256")
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        line = " ".join(map(str, ids))
        assert got[doc_id] == (len(ids), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    codec = bpe.codec(path, public_tokenizers.PATTERN)
    for _ in range(200):
        text = "".join(RNG.choice("ab \n\t'sé日😀x09.,-=! ") for _ in range(RNG.randint(0, 120)))
        assert codec.encode(text) == library.encode_ordinary(text)


def test_token_tables_append_and_edit():
    v = bpe.codec(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN).v
    for _ in range(100):
        data = bytes(RNG.choice(b"aeinthor ") for _ in range(RNG.randint(1, 200)))
        t = bpe.PieceTable(v, data)
        a = RNG.randint(0, len(data))
        new = bytes(RNG.choice(b"theinor") for _ in range(RNG.randint(0, 12)))
        t.replace(a, RNG.randint(a, len(data)), new).append(new)
        assert t.last == v.extend(t.data, [-1])


def removed(rows):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for k in range(len(t) - 49):
            s = t[k : k + 50]
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < i:
                gone[k : k + 50] = True
        out[i] = (len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_repeats(docs, rows):
    got = by_id(suffixes.removal_digests(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got.pop(None)[1] == 0
    assert got == removed([r[:2] for r in rows if r[0] is not None])
    spans = by_id(suffixes.remove_repeats(docs), "spans")
    assert {i: len(s[0]) for i, s in spans.items() if i is not None} == {i: x[2] for i, x in got.items()}


def test_repeats_in_small_alphabets(monkeypatch):
    for trial in range(60):
        monkeypatch.setattr(suffixes, "CHUNK", RNG.choice([60, 200, 5000]))
        letters = RNG.choice(["ab", "a", "abcdefgh"])
        parts = ["".join(RNG.choice(letters) for _ in range(RNG.randint(40, 300))) for _ in range(4)]
        data = [(i, "".join(RNG.choice(parts)[RNG.randint(0, 30) :] for _ in range(RNG.randint(0, 4)))) for i in range(10)]
        data += [(20, "ab " * 60), (21, "ab " * 80)]
        blobs = {}
        # any choice of pieces that come last gives the same result
        last = RNG.choice([None, np.array([RNG.random() < 0.5 for _ in range(7)]), np.ones(3, bool)])
        for k in range(0, len(data), 4):
            for b, x in suffixes._to_buckets([(i, 0, t.encode()) for i, t in data[k : k + 4]], 3, last):
                blobs.setdefault(b, []).append(x)
        gone = {i: np.zeros(len(t), bool) for i, t in data}
        for x in blobs.values():
            for i, _, s, n in zip(*suffixes.settle_bucket(x, last), strict=True):
                gone[i][s : s + n + 49] = True
        expected = removed(data)
        assert {i: int(g.sum()) for i, g in gone.items()} == {i: e[1] for i, e in expected.items()}, trial


def test_a_piece_in_many_contexts_is_split_up(spark):
    pieces = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(20_000)]
    order = suffixes.place_of(np.array([int.from_bytes(p.encode()) for p in pieces], np.uint64), None)
    first = pieces[int(order.argmin())]  # the smallest piece of nearly every string around it
    texts = [words(30) + first + words(30) for _ in range(2000)]
    data = list(enumerate(texts + [t[:90] + " " + t[60:] for t in texts[::40]]))
    buckets, counters, heavy = 1 << 30, 1 << 14, 20_000

    def heaviest(last):
        sizes = Counter()
        for b, x in suffixes._to_buckets([(i, 0, t.encode()) for i, t in data], buckets, last):
            sizes[b] += len(suffixes.unpack(x)[6])
        return max(sizes.values())

    rows = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    total = sum(len(t) for _, t in data)
    last = suffixes.heavy_counters(rows, total, counters, heavy)
    assert heaviest(None) > 100_000
    assert heaviest(last) <= 2 * heavy
    got = by_id(suffixes.removal_digests(rows, heavy=heavy), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == removed(data)


def test_pieces_are_counted_once_however_many_are_frequent(spark, monkeypatch):
    passage = "".join(RNG.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(120))
    data = [(i, words(20) + passage + words(20)) for i in range(1500)] + [(None, passage)]
    rows = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    reads, total = [], sum(len(t) for _, t in data)
    made = type(rows).mapInPandas
    monkeypatch.setattr(type(rows), "mapInPandas", lambda self, *a, **b: reads.append(1) or made(self, *a, **b))
    assert suffixes.heavy_counters(rows, 100, 1 << 14, 20_000) is None and not reads
    last = suffixes.heavy_counters(rows, total, 1 << 14, 20_000)
    assert len(reads) == 1  # a round for each piece of the passage before
    place = suffixes.place_of(suffixes.eights(np.frombuffer(passage.encode(), np.uint8)), last)
    assert (place >> np.uint64(59) >= 2).all()  # 1,500 of each, under 2 ** 3 times what may be in class 0
    # of a sample the classes are about the same, also if it cuts the texts
    monkeypatch.setattr(suffixes, "SAMPLE", total // 3)
    monkeypatch.setattr(suffixes, "SLICE", 70)
    some = suffixes.heavy_counters(rows, total, 1 << 14, 20_000)
    place = suffixes.place_of(suffixes.eights(np.frombuffer(passage.encode(), np.uint8)), some)
    assert (place >> np.uint64(59) >= 1).all()
    monkeypatch.setattr(suffixes, "FLUSH", 5000)
    got = by_id(suffixes.removal_digests(rows, heavy=20_000), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got.pop(None)
    assert got == removed([r for r in data if r[0] is not None])


def test_difference_cover():
    inside = np.isin(np.arange(31), suffixes._COVER)
    for i in range(31):
        for j in range(31):
            d = suffixes._OFFSETS[i, j]
            assert inside[(i + d) % 31] and inside[(j + d) % 31]


def test_urls(spark):
    data = [
        (0, None, ""), (1, "no scheme", "net/"), (2, "http://NET/x", None), (3, "https://a.example.net/en/1", ""), (4, "https://a.example.net/fr", ""),
        (5, "http://x.example.com/de/9?q", ""), (6, "http://y.org/fr/", ""), (7, "http://myexample.com/de/", ""), (8, "http://a.org?x/fr/", ""), (8, "http://a.org?x/fr/", ""),
    ]
    # what the rules block and allow teaches the words of other hosts
    hosts = ["cheap-pills", "casino-win", "spam-farm", "free-bets"]
    data += [(100 + i, f"http://{hosts[i % 4]}.net/{i}", "") for i in range(80)]
    data += [(200 + i, f"http://{hosts[i % 4]}.org/{i}", "") for i in range(80)]
    data += [(300 + i, f"http://quiet-garden{i % 9}.org/fr/{i}", "") for i in range(200)]
    data += [(900, "http://pillsfarm.org/1", ""), (901, "http://quietgarden.org/1", "")]
    frame = spark.createDataFrame(data, "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(frame).collect()}
    assert got[0][:3] == got[1][:3] == ("", "", None)
    assert got[2] == ("net", "/x", "net/", "block")
    assert got[3][2:] == ("example.net/en/", "allow") and got[4][2:] == ("net/", "block")
    assert got[5] == ("x.example.com", "/de/9", "example.com/de/", "block")
    assert got[6][2:] == ("org/fr/", "allow") and got[7][2] is None
    assert got[8][:3] == ("a.org", "", None)
    assert all(got[100 + i][2:] == ("net/", "block") and got[200 + i][2:] == (None, "block") for i in range(80))
    assert got[900][3] == "block" and got[901][3] == "allow"


def test_mix(docs, rows):
    got = mixing.mix(docs).collect()
    size = {r[0]: len(split(r[1])) for r in rows}
    total = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in ("a", "b", None)}
    cap, weight, target, left = {s: 2 * n for s, n in total.items()}, {"a": 5, "b": 2, None: 1}, {}, 1.5 * sum(total.values())
    while True:
        free = [s for s in total if s not in target]
        level = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if level[s] >= cap[s]]
        if not over:
            target |= level
            break
        for s in over:
            target[s] = cap[s]
            left -= cap[s]
        if len(over) == len(free):
            break
    source = {r[0]: r[3] for r in rows}
    for s in total:
        mine = [r for r in got if source[r.doc_id] == s]
        assert all(r.size == size[r.doc_id] and r.source_size == total[s] and abs(r.target - target[s]) < 1e-6 for r in mine)
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
        assert sum(r.taken for r in mine) == int(target[s] + 1e-9)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_documents_have_the_words(docs):
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    out = Counter()
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        out[r.doc_id] += len(split(r.text))
    assert dict(out) == taken


def test_mixed_documents_of_repeated_and_missing_ids(spark):
    """Rows that share an id, have none, or are copies of each other add up to what their source is due."""
    rows = [(None, words(10), "a") for _ in range(20)] + [(None, "same words in every row", "a")] * 30
    rows += [(7, words(n), "b") for n in (3, 9, 9, 20)] + [(8, "one two three", "b")] * 4 + [(9, "three of another", "c"), (9, "x y", None)]
    rows += [(None, None, "a"), (None, "", None), (10, "big " * 900, "d")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, source string, size int").repartition(4)
    size = {i: len(split(r[1])) for i, r in enumerate(rows)}
    plan = mixing.mix(docs).collect()
    assert len(plan) == len(rows) and sorted(r.size for r in plan) == sorted(size.values())
    due = Counter()
    for r in plan:
        due[r.source_size] += r.taken
        assert r.taken <= 2 * r.size
    assert {r.source_size: int(r.target + 1e-9) for r in plan} == dict(due)
    out, times = Counter(), Counter()
    for r in mixing.mixed_documents(docs).collect():
        source = rows[r.size][2]
        out[source] += len(split(r.text))
        times[r.size] += len(split(r.text))
        assert rows[r.size][1].startswith(r.text) and r.source == source
    assert all(times[i] <= 2 * size[i] for i in times)
    total = Counter()
    for i, r in enumerate(rows):
        total[r[2]] += size[i]
    assert out == {s: due[n] for s, n in total.items()}


def test_url_models_are_whole(spark, monkeypatch):
    """Words and tokens outside the broadcast head count as those in it do."""
    # the words of the host names are rarer than any word of the fillers
    data = [f"http://{'abcdefgh'[i % 8]}{i % 7}.com/{'/'.join(('ab', 'cde', 'fgab')[: i % 4])}/{'hgfe'[i % 3 :]}" for i in range(300)]
    data += [f"http://cheapzebra{i}-x.net/rareword{i}/zebra" for i in range(5)] + ["http://zebracheap.com/", "http://zebra.com/rareword2", None, "no"]
    data += [f"http://calm{i}.example.net/en/{'abcdefgh'[i]}{i}/cde" for i in range(8)]
    frame = spark.createDataFrame(list(enumerate(data)), "page_id long, url string")

    def verdicts():
        return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(frame, rules=urls.RULES[:2]).collect()}

    whole = verdicts()
    assert {v[3] for v in whole.values()} == {"allow", "block"}
    for head in (3, 20):
        monkeypatch.setattr(urls, "HEAD", head)
        monkeypatch.setattr(urls, "VOCABULARY", head, raising=False)
        assert verdicts() == whole


def test_urls_against_a_plain_version(spark):
    """All splits of every name, all counts and weights by hand."""
    vocabulary = ["red", "rose", "sun", "day", "moon", "game", "play", "cash"]
    data = []
    for i in range(160):
        a, b = RNG.choice(vocabulary), RNG.choice(vocabulary)
        end = RNG.choice(["net/", "example.com/de/", "org/fr/", "org/en/", "com/", "example.net/en/"])
        sep = RNG.choice(["-", "", "", "."])
        data.append(f"http://{a}{sep}{b}.{end}{RNG.choice(vocabulary)}{RNG.choice(vocabulary + [''])}/{i % 3}")
    data += ["http://unseenword.com/x", "http://" + "red" * 4 + ".com/", None, "none", data[0], data[0]]
    frame = spark.createDataFrame(list(enumerate(data)), "page_id long, url string")
    got = {r.page_id: r for r in urls.judge_urls(frame).collect()}

    count = Counter({w: 0 for w in urls.PLAIN})
    for r in got.values():
        found = re.findall(r"(?<=-)[a-z]+|[a-z]+(?=-)", r.host) + re.findall("[a-z]+", r.path.lower())
        count.update(w for w in found if len(w) > 1)
    count = {w: max(n, 1) for w, n in count.items()}
    total = sum(count.values())

    def splits(name):
        if not name:
            yield 0.0, ()
        for n in range(1, len(name) + 1):
            cost = np.log(total / count[name[:n]]) if name[:n] in count else np.log(total) + (n + 1) * np.log(10)
            for c, rest in splits(name[n:]):
                yield cost + c, (name[:n], *rest)

    split_of = {}

    def best(name):
        if name not in split_of:
            split_of[name] = min(splits(name)) if name.isalpha() else (0.0, (name,))
        return split_of[name][1]

    def tokens(r):
        labels = [x for x in re.findall("[a-z0-9]+", r.host) if x not in urls.PLAIN]
        runs = re.findall("[a-z0-9]+", r.path.lower())
        return [f"h:{w}" for x in labels for w in best(x)] + [t for x in runs for t in (["p:#"] if x.isdigit() else [f"p:{w}" for w in best(x)])]

    rules, examples, seen = dict(urls.RULES), Counter(), {"allow": Counter(), "block": Counter()}
    for r in got.values():
        if r.rule:
            examples[rules[r.rule]] += 1
            seen[rules[r.rule]].update(tokens(r))
    known = set(seen["allow"]) | set(seen["block"])
    assert min(examples.values()) > 10

    def log_share(kind, t):
        return np.log((seen[kind][t] + 1) / (sum(seen[kind].values()) + len(known) + 1))

    verdicts = Counter()
    for r in got.values():
        score = np.log((examples["block"] + 1) / (examples["allow"] + 1))
        score += sum(log_share("block", t) - log_share("allow", t) for t in tokens(r) if t in known)
        if r.rule:
            assert r.verdict == rules[r.rule]
        elif abs(score) > 1e-6:
            assert r.verdict == ("block" if score > 0 else "allow")
            verdicts[r.verdict] += 1
    assert min(verdicts["allow"], verdicts["block"]) > 5


def test_pages_keep_text_in_marked_wrappers():
    body = "<article><p>" + "Words of the article go on and on here. " * 8 + "</p></article>"
    plain = body.replace("article>", "div>")
    text = " ".join(("Words of the article go on and on here. " * 8).split())
    rest = '<nav><a href="/">Home page of the site</a></nav><div class="sidebar">Other things beside it</div>'
    for start, end in (
        ('<div class="layout has-sidebar">', "</div>"), ('<div class="no-sidebar">', "</div>"), ('<div id="with-comments">', "</div>"),
        ('<div class="search-result">', "</div>"), ('<form id="aspnetForm">', "</form>"), ("<form><fieldset>", "</fieldset></form>"),
        ('<div class="widget"><div class="modal">', "</div></div>"),
    ):
        for inner in (body, plain):
            assert pages.main_text(f"<body>{start}{rest}{inner}<button>Send it</button>{end}</body>") == text, start
    # an article in a marked block is kept if it is the only one, also if it is short
    beside = "<div><p>" + "A long text of another kind stands here. " * 12 + "</p></div>"
    short = "<article><p>Short news of the day.</p></article>"
    assert "Short news" in pages.main_text(f'<body><div class="widget">{short}</div>{beside}</body>')
    # marked blocks beside the text stay out
    for name in ("comments", "related", "cookie-notice"):
        assert pages.main_text(f'<body>{body}<div class="{name}"><article class="card"><p>Something else, not so long.</p></article></div></body>') == text


def prose(n):
    return "".join(f"<p>{words(40)}.</p>" for _ in range(n))


def plain(html):
    return " ".join(re.sub(r"<[^>]*>", " ", html).split())


def test_pages_keep_all_of_an_article():
    nav = '<div><ul><li><a href="/a">One page</a></li><li><a href="/b">Another page</a></li></ul></div>'
    a, b, c = prose(6), prose(3), prose(10)
    lead = "Some text directly in the body that says what follows, and that is no shorter than a sentence of the article is, nor than its lines."
    for page, want in (
        (f"<div>{a}</div><div>{b}</div>", a + b),
        (f"<article>{a}</article><article>{b}</article>", a + b),
        (f"<div><h1>Title of it</h1></div><div>Lead.</div><div>{c}</div>", f"Title of it Lead. {c}"),
        (f"{lead}<div>{c}</div>", f"{lead} {c}"),
        (f"<article><header><h1>Title</h1></header>{a}</article>", f"Title {a}"),
        (f'<article>{a}<section id="social-policy">{b}</section><h2 id="search">Search</h2>{a}</article>', f"{a}{b} Search {a}"),
        (f'<div>{a}<section id="search-engines">{b}</section></div>', a + b),
    ):
        for before in ("", nav, "<header>Name of the site</header>", '<div id="search-box">Search for it</div><div id="cookie-banner2 ad-slot-1">Ad</div>'):
            assert pages.main_text(f"<body>{before}{page}{nav}</body>") == plain(want), page[:60]


def random_tree(depth):
    """A page as nested lists: name, then texts and elements."""
    name = RNG.choice(["div", "section", "p"] if depth else ["div"])
    if name == "p" or depth > 4:
        return ["p", *[RNG.choice([words(RNG.randint(1, 30)), ["a", words(2)], ["b", words(3)]]) for _ in range(RNG.randint(0, 4))]]
    return [name, *[random_tree(depth + 1) if RNG.random() < 0.8 else words(4) for _ in range(RNG.randint(0, 5))]]


def test_page_densities_against_a_plain_version():
    def html(t):
        return t if isinstance(t, str) else f"<{t[0]}>{''.join(map(html, t[1:]))}</{t[0]}>"

    def count(t, in_link=False):
        """(characters, tags, characters in links, links) below an element, counted from nothing else."""
        if isinstance(t, str):
            n = sum(not ch.isspace() for ch in t)
            return np.array([n, 0, n * in_link, 0])
        return sum((count(x, in_link or t[0] == "a") + [0, (x[0] != "b") * 1, 0, (x[0] == "a") * 1] if isinstance(x, list) else count(x, in_link or t[0] == "a") for x in t[1:]), np.zeros(4, int))

    def density(t, page):
        chars, tags, link_chars, link_tags = map(int, count(t))
        if not chars:
            return 0.0
        ratio = chars / max(1, link_chars) * max(1, tags) / max(1, link_tags)
        base = np.log(chars / max(1, chars - link_chars) * link_chars + page[2] / max(1, page[0]) * chars + np.e)
        return chars / max(1, tags) * max(0.0, np.log(ratio)) / max(1.0, np.log(base))

    def nodes(t):
        yield t
        for x in t[1:]:
            if isinstance(x, list) and x[0] not in ("a", "b"):
                yield from nodes(x)

    for _ in range(150):
        tree = ["body", *[random_tree(0) for _ in range(3)]]
        page = count(tree)
        blocks = pages.weigh(pages.parse(html(tree)))
        plain_nodes = list(nodes(tree))
        assert [b.name for b in blocks] == [t[0] for t in plain_nodes]
        for b, t in zip(blocks, plain_nodes, strict=True):
            assert b.density == pytest.approx(density(t, page))
            inner = sum(density(x, page) if x[0] not in ("a", "b") else 0 for x in t[1:] if isinstance(x, list))
            own = sum(int(count(x, False)[0]) for x in t[1:] if isinstance(x, str) or x[0] in ("a", "b"))
            assert b.sum == pytest.approx(inner + own)


def test_long_runs_and_every_language_are_learned(spark):
    rng = random.Random(2)
    assert langid.words_of("Ab " + "x" * 85) == ["ab", "x" * 40, "x" * 40, "x" * 5]
    # two languages without spaces: they differ behind the first 40 letters only
    ends = {"aa": "pqr", "bb": "stu"}
    rows = [(i, "".join(rng.choices("xyz", k=40)) + "".join(rng.choices(ends[x], k=200)), x) for i, x in enumerate(["aa", "bb"] * 40)]
    # and more languages than 200, each with a word of its own
    rows += [(1000 + i, " ".join(["w" + "".join("abcdefghij"[int(c)] for c in f"{i // 8:03}")] * 12), f"l{i // 8:03}") for i in range(8 * 210)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    two = langid.fit(docs.where("lang in ('aa', 'bb')"))
    assert langid.identify_texts(two, [r[1] for r in rows[:80]])[0] == [r[2] for r in rows[:80]]
    assert len(langid.fit(docs, sample_docs=8, rounds=1).langs) == 212
