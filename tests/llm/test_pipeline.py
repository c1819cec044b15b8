"""The pipeline on a small table, stage by stage against plain versions of what each stage decides."""

import random

import pytest

import corpus_pipeline
from allelespan.llm import langid, minhash, mixing, secrets

RNG = random.Random(3)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    kinds = {"en": "the of and ing tion".split(), "de": "der die und ung keit".split()}
    rows = []
    for i in range(120):
        lang = RNG.choice(["en", "de"])
        text = " ".join("".join(RNG.choices(kinds[lang], k=RNG.randint(1, 3))) for _ in range(60))
        if i % 10 == 9:
            text = rows[-1][1]
        if i % 7 == 0:
            text += " password=hunter2xyz123"
        rows.append((i, text, lang, RNG.choice(["a", "b", None]), len(text)))
    rows += [(500, None, "en", "a", 0), (501, "12 34", "en", "a", 5)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, folder)
    ids = {r.doc_id for r in known.select("doc_id").collect()}
    assert known.columns == columns and ids == set(range(120))
    one = stages["near_dedup"](spark, known, folder)
    kept = {r.doc_id for r in minhash.near_duplicates(known).collect() if r.kept}
    assert one.columns == columns and {r.doc_id for r in one.collect()} == kept and len(kept) < 120
    clean = stages["secret_scans"](spark, one, folder)
    assert clean.columns == columns and clean.where("text like '%hunter2%'").count() == 0
    assert clean.where("n_chars != length(text)").count() == 0 and clean.count() == len(kept)
    assert all(not secrets.base_spans(r.text) for r in clean.collect())
    mixed = stages["source_mixing"](spark, clean, folder)
    taken = sum(r.taken for r in mixing.mix(clean).collect())
    assert mixed.columns == columns and sum(len(r.text.split()) for r in mixed.collect()) == taken
    tokens = stages["byte_bpe"](spark, mixed, folder)
    assert tokens.count() == mixed.count()


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r.n_tokens > 0 for r in rows)


def test_near_dedup_links_from_four_fifths(spark):
    def shingles(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    texts = []
    for _ in range(12):
        base = ["".join(RNG.choices("abcdefgh", k=6)) for _ in range(120)]
        texts.append(base)
        for n in (8, 10, 11, 12, 13, 14, 16):
            texts.append(base[:-n] + ["".join(RNG.choices("abcdefgh", k=6)) for _ in range(n)])
    texts = [" ".join(t) for t in texts]
    sets, low = [shingles(t) for t in texts], list(range(len(texts)))
    alike = [len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[:i]]
    assert any(0.8 <= x < 0.85 for x in alike) and any(0.7 < x < 0.8 for x in alike)
    for _ in texts:  # smallest id over links, until nothing moves
        low = [min(low[j] for j, b in enumerate(sets) if 5 * len(a & b) >= 4 * len(a | b)) for a in sets]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")
    assert {r.doc_id for r in got.collect()} == {i for i, x in enumerate(low) if i == x}


def test_language_stage_keeps_switched_and_unlabelled_texts(spark):
    kinds = {"en": "the of and ing tion", "de": "der die und ung keit", "fr": "eau oux ette elle que", "it": "zzo gli cchi ssimo nno"}

    def text(lang, n):
        return " ".join("".join(RNG.choices(kinds[lang].split(), k=RNG.randint(1, 3))) for _ in range(n))

    rows = [(i, text(lang, 60), lang) for i, lang in enumerate(list(kinds) * 30)]
    rows += [(900, " ".join(text(lang, n) for lang, n in (("en", 40), ("de", 35), ("fr", 30))), None)]
    rows += [(901, " ".join(text(lang, 30) for lang in kinds), "en"), (902, "1 2", "en"), (903, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    assert {r.doc_id for r in stage(spark, docs, "").collect()} == {*range(120), 900, 901}
    # nothing to learn from: what has letters stays
    blank = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.doc_id for r in stage(spark, blank, "").collect()} == {*range(120), 900, 901}


def test_language_stage_rejects_random_letters(spark):
    kinds = {"en": "the of and ing tion", "de": "der die und ung keit", "ru": "\u043d\u0430 \u043f\u043e \u0435\u043d\u0438\u0435 \u0441\u0442\u0432 \u043e\u0439"}

    def text(lang, n):
        return " ".join("".join(RNG.choices(kinds[lang].split(), k=RNG.randint(1, 3))) for _ in range(n))

    def noise(n, letters="abcdefghijklmnopqrstuvwxyz"):
        return " ".join("".join(RNG.choices(letters, k=RNG.randint(3, 9))) for _ in range(n))

    rows = [(i, text(lang, 60), lang) for i, lang in enumerate(list(kinds) * 60)]
    rows += [(200 + i, noise(40), None if i % 4 else RNG.choice(["en", "de", None])) for i in range(40)]
    # some of them with a label, and letters that the languages do have
    rows += [(300 + i, noise(40, sorted(set("".join(kinds["de"].split())))), None) for i in range(10)]
    mixed = [text("en", 25) + " " + text("ru", 20) + " " + text("de", 20) for _ in range(10)]
    rows += [(400 + i, t, None) for i, t in enumerate(mixed)]
    rows += [(500 + i, text("en", 30) + " " + noise(8) + " " + text("de", 10), "en") for i in range(10)]
    rows += [(600, "und", None), (601, "", "en"), (None, text("de", 30), None), (None, text("de", 30), None), (602, "Kqzx", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    got = stage(spark, docs, "").collect()
    ids = {r.doc_id for r in got}
    assert ids >= {*range(180), *range(400, 410), *range(500, 510), 600, None}
    assert not ids & {*range(200, 240), *range(300, 310), 601}
    model = langid.fit(docs)
    many = [noise(3000), text("en", 50), noise(3000)]
    assert [x >= 0.5 for x in langid.read_texts(model, many)[3]] == [False, True, False]
    assert [r.lang for r in got if r.doc_id is None] == ["de", "de"] and all(r.lang for r in got)
    assert stage(spark, docs.limit(0), "").count() == 0
