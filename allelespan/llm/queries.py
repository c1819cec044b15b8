"""The registered queries of the operators, each over its whole table, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from allelespan.llm import bpe, fingerprint, langid, minhash, mixing, packing, pages, phrases, quality, ranking, secrets, suffixes, urls
from allelespan.llm.common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sources: str, run: Callable[..., DataFrame], sql: str | None = None) -> None:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(*(table(spark, sf_dir, source) for source in sources.split()))

    call.__name__, call.__doc__ = key, run.__doc__
    QUERIES[key] = call
    if sql:
        ORACLE[key] = sql


_WORDS = r"coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])"

_LEVEL = """
SELECT {keys}, max(docs) AS docs, {bounds} FROM (
 SELECT {keys}, signal, docs, q1, q3, {reach} * greatest(q3 - q1, CASE signal {least} END) AS reach FROM (
  SELECT {keys}, signal, max(total) AS docs, min(CASE WHEN upto * 4 >= total THEN bin END) AS q1,
   min(CASE WHEN upto * 4 >= total * 3 THEN bin END) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}, signal ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {keys}, signal) AS total
   FROM (SELECT {keys}, signal, bin, sum(n) AS n FROM sketch GROUP BY {keys}, signal, bin))
  GROUP BY {keys}, signal)) GROUP BY {keys}"""


def _quality_sql() -> str:
    sides = [(s, side) for s in quality.SIGNALS for side in ("low", "high")]
    value = {"low": "q1 - reach", "high": "q3 + reach"}
    bounds = ", ".join(f"max(CASE WHEN signal = '{s}' THEN {value[side]} END) AS {s}_{side}" for s, side in sides)
    least = " ".join(f"WHEN '{s}' THEN {n}" for s, n in quality.LEAST.items())
    level = {name: _LEVEL.format(keys=keys, bounds=bounds, least=least, reach=quality.REACH) for name, keys in (("fine", "lk, sk"), ("by_lang", "lk"), ("by_all", "every"))}
    signals = {s: e.replace(" div ", " // ") for s, e in quality.SIGNALS.items()}
    rows = " UNION ALL ".join(f"SELECT lk, sk, '{s}' AS signal, {e} AS value FROM judged WHERE NOT base_failed" for s, e in signals.items())
    pick = ", ".join(
        f"CASE WHEN f.docs >= {quality.MIN_GROUP} THEN f.{s}_{side} WHEN l.docs >= {quality.MIN_GROUP} THEN l.{s}_{side} ELSE a.{s}_{side} END AS {s}_{side}"
        for s, side in sides
    )
    high = " OR ".join(f"({signals[s]}) > {s}_high" for s in ("symbols", "upper", "dup_lines"))
    out = " AND ".join(f"(({signals[s]}) > {s}_high OR ({signals[s]}) < {s}_low)" for s in ("word_length", "short"))
    return rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('s' || lang, 'n') AS lk, coalesce('s' || source, 'n') AS sk,
  coalesce(text, '') AS text, {_WORDS} AS w,
  [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM documents),
win AS (SELECT r, i, w[i:i + 4] AS k FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM again, (SELECT unnest(range(5)) AS j) GROUP BY r),
counted AS (SELECT d.r, doc_id, lk, sk, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_upper,
  len([x FOR x IN w IF length(x) <= 3]) AS n_short FROM d LEFT JOIN covered c ON c.r = d.r),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
signals AS ({rows}),
sketch AS (SELECT lk, sk, 0 AS every, signal, (value >> cut) << cut AS bin, count(*) AS n
  FROM (SELECT *, greatest(0, length(bin(value)) - 6) AS cut FROM signals) GROUP BY ALL),
fine AS ({level["fine"]}), by_lang AS ({level["by_lang"]}), by_all AS ({level["by_all"]}),
limits AS (SELECT f.lk, f.sk, {pick} FROM fine f JOIN by_lang l ON l.lk = f.lk, by_all a)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
 CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
 CASE WHEN base_failed THEN false ELSE NOT ({high} OR ({out})) END AS kept
FROM judged j LEFT JOIN limits m ON m.lk = j.lk AND m.sk = j.sk"""


_COMPONENTS_SQL = rf"""WITH RECURSIVE d AS (SELECT doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + 4] AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {minhash.PERCENT} * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, d.doc_id) AS component_id, d.doc_id = coalesce(c, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id"""

_WEIGHT = "CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {n} {cases} END".format(
    n=len(mixing.WEIGHTS), cases=" ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
)

_MIX_SQL = rf"""WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
  md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null|' || md5(coalesce(text, '')))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, {_WEIGHT} AS weight, {mixing.EPOCHS} * source_size AS cap FROM s),
o AS (SELECT *, sum(source_size) OVER () * {mixing.SHARE} AS total, CAST(sum(weight) OVER () AS BIGINT) AS all_weight,
  CAST(coalesce(sum(cap) OVER before, 0) AS BIGINT) AS cap_before, CAST(coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weight_before FROM w
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (CAST(total AS DOUBLE) - cap_before) * weight / (all_weight - weight_before) >= cap AS capped FROM o),
t AS (SELECT *, CAST(coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS BIGINT) AS cap_sum,
  CAST(coalesce(sum(CASE WHEN NOT capped THEN weight END) OVER (), 0) AS BIGINT) AS rest FROM c),
g AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE (CAST(total AS DOUBLE) - cap_sum) * weight / rest END AS target FROM t),
r AS (SELECT d.*, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
  CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS place
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
f AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM r)
SELECT doc_id, size, source_size, target,
 CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - place)) AS BIGINT) AS taken FROM f"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_PHRASES_SQL = rf"""WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang,
  unnest(regexp_split_to_array({_LOW}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), (SELECT unnest(range(1, {phrases.LONGEST + 1})) AS k)
  WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT lang, phrase, f AS a, i, array_to_string(w[:i], ' ') AS head, array_to_string(w[i + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
scored AS (SELECT cuts.lang, cuts.phrase, a, i, x.f AS l, y.f AS r, (2000000 * a) // (x.f + y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail),
chosen AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inside AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - n + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS n FROM c)) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
 CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM chosen JOIN t USING (lang) LEFT JOIN inside USING (lang, phrase) WHERE coalesce(100 * longer < {phrases.COVERED} * a, true)
QUALIFY rank <= {phrases.TOP}"""

_TERMS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_SEARCH_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS w FROM documents),
q AS (SELECT DISTINCT i, item_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS wt FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
m AS (SELECT d, doc_id, 100 - 50 + (50 * len(w) * n) // l AS m FROM d, s WHERE len(w) > 0),
scores AS (SELECT i, item_id, d, doc_id, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN wt USING (term) JOIN m USING (d) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {ranking.TOP}"""

query("op1_quality_rules", "documents", quality.judge, _quality_sql())
query("op2_minhash_near_dedup", "documents", minhash.near_duplicates, _COMPONENTS_SQL)
query("op3_secret_scans", "documents", secrets.scan)
query("op4_html_extraction", "pages", pages.extract)
query("op5_document_fingerprints", "documents", fingerprint.compare_with_next)
query("op6_language_id", "documents", langid.identify)
query("op7_byte_bpe", "documents", bpe.token_digests)
query("op8_suffix_array_dedup", "documents", suffixes.removal_digests)
query("op9_url_filters", "pages", urls.judge_urls)
query("op10_source_mixing", "documents", mixing.mix, _MIX_SQL)
query("op11_phrase_collocations", "documents", phrases.collocations, _PHRASES_SQL)
query("op12_ranked_search", "documents benchmark", ranking.search, _SEARCH_SQL)
query("op13_best_fit_packing", "documents", packing.pack)
