"""The registered query of each operator: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, codes, decontaminate, exact_dedup, licenses, mixing, quality, repeats, search, simhash, token_counts, toxicity, urls
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.learn(docs, labels, part=0, of=5))
    return scored.select("doc_id", toxicity.held_out(0, 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


WORDS_SQL = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATE_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS ws FROM benchmark),
g AS (
  SELECT DISTINCT item_id, len, array_to_string(ws[i : i + len - 1], ' ') AS gram
  FROM (SELECT item_id, ws, least(10, len(ws)) AS len, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
p AS (
  SELECT doc_id, i, l.len, array_to_string(ws[i : i + l.len - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d), (SELECT DISTINCT len FROM g) AS l
  WHERE i + l.len - 1 <= len(ws)),
h AS (SELECT p.doc_id, p.i, p.len, g.item_id FROM p JOIN g ON p.gram = g.gram AND p.len = g.len),
n AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + len)) AS w FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(n.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
  coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


@query("op2_decontaminate", DECONTAMINATE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.report(decontaminate.scan(docs, benchmark, n=10))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, limit=512)


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=4, most=4)


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query("op6_exact_dedup", EXACT_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return exact_dedup.duplicates(docs, exact_dedup.first_half())


@query("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.TEMPLATES)

LICENSES_SQL = f"""
WITH t AS (SELECT name, list_distinct([ws[i : i + 1] FOR i IN range(1, len(ws))]) AS g FROM (SELECT name, {WORDS_SQL} AS ws FROM (VALUES {TEMPLATE_ROWS}) AS v(name, text))),
l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS text FROM documents),
g AS (SELECT doc_id, line, list_distinct([ws[i : i + 1] FOR i IN range(1, len(ws))]) AS g
      FROM (SELECT doc_id, row_number() OVER () AS line, {WORDS_SQL} AS ws FROM l)),
m AS (SELECT g.doc_id, g.line, t.name, 2 * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS dice FROM g, t WHERE len(g.g) BETWEEN len(t.g) / 2 AND 2 * len(t.g)),
b AS (SELECT doc_id, line, arg_min(name, (-dice, name)) AS name, max(dice) AS dice FROM m WHERE dice >= {licenses.THRESHOLD} GROUP BY doc_id, line)
SELECT d.doc_id, count(b.line) AS n_lines, coalesce(string_agg(DISTINCT b.name, ',' ORDER BY b.name), '') AS licenses, coalesce(max(b.dice), 0.0) AS best_dice
FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id GROUP BY d.doc_id
"""


@query("op4_license_scan", LICENSES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned texts of all documents, and how many sentences each has lost."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs, count="n_removed").select("doc_id", "n_removed", "text")


RULES = [
    urls.Rule("block", "net/"),
    urls.Rule("allow", "example.net/en/"),
    urls.Rule("block", "example.com/de/"),
    urls.Rule("allow", "org/fr/"),
]


def _terms_sql(terms: str) -> str:
    return " + ".join(f"CAST(regexp_matches(u, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INTEGER)" for t in terms.split())


def _rules_sql() -> str:
    longest = sorted(RULES, key=lambda r: (-len(r.text), r.text))
    return "\n".join(
        f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND prefix(path, '{r.path}') THEN '{r.verdict} {r.text}'" for r in longest
    )


URLS_SQL = f"""
WITH l AS (SELECT page_id, coalesce(url, '') AS url,
  translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u FROM pages),
h AS (SELECT page_id, u, regexp_extract(u, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM l),
t AS (SELECT *, CAST({_terms_sql(urls.STRICT)} AS INTEGER) AS strict_terms, CAST({_terms_sql(urls.SOFT)} AS INTEGER) AS soft_terms FROM h),
r AS (SELECT *, CASE {_rules_sql()} END AS best FROM t)
SELECT page_id, host, path, split_part(best, ' ', 2) AS rule,
  coalesce(split_part(best, ' ', 1), CASE WHEN strict_terms > 0 OR soft_terms >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
  strict_terms, soft_terms
FROM r
"""


@query("op7_url_filter", URLS_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages"), RULES)


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.score_documents(docs, labels, part=1, of=3)


MIXING_SQL = """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
r AS (SELECT doc_id, source, CAST(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
  -ln((CAST('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', t)), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496)
    / (0.1::DOUBLE + 0.9::DOUBLE * len(list_distinct(lines)) / len(lines)) AS drawn FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM r GROUP BY source),
c AS (SELECT *, 3 * source_size AS cap, row_number() OVER o AS place,
  CAST(sum(source_size) OVER () AS BIGINT) - (sum(3 * source_size) OVER o - 3 * source_size) AS still,
  sum(weight) OVER () - (sum(weight) OVER o - weight) AS free
  FROM s WINDOW o AS (ORDER BY 3 * source_size / weight, source ROWS UNBOUNDED PRECEDING)),
l AS (SELECT arg_min(CAST(still AS DOUBLE) / CAST(free AS DOUBLE), place) AS level FROM c WHERE CAST(still AS DOUBLE) / CAST(free AS DOUBLE) * weight <= cap),
t AS (SELECT source, source_size, least(weight * level, CAST(cap AS DOUBLE)) AS target FROM c, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
p AS (SELECT doc_id, r.source, size, source_size, target, epochs, target - epochs * source_size AS rest,
  sum(size) OVER (PARTITION BY r.source ORDER BY drawn, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source),
k AS (SELECT *, CASE WHEN size > 0 THEN epochs + CAST(2 * before + size <= 2 * rest AS BIGINT) ELSE 0 END AS copies FROM p)
SELECT doc_id, source, size, source_size, target, copies, size * copies AS taken FROM k
"""


@query("op11_mixing", MIXING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


TERMS_SQL = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

SEARCH_SQL = f"""
WITH d AS (SELECT doc_id, {TERMS_SQL} AS ts FROM documents),
c AS (SELECT count(*) AS n_docs, CAST(coalesce(sum(len(ts)), 0) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark) GROUP BY item_id, term),
f AS (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM f WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, c GROUP BY term, n_docs),
i AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))) AS impact FROM p JOIN w USING (term), c),
s AS (SELECT item_id, doc_id, CAST(sum(qtf * impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER b AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW b AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER b <= 10
"""


@query("op12_search", SEARCH_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return search.search(docs, benchmark, k=10)


def _codes_sql(rounds: int = codes.ROUNDS) -> str:
    parts = """
v AS MATERIALIZED (SELECT vec_id, label, [CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
p AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label, j, x[j * (len(x) // 4) + 1 : (j + 1) * (len(x) // 4)] AS x FROM v, range(4) AS r(j)),
c0 AS MATERIALIZED (SELECT j, e, x AS entry FROM (SELECT j, x, row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS e FROM p) WHERE e < 256)"""
    for k in range(rounds + 1):
        parts += f""",
a{k} AS MATERIALIZED (SELECT row, arg_min(e, far) AS e, min(far[1]) AS error
  FROM (SELECT row, e, [list_sum([(a[1] - a[2]) * (a[1] - a[2]) FOR a IN list_zip(x, entry)]), e] AS far FROM p JOIN c{k} USING (j)) GROUP BY row)"""
        if k < rounds:
            parts += f""",
m{k} AS (SELECT j, e, list(mean ORDER BY i) AS entry FROM (
  SELECT j, e, i, CAST(floor(CAST(sum(c) AS DOUBLE) / count(*)) AS BIGINT) AS mean FROM (
    SELECT j, e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS c FROM p JOIN a{k} USING (row)) GROUP BY j, e, i) GROUP BY j, e),
c{k + 1} AS MATERIALIZED (SELECT j, e, coalesce(m{k}.entry, c{k}.entry) AS entry FROM c{k} LEFT JOIN m{k} USING (j, e))"""
    return f"""
WITH {parts},
k AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY j, e)) AS codebooks_sha256 FROM c{rounds}),
o AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY j) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM p JOIN a{rounds} USING (row) GROUP BY vec_id, label)
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o, k
"""


@query("op13_codes", _codes_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.encode(read_table(spark, sf_dir, "embeddings"))
