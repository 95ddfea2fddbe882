"""Registered queries of the operators, each over its whole table, and SQL for the same rows where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import (
    bpe_automaton,
    cholesky_qr,
    lines,
    minmax,
    packing,
    quality,
    recompression,
    repair,
    suffix_array,
    token_file,
    toxicity,
    urls,
    winnow,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return suffix_array.remove_repeats(docs, texts_too=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op2_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query
def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "template")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_decisions(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "line_no", "n_tokens", "class_doc", "class_line", "kept")


@query
def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_file.token_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85, rows=4)


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_words(_table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op10_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return recompression.remove_repeats(docs, texts_too=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op11_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cholesky_qr.whitened(_table(spark, sf_dir, "embeddings"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(turns), turns)


@query
def op13_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_automaton.round_trip_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op2_winnowing_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, s, m, array_to_string(w[s : s + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS s FROM d, (SELECT DISTINCT m FROM iw))
), hit AS (
  SELECT doc_id, s, m, item_id FROM dw JOIN iw USING (m, win)
), n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + m - 1)) AS p FROM hit) GROUP BY doc_id
), i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""

_LEVEL = """
, c{d} AS (
  SELECT host, template, segments[{n}] AS segment, count(*) AS n FROM l{d} WHERE len(segments) >= {n} GROUP BY ALL
), k{d} AS (
  SELECT host, template, segment FROM c{d} JOIN (SELECT host, template, sum(n) AS total FROM c{d} GROUP BY ALL) USING (host, template)
  WHERE n >= 5 AND n >= 0.01 * total
), l{n} AS (
  SELECT l.* EXCLUDE (template), l.template || CASE WHEN len(l.segments) < {n} THEN '' WHEN k.segment IS NULL THEN '/*'
         ELSE '/' || k.segment END AS template
  FROM l{d} l LEFT JOIN k{d} k ON l.host = k.host AND l.template = k.template AND l.segments[{n}] = k.segment
)"""

ORACLES["op3_url_templates"] = (
    r"""
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u
), r(own, start, says) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), f AS (
  SELECT page_id, arg_max(own || start, len(own || start)) AS rule, arg_max(says, len(own || start)) AS says
  FROM p, r WHERE (host = own OR ends_with(host, '.' || own)) AND starts_with(path, start) GROUP BY page_id
), l0 AS (
  SELECT page_id, host, path, rule, says, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, '' AS template
  FROM p LEFT JOIN f USING (page_id)
)"""
    + "".join(_LEVEL.format(d=d, n=d + 1) for d in range(4))
    + r"""
, t AS (
  SELECT page_id, host, path, rule, says, template || CASE WHEN len(segments) > 4 THEN '/**' ELSE '' END AS template FROM l4
), nodes AS (
  SELECT host, template, count(*) AS n, count(*) FILTER (says = 'block') AS b, count(*) FILTER (says = 'allow') AS a FROM t GROUP BY ALL
), e AS (
  SELECT template, (sum(b) + 4.0 * (SELECT sum(b) / greatest(1, sum(a) + sum(b)) FROM nodes)) / (sum(a) + sum(b) + 4.0) AS rate
  FROM nodes GROUP BY template
), o AS (
  SELECT nodes.*, rate, (b + 4.0 * rate) / (a + b + 4.0) AS own, regexp_replace(template, '/[^/*][^/]*', '/w', 'g') AS shape
  FROM nodes JOIN e USING (template)
), s AS (
  SELECT *, CASE WHEN own - 1.96 * sqrt(own * (1 - own) / (a + b + 4.0)) > 0.5 THEN 1
                 WHEN own + 1.96 * sqrt(own * (1 - own) / (a + b + 4.0)) < 0.5 THEN -1 ELSE 0 END AS side FROM o
), m AS (
  SELECT host, shape, side, (sum(b) + 4.0 * sum(rate * n) / sum(n)) / (sum(a) + sum(b) + 4.0) AS purity FROM s GROUP BY ALL
), v AS (
  SELECT host, template, purity FROM s JOIN m USING (host, shape, side)
)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN purity >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template
FROM t JOIN v USING (host, template)
"""
)

_WORD_SET = f"list_sort(list_distinct(regexp_extract_all(lower(line), '[^\\x20\\x09-\\x0D]+')))"

ORACLES["op4_line_dedup"] = f"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL
), l AS (
  SELECT doc_id, line_no, {_WORD_SET} AS w FROM raw
), c AS (
  SELECT w, min({{'d': doc_id, 'n': line_no}}) AS head, len(w) AS size FROM l WHERE len(w) > 0 GROUP BY w
), t AS (
  SELECT head, size, unnest(w) AS token FROM c
), pairs AS (
  SELECT x.head AS later, y.head AS earlier, x.size AS a, y.size AS b, count(*) AS n
  FROM t x JOIN t y ON x.token = y.token AND y.head < x.head AND 100 * y.size >= 90 * x.size AND 100 * x.size >= 90 * y.size
  GROUP BY ALL
), gone AS (
  SELECT DISTINCT later FROM pairs WHERE 100 * n >= 90 * (a + b - n)
)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(len(l.w) AS INTEGER) AS n_tokens, head.d AS class_doc,
       CAST(head.n AS INTEGER) AS class_line,
       len(l.w) = 0 OR (head.d = doc_id AND head.n = line_no AND later IS NULL) AS kept
FROM l LEFT JOIN c ON l.w = c.w LEFT JOIN gone ON head = later
"""

ORACLES["op7_near_duplicates"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_ AS (
  SELECT a AS doc_id, min(b) AS lowest FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(lowest, doc_id)) AS component_id,
       doc_id <= coalesce(lowest, doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_ USING (doc_id)
"""

ORACLES["op10_recompression_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, s, array_to_string(w[s : s + 49], ' ') AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS s FROM w WHERE len(w) >= 50)
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS p FROM (
    SELECT doc_id, unnest(generate_series(s, s + 49)) AS p
    FROM win JOIN (SELECT k, min(doc_id) AS first FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)) USING (k)
    WHERE first < doc_id
  ) GROUP BY doc_id
), left_ AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w
  ) LEFT JOIN gone USING (doc_id) WHERE p IS NULL OR NOT list_contains(p, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN left_ USING (doc_id)
"""
