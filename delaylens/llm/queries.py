"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from delaylens.llm import align, bpe, decontaminate, hnsw, jaccard, langid, lm, pii, preference, quality, repair, urlfilter, warc
from delaylens.llm.common import held_out, table
from delaylens.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a job under `name`."""

    def register(job: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: job(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 4))
    net = langid.fit(documents.where("not held_out"), "text", "lang", "doc_id")
    return langid.identify(documents, "text", ["doc_id", "held_out"], net)


@query("op2_quality_compression")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 4))
    seen = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 4))
    model = quality.fit(documents.where("not held_out"), seen, "text", "doc_id", "quality")
    return quality.score(documents, "text", ["doc_id", "held_out"], model)


OP3_SQL = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM turns
), ending AS (
  SELECT conv_id, max(i) AS last, arg_max(text, i) AS reply FROM placed WHERE role = 'assistant' GROUP BY conv_id
), sides AS (
  SELECT p.conv_id, p.i, p.role, p.text AS c, CASE WHEN p.i = e.last THEN coalesce(n.reply, '') ELSE p.text END AS r
  FROM placed p JOIN ending e USING (conv_id) LEFT JOIN ending n ON n.conv_id = xor(p.conv_id, 1)
), split AS (
  SELECT *, coalesce(min(CASE WHEN c <> r THEN i END) OVER (PARTITION BY conv_id) - 1, max(i) OVER (PARTITION BY conv_id)) AS k FROM sides
), long AS (
  SELECT conv_id, k, i, 'chosen' AS side, role, c AS text FROM split UNION ALL SELECT conv_id, k, i, 'rejected', role, r FROM split
), shown AS (
  SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown FROM long
), measured AS (
  SELECT *, sum(CASE WHEN i > k THEN length(shown) ELSE 0 END) OVER (PARTITION BY conv_id, side ORDER BY i) AS stop FROM shown
)
SELECT conv_id, CAST(max(k) AS BIGINT) AS n_prompt_turns,
  sha256(coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE side = 'chosen' AND i <= k), '')) AS prompt_sha256,
  sha256(coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE side = 'chosen' AND i > k), '')) AS chosen_sha256,
  sha256(coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE side = 'rejected' AND i > k), '')) AS rejected_sha256,
  coalesce(string_agg(CAST(stop - 11 - length(text) AS BIGINT) || '-' || CAST(stop - 1 AS BIGINT), ',' ORDER BY i)
    FILTER (WHERE side = 'chosen' AND i > k AND role = 'assistant'), '') AS chosen_spans,
  coalesce(string_agg(CAST(stop - 11 - length(text) AS BIGINT) || '-' || CAST(stop - 1 AS BIGINT), ',' ORDER BY i)
    FILTER (WHERE side = 'rejected' AND i > k AND role = 'assistant'), '') AS rejected_spans
FROM measured GROUP BY conv_id
"""


@query("op3_preference_format", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.swapped_replies(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return preference.digests(preference.format_pairs(pairs, "conv_id"), "conv_id")


@query("op4_bpe_word_table")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), "text", ["doc_id"], bpe.public_tokenizer())


OP8_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], chr(31)) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM worded WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT w.y, r.c FROM reach r JOIN ways w ON w.x = r.d
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT d AS doc_id, min(c) AS component_id FROM reach GROUP BY 1) USING (doc_id)
"""


@query("op8_ngram_jaccard_join", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), "text", "doc_id", width=4, percent=85)


OP10_SQL = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), occurring AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, n, item_id FROM occurring JOIN windows USING (n, phrase)
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS digest FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op10_benchmark_decontamination", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(documents, benchmark, "doc_id", "text", "item_id", "text")


@query("op7_lm_scoring")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 7))
    return lm.score(documents, "text", "doc_id", "held_out", documents.where("not held_out"))


# base32 is spelled out: the 160 bits of the digest in 32 groups of five
OP5_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY sha256(payload)) AS first FROM payloads
), bits AS (
  SELECT *, array_to_string(list_transform(range(40), lambda i: lpad(bin(strpos('0123456789abcdef', hex[i + 1]) - 1), 4, '0')), '') AS bits FROM hashed
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST(
    list_sum(list_transform(range(5), lambda j: CAST(bits[i * 5 + j + 1] AS INTEGER) * CAST(power(2, 4 - j) AS INTEGER))) AS INTEGER) + 1]), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
"""


@query("op5_warc_dictionary", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), "page_id", "url", "html")


#: Of op9's contract, in its order.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


# what the seeds say alone: no page of these tables links to another host (a test
# holds that), so nothing flows; tests of the operator cover the flow
OP9_SQL = """
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages
), hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests
), parsed AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest[length(raw) + 1:], '^[^?#]*') AS path FROM hosts
), rules AS (
  SELECT *, split_part(rule, '/', 1) AS h, rule[length(split_part(rule, '/', 1)) + 1:] AS p
  FROM (VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')) r(v, rule)
), ruled AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
  FROM parsed LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN host <> ''
  AND avg(CASE WHEN v = 'block' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY host) - avg(CASE WHEN v = 'allow' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY host) > 0.5
  THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""


@query("op9_url_trust", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), RULES, "page_id", "url", "html")


@query("op6_hnsw_search")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0, 20)


# crc32 spelled out; the cheapest edits by state, row by row: a recursion keeps the
# least (cost, audit, repaired) for each conversation and state 0 none, 1 system, 2 user, 3 assistant
OP11_SQL = r"""
WITH RECURSIVE named AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), harmed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS harm
  FROM named
), damaged AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM harmed, range(2) copies(k) WHERE harm <> 0 AND (k = 0 OR harm = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM placed
), inserts(q, q2, edits, price, said) AS (
  VALUES (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []), (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']),
    (3, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']), (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:'])
), moves(q, initial, q2, edit, price, who) AS (
  VALUES (0, 's', 1, 'K', 0, NULL), (0, 'u', 2, 'K', 0, NULL), (1, 'u', 2, 'K', 0, NULL), (2, 'a', 3, 'K', 0, NULL), (3, 'u', 2, 'K', 0, NULL),
    (0, NULL, 2, 'R', 1, 'user'), (1, NULL, 2, 'R', 1, 'user'), (3, NULL, 2, 'R', 1, 'user'), (2, NULL, 3, 'R', 1, 'assistant'),
    (0, NULL, 0, 'D', 2, NULL), (1, NULL, 1, 'D', 2, NULL), (2, NULL, 2, 'D', 2, NULL), (3, NULL, 3, 'D', 2, NULL)
), best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS way FROM conversations
  UNION ALL
  SELECT b.conv_id, b.i + 1, m.q2, min({'cost': b.way.cost + n.price + m.price + CASE WHEN m.edit <> 'D' AND r.fault = 'truncated' THEN 5 ELSE 0 END,
    'audit': b.way.audit || n.edits || m.edit,
    'lines': b.way.lines || n.said || CASE WHEN m.edit = 'D' THEN CAST([] AS VARCHAR[]) ELSE [coalesce(m.who, r.role) || ':' || r.text] END})
  FROM best b JOIN marked r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1 JOIN inserts n ON n.q = b.q
    JOIN moves m ON m.q = n.q2 AND (m.initial IS NULL OR m.initial = r.role[1]) AND (m.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
  GROUP BY 1, 2, 3
), sizes AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY 1
), done AS (
  SELECT b.conv_id, any_value(s) AS s, min({'cost': b.way.cost + n.price, 'audit': b.way.audit || n.edits, 'lines': b.way.lines || n.said}) AS way
  FROM best b LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM b.conv_id JOIN inserts n ON n.q = b.q
  WHERE b.i = coalesce(s.n, 0) AND n.q2 IN (0, 3) GROUP BY 1
)
SELECT conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate, coalesce(s.truncated, 0) AS truncated,
  coalesce(s.illegal, 0) AS illegal, CAST(way.cost AS BIGINT) AS cost, way.audit AS audit, sha256(array_to_string(way.lines, chr(10))) AS repaired_sha256
FROM done
"""


@query("op11_conversation_repair", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damaged(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return repair.report(rows, "conv_id", "turn", "role", "text", F.col("present"))


@query("op12_disclosed_terms")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.report(table(spark, sf_dir, "documents"), "text", ["doc_id"], bpe.public_tokenizer(), align.public_model())


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
