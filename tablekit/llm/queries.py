"""The operators' queries over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import bpe, decontaminate, html_extract, near_dup, quality, secrets, substring_dup, toxicity, url_filter, warc
from tablekit.llm.common import table

#: The rules of op10: (action, host, path).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.findings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "representative")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocabulary = table(spark, sf_dir, "documents"), bpe.read_vocabulary(tokenizer_path())
    decoded = bpe.encode(docs, vocabulary, bpe.compile_lexicon(docs, vocabulary), decoded=True)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index, path = warc.archive(pages)
    page_id = lambda c: F.col(c).cast(pages.schema["page_id"].dataType)
    found = warc.read(index, path)
    return found.select(page_id("page").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), page_id("refers_to").alias("refers_to"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter("quality = 1"))


def op9_substring_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dup.duplicate_passages(table(spark, sf_dir, "documents")).withColumnRenamed("partner_id", "partner_doc_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secrets, op2_decontaminate, op3_near_dup, op4_toxicity, op5_bpe, op6_html_extract, op7_warc, op8_quality, op9_substring_dup, op10_url_filter)}


_OP2_SQL = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), doc AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_window AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), doc_window AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)
), hit AS (
  SELECT r, i, d.n, item_id FROM doc_window d JOIN item_window USING (s) WHERE d.n = item_window.n
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

_OP7_SQL = r"""
WITH page AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS h FROM pages
), ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS head, row_number() OVER (PARTITION BY payload ORDER BY page_id DESC) AS k FROM page
), bits AS (
  SELECT *, array_to_string(list_transform(range(40), lambda i: lpad(bin(CAST(strpos('0123456789abcdef', substr(h, i + 1, 1)) - 1 AS BIGINT)), 4, '0')), '') AS b FROM ranked
)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(list_sum(list_transform(range(5), lambda j: CAST(substr(b, 5 * i + j + 1, 1) AS INTEGER) * CAST(pow(2, 4 - j) AS INTEGER))) AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN head END AS refers_to
FROM bits
"""

_OP10_SQL = r"""
WITH split AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, row_number() OVER () AS r, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split
), rules(action, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), best AS (
  SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN best USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": _OP2_SQL, "op7_warc": _OP7_SQL, "op10_url_filter": _OP10_SQL}
