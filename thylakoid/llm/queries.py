"""The registered queries of this subpackage, at their production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thylakoid.llm.decontamination import contaminated, decontaminate
from thylakoid.llm.embedding_dedup import near_vectors
from thylakoid.llm.fill_in_middle import fill_in_middle
from thylakoid.llm.hard_negatives import hard_negatives
from thylakoid.llm.language_id import fit, held_out, identify
from thylakoid.llm.line_dedup import drop_repeated_lines
from thylakoid.llm.personal_data import find_personal_data, joined
from thylakoid.llm.pieces import encode_decode
from thylakoid.llm.sharding import shard_documents
from thylakoid.llm.simhash import near_duplicates
from thylakoid.llm.suffix_dedup import cut_repeated_strings
from thylakoid.llm.token_counts import token_counts
from thylakoid.llm.url_filter import judge_urls, rule_table

QUERIES: dict = {}
SQL: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registered(fn):
    QUERIES[fn.__name__] = fn
    return fn


@registered
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@registered
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@registered
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), offsets=False)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


#: Words and windows as lists; a window's words are joined by spaces, which words never hold.
SQL["op2_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), win AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS words
  FROM b, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM win),
placed AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), hits AS (SELECT doc_id, i, placed.size, item FROM placed JOIN win ON placed.words = win.words AND placed.size = win.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN owners USING (doc_id)
"""


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@registered
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES), default="allow")


SQL["op4_url_filter"] = r"""
WITH r(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT row_number() OVER () AS id, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM u),
f AS (
  SELECT p.id, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY p.id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
  FROM p JOIN r ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN (SELECT * FROM f WHERE n = 1) USING (id)
"""


@registered
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


@registered
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL["op1_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, e' \t\n\x0B\x0C\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), e'\n')) AS line, generate_subscripts(string_split(coalesce(text, ''), e'\n'), 1) AS i FROM documents)
), r AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT l.*, r.k IS NOT NULL AND doc_id < last AS gone FROM l LEFT JOIN r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, e'\n' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


@registered
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs.filter(~held_out(F.col("doc_id")))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@registered
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@registered
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@registered
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeated_strings(table(spark, sf_dir, "documents"), bodies=False).drop("spans", "kept")


@registered
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"), redact=False)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


@registered
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


#: Products of whole numbers below 2^53 are exact as doubles.
SQL["op12_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.id AS anchor, c.id, a.label = c.label AS same, CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score FROM v a JOIN v c ON a.id <> c.id WHERE a.id % 50 = 0
), p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT * FROM (
  SELECT p.anchor AS anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM p JOIN s n ON p.anchor = n.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
) WHERE rank <= 3
"""


@registered
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"), texts=False)


SQL["op13_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), r AS (SELECT *, [CAST('0x' || substr(h, i, 8) AS BIGINT) for i in [1, 9, 17, 25]] AS x FROM d),
c AS (
  SELECT *, least(x[1] % (len(u) + 1), x[2] % (len(u) + 1)) AS a, greatest(x[1] % (len(u) + 1), x[2] % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 50 THEN 'plain' WHEN x[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM r
), p AS (SELECT *, array_to_string(u[: a], '') AS pre, array_to_string(u[a + 1 : b], '') AS mid, array_to_string(u[b + 1 :], '') AS suf FROM c)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
