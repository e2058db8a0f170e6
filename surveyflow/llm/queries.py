"""Queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyflow.llm import (
    bpe, language, line_dedup, packing, quality, quality_rules, ranked, sharding, simhash, topk, toxicity, vector_codes, warc,
)
from surveyflow.llm.common import id_crc, shared_path, stored, table

QUERIES = {}
ORACLE = {}

SHARDS = 8


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_id")


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.into_slots(table(spark, sf_dir, "documents"))
    loads = sharding.slot_loads(rows).collect()  # a row per virtual slot at most
    folder = shared_path(spark, "slot-map")
    first = sharding.even_map(sharding.SLOTS, SHARDS)
    sharding.save_map(spark, folder, 1, first)
    sharding.save_map(spark, folder, 2, sharding.rebalanced(first, {r.virtual_slot: r.bytes for r in loads}, SHARDS))
    counts = spark.createDataFrame(loads, "virtual_slot int, bytes long, rows long")
    placed = sharding.place(rows, sharding.load_map(spark, folder), counts)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
    )


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern)
    return bpe.decode(encoded, ranks, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query("op5_top_k", TOP_K_SQL)
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_crc(F.col("doc_id")) % 3 == 1
    model = language.Languages.learn(docs.filter(~held_out))
    return language.identify(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "shares"
    )


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    cut = packing.pieces(table(spark, sf_dir, "documents"), path)
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(stored(narrow, "pieces"))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_crc(F.col("doc_id")) % 5 == 0
    model = quality.learn(docs, labels.filter(~held_out))
    scored = quality.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), trusted)
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*base, "llr")


VECTOR_CODES_SQL = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
  SELECT vec_id, label, part, v[4*part+1] AS a, v[4*part+2] AS b, v[4*part+3] AS c, v[4*part+4] AS d
  FROM kept, range(16) r(part)
), c0 AS MATERIALIZED (
  SELECT part, e, a, b, c, d FROM points JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) s USING (vec_id)
)
""" + "".join(
    f""", a{n} AS MATERIALIZED (
  SELECT vec_id, label, p.part, p.a, p.b, p.c, p.d,
    min(((p.a-q.a)*(p.a-q.a) + (p.b-q.b)*(p.b-q.b) + (p.c-q.c)*(p.c-q.c) + (p.d-q.d)*(p.d-q.d))::HUGEINT * 64 + e) AS best
  FROM points p JOIN c{n} q USING (part) GROUP BY ALL
), c{n + 1} AS MATERIALIZED (
  SELECT q.part, q.e, coalesce(n.a, q.a) AS a, coalesce(n.b, q.b) AS b, coalesce(n.c, q.c) AS c, coalesce(n.d, q.d) AS d
  FROM c{n} q LEFT JOIN (
    SELECT part, best % 64 AS e, {', '.join(f'((sum({x}) - ((sum({x}) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS {x}' for x in 'abcd')}
    FROM a{n} GROUP BY ALL) n USING (part, e)
)
"""
    for n in range(3)
) + """, rows AS (
  SELECT vec_id, label, string_agg(format('{:02x}', (best % 64)::INTEGER), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error
  FROM a2 GROUP BY ALL
), book AS (
  SELECT sha256(string_agg(concat_ws(',', a, b, c, d), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM rows, book
"""


@query("op13_vector_codes", VECTOR_CODES_SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


PAGES_SQL = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id) AS n,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND n > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND n > 1 THEN first END AS refers_to
FROM p
"""


@query("op12_warc", PAGES_SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(warc.pages_to_records(table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z"), path)
    with warc.pushdown(spark):
        return stored(warc.page_rows(spark, path).drop("stated_digest"), "warc-pages")


RANKED_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL
), n AS (SELECT r, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
s AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS l FROM n),
q AS (
  SELECT item_id, term, count(*)::BIGINT AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), p AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, big_n),
x AS (
  SELECT item_id, doc_id, n.r, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // l))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN n USING (r), s GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 20
"""


@query("op11_ranked_search", RANKED_SQL)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
