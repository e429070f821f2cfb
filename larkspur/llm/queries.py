"""The registered queries of this subpackage: each applies one operator to its whole table. SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bitsliced, hnsw, mixing, neardup, pieces, quality, secrets, sharding, toxicity, warc
from larkspur.llm.common import held_out, spread, table

#: Where the SentencePiece model lies; the driver reads it.
TOKENIZER = os.environ.get("LARKSPUR_PIECES", "/opt/tokenizers/piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(spread(table(spark, sf_dir, "documents")))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hnsw.vectors(table(spark, sf_dir, "embeddings"))
    return hnsw.search(hnsw.build(rows), rows.where(F.col("id") % 20 == 0), 20)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spread(table(spark, sf_dir, "documents")), neardup.Settings(words=2))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(spread(table(spark, sf_dir, "documents")), TOKENIZER)


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bitsliced.quantised(table(spark, sf_dir, "embeddings"))
    return bitsliced.search(bitsliced.build(rows), rows.where(F.col("id") % 50 == 0), 5)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.copies(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return quality.grade(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_secret_scans, op2_nearest_neighbours, op3_minhash_near_dedup, op4_sentencepiece, op5_topk_search, op6_source_mixing, op7_toxicity, op8_quality_classifier, op9_warc, op10_sharding)}

ORACLES: dict[str, str] = {
    # CRC-32 by its table, which is made here from the polynomial.
    "op10_sharding": """
        WITH k AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
             b AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes,
                          list_transform(range(25), lambda s: substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || s), 1, 13)) AS draw FROM documents),
             s AS (SELECT doc_id, size, xor(list_reduce(list_concat([4294967295], bytes), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
                          list_position(draw[:24], list_max(draw[:24])) - 1 AS shard, list_position(draw, list_max(draw)) - 1 AS grown_shard FROM b, k)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, grown_shard FROM s
    """,
    "op3_minhash_near_dedup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
             s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]] ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w),
             e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
             p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2),
             l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
             u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
             r AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT r.x, u.b FROM r JOIN u ON r.y = u.a),
             m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
        SELECT s.doc_id, len(s.sh) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept FROM s JOIN m ON s.doc_id = m.x
    """,
    "op5_topk_search": """
        WITH t AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
                   FROM t q JOIN t c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank::INT AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
    """,
    "op9_warc": """
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
               CASE WHEN keeps THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN NOT keeps THEN first END AS refers_to
        FROM (SELECT *, first IS NULL OR octet_length(encode(coalesce(html, ''))) < 100 OR page_id IS NOT DISTINCT FROM first AS keeps
              FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages))
    """,
}
