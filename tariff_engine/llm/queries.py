"""The numbered queries over the benchmark tables, and DuckDB SQL where SQL can express one.

Each query is thin: it reads its table whole, applies the operator with production parameters and picks the
result's columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariff_engine.llm.exact_dedup import exact_dedup
from tariff_engine.llm.hamming_index import nearest_neighbours
from tariff_engine.llm.hard_negatives import hard_negatives
from tariff_engine.llm.importance import importance_resample
from tariff_engine.llm.lang_id import PER_LANGUAGE, LanguageModel, detect_language, training_sample
from tariff_engine.llm.license_scan import license_scan
from tariff_engine.llm.nbest import N_BEST, decode_pieces, encode_n_best
from tariff_engine.llm.packing import pack_documents
from tariff_engine.llm.prefix_counts import prefix_counts
from tariff_engine.llm.shingle_join import shingle_join
from tariff_engine.llm.simhash import simhash_groups
from tariff_engine.llm.token_files import write_token_files
from tariff_engine.llm.url_filter import filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _crc32(ids: np.ndarray) -> int:
    """Of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return files.scan(spark, _crc32, "ids_crc32 long", pa.int64())


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


def op4_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores and digests of the n best segmentations, best first, and what the best one's ids decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = encode_n_best(_table(spark, sf_dir, "documents"), model, N_BEST)
    n_pieces = lambda ids: (F.octet_length(ids) / 4).cast("long")
    every = F.concat(F.array("ids"), "alternatives")
    digests = found.select(
        "doc_id", n_pieces("ids").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "score",
        F.size("scores").cast("long").alias("n_found"), F.element_at("scores", -1).alias("last_score"), "scores",
        F.transform(every, lambda ids: F.struct(n_pieces(ids).alias("n_pieces"), F.crc32(ids).alias("ids_crc32"))).alias("segmentations"),
        "ids",
    )
    decoded = decode_pieces(digests, model)
    return decoded.select(
        "doc_id", "n_pieces", "ids_crc32", "score", "n_found", "last_score", "scores", "segmentations",
        F.length("text").cast("long").alias("n_chars"), F.crc32(F.encode("text", "utf-8")).alias("text_crc32"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    sample = training_sample(docs.where(fold != 2), F.col("text"), F.col("lang"), F.col("doc_id"), PER_LANGUAGE)
    found = detect_language(docs, LanguageModel.fit(sample))
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join(_table(spark, sf_dir, "documents")).counted


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents")).withColumn("n_detections", F.size("detections")).drop("detections")


def op8_hamming_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), budgets=(512,), keep_steps=False
    )
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), "fits_512")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label, null_ids=True)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_token_files": op2_token_files,
    "op3_url_filter": op3_url_filter,
    "op4_nbest": op4_nbest,
    "op5_language_id": op5_language_id,
    "op6_shingle_join": op6_shingle_join,
    "op7_license_scan": op7_license_scan,
    "op8_hamming_index": op8_hamming_index,
    "op9_prefix_counts": op9_prefix_counts,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_simhash": op11_simhash,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_importance": op13_importance,
}

def _crc_table() -> list[int]:
    """The byte table of CRC-32 (reflected polynomial 0xEDB88320)."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


ORACLE_SQL: dict[str, str] = {
    "op10_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS content
            FROM documents
        ),
        groups AS (SELECT content, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY content)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.content) AS text_sha256
        FROM texts t JOIN groups g ON t.content = g.content
    """,
    "op12_hard_negatives": """
        WITH taking_part AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS parts
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        scored AS (
            SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
                   CAST(list_dot_product(a.parts, b.parts) AS BIGINT) AS score
            FROM taking_part a JOIN taking_part b ON a.vec_id % 100 = 0 AND a.r <> b.r
        ),
        positives AS (
            SELECT * FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, other) <= 5
        ),
        ranked AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.vec_id, n.other) AS INTEGER) AS rank
            FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
            WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
    """,
    "op13_importance": f"""
        WITH crc AS (SELECT {_crc_table()}::BIGINT[] AS t),
        texts AS (
            SELECT doc_id AS id, row_number() OVER () AS r, true AS is_source, text FROM documents
            UNION ALL SELECT item_id, -row_number() OVER (), false, text FROM benchmark
        ),
        words AS (
            SELECT id, r, is_source, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
            FROM texts
        ),
        vocabulary AS (
            SELECT word, [CAST('0x' || substr(hex(encode(word)), 2 * k + 1, 2) AS BIGINT) FOR k IN range(strlen(word))] AS bytes
            FROM (SELECT DISTINCT word FROM words)
        ),
        hashed AS (
            SELECT word, xor(list_reduce(bytes, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT)
                         % 10000 AS bucket
            FROM vocabulary, crc
        ),
        counts AS (
            SELECT bucket, count(*) FILTER (is_source) AS s, count(*) FILTER (NOT is_source) AS t FROM words JOIN hashed USING (word) GROUP BY bucket
        ),
        totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE))
                                                / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
            FROM counts, totals
        ),
        weighed AS (
            SELECT r, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
            FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE is_source GROUP BY r
        ),
        scored AS (
            SELECT id AS doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                       (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296::DOUBLE
                   ))) AS BIGINT) AS score
            FROM texts LEFT JOIN weighed USING (r) WHERE is_source
        ),
        placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= (SELECT count(*) * 10 // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
        FROM placed
    """,
}
