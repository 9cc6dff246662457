"""Registered queries of the operators, one ``opN_<name>`` each, and the pipeline."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, fill_in_middle, jaccard, licenses, packing, pieces, quality, secrets, token_counts, topk, toxicity, warc
from .common import in_fold, learnable, read_columns, ready, score_texts


# Held-out folds: crc32 of the id modulo the first number leaves the second
TOXIC_FOLDS, QUALITY_FOLDS = (5, 0), (3, 1)


def fitted(operator, docs: DataFrame, labels: DataFrame, column: str, folds: tuple[int, int]):
    """The operator's model, learnt from the labels outside the held-out fold."""
    return operator.fit(docs, learnable(labels, column, in_fold(F.col("doc_id"), *folds)))


def _classify(operator, spark: SparkSession, sf_dir: str, column: str, folds: tuple[int, int]) -> DataFrame:
    docs = read_columns(spark, sf_dir, "documents", "doc_id", "text")
    model = fitted(operator, docs, read_columns(spark, sf_dir, "labels", "doc_id", column), column, folds)
    scored = score_texts(docs, model)
    return scored.select("doc_id", in_fold(F.col("doc_id"), *folds).alias("held_out"), "score", "predicted")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(toxicity, spark, sf_dir, "toxic", TOXIC_FOLDS)


def _every_hundredth():
    return F.col("vec_id") % 100 == 0


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_columns(spark, sf_dir, "embeddings", "vec_id", "embedding"), _every_hundredth())


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.highest_products(read_columns(spark, sf_dir, "embeddings", "vec_id", "embedding"), _every_hundredth())


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(quality, spark, sf_dir, "quality", QUALITY_FOLDS)


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_columns(spark, sf_dir, "documents", "doc_id", "text"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(read_columns(spark, sf_dir, "documents", "doc_id", "text")).drop("redacted")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in secrets.KINDS),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op6_piece_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_columns(spark, sf_dir, "documents", "doc_id", "text")
    found = pieces.n_best_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"))
    best = F.get("paths", 0)
    line = F.transform("paths", lambda p: F.concat_ws(":", p["score"].cast("bigint").cast("string"), p["n_tokens"].cast("string"), p["ids_crc32"].cast("string")))
    return found.select(
        "doc_id",
        F.coalesce(best["n_tokens"], F.lit(0)).alias("n_tokens"),
        best["score"].alias("score"),
        best["ids_crc32"].alias("ids_crc32"),
        F.size("paths").cast("bigint").alias("n_paths"),
        F.array_join(line, ",").alias("paths"),
        "round_trip",
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_columns(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_columns(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(read_columns(spark, sf_dir, "documents", "doc_id", "text"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive_folder(spark)
    warc.write_archives(read_columns(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return warc.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.fill_in_middle(read_columns(spark, sf_dir, "documents", "doc_id", "text"))
    rebuilt = fill_in_middle.restored(F.col("output"), F.col("form"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(rebuilt).alias("restored_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_columns(spark, sf_dir, "documents", "doc_id", "text")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))


def _shipping(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ready(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _shipping(f) for f in (
    op1_toxicity, op2_license_scans, op3_secret_scans, op4_nearest_neighbours, op5_quality_classifier,
    op6_piece_segmentation, op7_token_counts, op8_top_k, op9_packing,
    op10_jaccard_join, op11_warc, op12_fill_in_middle, op13_alignment,
)}

# DuckDB statements of the queries that SQL can express
ORACLE: dict[str, str] = {
    "op8_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w::DOUBLE[], c.w::DOUBLE[]) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
}
