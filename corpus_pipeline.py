"""Corpus pipeline: toxicity, quality, near duplicates, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``; all but the last return the columns
of ``documents``.  A decision changes the rows: rejected documents go, copies go, secrets
are blanked out.

Nulls, empty and repeated rows: a null text is scored as empty text by the classifiers,
links with nothing, keeps being null through the secret stage and is packed as an empty
document.  Copies are told by row: of a group one row stays, whether ids repeat or are null
(a null id only if the group has no other).  An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import jaccard, packing, quality, secrets, toxicity
from quire.llm.common import materialize, read_columns, score_texts
from quire.llm.queries import QUALITY_FOLDS, TOXIC_FOLDS, fitted

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies share four fifths of their five-word shingles (op10_jaccard_join has a contract of its own)
COPY_WORDS, COPY_PERCENT = 5, 80


def _judged(operator, docs: DataFrame, spark: SparkSession, sf_dir: str, column: str, folds, wanted: int) -> DataFrame:
    """The documents that the operator's model predicts to be ``wanted``; labels of the held-out fold teach nothing."""
    model = fitted(operator, docs, read_columns(spark, sf_dir, "labels", "doc_id", column), column, folds)
    return score_texts(docs, model, keep=COLUMNS).filter(F.col("predicted") == wanted).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not call toxic."""
    return _judged(toxicity, docs, spark, sf_dir, "toxic", TOXIC_FOLDS, 0)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model calls good."""
    return _judged(quality, docs, spark, sf_dir, "quality", QUALITY_FOLDS, 1)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, one row: that with the smallest id."""
    return jaccard.first_of_components(docs, COPY_WORDS, COPY_PERCENT).select(*COLUMNS)


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every stretch that holds a secret replaced; ``n_chars`` is counted anew."""
    found = secrets.secret_spans(docs, keep=tuple(c for c in COLUMNS if c not in ("doc_id", "text")))
    clean = found.withColumn("text", F.col("redacted"))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*COLUMNS)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near duplicates", drop_copies),
    ("secrets", blank_secrets),
    ("packing", pack_documents),
]

#: Models, redaction by a trained model and tokenization have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_columns(spark, sf_dir, "documents", *COLUMNS)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else materialize(out, "pipeline")
    return docs
