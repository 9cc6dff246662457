"""Per-document assessment: sections → features → metrics → scores → predictions.

One narrow projection over the corpus ``(path, text[, content, size])``; all
formats are routed in the same projection, so the whole assessment is a single
scan stage with no exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..options import GENERIC_READINESS, GENERIC_RISK, AssessOptions
from .features import features_of_sections
from .scoring import METRIC_SCHEMA, PREDICTION_SCHEMA, doc_metrics, predictions, readiness_score, risk_score
from .sections import format_of, route_sections


def with_sections(corpus: DataFrame) -> DataFrame:
    """Add ``fmt`` and ``section_list`` (the routed splitter's output)."""
    fmt = format_of(F.col("path"))
    return corpus.withColumn("fmt", fmt).withColumn("section_list", route_sections(F.col("fmt"), F.col("text")))


def assess_documents(corpus: DataFrame, opts: AssessOptions = AssessOptions()) -> DataFrame:
    """Full per-document assessment with the internal arrays kept.

    Output columns: ``path, fmt, size, sha256, sections, metrics,
    topicization_readiness, conversion_risk, predictions, raw_sections,
    section_list, features, text``.
    """
    cols = set(corpus.columns)
    size = F.col("size").cast("bigint") if "size" in cols else F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    sha = F.sha2(F.col("content"), 256) if "content" in cols else F.sha2(F.coalesce("text", F.lit("")), 256)
    base = with_sections(corpus).select(
        "path", "fmt", "text", "section_list", size.alias("size"), sha.alias("sha256")
    )
    structured = F.col("fmt") != "generic"
    feats = F.when(structured, features_of_sections(F.col("section_list"), opts))
    staged = base.withColumn("features", feats)
    metrics = F.when(structured, doc_metrics(F.col("section_list"), F.col("features"))).otherwise(
        F.lit(None).cast(METRIC_SCHEMA)
    )
    staged = staged.withColumn("metrics", metrics)
    return staged.select(
        "path",
        "fmt",
        "size",
        "sha256",
        F.size("section_list").cast("bigint").alias("sections"),
        "metrics",
        F.when(structured, readiness_score(F.col("metrics"), opts))
        .otherwise(F.lit(GENERIC_READINESS))
        .cast("bigint")
        .alias("topicization_readiness"),
        F.when(structured, risk_score(F.col("metrics"), opts))
        .otherwise(F.lit(GENERIC_RISK))
        .cast("bigint")
        .alias("conversion_risk"),
        F.when(structured, predictions(F.col("section_list"), F.col("features")))
        .otherwise(F.array().cast(PREDICTION_SCHEMA))
        .alias("predictions"),
        F.transform("section_list", lambda s: F.struct(s["title"].alias("title"), s["content"].alias("content"))).alias(
            "raw_sections"
        ),
        "section_list",
        "features",
        "text",
    )


def inventory(assessed: DataFrame) -> DataFrame:
    """The inventory row per document (what the inventory sink writes)."""
    return assessed.select(
        "path",
        "size",
        "sha256",
        "sections",
        "metrics",
        "topicization_readiness",
        "conversion_risk",
        "predictions",
        "raw_sections",
    )
