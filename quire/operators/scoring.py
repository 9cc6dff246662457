"""Document metrics, readiness / risk scores and per-section topic prediction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import (
    IMPERATIVE_DENSITY_MIN,
    PRED_CONCEPT,
    PRED_REFERENCE,
    PRED_TASK,
    AssessOptions,
)
from .sections import heading_ladder_valid

METRIC_SCHEMA = (
    "struct<heading_ladder_valid:boolean,avg_section_tokens:bigint,tables_simple:boolean,"
    "lists_depth_ok:boolean,images_with_alt:boolean,deep_nesting:boolean,"
    "complex_tables:boolean,unresolved_anchors:boolean,mixed_inline_blocks:boolean>"
)
PREDICTION_SCHEMA = "array<struct<index:int,title:string,pred:string,confidence:double,reasons:array<string>>>"


def doc_metrics(sections: Column, features: Column) -> Column:
    """Metrics of one document from its section / feature arrays.

    Average tokens is the floor of sum / max(1, n); the five structural checks the
    tool never measures are constants (kept as fields so callers may override).
    """
    n = F.size(features)
    total = F.aggregate(features, F.lit(0).cast("bigint"), lambda acc, f: acc + f["tokens"])
    return F.struct(
        heading_ladder_valid(sections).alias("heading_ladder_valid"),
        (total / F.greatest(n, F.lit(1))).cast("bigint").alias("avg_section_tokens"),
        F.forall(features, lambda f: f["tables"] <= 1).alias("tables_simple"),
        F.lit(True).alias("lists_depth_ok"),
        F.lit(True).alias("images_with_alt"),
        F.lit(False).alias("deep_nesting"),
        F.exists(features, lambda f: f["tables"] > 1).alias("complex_tables"),
        F.lit(False).alias("unresolved_anchors"),
        F.lit(False).alias("mixed_inline_blocks"),
    )


def _clamp(score: Column) -> Column:
    return F.least(F.lit(100), F.greatest(F.lit(0), score)).cast("bigint")


def readiness_score(metrics: Column, opts: AssessOptions = AssessOptions()) -> Column:
    """Additive weights for good structure + bonus for a target average length, clamped 0..100."""
    w = opts.topicization_weights
    lo, hi = opts.target_section_tokens
    avg = metrics["avg_section_tokens"]
    score = F.lit(0)
    for name in ("heading_ladder_valid", "tables_simple", "lists_depth_ok", "images_with_alt"):
        score = score + F.when(metrics[name], F.lit(int(w.get(name, 0)))).otherwise(0)
    score = score + F.when((avg >= lo) & (avg <= hi), F.lit(int(w.get("avg_section_len_target", 0)))).otherwise(0)
    return _clamp(score)


def risk_score(metrics: Column, opts: AssessOptions = AssessOptions()) -> Column:
    """Additive weights for risky structure, clamped 0..100."""
    w = opts.risk_weights
    score = F.lit(0)
    for name in ("deep_nesting", "complex_tables", "unresolved_anchors", "mixed_inline_blocks"):
        score = score + F.when(metrics[name], F.lit(int(w.get(name, 0)))).otherwise(0)
    return _clamp(score)


def _pred(spec) -> Column:
    kind, conf, reason = spec
    return F.struct(
        F.lit(kind).alias("pred"),
        F.lit(conf).cast("double").alias("confidence"),
        F.array(F.lit(reason)).alias("reasons"),
    )


def predict_topic(feature: Column) -> Column:
    """``struct<pred, confidence, reasons>`` for one section's features.

    task if an ordered list and (imperative density > 0.005 or a steps title);
    reference if pipe rows or reference markers; concept otherwise.
    """
    is_task = (feature["ordered_lists"] > 0) & (
        (feature["imperative_density"] > IMPERATIVE_DENSITY_MIN) | feature["has_steps_title"]
    )
    is_ref = (feature["tables"] > 0) | (feature["reference_markers"] > 0)
    return F.when(is_task, _pred(PRED_TASK)).when(is_ref, _pred(PRED_REFERENCE)).otherwise(_pred(PRED_CONCEPT))


def predictions(sections: Column, features: Column) -> Column:
    """``array<struct<index,title,pred,confidence,reasons>>`` aligned with sections."""
    return F.transform(
        features,
        lambda f, i: (lambda p: F.struct(
            i.alias("index"),
            F.get(sections, i)["title"].alias("title"),
            p["pred"].alias("pred"),
            p["confidence"].alias("confidence"),
            p["reasons"].alias("reasons"),
        ))(predict_topic(f)),
    )
