"""The four stages and their composition, each a function of DataFrames.

assess → (plans) → extract → transform → load.  Nothing is materialized between
stages except where a DataFrame is reused; the whole run is one lazy DAG whose
only exchanges are the near-duplicate clustering, the plan join and the ordered
map / report sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import stem
from ..operators.classify import classify_topic
from ..operators.convert import html_article, markdown_article
from ..operators.dedupe import cluster_keys, dedupe_items
from ..operators.inventory import assess_documents, inventory
from ..operators.routing import BatchConverter, build_registry, handler_for, no_handler_error
from ..operators.topics import build_topic, extract_body, extract_title, map_fragments, topic_file_name
from ..options import AssessOptions, ConvertOptions
from ..session import ship_package
from .conversion_plan import conversion_plans, join_bucketed, join_plans
from .report import report_fragments

class Outputs(dict):
    """Stage outputs; a value given as a zero-argument callable is built on first access
    (the clustering runs jobs while it is planned, so it is only built when asked for)."""

    def __getitem__(self, key):
        value = super().__getitem__(key)
        if callable(value) and not isinstance(value, DataFrame):
            value = value()
            self[key] = value
        return value


MD_HANDLER, HTML_HANDLER = "pandoc-md", "pandoc-html"


def assess_stage(corpus: DataFrame, opts: AssessOptions = AssessOptions()) -> Outputs:
    """Inventory, clusters ``(key, leader, similarity)``, plans and report fragments."""
    assessed = assess_documents(corpus, opts)
    inv = inventory(assessed)
    out = Outputs(assessed=assessed, inventory=inv, plans=conversion_plans(assessed))
    out["clusters"] = lambda: cluster_keys(dedupe_items(assessed, opts.dedupe_scope), opts)
    out["report"] = lambda: report_fragments(inv, out["clusters"])
    return out


def _extract(rows: DataFrame, copts: ConvertOptions) -> DataFrame:
    """Adds ``handler, docbook, error, has_docbook`` to rows with ``path`` and ``text``."""
    text = F.col("text")
    made = {MD_HANDLER: markdown_article(text), HTML_HANDLER: html_article(text)}
    batch = {name: c for name, c in copts.handlers.items() if isinstance(c, BatchConverter)}
    made |= {name: convert(text) for name, convert in copts.handlers.items() if name not in batch}
    registry = build_registry(copts.handler_overrides, copts.optional_handlers, copts.handlers)
    h = handler_for(F.col("path"), registry)
    failure = F.lit(None).cast("string")
    if batch:
        ship_package(rows.sparkSession)
        for k, (name, converter) in enumerate(batch.items()):
            own = F.when(h == name, F.coalesce(text, F.lit("")))
            rows = rows.withColumn(f"__converted_{k}", converter.column(own))
            made[name] = F.col(f"__converted_{k}")["value"]
            failure = F.coalesce(failure, F.col(f"__converted_{k}")["error"])
    docbook = None
    for name, column in made.items():
        docbook = F.when(h == name, column) if docbook is None else docbook.when(h == name, column)
    error = F.when(h.isNull(), no_handler_error(F.col("path"))).when(
        ~h.isin(*made),
        F.concat(F.lit("Handler '"), h, F.lit("' converts binary documents, which this engine does not read")),
    ).otherwise(failure)
    has = h.isin(*made) & failure.isNull() if batch else h.isin(*made)
    kept = [c for c in rows.columns if not c.startswith("__converted_")]
    return rows.select(*kept, h.alias("handler"), docbook.alias("docbook"), error.alias("error"), has.alias("has_docbook"))


def extract_stage(corpus: DataFrame, copts: ConvertOptions = ConvertOptions()) -> DataFrame:
    """``(path, handler, docbook, error)``: route by extension, convert Markdown / HTML, or
    by the caller's own converters (``copts.handlers``: name → ``Column → Column``).

    Unknown extensions, handlers without a converter and documents whose converter
    raises (``BatchConverter``) become error rows; the other rows are unaffected.
    """
    out = _extract(corpus.select("path", "text"), copts)
    return out.select("path", "handler", "docbook", "error")


def _transform(docs: DataFrame, copts: ConvertOptions, keep: tuple[str, ...] = ()) -> DataFrame:
    """Topics of ``(path, docbook, has_docbook, plan_type)`` rows (narrow).

    ``error`` depends only on the cheap ``has_docbook`` flag: filters on it are pushed
    below the projections by the optimizer, which copies the filtered expression,
    so it must not contain the conversion itself.  Classification always yields a
    known type (rule types and hints are validated), so no type error arises here.
    """
    db = F.col("docbook")
    ttype = classify_topic(stem(F.col("path")), db, copts.rules_by_filename, copts.rules_by_content, F.col("plan_type"))
    ok = F.col("has_docbook")
    staged = docs.select("path", *keep, "docbook", "has_docbook", F.when(ok, ttype).alias("topic_type"))
    xml = build_topic(extract_title(db), extract_body(db), F.col("topic_type"))
    out_dir = copts.topics_dir.rstrip("/")
    return staged.select(
        "path",
        *keep,
        "topic_type",
        F.when(ok, F.concat(F.lit(out_dir + "/"), topic_file_name(F.col("path"), F.col("topic_type")))).alias(
            "topic_path"
        ),
        F.when(ok, xml).alias("xml"),
        F.when(~ok, F.concat(F.lit("No intermediate document for "), F.col("path"))).alias("error"),
    )


def transform_stage(
    intermediates: DataFrame, plans: DataFrame | None = None, copts: ConvertOptions = ConvertOptions()
) -> DataFrame:
    """``(path, topic_type, topic_path, xml, error)`` from ``(path, docbook)``, with the
    plan hints of a separate plan table ``(source, default_topic_type)`` (left join).

    A missing intermediate (null docbook) is an error row for that path only.
    """
    docs = join_plans(intermediates.select("path", "docbook"), plans, copts.plan_key)
    return _transform(docs.withColumn("has_docbook", F.col("docbook").isNotNull()), copts)


def transform_tables(intermediates: str, hints: str, spark: SparkSession, copts: ConvertOptions = ConvertOptions()) -> DataFrame:
    """:func:`transform_stage` on tables bucketed by path (``sources.sinks.write_bucketed``): no exchange at all."""
    docs = join_bucketed(spark.table(intermediates).select("path", "docbook"), spark.table(hints))
    return _transform(docs.withColumn("has_docbook", F.col("docbook").isNotNull()), copts)


def load_stage(topics: DataFrame, copts: ConvertOptions = ConvertOptions()) -> dict[str, DataFrame]:
    """Map fragments over all successful topics and the topic count."""
    ok = topics.filter(F.col("error").isNull()).select("topic_path")
    return {
        "map": map_fragments(ok, copts.map_title, copts.map_dir),
        "topic_count": ok.agg(F.count(F.lit(1)).cast("bigint").alias("topic_count")),
    }


def errors(extracted: DataFrame, topics: DataFrame) -> DataFrame:
    """``(stage, path, error)`` for every failed document of extract and transform."""
    e = extracted.filter(F.col("error").isNotNull()).select(F.lit("extract").alias("stage"), "path", "error")
    t = topics.filter(F.col("error").isNotNull()).select(F.lit("transform").alias("stage"), "path", "error")
    return e.unionByName(t)


def run_summary(documents: DataFrame) -> DataFrame:
    """``(metric, value)`` from the per-document table in one aggregation:
    files, extract ok / failed, topics, transform failed."""
    agg = documents.agg(
        F.count(F.lit(1)).alias("files_found"),
        F.count_if(F.col("extract_error").isNull()).alias("extract_ok"),
        F.count_if(F.col("extract_error").isNotNull()).alias("extract_failed"),
        F.count_if(F.col("extract_error").isNull() & F.col("error").isNull()).alias("topics"),
        F.count_if(F.col("extract_error").isNull() & F.col("error").isNotNull()).alias("transform_failed"),
    )
    names = ["files_found", "extract_ok", "extract_failed", "topics", "transform_failed"]
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("value")) for n in names])
    return agg.select(F.explode(pairs).alias("m")).select("m.metric", "m.value")


def run_all(
    corpus: DataFrame, opts: AssessOptions = AssessOptions(), copts: ConvertOptions = ConvertOptions()
) -> Outputs:
    """Whole conversion: assess → extract → transform (with plans) → load.

    The plan's default type travels in the same row, so no plan join is needed:
    assessment, extraction and transformation are one narrow projection.
    """
    assessed = assess_stage(corpus, opts)
    a = assessed["assessed"].select(
        "path",
        "text",
        F.coalesce(F.get("predictions", 0)["pred"], F.lit("concept")).alias("plan_type"),
    )
    rows = _extract(a, copts)
    extracted = rows.select("path", "handler", "docbook", "error")
    # one row per document: extraction and transformation results side by side (no join)
    documents = _transform(
        rows.select("path", "handler", F.col("error").alias("extract_error"), "docbook", "has_docbook", "plan_type"),
        copts,
        keep=("handler", "extract_error"),
    ).withColumn("error", F.when(F.col("extract_error").isNull(), F.col("error")))
    topics = documents.filter(F.col("extract_error").isNull()).select("path", "topic_type", "topic_path", "xml", "error")
    ok_topics = topics.filter(F.col("error").isNull())
    failures = documents.filter(F.col("extract_error").isNotNull() | F.col("error").isNotNull()).select(
        F.when(F.col("extract_error").isNotNull(), F.lit("extract")).otherwise(F.lit("transform")).alias("stage"),
        "path",
        F.coalesce("extract_error", "error").alias("error"),
    )
    assessed.update(
        extracted=extracted,
        documents=documents,
        topics=topics,
        map=map_fragments(ok_topics.select("topic_path"), copts.map_title, copts.map_dir),
        topic_count=ok_topics.agg(F.count(F.lit(1)).cast("bigint").alias("topic_count")),
        errors=failures,
        summary=run_summary(documents),
    )
    return assessed
