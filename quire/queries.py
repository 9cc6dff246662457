"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the derived corpora of
``sources.tables``) and runs over all of their rows.  Column names match the
DuckDB statements in ``quire.oracle`` one for one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import token_count
from .operators.features import section_features, verb_hits
from .operators.inventory import assess_documents
from .operators.scoring import predict_topic
from .operators.sections import format_of, heading_ladder_valid, html_sections, markdown_sections, section_rows
from .options import AssessOptions
from .sources.tables import corpus

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


_PLANS: dict = {}


def _memo(kind: str, spark: SparkSession, sf: str, build, *extra):
    """Reuse a lazily built DataFrame (the plan object, not data) within one session."""
    key = (kind, spark.sparkContext.applicationId, sf, *map(repr, extra))
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    return _memo("corpus", spark, sf, lambda: corpus(spark, sf))


def _assessed(spark: SparkSession, sf: str, opts: AssessOptions = AssessOptions()) -> DataFrame:
    return _memo("assessed", spark, sf, lambda: assess_documents(_corpus(spark, sf), opts), opts)


# ---------------------------------------------------------------- sections
@register("md_sections")
def q_md_sections(spark, sf):
    c = _corpus(spark, sf).filter(format_of(F.col("path")) == "md")
    return section_rows(c.select("path", markdown_sections(F.col("text")).alias("sections")))


@register("html_sections")
def q_html_sections(spark, sf):
    c = _corpus(spark, sf).filter(format_of(F.col("path")) == "html")
    return section_rows(c.select("path", html_sections(F.col("text")).alias("sections")))


@register("section_rows")
def q_section_rows(spark, sf):
    a = _assessed(spark, sf)
    return section_rows(a, "section_list", keep=("path", "fmt"))


@register("route_format")
def q_route_format(spark, sf):
    return _corpus(spark, sf).select("path", format_of(F.col("path")).alias("fmt"))


@register("assess_generic")
def q_assess_generic(spark, sf):
    a = _assessed(spark, sf).filter(F.col("fmt") == "generic")
    return a.select(
        "path",
        "sections",
        F.get("raw_sections", 0)["title"].alias("title"),
        F.get("raw_sections", 0)["content"].alias("content"),
        "topicization_readiness",
        "conversion_risk",
        F.size("predictions").cast("bigint").alias("n_predictions"),
    )


# ---------------------------------------------------------------- features
@register("token_count")
def q_token_count(spark, sf):
    return _corpus(spark, sf).select("path", token_count(F.coalesce("text", F.lit(""))).alias("tokens"))


def _feature_rows(spark, sf):
    a = _assessed(spark, sf).filter(F.col("fmt") != "generic")
    rows = section_rows(a, "section_list", keep=("path",))
    return rows.withColumn("f", section_features(F.col("title"), F.col("content")))


@register("section_features")
def q_section_features(spark, sf):
    r = _feature_rows(spark, sf)
    return r.select("path", "section_index", "f.*")


@register("imperative_density")
def q_imperative_density(spark, sf):
    opts = AssessOptions()
    r = _feature_rows(spark, sf)
    return r.select(
        "path",
        "section_index",
        verb_hits(F.col("content"), opts.task_keywords).alias("verb_hits"),
        F.col("f.tokens").alias("tokens"),
        F.col("f.imperative_density").alias("imperative_density"),
    )


@register("predict_topic")
def q_predict_topic(spark, sf):
    r = _feature_rows(spark, sf).withColumn("p", predict_topic(F.col("f")))
    return r.select(
        "path",
        "section_index",
        "title",
        F.col("p.pred").alias("pred"),
        F.col("p.confidence").alias("confidence"),
        F.array_join("p.reasons", "; ").alias("reasons"),
    )


# ---------------------------------------------------------------- document level
@register("heading_ladder")
def q_heading_ladder(spark, sf):
    a = _assessed(spark, sf).filter(F.col("fmt") != "generic")
    return a.select("path", heading_ladder_valid(F.col("section_list")).alias("heading_ladder_valid"))


@register("doc_metrics")
def q_doc_metrics(spark, sf):
    a = _assessed(spark, sf).filter(F.col("fmt") != "generic")
    return a.select("path", "metrics.*")


@register("readiness_score")
def q_readiness(spark, sf):
    return _assessed(spark, sf).select("path", "topicization_readiness")


@register("risk_score")
def q_risk(spark, sf):
    return _assessed(spark, sf).select("path", "conversion_risk")


def _prediction_text(p):
    reasons = F.array_join(p["reasons"], "; ")
    return F.concat_ws("|", p["index"].cast("string"), p["title"], p["pred"], p["confidence"].cast("string"), reasons)


@register("inventory")
def q_inventory(spark, sf):
    a = _assessed(spark, sf)
    return a.select(
        "path",
        "size",
        "sha256",
        "sections",
        "topicization_readiness",
        "conversion_risk",
        F.array_join(F.transform("predictions", lambda p: p["pred"]), ",").alias("pred_types"),
        F.array_join(F.transform("predictions", _prediction_text), "\n").alias("predictions"),
        F.md5(F.array_join(F.transform("raw_sections", lambda s: F.concat_ws("\u0001", s["title"], s["content"])), "\u0002")).alias("raw_sections_md5"),
        F.col("metrics.avg_section_tokens").alias("avg_section_tokens"),
        F.col("metrics.heading_ladder_valid").alias("heading_ladder_valid"),
        F.col("metrics.complex_tables").alias("complex_tables"),
    )


@register("fingerprint")
def q_fingerprint(spark, sf):
    c = _corpus(spark, sf)
    t = F.coalesce("text", F.lit(""))
    return c.select("path", F.octet_length(t).cast("bigint").alias("size"), F.sha2(t, 256).alias("sha256"))


# ---------------------------------------------------------------- near duplicates
from .operators.dedupe import cluster_keys, cluster_members, cluster_table, dedupe_items, shingles, signature_similarity, signature_table  # noqa: E402

LOOSE = AssessOptions(ngram=3, threshold=0.7)


def _items(spark, sf, opts=AssessOptions()):
    return dedupe_items(_assessed(spark, sf, opts), opts.dedupe_scope)


@register("shingles")
def q_shingles(spark, sf):
    opts = AssessOptions()
    sh = _items(spark, sf).select("key", shingles(F.col("text"), opts.ngram).alias("sh"))
    return sh.select(
        "key",
        F.size("sh").cast("bigint").alias("n_shingles"),
        F.size(F.array_distinct("sh")).cast("bigint").alias("n_distinct"),
        F.md5(F.array_join("sh", "|")).alias("digest"),
    )


@register("minhash_signature")
def q_minhash(spark, sf):
    s = signature_table(_items(spark, sf))
    return s.select("key", F.array_join(F.transform("sig", lambda v: v.cast("string")), ",").alias("sig"))


@register("signature_similarity")
def q_signature_similarity(spark, sf):
    # each document against the document with the next doc_id (an equi-join, no global order)
    docs = read_table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("docs/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("key")
    )
    s = signature_table(_items(spark, sf)).join(docs, "key")
    a = s.select(F.col("doc_id").alias("id_a"), F.col("key").alias("a"), F.col("sig").alias("sa"))
    b = s.select((F.col("doc_id") - 1).alias("id_a"), F.col("key").alias("b"), F.col("sig").alias("sb"))
    return a.join(b, "id_a").select("a", "b", signature_similarity(F.col("sa"), F.col("sb")).alias("similarity"))


@register("near_dup_clusters")
def q_near_dup_clusters(spark, sf):
    return cluster_keys(_items(spark, sf)).select("key", "leader")


@register("near_dup_clusters_loose")
def q_near_dup_clusters_loose(spark, sf):
    return cluster_keys(_items(spark, sf, LOOSE), LOOSE).select("key", "leader")


@register("near_dup_clusters_document")
def q_near_dup_clusters_document(spark, sf):
    opts = AssessOptions(dedupe_scope="document")
    return cluster_keys(_items(spark, sf, opts), opts).select("key", "leader")


# unlike documents of one template: many share buckets, few resemble each other
TEMPLATED = AssessOptions(ngram=3, threshold=0.7, dedupe_scope="document")


@register("near_dup_clusters_templated")
def q_near_dup_clusters_templated(spark, sf):
    items = dedupe_items(assess_documents(corpus(spark, sf, ("part",)), TEMPLATED), TEMPLATED.dedupe_scope)
    return cluster_keys(items, TEMPLATED).select("key", "leader")


@register("near_dup_pairs")
def q_near_dup_pairs(spark, sf):
    kl = cluster_keys(_items(spark, sf))
    return kl.filter(F.col("key") != F.col("leader")).select(
        F.col("leader").alias("a"), F.col("key").alias("b"), "similarity"
    )


@register("clusters")
def q_clusters(spark, sf):
    return cluster_table(cluster_keys(_items(spark, sf)))


@register("cluster_members")
def q_cluster_members(spark, sf):
    # of loose clusters, which are larger
    return cluster_members(cluster_keys(_items(spark, sf, LOOSE), LOOSE))


@register("report_duplicates")
def q_report_duplicates(spark, sf):
    return cluster_table(cluster_keys(_items(spark, sf))).filter(F.col("size") > 1)


# ---------------------------------------------------------------- conversion: shared derived inputs
from .functions.paths import basename as path_basename, relative_path, stem as path_stem, suffix as path_suffix  # noqa: E402
from .operators.classify import classify_topic  # noqa: E402
from .functions.text import xml_escape  # noqa: E402
from .operators.convert import html_article, markdown_article  # noqa: E402
from .operators.measured import FIELDS as MEASURED_FIELDS, measured  # noqa: E402
from .operators.routing import BatchConverter, build_registry, extension, handler_for, no_handler_error  # noqa: E402
from .operators.topics import (  # noqa: E402
    build_topic,
    extract_body,
    extract_title,
    map_fragments,
    topic_type_error,
    topicref,
)
from .options import ConvertOptions, Rule  # noqa: E402
from .plans.conversion_plan import conversion_plans, join_plans, plan_collisions, plan_hints, plan_json, read_plans  # noqa: E402
from .plans.report import report_fragments, report_summary  # noqa: E402
from .plans.stages import assess_stage, errors, extract_stage, run_all, run_summary, transform_stage, transform_tables  # noqa: E402
from .session import ensure_checkpoint_dir  # noqa: E402
from .sources.files import decode_text  # noqa: E402
from .sources.sinks import write_bucketed, write_plans  # noqa: E402
from .sources.tables import docbook_corpus, guides, read_table  # noqa: E402

# Rules exercised by the classification queries (glob on the stem, regex on the content).
FILENAME_RULES = (Rule("2?", "task"), Rule("[13]*5", "Reference"), Rule("4[!0-4]", "glossary"))
CONTENT_RULES = (Rule(r"\bnicht\b", "reference"), Rule(r"end[[&&.]", "reference"), Rule("Parameters:", "reference"), Rule("procedure", "TASK"))
RULED = ConvertOptions(rules_by_filename=FILENAME_RULES, rules_by_content=CONTENT_RULES)
# plan hints of the classification query: valid (needs normalising), invalid, missing
HINT_SQL = "CASE doc_id % 3 WHEN 0 THEN ' Task ' WHEN 1 THEN 'bogus' END"
# topic types of the topic-builder query, one unknown type among them
TYPE_SQL = "CASE WHEN doc_id % 50 = 0 THEN 'bogus' ELSE element_at(array('concept', 'task', 'reference'), cast(doc_id % 3 AS int) + 1) END"
# map folders of the topicref query
MAPDIR_SQL = "CASE WHEN doc_id % 5 = 0 THEN 'out/maps' WHEN doc_id % 2 = 0 THEN 'dita' ELSE 'dita/topics' END"
# extensions of the routing query
ROUTE_PATH_SQL = (
    "concat('in/', source, '/', cast(doc_id as string), "
    "CASE doc_id % 6 WHEN 0 THEN '.md' WHEN 1 THEN '.HTML' WHEN 2 THEN '.htm' WHEN 3 THEN '.docx' "
    "WHEN 4 THEN '.xyz' ELSE '' END)"
)


def _docbook_with_ids(spark, sf):
    return docbook_corpus(spark, sf)


# ---------------------------------------------------------------- paths, routing
@register("path_parts")
def q_path_parts(spark, sf):
    c = _corpus(spark, sf).select("path")
    extra = read_table(spark, sf, "documents").selectExpr(
        "concat('docs/', source, '/.', cast(doc_id as string)) AS path",
    ).unionByName(read_table(spark, sf, "documents").selectExpr(
        "concat('docs/', source, '/', cast(doc_id as string), '.tar.gz') AS path",
    ))
    p = F.col("path")
    return c.unionByName(extra).select(
        "path", path_basename(p).alias("basename"), path_stem(p).alias("stem"), path_suffix(p).alias("suffix")
    )


@register("route_handler")
def q_route_handler(spark, sf):
    reg = build_registry()
    paths = read_table(spark, sf, "documents").selectExpr(f"{ROUTE_PATH_SQL} AS path")
    h = handler_for(F.col("path"), reg)
    return paths.select(
        "path", extension(F.col("path")).alias("ext"), h.alias("handler"),
        F.when(h.isNull(), no_handler_error(F.col("path"))).alias("error"),
    )


# ---------------------------------------------------------------- DocBook → topic pieces
@register("docbook_title")
def q_docbook_title(spark, sf):
    return docbook_corpus(spark, sf).select("path", extract_title(F.col("docbook")).alias("title"))


@register("docbook_body")
def q_docbook_body(spark, sf):
    return docbook_corpus(spark, sf).select("path", extract_body(F.col("docbook")).alias("body"))


@register("build_topic")
def q_build_topic(spark, sf):
    d = _docbook_with_ids(spark, sf).withColumn("topic_type", F.expr(TYPE_SQL))
    db = F.col("docbook")
    return d.select(
        "path",
        "topic_type",
        build_topic(extract_title(db), extract_body(db), F.col("topic_type")).alias("xml"),
        topic_type_error(F.col("topic_type")).alias("error"),
    )


@register("classify_topic")
def q_classify_topic(spark, sf):
    d = _docbook_with_ids(spark, sf).withColumn("plan_type", F.expr(HINT_SQL))
    t = classify_topic(path_stem(F.col("path")), F.col("docbook"), FILENAME_RULES, CONTENT_RULES, F.col("plan_type"))
    return d.select("path", t.alias("topic_type"))


@register("topicref")
def q_topicref(spark, sf):
    d = read_table(spark, sf, "documents").selectExpr(
        "concat('dita/topics/', cast(doc_id as string), '_concept.dita') AS topic_path", f"{MAPDIR_SQL} AS map_dir"
    )
    return d.select("topic_path", "map_dir", topicref(F.col("topic_path"), F.col("map_dir")).alias("ref"))


# ---------------------------------------------------------------- plans
def _plans(spark, sf):
    return conversion_plans(_assessed(spark, sf))


@register("conversion_plan")
def q_conversion_plan(spark, sf):
    p = plan_json(_plans(spark, sf), keep=True)
    return p.select(
        "source",
        "plan_file",
        "default_topic_type",
        F.col("chunking.level").cast("bigint").alias("chunk_level"),
        F.col("chunking.nested_topics").alias("nested_topics"),
        "risk",
        "readiness",
        F.array_join(F.transform("sections", lambda s: s["pred"]), ",").alias("section_types"),
        "json",
    )


@register("plan_collisions")
def q_plan_collisions(spark, sf):
    return plan_collisions(_plans(spark, sf))


@register("plan_join")
def q_plan_join(spark, sf):
    # the plans as the sink writes them, read back
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/plans-{uuid.uuid4().hex}"
    write_plans(plan_json(_plans(spark, sf)), path)
    p = read_plans(spark, path).select("source", "default_topic_type")
    return join_plans(docbook_corpus(spark, sf).select("path"), p, "path").select("path", "plan_type")


@register("plan_join_basename")
def q_plan_join_basename(spark, sf):
    p = _plans(spark, sf).select("source", "default_topic_type")
    return join_plans(docbook_corpus(spark, sf).select("path"), p, "basename").select("path", "plan_type")


# ---------------------------------------------------------------- intermediates and stages
@register("md_to_intermediate")
def q_md_to_intermediate(spark, sf):
    c = _corpus(spark, sf).filter(format_of(F.col("path")) == "md")
    return c.select("path", markdown_article(F.col("text")).alias("docbook"))


@register("html_to_intermediate")
def q_html_to_intermediate(spark, sf):
    c = _corpus(spark, sf).filter(format_of(F.col("path")) == "html")
    return c.select("path", html_article(F.col("text")).alias("docbook"))


@register("md_blocks")
def q_md_blocks(spark, sf):
    return guides(spark, sf, "md").select("path", markdown_article(F.col("text")).alias("docbook"))


@register("html_structure")
def q_html_structure(spark, sf):
    return guides(spark, sf, "html").select("path", html_article(F.col("text")).alias("docbook"))


@register("measured_metrics")
def q_measured_metrics(spark, sf):
    out = measured(assess_documents(guides(spark, sf, "linked")))
    return out.select("path", *(F.col(f"metrics.{f}").alias(f) for f in MEASURED_FIELDS), "topicization_readiness", "conversion_risk")


@register("extract_stage")
def q_extract_stage(spark, sf):
    e = extract_stage(_corpus(spark, sf))
    return e.select("path", "handler", F.md5("docbook").alias("docbook_md5"), "error")


def _lines_to_intermediate(text):
    """A user's converter for plain text: every line that is not empty becomes a paragraph."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x != "")
    paras = F.transform(lines, lambda x: F.concat(F.lit("<para>"), xml_escape(x), F.lit("</para>")))
    return F.concat(F.lit("<article>"), F.array_join(paras, ""), F.lit("</article>"))


@register("extract_user_converter")
def q_extract_user_converter(spark, sf):
    copts = ConvertOptions(handlers={"text-lines": _lines_to_intermediate}, handler_overrides={".txt": "text-lines"})
    e = extract_stage(_corpus(spark, sf), copts)
    return e.select("path", "handler", F.md5("docbook").alias("docbook_md5"), "error")


def _lines_or_failure(texts):
    """A converter in Python that fails for some texts: those with a word of 14 letters or more."""
    out = []
    for text in texts:
        if re.search(r"[A-Za-z]{14}", text):
            raise ValueError("a word is too long")
        lines = [x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;") for x in text.split("\n") if x]
        out.append("<article>" + "".join(f"<para>{x}</para>" for x in lines) + "</article>")
    return out


@register("extract_failing_converter")
def q_extract_failing_converter(spark, sf):
    copts = ConvertOptions(handlers={"python-lines": BatchConverter(_lines_or_failure)}, handler_overrides={".txt": "python-lines"})
    e = extract_stage(_corpus(spark, sf), copts)
    return e.select("path", "handler", F.md5("docbook").alias("docbook_md5"), "error")


# a conditional group, which Java has no form of: a digit before 7, or else the word
PYTHON_RULES = (Rule(r"(\d)?(?(1)7|\bque\b)", "reference"), Rule("procedure", "TASK"))


@register("classify_python_rule")
def q_classify_python_rule(spark, sf):
    d = docbook_corpus(spark, sf)
    return d.select("path", classify_topic(path_stem(F.col("path")), F.col("docbook"), (), PYTHON_RULES).alias("topic_type"))


BUCKETS = 32


@register("transform_bucketed")
def q_transform_bucketed(spark, sf):
    d = _docbook_with_ids(spark, sf)
    d = d.withColumn("docbook", F.when(F.col("doc_id") % 97 != 0, F.col("docbook")))
    hints = plan_hints(_plans(spark, sf)).select(F.col("plan_key").alias("path"), "plan_type")
    docs = write_bucketed(d.select("path", "docbook"), "path", BUCKETS, "intermediates")
    return transform_tables(docs, write_bucketed(hints, "path", BUCKETS, "hints"), spark, RULED)


def _ruled_topics(spark, sf):
    d = _docbook_with_ids(spark, sf)
    # every 97th intermediate is missing: an error row for that path only
    d = d.withColumn("docbook", F.when(F.col("doc_id") % 97 != 0, F.col("docbook")))
    plans = _plans(spark, sf).select("source", "default_topic_type")
    return transform_stage(d.select("path", "docbook"), plans, RULED)


@register("transform_stage")
def q_transform_stage(spark, sf):
    return _ruled_topics(spark, sf)


def _run(spark, sf):
    return _memo("run", spark, sf, lambda: run_all(_corpus(spark, sf)))


@register("assess_stage")
def q_assess_stage(spark, sf):
    out = assess_stage(_corpus(spark, sf))
    return out["plans"].select(
        F.col("source").alias("path"), "default_topic_type", F.col("risk").alias("conversion_risk"),
        F.col("readiness").alias("topicization_readiness"),
    ).join(out["clusters"].select(F.col("key").alias("path"), "leader"), "path")


@register("end_to_end")
def q_end_to_end(spark, sf):
    d = _run(spark, sf)["documents"]
    return d.select("path", "topic_type", "topic_path", F.md5("xml").alias("xml_md5"), "extract_error")


@register("topics")
def q_topics(spark, sf):
    return _run(spark, sf)["topics"].filter(F.col("error").isNull()).select("path", "topic_path", "topic_type", "xml")


@register("topic_type_counts")
def q_topic_type_counts(spark, sf):
    t = _run(spark, sf)["topics"].filter(F.col("error").isNull())
    return t.groupBy("topic_type").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("topic_map")
def q_topic_map(spark, sf):
    return _run(spark, sf)["map"]


@register("topic_count")
def q_topic_count(spark, sf):
    return _run(spark, sf)["topic_count"]


@register("load_stage")
def q_load_stage(spark, sf):
    # the map of the ruled transform over all documents, as fragments
    plans = _plans(spark, sf).select("source", "default_topic_type")
    t = transform_stage(docbook_corpus(spark, sf).select("path", "docbook"), plans, RULED)
    return map_fragments(t.filter(F.col("error").isNull()).select("topic_path"), "Docs & Notes", "dita")


@register("errors_split")
def q_errors_split(spark, sf):
    out = _run(spark, sf)
    return out["errors"]


@register("run_summary")
def q_run_summary(spark, sf):
    return _run(spark, sf)["summary"]


# ---------------------------------------------------------------- report
@register("report_summary")
def q_report_summary(spark, sf):
    return report_summary(_assessed(spark, sf))


@register("report_html")
def q_report_html(spark, sf):
    out = assess_stage(_corpus(spark, sf))
    return out["report"]


# ---------------------------------------------------------------- file sources
@register("decode_text")
def q_decode_text(spark, sf):
    # the documents as bytes: Latin-1 for odd ids whose text it can express, else UTF-8
    utf8 = (F.col("doc_id") % 2 == 0) | F.col("text").rlike(r"[^\x{0}-\x{ff}]")
    d = read_table(spark, sf, "documents").select(
        F.concat(F.lit("docs/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"),
        "text",
        F.when(utf8, F.encode("text", "UTF-8")).otherwise(F.encode("text", "ISO-8859-1")).alias("content"),
    )
    dec = decode_text(F.col("content"))
    return d.select(
        "path",
        (dec == F.col("text")).alias("round_trip"),
        F.is_valid_utf8(F.col("content").cast("string")).alias("valid_utf8"),
        F.length(dec).cast("bigint").alias("n_chars"),
    )
