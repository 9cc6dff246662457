import pytest
from pyspark.sql import functions as F

from quire.functions.text import token_count
from quire.operators.features import section_features, verb_hits
from quire.operators.inventory import assess_documents
from quire.operators.scoring import predict_topic, readiness_score, risk_score
from quire.options import AssessOptions


def test_tokens(spark):
    df = spark.createDataFrame([("hello, world!",), ("step 1 of 3",), ("",)], "t string")
    assert [r[0] for r in df.select(token_count(F.col("t"))).collect()] == [2, 4, 0]


def test_density_and_counts(spark):
    df = spark.createDataFrame(
        [
            ("Steps to Install", "Click here and run the script."),
            ("x", "1. First item\n2. Second item"),
            ("x", "| A | B |\n|---|---|\n| 1 | 2 |"),
            ("x", "![alt](a.png) and [link](b) and ![](c.png)"),
            ("x", "Parameters and OPTIONS; running clicks"),
        ],
        "title string, content string",
    )
    f = df.select(section_features(F.col("title"), F.col("content")).alias("f")).select("f.*").collect()
    assert f[0].has_steps_title is True
    assert f[0].imperative_density == pytest.approx(2 / 6)
    assert f[1].ordered_lists == 2
    assert f[2].tables == 3
    # a link pattern also counts images that have alt text
    assert (f[3].images, f[3].links) == (2, 2)
    assert f[4].reference_markers == 2
    # whole words only: "running" / "clicks" are no hits
    assert f[4].imperative_density == 0.0


def test_duplicate_verbs_count_twice(spark):
    df = spark.createDataFrame([("Click CLICK run",)], "t string")
    assert df.select(verb_hits(F.col("t"), ["click", "Click", "run"])).first()[0] == 5


def _metrics(**kw):
    base = dict(
        heading_ladder_valid=True, avg_section_tokens=200, tables_simple=True, lists_depth_ok=True,
        images_with_alt=True, deep_nesting=False, complex_tables=False, unresolved_anchors=False,
        mixed_inline_blocks=False,
    )
    base.update(kw)
    return base


def test_scores(spark):
    schema = (
        "heading_ladder_valid boolean, avg_section_tokens bigint, tables_simple boolean, lists_depth_ok boolean, "
        "images_with_alt boolean, deep_nesting boolean, complex_tables boolean, unresolved_anchors boolean, "
        "mixed_inline_blocks boolean"
    )
    rows = [
        _metrics(),
        _metrics(avg_section_tokens=1000, heading_ladder_valid=False, tables_simple=False, lists_depth_ok=False,
                 images_with_alt=False),
        _metrics(deep_nesting=True, complex_tables=True, unresolved_anchors=True, mixed_inline_blocks=True),
        _metrics(complex_tables=True),
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    m = F.struct(*df.columns)
    got = [tuple(r) for r in df.select(readiness_score(m), risk_score(m)).collect()]
    assert got == [(50, 0), (0, 0), (50, 70), (50, 25)]
    heavy = AssessOptions(topicization_weights={k: 50 for k in AssessOptions().topicization_weights})
    assert df.limit(1).select(readiness_score(m, heavy)).first()[0] == 100


def test_predictions(spark):
    schema = "ordered_lists bigint, imperative_density double, has_steps_title boolean, tables bigint, reference_markers bigint"
    df = spark.createDataFrame(
        [(3, 0.02, False, 0, 0), (0, 0.0, False, 2, 0), (0, 0.0, False, 0, 0), (0, 0.9, True, 0, 0)], schema
    )
    got = [r[0] for r in df.select(predict_topic(F.struct(*df.columns))["pred"]).collect()]
    assert got == ["task", "reference", "concept", "concept"]


SAMPLE = (
    "---\ntitle: Sample Guide\n---\n# Sample Guide\n\nThis section explains the **concepts**.\n\n## Steps\n\n"
    "1. Open the app.\n2. Click the button.\n3. Verify the result.\n\n## Reference\n\nParameters:\n- Timeout\n- Retries\n"
)


def test_sample_guide(spark):
    corpus = spark.createDataFrame([("in/sample.md", SAMPLE), ("in/x.txt", "plain")], "path string, text string")
    a = {r.path: r for r in assess_documents(corpus).collect()}
    s = a["in/sample.md"]
    assert [p.title for p in s.predictions] == ["Document", "Sample Guide", "Steps", "Reference"]
    assert [p.pred for p in s.predictions] == ["concept", "concept", "task", "reference"]
    assert s.metrics.heading_ladder_valid is True
    g = a["in/x.txt"]
    assert (g.sections, g.topicization_readiness, g.conversion_risk, g.metrics, len(g.predictions)) == (1, 50, 50, None, 0)
    assert g.raw_sections[0].content == "plain"


def test_array_form_equals_exploded_form(spark):
    """Metrics from the in-row arrays equal a groupBy over exploded section rows."""
    import os

    from quire.operators.sections import section_rows
    from quire.sources.tables import corpus

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    a = assess_documents(corpus(spark, sf)).filter(F.col("fmt") != "generic")
    rows = section_rows(a, "section_list", keep=("path",))
    f = rows.select("path", section_features(F.col("title"), F.col("content")).alias("f"))
    grouped = f.groupBy("path").agg(
        (F.sum("f.tokens") / F.count(F.lit(1))).cast("bigint").alias("avg"),
        F.bool_and(F.col("f.tables") <= 1).alias("simple"),
        F.bool_or(F.col("f.tables") > 1).alias("complex"),
        F.count(F.lit(1)).alias("n"),
    )
    arr = a.filter(F.col("sections") > 0).select(
        "path",
        F.col("metrics.avg_section_tokens").alias("avg"),
        F.col("metrics.tables_simple").alias("simple"),
        F.col("metrics.complex_tables").alias("complex"),
        F.col("sections").alias("n"),
    )
    assert arr.exceptAll(grouped.select(*arr.columns)).count() == 0
    assert grouped.select(*arr.columns).exceptAll(arr).count() == 0
