"""Measured metrics: list depth, anchors across documents, option against the constant defaults."""

from pyspark.sql import functions as F

from quire.operators.inventory import assess_documents
from quire.operators.measured import anchors, list_depth, measured, unresolved


def test_list_depth(spark):
    cases = [
        ("", 0), ("text", 0), ("- a\n- b", 1), ("- a\n  - b\n    - c\n- d", 3), ("1. a\n   - b\n\n   more\n      - c", 3), ("- a\n\ntext\n\n  - b", 1),
        ("- a\n    - b\n  - c\n      - d", 3), ("-no item\n*neither*", 0), ("- a\n" * 2000, 1), ("".join(" " * k + "- x\n" for k in range(60)), 60),
    ]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string").coalesce(1)
    assert [r[0] for r in df.select(list_depth(F.col("t"))).collect()] == [d for _, d in cases]


def test_anchors_are_resolved_across_documents(spark):
    docs = {
        "d/a.md": "# One & Two\n\n# Same\n\n# Same\n\n[ok](#one--two) [again](#same-1) [b](b.md) [c](sub/c.md#Über-uns) ![img](none.png)",
        "d/b.md": "no headings [up](../d/a.md#same) [web](https://x#y) [mail](mailto:x)",
        "d/sub/c.md": "# Über uns\n[back](../a.md#same-2)",
        "d/sub/e.md": "[gone](missing.md)", "d/f.md": "[self](f.md) [lost](#lost)", "d/g.md": None, "d/h.html": "<a href='#x'>y</a>",
    }
    corpus = spark.createDataFrame(list(docs.items()), "path string, text string").coalesce(1)
    assessed = assess_documents(corpus)
    assert {(r.path, r.anchor) for r in anchors(assessed.filter("path = 'd/a.md'")).collect()} == {("d/a.md", a) for a in ("one--two", "same", "same-1")}
    md = assessed.filter("fmt = 'md'").select("path", F.coalesce("text", F.lit("")).alias("text"), "section_list")
    assert {r.path for r in unresolved(md).collect()} == {"d/sub/c.md", "d/sub/e.md", "d/f.md"}
    out = {r.path: r for r in measured(assessed).collect()}
    assert len(out) == len(docs) and {p for p, r in out.items() if r.metrics.unresolved_anchors} == {"d/sub/c.md", "d/sub/e.md", "d/f.md"}
    assert out["d/f.md"].conversion_risk == 15 and out["d/b.md"].conversion_risk == 0
    # the defaults stay constants
    before = {r.path: r for r in assessed.collect()}
    assert not any(r.metrics.unresolved_anchors for r in before.values()) and before["d/h.html"].metrics == out["d/h.html"].metrics
    assert measured(assessed.limit(0)).collect() == []


def test_anchors_are_shared_by_many_tasks_and_the_join_carries_no_texts(spark):
    corpus = spark.createDataFrame([(f"d/{k}.md", f"# A\n\n[x](#a) [y](#b{k})") for k in range(50)], "path string, text string")
    assessed = assess_documents(corpus)
    md = assessed.filter("fmt = 'md'").select("path", F.coalesce("text", F.lit("")).alias("text"), "section_list")
    lost = unresolved(md)
    assert len(lost.collect()) == 50 and lost.rdd.getNumPartitions() >= 200
    plan = measured(assessed).select("path", "metrics")._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    carried = plan.children().head().output().mkString(",")
    assert "metrics" in carried and "text" not in carried


def test_anchors_are_not_sent_whole_to_every_task(spark, tmp_path):
    """However small the planner takes the documents to be (by their file), their anchors are merged, not broadcast."""
    spark.createDataFrame([("d/a.md", "# A\n\n[x](#a) [y](#b)"), ("d/b.md", "[z](a.md#a)")], "path string, text string").write.parquet(f"{tmp_path}/corpus")
    assessed = assess_documents(spark.read.parquet(f"{tmp_path}/corpus"))
    out = measured(assessed).select("path", "metrics.unresolved_anchors")
    assert "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()
    assert {tuple(r) for r in out.collect()} == {("d/a.md", True), ("d/b.md", False)}
