import os
import tempfile

from pyspark.sql import functions as F

from quire.functions.paths import basename, relative_path, stem, suffix
from quire.operators.classify import classify_topic
from quire.operators.routing import build_registry
from quire.operators.topics import build_topic, extract_body, extract_title, topic_type_error
from quire.options import ConvertOptions, Rule
from quire.plans.stages import run_all, transform_stage
from quire.sources.files import decode_text, read_corpus
from quire.sources.sinks import read_fragments_text, write_fragments

import pytest


def test_title_and_body(spark):
    df = spark.createDataFrame(
        [("<title>First</title><title>Second</title>",), ("no title <b>here</b> & more",),
         ("<para>One.</para><para> Two. </para>",), ("<TITLE></TITLE>",)],
        "d string",
    )
    got = df.select(extract_title(F.col("d")).alias("t"), extract_body(F.col("d")).alias("b")).collect()
    assert [g.t for g in got] == ["First", "Untitled", "Untitled", ""]
    assert got[1].b == "<p>no title here &amp; more</p>"
    assert got[2].b == "<p>One.</p><p>Two.</p>"


def test_build_topic(spark):
    df = spark.createDataFrame([("A & B", "concept"), ("T", "task"), ("R", "reference"), ("X", "glossary")], "t string, k string")
    got = df.select(build_topic(F.col("t"), F.lit("<p>b</p>"), F.col("k")).alias("x"), topic_type_error(F.col("k")).alias("e")).collect()
    assert got[0].x == '<concept id="t1"><title>A &amp; B</title><conbody><p>b</p></conbody></concept>'
    assert got[1].x.startswith('<task id="t1">') and got[2].x.endswith("</refbody></reference>")
    assert got[3].x is None and got[3].e.startswith("Unknown topic_type 'glossary'")


def test_paths(spark):
    df = spark.createDataFrame(
        [("a/b/guide.md",), ("a/.bashrc",), ("x.tar.gz",), ("dir/x.",), ("noext",)], "p string"
    )
    got = [tuple(r) for r in df.select(basename(F.col("p")), stem(F.col("p")), suffix(F.col("p"))).collect()]
    assert got == [("guide.md", "guide", ".md"), (".bashrc", ".bashrc", ""), ("x.tar.gz", "x.tar", ".gz"),
                   ("x.", "x.", ""), ("noext", "noext", "")]
    rel = spark.createDataFrame([("out/topics/guide_task.dita", "out"), ("dita/t/a.dita", "maps/x"), ("a.dita", "a")],
                                "t string, b string")
    assert [r[0] for r in rel.select(relative_path(F.col("t"), F.col("b"))).collect()] == [
        "topics/guide_task.dita", "../../dita/t/a.dita", "../a.dita"]


def test_classify_order(spark):
    rules_f = (Rule("guide*", "task"), Rule("index", "concept"))
    rules_c = (Rule("procedure", "reference"), Rule(r"\bcafé\b", "task"))
    df = spark.createDataFrame(
        [
            ("guide", "procedure text", None),       # filename rule wins over content rule
            ("index", "click", None),                # stem matched: index.md / index.html
            ("other", "a PROCEDURE", None),          # content rule, case-insensitive
            ("other", "Click the button.", "concept"),  # valid plan hint beats heuristics
            ("other", "Click the button.", "bogus"),    # invalid hint ignored → task words
            ("other", "see the table of values", None),  # reference words
            ("other", "nothing here", None),
            ("other", "un café noir", None),         # \b is Unicode-aware as in Python
        ],
        "stem string, content string, plan string",
    )
    got = [r[0] for r in df.select(classify_topic(F.col("stem"), F.col("content"), rules_f, rules_c, F.col("plan"))).collect()]
    assert got == ["task", "concept", "reference", "concept", "task", "reference", "concept", "task"]


def test_registry():
    reg = build_registry({".docx": "oxygen-docx"}, ("oxygen-docx",))
    assert reg[".docx"] == "oxygen-docx" and reg[".htm"] == "pandoc-html"
    with pytest.raises(ValueError):
        build_registry({".md": "nope"})


def test_transform_errors_and_plans(spark):
    inter = spark.createDataFrame(
        [("in/guide.md", "<title>G</title><para>Click it.</para>"), ("in/ref.md", None), ("in/c.md", "<para>x</para>")],
        "path string, docbook string",
    )
    plans = spark.createDataFrame([("in/c.md", "reference")], "source string, default_topic_type string")
    out = {r.path: r for r in transform_stage(inter, plans).collect()}
    assert out["in/guide.md"].topic_path == "dita/topics/guide_task.dita"
    assert out["in/ref.md"].error is not None and out["in/ref.md"].xml is None
    assert out["in/c.md"].topic_type == "reference"


def test_files_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="quire-files-", dir="/tmp")
    os.makedirs(os.path.join(root, "sub"))
    with open(os.path.join(root, "a.md"), "wb") as f:
        f.write("# Café\r\n\r\nClick run.\r\n".encode("utf-8"))
    with open(os.path.join(root, "sub", "b.html"), "wb") as f:
        f.write("<h1>Caf\xe9</h1><p>text</p>".encode("latin-1"))
    with open(os.path.join(root, "c.txt"), "w") as f:
        f.write("ignored")
    corpus = read_corpus(spark, root, [".md", ".html"])
    got = {os.path.basename(r.path): r.text for r in corpus.collect()}
    assert got == {"a.md": "# Café\n\nClick run.\n", "b.html": "<h1>Café</h1><p>text</p>"}
    out = run_all(corpus)
    assert out["topic_count"].first()[0] == 2
    write_fragments(out["map"], os.path.join(root, "out", "map"))
    text = read_fragments_text(spark, os.path.join(root, "out", "map"))
    assert text.startswith('<?xml version="1.0"') and text.endswith("</map>\n") and text.count("<topicref") == 2


def test_empty_map(spark):
    from quire.operators.topics import map_fragments

    root = tempfile.mkdtemp(prefix="quire-map-", dir="/tmp")
    empty = spark.createDataFrame([], "topic_path string")
    write_fragments(map_fragments(empty, "A & B", "dita"), root + "/m")
    text = read_fragments_text(spark, root + "/m")
    assert "<title>A &amp; B</title>\n\n</map>\n" in text


def test_decode(spark):
    df = spark.createDataFrame([(bytearray("café".encode("utf-8")),), (bytearray("café".encode("latin-1")),)], "c binary")
    assert [r[0] for r in df.select(decode_text(F.col("c"))).collect()] == ["café", "café"]


def test_plan_sink_round_trip(spark):
    from quire.operators.inventory import assess_documents
    from quire.plans.conversion_plan import conversion_plans, plan_json, read_plans
    from quire.sources.sinks import write_plans

    corpus = spark.createDataFrame([("d/guide.md", "# G\n\n1. Click it\n"), ("e/guide.md", "text")], "path string, text string")
    plans = conversion_plans(assess_documents(corpus))
    root = tempfile.mkdtemp(prefix="quire-plans-", dir="/tmp")
    write_plans(plan_json(plans), root + "/plans")
    back = {r.source: r for r in read_plans(spark, root + "/plans").collect()}
    assert back["d/guide.md"].default_topic_type == "task"
    assert back["d/guide.md"].plan_file == "guide.md.conversion_plan.json"
    assert back["e/guide.md"].chunking.nested_topics is True


def test_semantics_that_are_easy_to_get_wrong(spark):
    from quire.operators.sections import markdown_sections

    # Q2: '#' inside a code fence is a heading; '# ' with nothing after is a heading with empty title
    df = spark.createDataFrame([("```\n# not code\n```\n# \nx",)], "t string")
    secs = [(s.level, s.title) for s in df.select(markdown_sections(F.col("t")).alias("s")).first().s]
    assert secs == [(0, "Document"), (1, "not code"), (1, "")]
    # Q11: filename rules see the stem, so a pattern ending in '.md' never matches
    rules = (Rule("*HOWTO*.md", "task"),)
    st = spark.createDataFrame([("my_HOWTO_guide",)], "stem string")
    got = st.select(classify_topic(F.col("stem"), F.lit("plain words"), rules, ())).first()[0]
    assert got == "concept"
    # Q15: a.md and a.html of one type share one topic path
    inter = spark.createDataFrame([("x/a.md", "<para>p</para>"), ("y/a.html", "<para>q</para>")], "path string, docbook string")
    paths = {r.topic_path for r in transform_stage(inter).collect()}
    assert paths == {"dita/topics/a_concept.dita"}


def test_source_extensions():
    from quire.sources.files import source_extensions

    fmts = {"treat_as_html": [".html", ".htm"], "treat_as_markdown": [".md", "md", 3]}
    assert source_extensions(fmts) == [".htm", ".html", ".md"]
    assert source_extensions({}) == [".md", ".docx", ".html"]


def test_python_regex_translation(spark):
    from quire.functions.regex import python_regex_to_java

    pat = python_regex_to_java(r"(?P<w>ab)\s+(?P=w)\b")
    df = spark.createDataFrame([("ab  ab",), ("ab ac",), ("ab　abc",)], "t string")
    assert [r[0] for r in df.select(F.col("t").rlike(pat)).collect()] == [True, False, False]


def test_fragment_writer_refuses_existing_folder(spark):
    from quire.operators.topics import map_fragments

    root = tempfile.mkdtemp(prefix="quire-exists-", dir="/tmp")
    frags = map_fragments(spark.createDataFrame([("dita/topics/a.dita",)], "topic_path string"), "T", "dita")
    write_fragments(frags, root + "/m")
    with pytest.raises(Exception, match="(?i)already exists"):
        write_fragments(frags, root + "/m")


def test_html_paragraphs(spark):
    from quire.operators.convert import html_article

    html = [
        "<p>one</p><p>two</p><script>var x=1;</script>",
        "<style>p {}</style><h1>A &amp; <b>B</b></h1><div>x <i>y</i><br>z</div><!-- <p>no</p> --><ul><li>1</li><li>2</li></ul>",
        "plain\ntext", "", None, "<SCRIPT type='a'>\n<p>q</p>\n</SCRIPT ><P class=x>upper</P>", "<pre>k</pre><param>m",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(html)], "i int, t string").coalesce(1)
    got = {r.i: r.d for r in df.select("i", html_article(F.col("t")).alias("d")).collect()}
    assert got[0] == "<article><para>one</para><para>two</para></article>"
    assert got[1] == (
        "<article><section><title>A &amp; B</title><para>x <emphasis>y</emphasis></para><para>z</para>"
        "<itemizedlist><listitem><para>1</para></listitem><listitem><para>2</para></listitem></itemizedlist></section></article>"
    )
    assert got[2] == "<article><para>plain\ntext</para></article>"
    assert got[3] == got[4] == "<article></article>"
    assert got[5] == "<article><para>upper</para></article>"
    assert got[6] == "<article><programlisting>k</programlisting><para>m</para></article>"


def test_failing_converter(spark):
    from quire.operators.routing import BatchConverter
    from quire.plans.stages import extract_stage, run_all

    def convert(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("cannot read bad")
        if any("short" in t for t in texts):
            return []
        return [None if t == "nothing" else f"<article><para>{t}</para></article>" for t in texts]

    rows = [(f"{i}.txt", t) for i, t in enumerate(["a", "bad one", "", None, "nothing", "short", "b"] * 3)] + [("x.md", "# bad"), ("y.xyz", "bad")]
    corpus = spark.createDataFrame(rows, "path string, text string").coalesce(1)
    copts = ConvertOptions(handlers={"mine": BatchConverter(convert)}, handler_overrides={".txt": "mine"})
    got = {r.path: (r.docbook, r.error) for r in extract_stage(corpus, copts).collect()}
    for path, text in rows[:21]:
        docbook, error = got[path]
        if text in ("bad one", "nothing", "short"):
            assert docbook is None and error == {"bad one": "cannot read bad", "nothing": "The converter returned nothing", "short": "0 intermediates for 1 texts"}[text]
        else:
            assert docbook == f"<article><para>{text or ''}</para></article>" and error is None
    assert got["x.md"][1] is None and "No extractor" in got["y.xyz"][1]
    out = run_all(corpus, copts=copts)
    assert {(r.stage, r.path) for r in out["errors"].collect()} == {("extract", p) for p, (_, e) in got.items() if e}
    assert out["topic_count"].first()[0] == sum(e is None for _, e in got.values())


def test_bucketed_plan_join_moves_nothing(spark):
    from quire.plans.stages import transform_tables
    from quire.sources.sinks import write_bucketed

    rows = [(f"d/{i}.md", f"<title>T{i}</title><para>p</para>" if i % 5 else None) for i in range(200)] + [("d/0.md", "<para>again</para>")]
    inter = spark.createDataFrame(rows, "path string, docbook string").repartition(3)
    hints = spark.createDataFrame([(f"d/{i}.md", "task" if i % 2 else "reference") for i in range(150)], "path string, plan_type string").repartition(2)
    tables = write_bucketed(inter, "path", 4, "docs"), write_bucketed(hints, "path", 4, "hints")
    out = transform_tables(*tables, spark)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    want = transform_stage(inter, hints.select(F.col("path").alias("source"), F.col("plan_type").alias("default_topic_type")))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


def test_rules_in_pythons_dialect(spark):
    import re

    texts = ["a7", "7", "x que y", "queue", "A que", "", None, "17", "nothing"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    pattern = r"(\d)?(?(1)7|\bque\b)"
    got = [r[0] for r in df.select(classify_topic(F.lit("s"), F.col("t"), (), (Rule(pattern, "reference"),))).collect()]
    assert got == ["reference" if re.search(pattern, t or "", re.I) else "concept" for t in texts]
    with pytest.raises(ValueError):
        classify_topic(F.lit("s"), F.lit("t"), (), (Rule("(", "task"),))


def test_numbering_of_huge_and_small_groups(spark):
    from quire.operators.numbering import numbered

    rows = [("hot", i) for i in range(3000)] + [(f"g{i % 40}", i) for i in range(200)] + [(None, 5), (None, 3)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbered(df, ["g"], ["k"]).collect()
        alone = numbered(df, [], ["g", "k"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = {}
    for g, k in rows:
        groups.setdefault(g, []).append(k)
    assert sorted((r.g or "", r.k, r.position) for r in got) == sorted((g or "", k, i) for g, ks in groups.items() for i, k in enumerate(sorted(ks)))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r.g, r.k) for r in sorted(alone, key=lambda r: r.position)] == order and len({r.position for r in alone}) == len(rows)
    assert numbered(df.limit(0), ["g"], ["k"]).collect() == []


def test_body_without_paragraphs_is_whole(spark):
    from quire.operators.topics import extract_body

    df = spark.createDataFrame([("<a>" + "x" * 5000 + "</a>",)], "d string")
    row = df.select(extract_body(F.col("d")).alias("whole"), extract_body(F.col("d"), 200).alias("cut")).first()
    assert row.whole == "<p>" + "x" * 5000 + "</p>" and row.cut == "<p>" + "x" * 200 + "</p>"


def test_user_converter(spark):
    from quire.options import ConvertOptions
    from quire.plans.stages import extract_stage, run_all

    corpus = spark.createDataFrame([("a.txt", "hello"), ("b.md", "# T\n\np"), ("c.xyz", "")], "path string, text string")
    copts = ConvertOptions(
        handlers={"mine": lambda c: F.concat(F.lit("<article><para>"), F.upper(c), F.lit("</para></article>"))}, handler_overrides={".txt": "mine"}
    )
    got = {r.path: (r.handler, r.docbook, r.error) for r in extract_stage(corpus, copts).collect()}
    assert got["a.txt"] == ("mine", "<article><para>HELLO</para></article>", None)
    assert got["b.md"][0] == "pandoc-md" and "No extractor" in got["c.xyz"][2]
    assert run_all(corpus, copts=copts)["topic_count"].first()[0] == 2
    with pytest.raises(ValueError, match="Unknown extractor"):
        extract_stage(corpus, ConvertOptions(handler_overrides={".txt": "mine"}))


def test_writers_round_trip(spark):
    from quire.operators.inventory import assess_documents, inventory
    from quire.operators.topics import map_fragments
    from quire.plans.conversion_plan import conversion_plans, plan_json, read_plans
    from quire.plans.report import report_fragments
    from quire.sources.sinks import write_clusters, write_inventory, write_plans, write_topics

    root = tempfile.mkdtemp(prefix="quire-writers-", dir="/tmp")
    corpus = spark.createDataFrame(
        [(f"d/{i}.md", f"# Title {i}\n\nClick & run \"{i}\".\n\n## Steps\n\n1. open\n2. press\n") for i in range(40)], "path string, text string"
    )
    assessed = assess_documents(corpus)
    inv = inventory(assessed)
    write_inventory(inv, root + "/inv")
    back = spark.read.schema(inv.schema).json(root + "/inv")
    assert sorted(map(str, back.collect())) == sorted(map(str, inv.collect()))
    plans = conversion_plans(assessed)
    write_plans(plan_json(plans), root + "/plans")
    got = read_plans(spark, root + "/plans").select(plans.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, plans.collect()))
    pairs = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "key string, leader string")
    write_clusters(pairs, root + "/clusters")
    assert sorted((r.leader, r.key) for r in spark.read.json(root + "/clusters").collect()) == [("a", "a"), ("a", "b"), ("c", "c")]
    topics = corpus.select("path", F.concat("path", F.lit(".dita")).alias("topic_path"), F.lit("<x/>").alias("xml"), F.lit("task").alias("topic_type"), F.lit(None).cast("string").alias("error"))
    write_topics(topics, root + "/topics")
    assert spark.read.json(root + "/topics").filter("topic_type = 'task'").count() == 40
    # map and report: the files are the fragments in order
    for name, frags in (("map", map_fragments(topics, "T", "d")), ("report", report_fragments(inv, pairs))):
        write_fragments(frags.repartition(7), f"{root}/{name}")
        want = "".join(r.fragment for r in sorted(frags.collect(), key=lambda r: (r.part, r.k1, r.k2, r.k3)))
        assert read_fragments_text(spark, f"{root}/{name}") == want
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark says about a scheme it has no file system for
        write_fragments(map_fragments(topics, "T", "d"), "nosuchscheme://box/out/map")


def test_hot_basename(spark):
    from quire.plans.conversion_plan import join_plans

    docs = spark.createDataFrame([(f"d{i}/README.md",) for i in range(200)] + [("x/other.md",)], "path string")
    plans = spark.createDataFrame([(f"d{i}/README.md", "task" if i == 99 else "concept") for i in range(200)], "source string, default_topic_type string")
    got = join_plans(docs, plans, "basename").collect()
    assert len(got) == 201 and {r.plan_type for r in got if r.path.startswith("d")} == {"task"}
    assert [r.plan_type for r in got if r.path == "x/other.md"] == [None]
