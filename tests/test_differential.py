"""Random tricky texts through the Spark operators and the independent DuckDB statements."""

import random

import duckdb
from pyspark.sql import functions as F

from quire import oracle
from quire.operators.features import section_features
from quire.operators.sections import html_sections, markdown_sections

PIECES = [
    "#", "##", "###", "######", "#######", " ", "\t", "　", "\xa0", "\n", "\n\n", "\r\n", "\r", "\x0c",
    "\x1f", " ", "word", "Click", "run", "1.", "2)", "-", "*", "+", "|", "| a |", "![i](x)", "[l](y)",
    "Parameters", "options", "steps", "é", "ß", "_", "<h1>", "</h1>", "<H2 x=1>", "</h3>", "<p>", "<b>", ">",
]


def _texts(seed, n):
    rng = random.Random(seed)
    return [("t%03d" % i, "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 40)))) for i in range(n)]


def _duck(rows, fmt, select):
    con = duckdb.connect()
    con.execute("CREATE TABLE src(path VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO src VALUES (?, ?)", rows)
    sql = (
        f"WITH corpus AS (SELECT path, coalesce(text, '') AS text, '{fmt}' AS fmt FROM src),"
        + ",".join([oracle.MD_SECTIONS, oracle.HTML_SECTIONS])
        + "\n" + select
    )
    return sorted(tuple(r) for r in con.execute(sql).fetchall())


def _spark_sections(spark, rows, fn):
    df = spark.createDataFrame(rows, "path string, text string")
    out = df.select("path", F.posexplode(fn(F.col("text"))).alias("i", "s")).select(
        "path", F.col("i").cast("bigint"), F.col("s.level").cast("bigint"), "s.title", "s.content"
    )
    return sorted(tuple(r) for r in out.collect())


def test_markdown_sections_random(spark):
    rows = _texts(5, 400)
    want = _duck(rows, "md", "SELECT path, section_index, level, title, content FROM md_sections")
    assert _spark_sections(spark, rows, markdown_sections) == want


def test_html_sections_random(spark):
    rows = _texts(6, 400)
    want = _duck(rows, "html", "SELECT path, section_index, level, title, content FROM html_sections")
    assert _spark_sections(spark, rows, html_sections) == want


def test_features_random(spark):
    rows = _texts(7, 400)
    con = duckdb.connect()
    con.execute("CREATE TABLE src(path VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO src VALUES (?, ?)", rows)
    sql = (
        "WITH corpus AS (SELECT path, text AS title, text AS content FROM src),"
        + oracle.FEATURES.replace("SELECT * FROM md_sections UNION ALL SELECT * FROM html_sections",
                                  "SELECT path, 0 AS section_index, 0 AS level, title, content FROM corpus")
        + "\nSELECT path, tokens, ordered_lists, unordered_lists, tables, images, links, has_steps_title, "
        "verb_hits, reference_markers FROM feat"
    )
    want = sorted(tuple(r) for r in con.execute(sql).fetchall())
    df = spark.createDataFrame(rows, "path string, text string")
    from quire.operators.features import verb_hits
    from quire.options import TASK_KEYWORDS

    f = df.select("path", section_features(F.col("text"), F.col("text")).alias("f"),
                  verb_hits(F.col("text"), TASK_KEYWORDS).alias("verb_hits"))
    got = sorted(tuple(r) for r in f.select(
        "path", "f.tokens", "f.ordered_lists", "f.unordered_lists", "f.tables", "f.images", "f.links",
        "f.has_steps_title", "verb_hits", "f.reference_markers").collect())
    assert got == want


# FIXED VALUES: the Python patterns whose match counts the section features are
# (tokens, ordered items, unordered items, pipe rows, images, links), in that order.
PY_FEATURE_PATTERNS = [
    (r"\w+", 0),
    (r"^\s*\d+[.)]\s+", "M"),
    (r"^\s*[-*+]\s+", "M"),
    (r"^\s*\|.*\|\s*$", "M"),
    (r"!\[([^\]]*)\]\(([^)]+)\)", 0),
    (r"\[([^\]]+)\]\(([^)]+)\)", 0),
]


def test_features_match_python_re(spark):
    import re

    rows = _texts(8, 400)
    df = spark.createDataFrame(rows, "path string, text string")
    f = df.select("path", section_features(F.lit(""), F.col("text")).alias("f")).select(
        "path", "f.tokens", "f.ordered_lists", "f.unordered_lists", "f.tables", "f.images", "f.links"
    )
    got = {r[0]: tuple(r[1:]) for r in f.collect()}
    for path, text in rows:
        want = tuple(
            len(re.findall(p, text, re.MULTILINE if flag == "M" else 0)) for p, flag in PY_FEATURE_PATTERNS
        )
        assert got[path] == want, (path, text)
    # whole-word, case-insensitive verb hits
    from quire.operators.features import verb_hits

    verbs = ["click", "run", "open"]
    vh = {r[0]: r[1] for r in df.select("path", verb_hits(F.col("text"), verbs)).collect()}
    for path, text in rows:
        want = sum(len(re.findall(r"\b" + re.escape(v) + r"\b", text, re.IGNORECASE)) for v in verbs)
        assert vh[path] == want, (path, text)


MARKUP = ["<title>", "</title>", "<TITLE>", "<para>", "</para>", "<PARA>", "<h1>", "</h2>", "<h3 id=x>", "<b>",
          "</b>", "\n", "\r\n", " ", "x", "é", "&", "<", ">", "<>", "title", "para"]


def test_markup_regexes_match_python_re(spark):
    import re

    from quire.operators.sections import HTML_HEADING
    from quire.operators.topics import PARA_RE, TITLE_RE

    rng = random.Random(9)
    rows = [("m%03d" % i, "".join(rng.choice(MARKUP) for _ in range(rng.randrange(0, 30)))) for i in range(400)]
    df = spark.createDataFrame(rows, "path string, d string")
    d = F.col("d")
    got = {r[0]: tuple(r[1:]) for r in df.select(
        "path",
        d.rlike(TITLE_RE),
        F.regexp_extract(d, TITLE_RE, 1),
        F.regexp_extract_all(d, F.lit(PARA_RE), 1),
        F.regexp_replace(d, "<[^>]+>", ""),
        F.regexp_extract_all(d, F.lit(HTML_HEADING), 1),
        F.regexp_extract_all(d, F.lit(HTML_HEADING), 2),
    ).collect()}
    # FIXED VALUES: the Python patterns of title, paragraph, tag and HTML heading
    title = re.compile(r"<title>(.*?)</title>", re.IGNORECASE)
    para = re.compile(r"<para>(.*?)</para>", re.IGNORECASE | re.DOTALL)
    heading = re.compile(r"<h([1-6])(?:[^>]*)>(.*?)</h[1-6]>", re.IGNORECASE | re.DOTALL)
    for path, text in rows:
        m = title.search(text)
        heads = heading.findall(text)
        want = (
            m is not None,
            m.group(1) if m else "",
            para.findall(text),
            re.sub(r"<[^>]+>", "", text),
            [h[0] for h in heads],
            [h[1] for h in heads],
        )
        assert got[path] == want, (path, text)


def test_random_classes_and_globs_equal_python(spark):
    """Rule patterns with Python-only class syntax, against re and fnmatch."""
    import fnmatch
    import random
    import re

    from quire.functions.regex import checked_java_pattern, glob_to_java, python_regex_to_java

    rng = random.Random(17)
    parts = ["a", "b-d", "[", "&&", "&", r"\W", r"\S", r"\D", r"\w", r"\s", r"\d", "é", "^", "~", "_", r"\]", ".", "|"]
    patterns = ["[a[]b", r"^[\W]$", r"[^\W\d]x", "[]a]", "[^]a]+", "[[:]b", r"[\S\s]", r"[^\S]", "[a&&b]"]
    for _ in range(40):
        body = "".join(rng.sample(parts, rng.randint(1, 4))).lstrip("^")
        if body:
            patterns.append(f"{rng.choice(['', '^', 'x?'])}[{rng.choice(['', '^'])}{body}]{rng.choice(['', '+', 'b', '$'])}")
    usable = []
    for p in patterns:
        try:
            re.compile(p)
        except re.error:
            continue
        usable.append(p)
    texts = ["", "a", "b", "[b", "ab", "&", "é", "É1", " ", "_", "^", "~x", "]", "x&&y", "١", "a b", "|", ".", "9x", "-"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cols = [F.col("t").rlike("(?iud)" + checked_java_pattern(python_regex_to_java(p), p)).alias(f"c{i}") for i, p in enumerate(usable)]
    for row in df.select("t", *cols).collect():
        for i, p in enumerate(usable):
            assert row[f"c{i}"] == bool(re.search(p, row.t, re.IGNORECASE)), (p, row.t)
    globs = ["[a[]b", "a[x[]b", "[!a]*", "[[]", "a?[&&]", "*.[]x]", "[^a]"]
    cols = [F.col("t").rlike(checked_java_pattern(glob_to_java(g), g)).alias(f"c{i}") for i, g in enumerate(globs)]
    names = texts + ["a[b", "axb", "[", "ab&", "q.]", "q.x", "^"]
    for row in spark.createDataFrame([(t,) for t in names], "t string").select("t", *cols).collect():
        for i, g in enumerate(globs):
            assert row[f"c{i}"] == fnmatch.fnmatchcase(row.t, g), (g, row.t)


def test_rules_that_cannot_be_used_are_named_on_the_driver(spark):
    import pytest

    from quire.operators.classify import classify_topic
    from quire.options import Rule

    with pytest.raises(ValueError, match=r"\(unclosed"):
        classify_topic(F.col("s"), F.col("c"), rules_by_content=(Rule("(unclosed", "task"),))
    # a conditional group has no Java form: Python evaluates the rule
    df = spark.createDataFrame([("s", "xa"), ("s", "xb"), ("s", "b")], "s string, c string")
    topic = classify_topic(F.col("s"), F.col("c"), rules_by_content=(Rule("(x)?(?(1)a|^b)", "task"),))
    assert [r[0] for r in df.coalesce(1).select(topic).collect()] == ["task", "concept", "task"]
