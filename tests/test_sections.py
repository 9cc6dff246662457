from pyspark.sql import functions as F

from quire.operators.sections import heading_ladder_valid, html_sections, markdown_sections


def _secs(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", fn(F.col("t")).alias("s")).orderBy("i").collect()
    return [[(s.level, s.title, s.content) for s in r.s] for r in out]


def test_markdown_fixtures(spark):
    got = _secs(spark, markdown_sections, [
        "# One\n\nFirst.\n## Two\n\nSecond.",
        "Intro text.\n# Section",
        "",
        "# A\n# B\nContent",
        "\n# A",
        "####### seven\n#\tTab title  \n",
        "a\r\nb\r# H\x0cx",
    ])
    assert got[0] == [(1, "One", "First."), (2, "Two", "Second.")]
    assert got[1] == [(0, "Document", "Intro text."), (1, "Section", "")]
    assert got[2] == []
    assert got[3] == [(1, "A", ""), (1, "B", "Content")]
    # a blank line before the first heading already makes a preamble
    assert got[4] == [(0, "Document", ""), (1, "A", "")]
    # seven '#' is no heading; a tab separates level and title
    assert got[5] == [(0, "Document", "####### seven"), (1, "Tab title", "")]
    # every splitlines break counts (\r\n, \r, form feed)
    assert got[6] == [(0, "Document", "a\nb"), (1, "H", "x")]


def test_html_fixtures(spark):
    got = _secs(spark, html_sections, [
        '<h1 id="foo" class="bar">Text</h1><p>body</p>',
        "<p>Intro text.</p><h1>Section</h1>",
        "<p> </p><H2>A</h3>x<h1><b>B</b></h1>",
        "",
    ])
    assert got[0] == [(1, "Text", "body")]
    assert got[1] == [(0, "Document", "Intro text."), (1, "Section", "")]
    # blank preamble dropped, closing level may differ, tags removed from titles
    assert got[2] == [(2, "A", "x"), (1, "B", "")]
    assert got[3] == []


def test_heading_ladder(spark):
    cases = [[1, 2, 3], [2, 3, 2], [1, 3], [], [2], [2, 2, 2], [0, 3], [3]]
    expect = [True, True, False, True, True, True, False, True]
    df = spark.createDataFrame(
        [(i, [(lv, "t", "c") for lv in c]) for i, c in enumerate(cases)],
        "i int, s array<struct<level:int,title:string,content:string>>",
    )
    got = [r.ok for r in df.select("i", heading_ladder_valid(F.col("s")).alias("ok")).orderBy("i").collect()]
    assert got == expect
