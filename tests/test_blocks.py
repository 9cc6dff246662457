"""Markdown blocks, HTML structure and references, on fixtures and against plain versions."""

import html
import random
import xml.dom.minidom

import pytest
from pyspark.sql import functions as F

from quire.functions.entities import html_unescape
from quire.functions.regex import WORDS
from quire.functions.text import OTHER_BREAKS, plain, token_count, tokens_lower
from quire.operators.blocks import CONTROL
from quire.operators.convert import html_article, markdown_article
from quire.operators.features import verb_hits
from quire.options import TASK_KEYWORDS

MARKDOWN = [
    ("", ""), (None, ""), ("plain", "<para>plain</para>"),
    ("```python\n# not a heading\nx = 1 < 2\n```\nafter\n~~~\nopen\n# still",
     '<programlisting language="python"># not a heading\nx = 1 &lt; 2</programlisting><para>after</para><programlisting>open\n# still</programlisting>'),
    ("- a\n- b\n  - b1\n  - b2\n    1. deep\n\n    para in deep\n- c\n\nend\n",
     "<itemizedlist><listitem><para>a</para></listitem><listitem><para>b</para><itemizedlist><listitem><para>b1</para></listitem><listitem><para>b2</para>"
     "<orderedlist><listitem><para>deep</para></listitem></orderedlist><para>para in deep</para></listitem></itemizedlist></listitem>"
     "<listitem><para>c</para></listitem></itemizedlist><para>end</para>"),
    ("1. one\n2. two\n3) three", '<orderedlist><listitem><para>one</para></listitem><listitem><para>two</para></listitem></orderedlist>'
     '<orderedlist startingnumber="3"><listitem><para>three</para></listitem></orderedlist>'),
    ("* * *\n> quote **b**\n> - l1\n> - l2",
     '<blockquote><para>quote <emphasis role="strong">b</emphasis></para><itemizedlist><listitem><para>l1</para></listitem><listitem><para>l2</para></listitem></itemizedlist></blockquote>'),
    ("| a | b\\|c |\n| --- | :-: |\n| 1 | 2 | 3 |\n| x |",
     '<table><tgroup cols="2"><thead><row><entry>a</entry><entry>b|c</entry></row></thead><tbody><row><entry>1</entry><entry>2</entry></row>'
     "<row><entry>x</entry><entry></entry></row></tbody></tgroup></table>"),
    ("| a | b |\n| --- |\ntext", "<para>| a | b |\n| --- |\ntext</para>"),
    ("Title\n=====\n\nSub\n---\np\n\n    code\n      more\n\nlast",
     "<section><title>Title</title></section><section><title>Sub</title><para>p</para><programlisting>code\n  more</programlisting><para>last</para></section>"),
    ("---\ntitle: x\n---\n# H\ntext\n# \nempty title\n## T ##", "<section><title>H</title><para>text</para></section><section><title></title><para>empty title</para></section><section><title>T</title></section>"),
    ("*em* **strong** `a <x>` [spec](http://x/?a=1&b=2) ![i](a.png) [r][One] [one] [none] \\*lit\\* <http://u.v>\n\n[one]: http://one \"t\"\n[one]: http://two",
     '<para><emphasis>em</emphasis> <emphasis role="strong">strong</emphasis> <literal>a &lt;x&gt;</literal> <ulink url="http://x/?a=1&amp;b=2">spec</ulink> '
     '<inlinemediaobject><imageobject><imagedata fileref="a.png"/></imageobject><textobject><phrase>i</phrase></textobject></inlinemediaobject> '
     '<ulink url="http://one">r</ulink> <ulink url="http://one">one</ulink> [none] *lit* <ulink url="http://u.v">http://u.v</ulink></para>'),
    ("a_b_c **x *y* z** __s__ _e_ 2*3*4 ***junk x*** y", '<para>a_b_c <emphasis role="strong">x <emphasis>y</emphasis> z</emphasis> <emphasis role="strong">s</emphasis> <emphasis>e</emphasis> 2*3*4 ***junk x*** y</para>'),
    ("- x\nlazy\n\n\n- y\n\n  second", "<itemizedlist><listitem><para>x\nlazy</para></listitem><listitem><para>y</para><para>second</para></listitem></itemizedlist>"),
]
PAGES = [
    ("<p>Caf&eacute;&nbsp;&#8217;s &#x1F600; &amp;lt; &bogus; &amp &#150; &#0;</p>", "<para>Café\xa0’s 😀 &amp;lt; &amp;bogus; &amp;amp – �</para>"),
    ("<ul><li>a<ul><li>a1<li>a2</ul><li><p>b</p><p>c</p></li></ul>text<ol><li>x</ol>",
     "<itemizedlist><listitem><para>a</para><itemizedlist><listitem><para>a1</para></listitem><listitem><para>a2</para></listitem></itemizedlist></listitem>"
     "<listitem><para>b</para><para>c</para></listitem></itemizedlist><para>text</para><orderedlist><listitem><para>x</para></listitem></orderedlist>"),
    ("<table><tr><th>h<th>i</tr><tr><td>1<td><ul><li>z</ul></table>after",
     "<informaltable><tbody><tr><td><para>h</para></td><td><para>i</para></td></tr><tr><td><para>1</para></td><td><itemizedlist><listitem><para>z</para></listitem></itemizedlist></td></tr></tbody></informaltable><para>after</para>"),
    ("<h1>A &amp; <b>B</b></h1><pre class=x>line 1\n  line <b>2</b> &lt;\n\nline 4</pre>tail <b>bold</b> <code>c&lt;d</code> <a href=\"/x?a=1&amp;b=2\">go <em>there</em></a>",
     "<section><title>A &amp; B</title><programlisting>line 1\n  line 2 &lt;\n\nline 4</programlisting><para>tail <emphasis role=\"strong\">bold</emphasis> <literal>c&lt;d</literal> "
     "<ulink url=\"/x?a=1&amp;b=2\">go <emphasis>there</emphasis></ulink></para></section>"),
    # not nested as they should be: paragraphs
    ("<ul>loose<li>a</ul>", "<para>loose</para><para>a</para>"), ("<li>a</li></ul>", "<para>a</para>"), ("<ol><li>a</ul>", "<para>a</para>"), ("<td>x", "<para>x</para>"),
    ("plain\n\n\ntext", "<para>plain\ntext</para>"), (None, ""), ("", ""),
]


@pytest.mark.parametrize("convert,cases", [(markdown_article, MARKDOWN), (html_article, PAGES)], ids=["markdown", "html"])
def test_fixtures(spark, convert, cases):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").coalesce(1)
    got = {r.i: r.d for r in df.select("i", convert(F.col("t")).alias("d")).collect()}
    for i, (text, want) in enumerate(cases):
        assert got[i] == f"<article>{want}</article>", text


def test_random_texts_give_well_formed_xml(spark):
    rng = random.Random(9)
    md = ["- ", "* ", "1. ", "> ", "# ", "```\n", "\n", "\n\n", "  ", "    ", "a", "b c", "*", "**", "_", "`", "[x]", "(u)", "[x]: u\n", "|", "|-|\n", "---\n", "&", "<", "\\", "!", "\x02", "é"]
    tags = [f"<{c}{t}>" for t in ("ul", "ol", "li", "table", "tr", "td", "p", "b", "em", "pre", "h1", "a href=x", "code", "br") for c in ("", "/")] + ["x", " ", "\n\n", "&amp;", "&#3;", "<", "&", "\x01", "\x0e"]
    rows = [(0, "".join(rng.choice(md) for _ in range(rng.randint(1, 40)))) for _ in range(400)] + [(1, "".join(rng.choice(tags) for _ in range(rng.randint(1, 30)))) for _ in range(400)]
    df = spark.createDataFrame(rows, "k int, t string").coalesce(2)
    for k, convert in ((0, markdown_article), (1, html_article)):
        for r in df.filter(F.col("k") == k).select("t", convert(F.col("t")).alias("d")).collect():
            xml.dom.minidom.parseString(r.d.encode())  # raises on a tag out of place


def test_long_and_repetitive_texts_end(spark):
    texts = ["- " + "x\n- " * 20_000, "```\n" + "l\n" * 50_000, "-" * 50_000, "**a " * 10_000, "|a|\n|-|\n" + "|x|\n" * 10_000, "> " * 2000 + "x", "[a](b " * 10_000, "`" * 9999 + "x", "  \n" * 20_000]
    pages = ["<ul><li>" * 10_000, "<ul>" + "<li>x" * 20_000 + "</ul>", "&amp;" * 20_000, "<pre>" + "x\n" * 50_000 + "</pre>", "<b>" * 20_000, "<a href=x>" * 10_000]
    df = spark.createDataFrame([(t, p) for t, p in zip(texts, pages + [""] * 3, strict=True)], "t string, p string").coalesce(1)
    got = df.select(F.length(markdown_article(F.col("t"))).alias("m"), F.length(html_article(F.col("p"))).alias("h")).collect()
    assert len(got) == len(texts) and all(r.m > 18 and r.h > 18 for r in got)


def test_references_equal_python(spark):
    names = ["eacute", "nbsp", "hellip", "notin", "NotEqualTilde", "euro", "zwj", "bogusname"]
    texts = [f"a&{n};b" for n in names] + [f"&#{n};" for n in (9, 38, 65, 128, 150, 159, 8364, 128512, 1114111)] + [f"&#x{n:X};" for n in (0x26, 0x80, 0x2019, 0x1F600)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r.u for r in df.select(html_unescape(F.col("t")).alias("u")).collect()]
    for t, u in zip(texts, got, strict=True):
        want = html.unescape(t)
        assert u == want or (t == "&#1114111;" and u == "\U0010ffff"), t


def test_checks_before_costly_patterns_change_nothing(spark):
    """Each check that spares a pattern, on texts that pass it, fail it or nearly do."""
    parts = ["a", "Set", "\u017felect", "CL\u0130CK", "\u212aey", "click", "run", " ", "\t", "\n", "\n\n", "\n \n", "\r\n", "\x0b", "\x85", "\u2028", "\x01", "---\n", "===", "|", "--- | ---\n", "é", "_", "*", "&", "<http", "7"]
    rng = random.Random(4)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(400)]
    t = F.col("t")
    exact = F.regexp_count(t, F.lit(WORDS)).cast("bigint")
    verbs = r"(?iu)(?<![\p{L}\p{N}_])(?:click|open|press|run|select|type)(?![\p{L}\p{N}_])"
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select(
        "t", token_count(t).alias("n"), exact.alias("n_exact"), verb_hits(t, TASK_KEYWORDS).alias("v"), F.regexp_count(t, F.lit(verbs)).alias("v_exact"),
        t.rlike(OTHER_BREAKS + "|" + CONTROL).alias("odd"), plain(t).alias("plain"), tokens_lower(t).alias("low"),
    ).collect()
    for r in rows:
        assert (r.n, r.v) == (r.n_exact, r.v_exact) and len(r.low) == r.n, r
        assert not (r.odd and r.plain) and r.plain == all(x in "\t\n" or " " <= x <= "~" for x in r.t), r


def test_prose_is_searched_once_for_other_breaks(spark):
    """The text of a plain document is bound before it is searched: no copy of the search in each use of the text."""
    plan = spark.createDataFrame([("a",)], "t string").select(markdown_article(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(OTHER_BREAKS) <= 1
