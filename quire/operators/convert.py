"""Markdown / HTML → DocBook-like intermediate XML.

The tool this replaces shells out to an external converter per file.  Here the
conversion is a narrow projection: each heading becomes a ``<section>`` with an escaped
``<title>``, the blocks before the first heading stand in front.  Markdown is cut into
blocks by ``operators.blocks``.

HTML: tags that end a paragraph become blank lines.  Tags of lists and tables stay as
structure: what closes before a ``<li>``, ``<tr>`` or ``<td>`` is told by the structural tag
before it, so that omitted end tags need no search.  A fold with a stack checks first that
lists and tables are nested as they should be; a part that is not becomes paragraphs.  Text
in ``<pre>`` keeps its line breaks, inline elements without elements inside become markup,
character references are decoded once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.entities import html_unescape
from ..functions.regex import WS_INLINE
from ..functions.text import let, py_strip, remove_tags, xml_escape
from .blocks import CONTROL, markdown_article
from .sections import HTML_HEADING, split_on_headings

__all__ = ["html_article", "markdown_article"]

# Parts of a page that are no text, and the tags that end a paragraph.
DROPPED = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
BLOCK_TAG = (
    r"(?is)</?(?:address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|figure|footer|form|head|header|hr|html|li|main|nav|"
    r"ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>"
)
BLOCK_BREAK = "\\n(?:" + WS_INLINE + "*\\n)+"


def paragraphs(content: Column) -> Column:
    """Blank-line separated blocks → ``<para>…</para>`` (escaped), concatenated."""
    blocks = F.filter(F.transform(F.split(F.coalesce(content, F.lit("")), BLOCK_BREAK, -1), py_strip), lambda b: b != "")
    return F.array_join(F.transform(blocks, lambda b: F.concat(F.lit("<para>"), xml_escape(b), F.lit("</para>"))), "")


# Marks for inline elements and preformatted text: no characters of an XML document
PRE_MARK = "\x01"
PRE = r"(?is)<pre\b[^>]*>(.*?)</pre\s*>"
INLINE = (
    (r"(?is)<(?:code|tt|kbd|samp)\b[^>]*>([^<]*)</(?:code|tt|kbd|samp)\s*>", "\x05$1\x06"),
    (r"(?is)<(?:em|i)\b[^>]*>([^<]*)</(?:em|i)\s*>", "\x03$1\x04"),
    (r"(?is)<(?:strong|b)\b[^>]*>([^<]*)</(?:strong|b)\s*>", "\x02$1\x04"),
    (r"""(?is)<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^'"]*)'|([^\s>"']+))[^>]*>([^<]*)</a\s*>""", "\x0e$1$2$3\x0f$4\x10"),
)
MARKS = (
    ("\x02", '<emphasis role="strong">'), ("\x03", "<emphasis>"), ("\x04", "</emphasis>"), ("\x05", "<literal>"), ("\x06", "</literal>"),
)
LINK_MARKS = ("\x0e([^\x0f]*)\x0f([^\x10]*)\x10", '<ulink url="$1">$2</ulink>')
STRUCTURE = r"(?i)</?(?:ul|ol|table)\b[^>]*>|<(?:li|tr|td|th)\b[^>]*>"
OPTIONAL_END = r"(?i)</(?:li|tr|td|th)\s*>"
DEEPEST = 64  # lists and tables inside each other; deeper ones become paragraphs


def html_blocks(raw: Column) -> Column:
    """Text of raw HTML: block tags become blank lines, other tags go, entities are decoded."""
    return html_unescape(remove_tags(F.regexp_replace(raw, BLOCK_TAG, "\n\n")))


def _code(tag: Column) -> Column:
    """One letter for a structural tag; a capital closes."""
    name = F.lower(F.regexp_extract(tag, r"</?([A-Za-z]+)", 1))
    letter = F.when(name == "ul", "u").when(name == "ol", "o").when(name == "table", "t").when(name == "li", "l").when(name == "tr", "r").otherwise("d")
    return F.when(tag.startswith("</"), F.upper(letter)).otherwise(letter)


def _nested(codes: Column) -> Column:
    """Whether lists and tables open and close in order, items stand in lists and cells in tables."""

    def step(stack, c):
        top = F.right(stack, F.lit(1))
        opens, closes = c.isin("u", "o", "t"), c.isin("U", "O", "T")
        fine = F.when(opens, F.length(stack) < DEEPEST).when(closes, top == F.lower(c)).when(c == "l", top.isin("u", "o")).otherwise(top == "t")
        after = F.when(opens, F.concat(stack, c)).when(closes, F.left(stack, F.length(stack) - 1)).otherwise(stack)
        return F.when(fine, after).otherwise(F.lit("!"))

    return F.aggregate(codes, F.lit(""), step) == ""


def _tags(code: Column, before: Column) -> Column:
    """What a structural tag writes, given the one before it."""
    lists, rows = before.isin("u", "o"), before.isin("t", "r")
    end_item = F.when(lists, "").otherwise("</listitem>")
    end_cell, end_row = F.when(rows, "").otherwise("</td>"), F.when(before == "t", "").otherwise("</tr>")
    return (
        F.when(code == "u", "<itemizedlist>").when(code == "o", "<orderedlist>").when(code == "t", "<informaltable><tbody>")
        .when(code == "l", F.concat(end_item, F.lit("<listitem>")))
        .when(code == "r", F.concat(end_cell, end_row, F.lit("<tr>")))
        .when(code == "d", F.concat(F.when(before == "t", "<tr>").otherwise(end_cell), F.lit("<td>")))
        .when(code == "T", F.concat(end_cell, end_row, F.lit("</tbody></informaltable>")))
        .otherwise(F.concat(end_item, F.when(code == "U", "</itemizedlist>").otherwise("</orderedlist>")))
    )


def html_body(raw: Column) -> Column:
    """Paragraphs, lists, tables and preformatted text of a part of a page without headings."""

    def joined(p):
        code = lambda i: F.get(p["codes"], i)
        tag = lambda i: F.when(i > 0, _tags(code(i - 1), F.coalesce(code(i - 2), F.lit("")))).otherwise("")
        return F.array_join(F.transform(p["pieces"], lambda t, i: F.concat(tag(i), paragraphs(html_blocks(t)))), "")

    def checked(p):
        # text that stands in a list or table, but in no item or cell
        open_ = lambda t, i: (i > 0) & F.get(p["codes"], i - 1).isin("u", "o", "t", "r") & (py_strip(remove_tags(t)) != "")
        loose = F.exists(F.transform(p["pieces"], open_), lambda b: b)
        return let(F.when((F.size(p["codes"]) == 0) | (_nested(p["codes"]) & ~loose), p).otherwise(F.struct(F.array(p["whole"]).alias("pieces"), F.slice(p["codes"], 1, 0).alias("codes"), p["whole"].alias("whole"))), joined)

    def structured(x):
        codes = F.transform(F.regexp_extract_all(x, F.lit(STRUCTURE), 0), _code)
        return let(F.struct(F.split(x, STRUCTURE, -1).alias("pieces"), codes.alias("codes"), x.alias("whole")), checked)

    def marked(t):
        x = F.regexp_replace(F.regexp_replace(t, PRE, f"<p>{PRE_MARK}<p>"), r"\n\s*\n", "\n")
        for pattern, mark in INLINE:
            x = F.regexp_replace(x, pattern, mark)
        return F.regexp_replace(x, OPTIONAL_END, "<p>")

    def finished(x, t):
        for mark, tag in MARKS:
            x = F.replace(x, F.lit(mark), F.lit(tag))
        listing = lambda c: F.concat(F.lit("<programlisting>"), xml_escape(html_unescape(remove_tags(c))), F.lit("</programlisting>"))
        codes = F.transform(F.regexp_extract_all(t, F.lit(PRE), 1), listing)
        put = lambda p: F.array_join(F.transform(p["pieces"], lambda s, i: F.concat(s, F.coalesce(F.get(p["codes"], i), F.lit("")))), "")
        return let(F.struct(F.split(F.regexp_replace(x, *LINK_MARKS), f"<para>{PRE_MARK}</para>", -1).alias("pieces"), codes.alias("codes")), put)

    return let(raw, lambda t: let(let(marked(t), structured), lambda x: finished(x, t)))


def html_article(text: Column) -> Column:
    """``<article>`` of a page: one flat ``<section>`` per heading; scripts, styles and comments are dropped first."""
    clean = lambda c: py_strip(remove_tags(c))
    t = F.regexp_replace(F.coalesce(text, F.lit("")), DROPPED, "")
    sections = split_on_headings(
        F.when(t.rlike(CONTROL), F.regexp_replace(t, CONTROL, "�")).otherwise(t),
        HTML_HEADING,
        level_of=lambda lv: lv,
        title_of=clean,
        body_of=lambda c: c,
        keep_preamble=lambda pre: clean(pre) != "",
    )

    def section(s):
        title = F.concat(F.lit("<section><title>"), xml_escape(py_strip(html_unescape(s["title"]))), F.lit("</title>"))
        head, end = F.when(s["level"] > 0, title).otherwise(""), F.when(s["level"] > 0, F.lit("</section>")).otherwise("")
        return F.concat(head, html_body(s["content"]), end)

    return F.concat(F.lit("<article>"), F.array_join(F.transform(sections, section), ""), F.lit("</article>"))
