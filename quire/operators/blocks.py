"""Markdown text → DocBook-like blocks, as expressions on one row.

The state that a line-by-line reader carries (inside a fence, inside a list) is held by one
regular expression that matches a whole block at a time: a fenced block ends at its own
fence, a list at the first line that neither belongs to an item nor starts one of its kind.
``regexp_extract_all`` with it cuts a text into blocks in one linear scan; every loop in it
is over characters, so that long blocks need no deep recursion.  Items of lists and
quotes are texts of their own and are cut again, down to ``DEPTH`` levels (what lies deeper
becomes paragraphs).

Inline markup takes two passes: link definitions are collected per document, then each
paragraph's tokens (code, escapes, links, images) are masked in order, emphasis is marked in
what is left, and the tokens are put back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import OTHER_BREAKS, holds, let, normalize_newlines, plain, py_strip, xml_escape

DEPTH = 3
NEVER = 2**31 - 1
MASK = "\x01"  # no character of an XML document
CONTROL = "[\x00-\x08\x0b\x0c\x0e-\x1f]"

# --------------------------------------------------------------------------- block patterns
_GAP = r"(?=[ \t]|$)"
_RULE = r" {0,3}(?:(?=-[ \t]*-[ \t]*-)[- \t]+|(?=\*[ \t]*\*[ \t]*\*)[* \t]+|(?=_[ \t]*_[ \t]*_)[_ \t]+)$"
_FENCE_START = r" {0,3}(?:`{3,}[^`\n]*$|~{3})"
_HEADING = rf" {{0,3}}#{{1,6}}{_GAP}[^\n]*"
_ITEM = rf" {{0,3}}(?:[-*+]|\d{{1,9}}[.)]){_GAP}"
_INTERRUPT = rf"(?:{_FENCE_START}|{_HEADING}| {{0,3}}>|{_RULE}|{_ITEM})"
# what may follow a paragraph's line without a blank line between: empty items and numbers but 1 do not begin a list there
_AFTER_TEXT = rf"(?:{_FENCE_START}|{_HEADING}| {{0,3}}>|{_RULE}| {{0,3}}(?:[-*+]|1[.)])[ \t]+\S)"


def _list(marker: str, same: str) -> str:
    end = rf"\n(?!\n|\z)(?![ \t]{{2,}}\S)(?!{same}{_GAP}(?<!\A))(?:(?<=\n\n)|(?={_INTERRUPT}))"
    return rf"(?!{_RULE}) {{0,3}}{marker}{_GAP}[^\n]*(?s:.*?)(?={end}|\z)"


_BLOCKS = (
    r" {0,3}(?<fence>`{3,}(?=[^`\n]*$)|~{3,})[^\n]*(?s:.*?)(?:\n {0,3}\k<fence>[`~]*[ \t]*$|\z)",
    _HEADING,
    _RULE,
    r" {0,3}>[^\n]*(?s:.*?)(?=\n(?! {0,3}>)|\z)",
    _list(r"(?<bullet>[-*+])", rf"(?!{_RULE}) {{0,1}}\k<bullet>"),
    _list(r"\d{1,9}(?<dot>[.)])", r" {0,2}\d{1,9}\k<dot>"),
    rf" {{0,3}}(?! )[^\n]*\|[^\n]*\n(?=[^\n]*\|)(?=[^\n]*-)[|: \t-]+$(?s:.*?)(?=\n(?:\n|{_INTERRUPT})|\z)",
    r"(?: {4}|\t)[^\n]*(?s:.*?)(?=\n(?! {4}|\t|\n)|\z)",
    r" {0,3}\[[^\]\n]+\]:[ \t]*\S[^\n]*$",
    r" {0,3}\S[^\n]*\n {0,3}(?:=+|-+)[ \t]*$",
    rf"[^\n]+(?s:.*?)(?=\n(?:\n|{_AFTER_TEXT})|\z)",
)
BLOCK = "(?md)^(?:" + "|".join(_BLOCKS) + ")"
FRONT_MATTER = r"\A---[ \t]*\n(?s:.*?)\n(?:---|\.\.\.)[ \t]*(?:\n|\z)"

IS_FENCE = r"(?d)\A {0,3}(?:`{3,}[^`\n]*(?:\n|\z)|~{3})"
IS_HEADING = r"(?d)\A {0,3}#{1,6}(?:[ \t\n]|\z)"
IS_SETEXT = r"(?d)\A {0,3}\S[^\n]*\n {0,3}(?:=+|-+)[ \t]*\z"
IS_RULE = r"(?d)\A" + _RULE.removesuffix("$") + r"\z"
IS_QUOTE = r"(?d)\A {0,3}>"
IS_BULLETS = r"(?d)\A {0,3}[-*+](?:[ \t\n]|\z)"
IS_NUMBERS = r"(?d)\A {0,3}\d{1,9}[.)](?:[ \t\n]|\z)"
IS_TABLE = r"(?d)\A {0,3}(?! )[^\n]*\|[^\n]*\n(?=[^\n]*\|)(?=[^\n]*-)[|: \t-]+(?:\n|\z)"
IS_CODE = r"(?d)\A(?: {4}|\t)"
IS_DEFINITION = r"(?d)\A {0,3}\[[^\]\n]+\]:[ \t]*\S[^\n]*\z"
FENCED = r"(?sd)\A {0,3}(`{3,}|~{3,})[ \t]*([^\s`]*)[^\n]*\n?(.*?)(?:\n {0,3}\1[`~]*[ \t]*|\n? {0,3}\1[`~]*[ \t]*\z)?\z"
ATX_TITLE = r"(?d)\A {0,3}#{1,6}(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*\z"
MARKER = r"(?d)\A {0,3}(?:[-*+]|\d{1,9}[.)])(?:[ \t]{1,4}(?=\S)|[ \t]*)"

# --------------------------------------------------------------------------- inline patterns (on escaped text)
PUNCTUATION = r"[!-/:-@\[-`{-~]"
TOKEN = "(?d)" + "|".join((
    r"(?<![`])(?<ticks>`+)(?!`)(?s:.+?)(?<!`)\k<ticks>(?!`)",
    rf"\\{PUNCTUATION}",
    r"!?\[[^\[\]\n]*\]\([^()\s]*(?:[ \t]+(?:\"[^\"\n]*\"|'[^'\n]*'))?\)",
    r"!?\[[^\[\]]+\](?:\[[^\[\]]*\])?",
    r"&lt;https?://[^\s<>]+?&gt;",
))
MAY_HOLD = ("`", "\\", "[", "*", "_", "&lt;http")  # without any of these no token and no emphasis is in a text
WORD = r"\p{L}\p{N}"
EMPHASIS = (
    (rf"(?<![{WORD}*])\*(?![\s*])([^*]+?)(?<![\s*])\*(?![{WORD}*])", "<emphasis>$1</emphasis>"),
    (rf"(?<![{WORD}*])\*\*(?![\s*])([^*]+?)(?<![\s*])\*\*(?![{WORD}*])", '<emphasis role="strong">$1</emphasis>'),
    (rf"(?<![{WORD}_])_(?![\s_])([^_]+?)(?<![\s_])_(?![{WORD}_])", "<emphasis>$1</emphasis>"),
    (rf"(?<![{WORD}_])__(?![\s_])([^_]+?)(?<![\s_])__(?![{WORD}_])", '<emphasis role="strong">$1</emphasis>'),
)


def emphasised(c: Column) -> Column:
    for pattern, tag in EMPHASIS:
        c = F.regexp_replace(c, pattern, tag)
    return c


def attribute(c: Column) -> Column:
    """Escaped text as an attribute's value."""
    return F.replace(c, F.lit('"'), F.lit("&quot;"))


def _ulink(url: Column, text: Column) -> Column:
    return F.concat(F.lit('<ulink url="'), attribute(url), F.lit('">'), text, F.lit("</ulink>"))


def _image(url: Column, text: Column) -> Column:
    return F.concat(
        F.lit('<inlinemediaobject><imageobject><imagedata fileref="'), attribute(url), F.lit('"/></imageobject><textobject><phrase>'),
        text, F.lit("</phrase></textobject></inlinemediaobject>"),
    )


def _token(t: Column, links: Column) -> Column:
    """One masked token; a reference without a definition stays as it is."""
    text, url = F.regexp_extract(t, r"(?s)\A!?\[(.*?)\]", 1), F.regexp_extract(t, r"\]\(([^()\s]*)", 1)
    named = F.regexp_extract(t, r"(?s)\]\[(.*)\]\z", 1)
    place = F.array_position(links["ids"], F.lower(py_strip(F.when(named == "", text).otherwise(named))))
    defined = F.get(links["urls"], place.cast("int") - 1)
    image, inline = t.startswith("!"), t.endswith(")")
    target = F.when(inline, url).otherwise(defined)
    code = F.regexp_replace(F.regexp_extract(t, r"(?s)\A`+(.*?)`+\z", 1), r"(?s)\A [ ]*+(?=\S)(.*) \z|\n", "$1")
    return (
        F.when(t.startswith("`"), F.concat(F.lit("<literal>"), py_strip(code), F.lit("</literal>")))
        .when(t.startswith("\\"), F.substring(t, 2, 1))
        .when(t.startswith("&lt;"), let(F.regexp_extract(t, r"\A&lt;(.*)&gt;\z", 1), lambda u: _ulink(u, u)))
        .when(target.isNull(), t)
        .when(image, _image(target, text))
        .otherwise(_ulink(target, emphasised(text)))
    )


def inline(text: Column, links: Column) -> Column:
    """Escaped text with ``<emphasis>``, ``<literal>``, ``<ulink>`` and images."""

    def scanned(t):
        parts = F.struct(F.split(emphasised(F.regexp_replace(t, TOKEN, MASK)), MASK, -1).alias("pieces"), F.regexp_extract_all(t, F.lit(TOKEN), 0).alias("tokens"))
        return let(parts, lambda p: F.array_join(F.transform(p["pieces"], lambda x, i: F.concat(x, F.coalesce(_token(F.get(p["tokens"], i), links), F.lit("")))), ""))

    return let(xml_escape(text), lambda t: F.when(holds(t, *MAY_HOLD), scanned(t)).otherwise(t))


# --------------------------------------------------------------------------- blocks
def blocks_of(text: Column) -> Column:
    """The blocks of a text, in order; blank lines lie between them."""

    def cut(t):
        blank = t.startswith(" ") | t.startswith("\t") | holds(t, "\n ", "\n\t")  # a line may be blank
        return F.regexp_extract_all(F.when(blank, F.regexp_replace(t, r"(?md)^[ \t]+$", "")).otherwise(t), F.lit(BLOCK), 0)

    return let(text, cut)


def definitions(blocks: Column) -> Column:
    """``struct<ids, urls>`` of the link definitions; the first of an id counts (``array_position`` finds it)."""
    found = F.filter(blocks, lambda b: b["kind"] == "definition")
    return F.struct(
        F.transform(found, lambda b: F.lower(py_strip(xml_escape(F.regexp_extract(b["text"], r"\[([^\]\n]+)\]", 1))))).alias("ids"),
        F.transform(found, lambda b: xml_escape(F.regexp_extract(b["text"], r"\]:[ \t]*<?([^\s>]+)", 1))).alias("urls"),
    )


def _wrap(tag: str, inner: Column, attributes: Column | str = "") -> Column:
    return F.concat(F.lit(f"<{tag}"), F.lit(attributes) if isinstance(attributes, str) else attributes, F.lit(">"), inner, F.lit(f"</{tag}>"))


def _kind(b: Column) -> Column:
    """What a block is, by its beginning; ``blocks_of`` has cut it at its end."""
    order = (
        ("code", IS_FENCE), ("heading", IS_HEADING), ("rule", IS_RULE), ("quote", IS_QUOTE), ("bullets", IS_BULLETS), ("numbers", IS_NUMBERS),
        ("table", IS_TABLE), ("indented", IS_CODE), ("definition", IS_DEFINITION), ("underlined", IS_SETEXT),
    )
    special = None
    for name, pattern in order:
        special = F.when(b.rlike(pattern), name) if special is None else special.when(b.rlike(pattern), name)
    # a pattern that is bound to the beginning is still tried at every place: of what begins with a letter, most cannot be
    lettered = F.when(b.contains("|") & b.rlike(IS_TABLE), "table").when(F.right(F.rtrim(b, F.lit(" \t")), F.lit(1)).isin("-", "=") & b.rlike(IS_SETEXT), "underlined").otherwise("text")
    # most blocks are plain text of a line or two
    return F.when(F.substring(b, 1, 1).rlike(r"\A\p{L}"), lettered).when(b.rlike(r"\A[ ]*[^\s\p{L}]|\n|\A(?: {4}|\t)|\A {0,3}\d{1,9}[.)]"), special.otherwise("text")).otherwise("text")


def _cells(row: Column) -> Column:
    inner = F.regexp_replace(F.btrim(row, F.lit(" \t")), r"\A\||(?<!\\)\|\z", "")
    return F.transform(F.split(inner, r"(?<!\\)\|", -1), lambda c: F.replace(F.btrim(c, F.lit(" \t")), F.lit("\\|"), F.lit("|")))


def _table(block: Column, links: Column) -> Column:
    """Header, delimiter row and rows; rows get as many cells as the header has."""
    rows = F.transform(F.filter(F.split(block, "\n", -1), lambda r: r != ""), _cells)

    def whole(rows):
        n = F.size(F.get(rows, 0))
        entry = lambda cells: lambda i: _wrap("entry", inline(F.coalesce(F.get(cells, i), F.lit("")), links))
        row = lambda cells: _wrap("row", F.array_join(F.transform(F.sequence(F.lit(0), n - 1), entry(cells)), ""))

        def group(made):
            body = F.array_join(F.slice(made, F.lit(3), F.greatest(F.size(made) - 2, F.lit(0))), "")
            return F.concat(_wrap("thead", F.get(made, 0)), _wrap("tbody", body))

        return _wrap("table", _wrap("tgroup", let(F.transform(rows, row), group), F.concat(F.lit(' cols="'), n.cast("string"), F.lit('"'))))

    return let(rows, whole)


def _children(b: Column, kind: Column) -> Column:
    """The texts inside a quote or the items of a list; none for other blocks."""

    def items(start: str, indent: str):
        return F.transform(F.split(b, start, -1), lambda x: F.regexp_replace(F.regexp_replace(x, MARKER, ""), indent, ""))

    return (
        F.when(kind == "quote", F.array(F.regexp_replace(b, r"(?md)^ {0,3}> ?", "")))
        .when(kind == "bullets", items(r"\n(?= {0,1}[-*+](?:[ \t\n]|\z))", r"(?md)^ {1,2}"))
        .when(kind == "numbers", items(r"\n(?= {0,2}\d{1,9}[.)](?:[ \t\n]|\z))", r"(?md)^ {1,3}"))
    )


def _title(b: Column, kind: Column) -> Column:
    """Title of a heading block, null for other blocks."""
    return F.when(kind == "heading", py_strip(F.regexp_extract(b, ATX_TITLE, 1))).when(kind == "underlined", py_strip(F.regexp_extract(b, r"\A([^\n]*)", 1)))


def _block(b: Column, kind: Column, links: Column, depth: int, sections: Column | None = None) -> Column:
    """One block; ``sections``: what closes the section before, if headings open sections."""
    title = _title(b, kind)
    # one inline scan serves paragraphs and headings
    text = let(inline(F.coalesce(title, py_strip(b)), links), lambda t: (
        F.when(title.isNull() & (t == ""), F.lit(""))
        .when(title.isNull(), _wrap("para", t))
        .otherwise(_wrap("bridgehead", t) if sections is None else F.concat(sections, F.lit("<section>"), _wrap("title", t)))
    ))
    fenced = _wrap("programlisting", xml_escape(F.regexp_extract(b, FENCED, 3)), let(F.regexp_extract(b, FENCED, 2), lambda x: F.when(x != "", F.concat(F.lit(' language="'), attribute(xml_escape(x)), F.lit('"'))).otherwise("")))
    indented = _wrap("programlisting", xml_escape(F.rtrim(F.regexp_replace(b, r"(?md)^(?: {4}|\t)", ""), F.lit("\n"))))
    aligned = let(F.split(b, "\n", 3), lambda r: F.size(_cells(F.get(r, 0))) == F.size(_cells(F.get(r, 1))))
    out = F.when(kind == "code", fenced).when(kind == "indented", indented).when(kind.isin("rule", "definition"), F.lit("")).when((kind == "table") & aligned, _table(b, links))
    if depth:
        def container(inner):
            listed = lambda: F.array_join(F.transform(inner, lambda x: _wrap("listitem", x)), "")
            first = F.regexp_extract(b, r"\A {0,3}(\d{1,9})[.)]", 1)
            start = F.when(first.isin("", "1"), F.lit("")).otherwise(F.concat(F.lit(' startingnumber="'), first.cast("bigint").cast("string"), F.lit('"')))
            return F.when(kind == "quote", _wrap("blockquote", F.array_join(inner, ""))).when(kind == "bullets", _wrap("itemizedlist", listed())).otherwise(_wrap("orderedlist", listed(), start))

        inside = lambda t: F.array_join(F.transform(blocks_of(t), lambda x: let(_kind(x), lambda k: _block(x, k, links, depth - 1))), "")
        out = out.when(kind.isin("quote", "bullets", "numbers"), let(F.transform(_children(b, kind), inside), container))
    return out.otherwise(text)


def markdown_article(text: Column) -> Column:
    """``<article>`` of a Markdown text: one flat ``<section>`` per heading, the blocks before the first in front."""
    t = F.coalesce(text, F.lit(""))
    breaks = F.when(t.rlike(OTHER_BREAKS), normalize_newlines(t)).otherwise(t)
    clean = let(breaks, lambda n: F.when(n.rlike(CONTROL), F.regexp_replace(n, CONTROL, "�")).otherwise(n))
    front = lambda n: F.when(n.startswith("---"), F.regexp_replace(n, "(?d)" + FRONT_MATTER, "")).otherwise(n)
    norm = let(F.when(plain(t), t).otherwise(clean), front)

    def article(s):
        def block(b, i):
            close = F.when(i >= s["first"], F.lit("</section>")).otherwise("")
            return _block(b["text"], b["kind"], s["links"], DEPTH, close)

        # the headings' place decides what closes a section; without one nothing does
        end = F.when(s["first"] < NEVER, F.lit("</section>")).otherwise("")
        return F.concat(F.lit("<article>"), F.array_join(F.transform(s["blocks"], block), ""), end, F.lit("</article>"))

    def described(blocks):
        place = F.array_position(F.transform(blocks, lambda b: b["kind"].isin("heading", "underlined")), True).cast("int")
        return let(F.struct(blocks.alias("blocks"), definitions(blocks).alias("links"), F.when(place > 0, place).otherwise(NEVER).alias("first")), article)

    return let(F.transform(blocks_of(norm), lambda b: F.struct(b.alias("text"), _kind(b).alias("kind"))), described)
