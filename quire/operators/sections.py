"""Section splitting (Markdown ATX headings, HTML ``<hN>`` headings, generic fallback).

Every splitter is a ``Column → Column`` expression that returns
``array<struct<level:int,title:string,content:string>>`` for one document, so
all sections of a document stay in its row: per-document work is a narrow
projection and never shuffles.  ``section_rows`` explodes on demand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.regex import WS_INLINE
from ..functions.text import OTHER_BREAKS, let, normalize_newlines, plain, py_strip, remove_tags

SECTION_SCHEMA = "array<struct<level:int,title:string,content:string>>"
PREAMBLE_TITLE = "Document"

# A Markdown heading line: 1-6 '#', at least one blank (not a line break), title.
MD_HEADING = "(?md)^(#{1,6})" + WS_INLINE + "+([^\\n]*)"
# An HTML heading: open tag h1-h6 with any attributes, lazy body, any closing level.
HTML_HEADING = r"(?isu)<h([1-6])(?:[^>]*)>(.*?)</h[1-6]>"


def _section(level: Column, title: Column, content: Column) -> Column:
    return F.struct(
        level.cast("int").alias("level"),
        title.alias("title"),
        content.alias("content"),
    )


def _empty_sections() -> Column:
    return F.array().cast(SECTION_SCHEMA)


def split_on_headings(text: Column, pattern: str, level_of, title_of, body_of, keep_preamble) -> Column:
    """Shared shape: ``split`` gives preamble + one body per heading, in match order.

    ``split`` and ``regexp_extract_all`` use the same matcher, so piece ``i + 1``
    is the body that follows heading ``i``.  A text without any heading skips
    both (one ``rlike`` scan, no arrays).
    """

    def preamble_only(t):
        return F.when(
            keep_preamble(t), F.array(_section(F.lit(0), F.lit(PREAMBLE_TITLE), body_of(t)))
        ).otherwise(_empty_sections())

    def with_headings(t):
        parts = F.struct(
            F.split(t, pattern, -1).alias("pieces"),
            F.regexp_extract_all(t, F.lit(pattern), 1).alias("levels"),
            F.regexp_extract_all(t, F.lit(pattern), 2).alias("titles"),
        )

        def build(p):
            pieces, titles = p["pieces"], p["titles"]
            heads = F.transform(
                p["levels"],
                lambda lv, i: _section(level_of(lv), title_of(F.get(titles, i)), body_of(F.get(pieces, i + 1))),
            )
            return F.concat(preamble_only(F.get(pieces, 0)), heads)

        return let(parts, build)

    return let(text, lambda t: F.when(t.rlike(pattern), with_headings(t)).otherwise(preamble_only(t)))


def markdown_sections(text: Column) -> Column:
    """Split Markdown at ATX headings.

    Text before the first heading becomes a level-0 ``Document`` section when at
    least one line precedes the heading (even a blank one); empty text has no
    section.  Contents are stripped, titles stripped.
    """
    t = F.coalesce(text, F.lit(""))
    norm = F.when(~plain(t) & t.rlike(OTHER_BREAKS), normalize_newlines(t)).otherwise(t)
    return split_on_headings(
        norm,
        MD_HEADING,
        level_of=F.length,
        title_of=py_strip,
        body_of=py_strip,
        keep_preamble=lambda pre: pre != "",
    )


def html_sections(text: Column) -> Column:
    """Split HTML at ``<h1>``–``<h6>`` headings; tags removed from titles and contents.

    A preamble is kept only when it has text after tag removal.
    """
    t = F.coalesce(text, F.lit(""))
    clean = lambda c: py_strip(remove_tags(c))
    return split_on_headings(
        t,
        HTML_HEADING,
        level_of=lambda lv: lv,
        title_of=clean,
        body_of=clean,
        keep_preamble=lambda pre: clean(pre) != "",
    )


def generic_sections(text: Column) -> Column:
    """One ``Document`` section holding the raw text (formats without a splitter)."""
    return F.array(_section(F.lit(0), F.lit(PREAMBLE_TITLE), F.coalesce(text, F.lit(""))))


def format_of(path: Column) -> Column:
    """Assess routing on the lower-cased path: ``md`` / ``html`` / ``generic``."""
    low = F.lower(path)
    return (
        F.when(low.endswith(".md"), F.lit("md"))
        .when(low.endswith(".html") | low.endswith(".htm"), F.lit("html"))
        .otherwise(F.lit("generic"))
    )


def route_sections(fmt: Column, text: Column) -> Column:
    """Choose the splitter per row in one projection (no union of three scans)."""
    return (
        F.when(fmt == "md", markdown_sections(text))
        .when(fmt == "html", html_sections(text))
        .otherwise(generic_sections(text))
    )


def heading_ladder_valid(sections: Column) -> Column:
    """False when a level exceeds the previous one by more than 1 (level 0 counts as 1)."""
    return let(
        F.transform(sections, lambda s: F.greatest(s["level"], F.lit(1))),
        lambda eff: F.forall(
            F.transform(eff, lambda lv, i: (i == 0) | (lv - F.get(eff, i - 1) <= 1)),
            lambda ok: ok,
        ),
    )


def section_rows(df: DataFrame, sections_col: str = "sections", keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """One row per section with its 0-based ``section_index`` (narrow ``posexplode``)."""
    # posexplode_outer + null filter: a plain posexplode makes the optimizer infer
    # ``size(sections) > 0`` and push it below the projection, evaluating the
    # splitter expression a second and third time
    return df.select(
        *keep,
        F.posexplode_outer(sections_col).alias("section_index", "section"),
    ).filter(F.col("section_index").isNotNull()).select(
        *keep,
        F.col("section_index").cast("bigint").alias("section_index"),
        F.col("section.level").cast("bigint").alias("level"),
        F.col("section.title").alias("title"),
        F.col("section.content").alias("content"),
    )
