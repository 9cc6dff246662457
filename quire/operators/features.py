"""Per-section features as one struct, computed with built-in regex counters.

Every count is ``regexp_count`` (no intermediate arrays), lists / tables use
Python's multi-line semantics (``(?md)``: only ``\\n`` ends a line, ``\\s`` may
cross lines as in ``re``).
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.regex import WORD, WS, whole_word
from ..functions.text import count_matches, holds, let, token_count
from ..options import AssessOptions

ORDERED_ITEM = "(?md)^" + WS + r"*\p{Nd}+[.)]" + WS + "+"
UNORDERED_ITEM = "(?md)^" + WS + "*[-*+]" + WS + "+"
PIPE_ROW = "(?md)^" + WS + r"*\|.*\|" + WS + "*$"
IMAGE = r"!\[([^\]]*)\]\(([^)]+)\)"
LINK = r"\[([^\]]+)\]\(([^)]+)\)"

FEATURE_SCHEMA = (
    "struct<tokens:bigint,ordered_lists:bigint,unordered_lists:bigint,tables:bigint,"
    "images:bigint,links:bigint,has_steps_title:boolean,imperative_density:double,"
    "reference_markers:bigint>"
)


def verb_hits(content: Column, verbs, lower: Column | None = None) -> Column:
    """Σ over verbs of case-insensitive whole-word occurrences (``\\bverb\\b``); ``lower`` is the lower-cased content, if known."""
    verbs = list(verbs)
    if not verbs:
        return F.lit(0).cast("bigint")
    simple = all(v and all(ch.isalnum() or ch == "_" for ch in v) for v in verbs)
    if simple:
        # whole tokens: a token equals at most one distinct verb, so one pass counts all
        mult = Counter(v.lower() for v in verbs)
        groups: dict[int, list[str]] = {}
        for v, m in mult.items():
            groups.setdefault(m, []).append(v)
        total = None
        for m, vs in sorted(groups.items()):
            alt = "|".join(sorted(vs))
            pat = f"(?iu)(?<!{WORD})(?:{alt})(?!{WORD})"
            term = count_matches(content, pat) * m
            total = term if total is None else total + term
        # ASCII text without any of the letter sequences has no hit; other characters may fold to ASCII letters
        possible = holds(F.lower(content) if lower is None else lower, *mult) | (F.octet_length(content) != F.length(content))
        return F.when(possible, total).when(content.isNotNull(), F.lit(0).cast("bigint"))
    total = None
    for v in verbs:
        term = count_matches(content, "(?iu)" + whole_word(v))
        total = term if total is None else total + term
    return total


def imperative_density(content: Column, verbs, tokens: Column | None = None, lower: Column | None = None) -> Column:
    tokens = token_count(content) if tokens is None else tokens
    return verb_hits(content, verbs, lower) / F.greatest(tokens, F.lit(1))


def _any_substring(text_lower: Column, keys) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | text_lower.contains(k.lower())
    return cond


def _count_substrings(text_lower: Column, keys) -> Column:
    total = F.lit(0).cast("bigint")
    for k in keys:
        total = total + text_lower.contains(k.lower()).cast("bigint")
    return total


def _count_if_held(content: Column, pattern: str, part: str) -> Column:
    """``count_matches`` of a pattern whose every match holds ``part``; ``content`` is not null."""
    return F.when(holds(content, part), count_matches(content, pattern)).otherwise(F.lit(0).cast("bigint"))


def section_features(title: Column, content: Column, opts: AssessOptions = AssessOptions()) -> Column:
    """The nine features of one section as a struct."""
    content = F.coalesce(content, F.lit(""))
    title = F.coalesce(title, F.lit(""))

    def build(b):
        tokens = b["tokens"]
        return F.struct(
            tokens.alias("tokens"),
            count_matches(content, ORDERED_ITEM).alias("ordered_lists"),
            count_matches(content, UNORDERED_ITEM).alias("unordered_lists"),
            _count_if_held(content, PIPE_ROW, "|").alias("tables"),
            _count_if_held(content, IMAGE, "](").alias("images"),
            _count_if_held(content, LINK, "](").alias("links"),
            _any_substring(F.lower(title), opts.task_landmarks).alias("has_steps_title"),
            imperative_density(content, opts.task_keywords, tokens, b["lower"]).alias("imperative_density"),
            _count_substrings(b["lower"], opts.reference_markers).alias("reference_markers"),
        )

    bound = F.struct(token_count(content).alias("tokens"), F.lower(content).alias("lower"))
    return let(bound, build)


def features_of_sections(sections: Column, opts: AssessOptions = AssessOptions()) -> Column:
    """``array<feature struct>`` aligned with ``sections``."""
    return F.transform(sections, lambda s: section_features(s["title"], s["content"], opts))
