"""Topic-type classification as one ordered ``CASE WHEN`` chain.

Priority: filename rules (glob on the stem) → content rules (case-insensitive
regex search) → a valid plan hint → task words → reference words → concept.
Rules are driver-side data folded into the expression, so classification is a
narrow projection.  Content rules run in the JVM; one that only Python's dialect can express is
evaluated by Python in Arrow batches.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.regex import WORD, checked_java_pattern, glob_to_java, python_regex_to_java
from ..functions.text import py_strip
from ..options import REFERENCE_HEURISTIC_WORDS, TASK_HEURISTIC_WORDS, TOPIC_TYPES, Rule

TASK_WORDS_RE = f"(?iu)(?<!{WORD})(?:{'|'.join(TASK_HEURISTIC_WORDS)})(?!{WORD})"
REFERENCE_WORDS_RE = f"(?iu)(?<!{WORD})(?:{'|'.join(REFERENCE_HEURISTIC_WORDS)})(?!{WORD})"


def validated_type(raw: str) -> str:
    """Lower-case + strip; unknown types fall back to ``concept`` (driver side, rules)."""
    t = raw.lower().strip()
    return t if t in TOPIC_TYPES else "concept"


def valid_type(c: Column) -> Column:
    """Column form of :func:`validated_type`."""
    t = py_strip(F.lower(c))
    return F.when(t.isin(*TOPIC_TYPES), t).otherwise(F.lit("concept"))


def content_rule_pattern(pattern: str) -> str:
    """Python ``re.search(pattern, text, re.IGNORECASE)`` as a Java pattern."""
    try:
        re.compile(pattern)
    except re.error as e:
        raise ValueError(f"rule pattern {pattern!r} cannot be used: {e}") from None
    return checked_java_pattern("(?iud)" + python_regex_to_java(pattern), pattern)


def python_search(content: Column, pattern: str) -> Column:
    """``re.search(pattern, text, re.IGNORECASE)`` in Python, Arrow batch by batch: for patterns that Java has no form of."""

    def run(texts: pd.Series) -> pd.Series:
        search = re.compile(pattern, re.IGNORECASE).search
        return pd.Series([search(t) is not None for t in texts.fillna("")], dtype=bool)

    return F.pandas_udf(run, "boolean")(content)


def content_rule(content: Column, pattern: str) -> Column:
    """Whether a content rule matches: in the JVM, or by Python's own engine where Java refuses the pattern."""
    try:
        java = content_rule_pattern(pattern)
    except ValueError:
        try:
            re.compile(pattern)
        except re.error:
            raise ValueError(f"rule pattern {pattern!r} cannot be used") from None
        return python_search(content, pattern)
    return content.rlike(java)


def classify_topic(
    stem: Column,
    content: Column,
    rules_by_filename: tuple[Rule, ...] = (),
    rules_by_content: tuple[Rule, ...] = (),
    plan_type: Column | None = None,
) -> Column:
    """The topic type (``concept`` / ``task`` / ``reference``) of one document."""
    content = F.coalesce(content, F.lit(""))
    branches: list[tuple[Column, Column]] = []
    for r in rules_by_filename:
        branches.append((stem.rlike(checked_java_pattern(glob_to_java(r.pattern), r.pattern)), F.lit(validated_type(r.type))))
    for r in rules_by_content:
        branches.append((content_rule(content, r.pattern), F.lit(validated_type(r.type))))
    if plan_type is not None:
        hint = py_strip(F.lower(plan_type))
        branches.append((plan_type.isNotNull() & hint.isin(*TOPIC_TYPES), hint))
    branches.append((content.rlike(TASK_WORDS_RE), F.lit("task")))
    branches.append((content.rlike(REFERENCE_WORDS_RE), F.lit("reference")))
    expr = None
    for cond, val in branches:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit("concept"))
