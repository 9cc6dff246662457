"""Column → Column text helpers on built-in Spark expressions (JVM side, no UDF)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import LINE_BREAK, LINE_BREAK_CHARS, PY_SPACE_CHARS, WORDS, char_class

TAG = r"<[^>]+>"
# line breaks other than "\n" (only texts containing one need normalising)
OTHER_BREAKS = char_class(LINE_BREAK_CHARS.replace("\n", ""))
# one loop over one range of characters, far cheaper than a search for any of many
PLAIN = r"\A[ -~\n\t]*\z"
ASCII_WORDS = r"\w+"  # the same as WORDS in a plain text, by one table instead of Unicode properties


def lit_str(s: str) -> Column:
    return F.lit(s)


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.btrim(c, F.lit(PY_SPACE_CHARS))


def normalize_newlines(c: Column) -> Column:
    """Every ``str.splitlines`` break (incl. ``\\r\\n``) becomes ``\\n``."""
    return F.regexp_replace(c, F.lit(LINE_BREAK), F.lit("\n"))


def plain(c: Column) -> Column:
    """Whether a text is of printable ASCII, tabs and ``\\n`` alone: neither another line break nor a control character is in it."""
    return c.rlike(PLAIN)


def holds(c: Column, *parts: str) -> Column:
    """Whether one of ``parts`` is in a text: a search over bytes, to be asked before a costly expression."""
    return reduce(or_, (c.contains(F.lit(p)) for p in parts))


def text_mode_newlines(c: Column) -> Column:
    """Universal-newline reading: ``\\r\\n`` and ``\\r`` become ``\\n``."""
    return F.regexp_replace(c, F.lit("\r\n?"), F.lit("\n"))


def remove_tags(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(TAG), F.lit(""))


def xml_escape(c: Column) -> Column:
    """``&``, ``<``, ``>`` → entities (``&`` first)."""
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def html_escape(c: Column) -> Column:
    """``html.escape`` with quotes: ``& < > " '``."""
    c = xml_escape(c)
    c = F.replace(c, F.lit('"'), F.lit("&quot;"))
    return F.replace(c, F.lit("'"), F.lit("&#x27;"))


def count_matches(c: Column, pattern: str) -> Column:
    """Number of non-overlapping matches (``len(re.findall(...))``), as bigint."""
    return F.regexp_count(c, F.lit(pattern)).cast("bigint")


def token_count(c: Column) -> Column:
    """Number of ``\\w+`` tokens."""
    return F.when(plain(c), count_matches(c, ASCII_WORDS)).otherwise(count_matches(c, WORDS))


def tokens_lower(c: Column) -> Column:
    """``[t.lower() for t in re.findall(r'\\w+', text)]``."""
    words = F.when(plain(c), F.regexp_extract_all(c, F.lit(ASCII_WORDS), 0)).otherwise(F.regexp_extract_all(c, F.lit(WORDS), 0))
    return F.transform(words, lambda t: F.lower(t))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    An expression referenced inside a higher-order function's lambda is evaluated
    again for every element; binding it first keeps per-row work linear.
    """
    return F.get(F.transform(F.array(value), body), 0)
