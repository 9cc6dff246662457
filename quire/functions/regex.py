"""Regex building blocks that make Java (Spark) and RE2 (DuckDB) patterns behave
like Python's ``re`` on ``str``.

Character sets are derived from Python itself by a rule (``str.isspace``,
``str.splitlines``), not typed in, so they follow the interpreter's Unicode data.
All escapes use the ``\\x{...}`` form, which both Java and RE2 accept.
"""

from __future__ import annotations

import fnmatch
import re
import sys

from pyspark.sql import SparkSession

# Python ``\w`` on str == letters, numbers and underscore.
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
WORDS = WORD + "+"


def _chars_where(pred) -> str:
    return "".join(chr(c) for c in range(sys.maxunicode + 1) if pred(chr(c)))


#: characters Python's ``str.isspace`` accepts (== ``\s`` of ``re`` on str)
PY_SPACE_CHARS = _chars_where(str.isspace)
#: characters at which ``str.splitlines`` breaks a line ("\r\n" is one break)
LINE_BREAK_CHARS = _chars_where(lambda ch: len(("a" + ch + "b").splitlines()) == 2)


def char_class(chars: str, negate: bool = False) -> str:
    """Regex class for a set of characters, ranges merged, every char escaped."""
    cps = sorted({ord(c) for c in chars})
    parts: list[str] = []
    i = 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        lo, hi = cps[i], cps[j]
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
        i = j + 1
    return "[" + ("^" if negate else "") + "".join(parts) + "]"


#: Python ``\s``
WS = char_class(PY_SPACE_CHARS)
#: Python ``\s`` without line breaks (what ``\s`` can match inside one line)
WS_INLINE = char_class("".join(c for c in PY_SPACE_CHARS if c not in LINE_BREAK_CHARS))
#: one line break as ``str.splitlines`` sees it
LINE_BREAK = "\\r\\n|" + char_class(LINE_BREAK_CHARS)


def py_boundary_before(first: str) -> str:
    """Python ``\\b`` placed before a literal starting with ``first``."""
    if not first:
        return f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
    return f"(?<!{WORD})" if re.match(r"\w", first) else f"(?<={WORD})"


def py_boundary_after(last: str) -> str:
    """Python ``\\b`` placed after a literal ending with ``last``."""
    if not last:
        return f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
    return f"(?!{WORD})" if re.match(r"\w", last) else f"(?={WORD})"


def whole_word(literal: str) -> str:
    """Java pattern equal to Python ``\\b<re.escape(literal)>\\b``."""
    body = java_quote(literal)
    return py_boundary_before(literal[:1]) + body + py_boundary_after(literal[-1:])


def java_quote(literal: str) -> str:
    """Escape a literal for a Java regex (each non-word char escaped, as ``re.escape`` does)."""
    out = []
    for ch in literal:
        if re.match(r"[A-Za-z0-9_]", ch) or ord(ch) > 127:
            out.append(ch)
        elif ch in "\t\n\r\f\v" or ch == " ":
            out.append(f"\\x{{{ord(ch):x}}}")
        else:
            out.append("\\" + ch)
    return "".join(out)


_PY_ESCAPES = {
    "w": WORD,
    "W": NOT_WORD,
    "d": r"\p{Nd}",
    "D": r"\P{Nd}",
    "s": WS,
    "S": char_class(PY_SPACE_CHARS, negate=True),
    "b": f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))",
    "B": f"(?:(?<={WORD})(?={WORD})|(?<!{WORD})(?!{WORD}))",
    "Z": r"\z",
}
_PY_ESCAPES_IN_CLASS = {"w": r"\p{L}\p{N}_", "d": r"\p{Nd}", "D": r"\P{Nd}", "s": WS[1:-1], "b": r"\x{8}"}
#: complements that have no form inside a Java class without nesting
_PY_COMPLEMENTS = {"W": NOT_WORD, "S": char_class(PY_SPACE_CHARS, negate=True)}


def _class_to_java(pattern: str, i: int) -> tuple[str, int]:
    """Java form of the Python class that starts at ``pattern[i] == "["``, and the place after it.

    ``[`` and ``&`` are ordinary characters in a Python class, operators in a Java one.  A
    class with ``\\W`` or ``\\S`` becomes an alternative of classes; if negated, any character
    that the alternative does not match.
    """
    i += 1
    negated = pattern.startswith("^", i)
    i += negated
    items, others, first = [], [], True
    while i < len(pattern) and (pattern[i] != "]" or first):
        ch = pattern[i]
        first = False
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt in _PY_COMPLEMENTS:
                others.append(_PY_COMPLEMENTS[nxt])
            else:
                items.append(_PY_ESCAPES_IN_CLASS.get(nxt, ch + nxt))
            i += 2
            continue
        items.append("\\" + ch if ch in "[]&^~" else ch)
        i += 1
    own = "".join(items)
    if not others:
        return f"[{'^' if negated else ''}{own}]", i + 1
    alternatives = "|".join(([f"[{own}]"] if own else []) + others)
    return (f"(?:(?!{alternatives})(?s:.))" if negated else f"(?:{alternatives})"), i + 1


def python_regex_to_java(pattern: str) -> str:
    """Translate the Python-only meaning of ``\\w \\W \\d \\D \\s \\S \\b \\B \\Z``, of classes and the
    ``(?P<name>…)`` / ``(?P=name)`` group syntax to Java.

    Java gives these escapes ASCII meaning by default; Python gives them Unicode
    meaning on str.  Everything else in the two dialects used by rule patterns
    (groups, quantifiers, atomic groups, look-around) is shared.
    """
    out: list[str] = []
    i, n = 0, len(pattern)
    while i < n:
        ch = pattern[i]
        if ch == "\\" and i + 1 < n:
            out.append(_PY_ESCAPES.get(pattern[i + 1], ch + pattern[i + 1]))
            i += 2
        elif pattern.startswith("(?P<", i):
            out.append("(?<")  # named group
            i += 4
        elif pattern.startswith("(?P=", i):
            j = pattern.index(")", i)
            out.append("\\k<" + pattern[i + 4:j] + ">")  # named back-reference
            i = j + 1
        elif ch == "[":
            part, i = _class_to_java(pattern, i)
            out.append(part)
        else:
            out.append(ch)
            i += 1
    return "".join(out)


def checked_java_pattern(java: str, rule: str) -> str:
    """``java`` if both dialects accept the rule, else a ``ValueError`` that names it (on the driver)."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            spark._jvm.java.util.regex.Pattern.compile(java)
        except Exception as e:  # noqa: BLE001 - any complaint of the pattern compiler
            raise ValueError(f"rule pattern {rule!r} cannot be used: {str(e).splitlines()[0]}") from None
    return java


def glob_to_java(glob: str) -> str:
    """``fnmatch.fnmatch`` (case-sensitive, POSIX) as a full-match Java pattern."""
    return r"\A" + python_regex_to_java(fnmatch.translate(glob))
