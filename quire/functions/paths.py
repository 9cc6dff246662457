"""Path helpers on POSIX path strings (basename, stem, suffix, relative href)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_scheme(c: Column) -> Column:
    """``file:/a/b`` / ``file:///a/b`` → ``/a/b``; other paths unchanged."""
    return F.regexp_replace(c, F.lit(r"^file:(//)?"), F.lit(""))


def basename(c: Column) -> Column:
    return F.regexp_extract(c, r"([^/]*)$", 1)


def stem(c: Column) -> Column:
    """``pathlib.PurePath.stem``: basename without its last suffix; dot-files keep their name."""
    return F.regexp_replace(basename(c), F.lit(r"(?s)(?<=.)\.[^.]+\z"), F.lit(""))


def suffix(c: Column) -> Column:
    """``pathlib.PurePath.suffix`` (last ``.xxx`` of a name that is not only a leading dot)."""
    return F.regexp_extract(basename(c), r"(?s)(?<=.)(\.[^.]+)\z", 1)


def _components(c: Column) -> Column:
    return F.filter(F.split(c, "/"), lambda x: (x != "") & (x != "."))


def relative_path(target: Column, base: Column) -> Column:
    """POSIX path of ``target`` relative to directory ``base`` (walking up with ``..``).

    Both are taken as clean paths relative to one root (no ``..`` inside).
    """
    from .text import let

    def build(p):
        t, b = p["t"], p["b"]
        n = F.least(F.size(t), F.size(b))
        same = lambda i: (i < n) & (F.get(t, i) == F.get(b, i))
        # length of the common prefix: count leading positions that agree
        common = F.aggregate(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
            F.struct(F.lit(0).alias("k"), F.lit(True).alias("same")),
            lambda acc, i: F.struct(
                F.when(acc["same"] & same(i), acc["k"] + 1).otherwise(acc["k"]).alias("k"),
                (acc["same"] & same(i)).alias("same"),
            ),
            lambda acc: acc["k"],
        )
        return let(common, lambda c: F.concat(
            F.repeat(F.lit("../"), F.size(b) - c),
            F.array_join(F.slice(t, c + 1, F.greatest(F.size(t) - c, F.lit(0))), "/"),
        ))

    return let(F.struct(_components(target).alias("t"), _components(base).alias("b")), build)
