"""File sources: discover documents under a folder, decode their bytes, fingerprint them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import strip_scheme
from ..functions.text import text_mode_newlines
from ..options import DEFAULT_EXTENSIONS


def source_extensions(formats: dict | None = None) -> list[str]:
    """Distinct sorted extensions of all format lists (entries starting with '.')."""
    exts = sorted({v for vals in (formats or {}).values() for v in vals if isinstance(v, str) and v.startswith(".")})
    return exts or list(DEFAULT_EXTENSIONS)


def discover(spark: SparkSession, root: str, extensions=DEFAULT_EXTENSIONS) -> DataFrame:
    """``(path, size, modification_time, content)`` of every file below ``root`` whose
    name ends in one of ``extensions`` (case-sensitive), recursively.

    Spark's file index skips names starting with ``.`` or ``_``; ordering is left to
    consumers (``orderBy('path')`` gives the sorted listing).
    """
    exts = [e.lstrip(".") for e in extensions]
    glob = "*." + exts[0] if len(exts) == 1 else "*.{" + ",".join(exts) + "}"
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return df.select(
        strip_scheme(F.col("path")).alias("path"),
        F.col("length").cast("bigint").alias("size"),
        F.col("modificationTime").alias("modification_time"),
        "content",
    )


def decode_text(content: Column) -> Column:
    """Strict UTF-8 when valid, else Latin-1; universal newlines (``\\r\\n``, ``\\r`` → ``\\n``)."""
    as_utf8 = content.cast("string")
    text = F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(content, "ISO-8859-1"))
    return text_mode_newlines(text)


def read_corpus(spark: SparkSession, root: str, extensions=DEFAULT_EXTENSIONS) -> DataFrame:
    """``(path, size, content, text)``: the corpus of a folder, ready for ``assess_documents``."""
    from .tables import spread

    files = spread(discover(spark, root, extensions))
    return files.select("path", "size", "content", decode_text(F.col("content")).alias("text"))


def fingerprint(content: Column) -> Column:
    """SHA-256 hex of the raw bytes."""
    return F.sha2(content, 256)
