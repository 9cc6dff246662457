"""Sinks: every artefact is written by Spark writers, in parallel.

* inventory / clusters / plans / topics → JSON lines (or parquet) folders
* map and report → ordered fragments of whole lines written as text; the part files,
  concatenated in the order of their numbers, are the document.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def write_fragments(fragments: DataFrame, path: str) -> None:
    """Write an ordered fragment table as one text document split into part files.

    Every fragment is one or more whole lines (it ends with a line break), so Spark's text
    writer can write it, with its commit protocol and on any file system.  ``orderBy``
    range-partitions by the keys: part ``i`` holds a contiguous, sorted slice, and the
    part files concatenated in the order of their numbers are the document.  An existing
    folder is refused: its part files would mix with the new ones.
    """
    line = F.expr("substring(fragment, 1, length(fragment) - 1)")  # the writer adds the last line break
    whole = F.when(F.col("fragment").endswith("\n"), line).otherwise(F.raise_error(F.lit("a fragment must end with a line break")))
    fragments.orderBy("part", "k1", "k2", "k3").select(whole.alias("value")).write.mode("error").text(path)


def read_fragments_text(spark, path: str) -> str:
    """Concatenate a written fragment folder (small outputs / tests)."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value").collect()
    number = lambda f: int(re.search(r"part-(\d+)", f["file"].rsplit("/", 1)[-1]).group(1))
    return "".join(f["value"] for f in sorted(files, key=number))


def write_inventory(inventory: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    inventory.write.mode(mode).format(fmt).save(path)


def write_clusters(key_leader: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Flat cluster table sorted by (leader, key): leader first within each cluster."""
    key_leader.select("leader", "key").orderBy("leader", "key").write.mode(mode).json(path)


def write_plans(plan_json: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per line with its would-be file name."""
    plan_json.select("plan_file", "json").write.mode(mode).json(path)


def write_topics(topics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Successful topics partitioned by topic type."""
    (
        topics.filter(F.col("error").isNull())
        .select("path", "topic_path", "xml", "topic_type")
        .write.mode(mode)
        .partitionBy("topic_type")
        .json(path)
    )


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str) -> str:
    """Write ``df`` as a table bucketed by ``key`` into the shared folder and return the table's name.

    No exchange: every task writes its rows to the files of their buckets.  Tables with the
    same number of buckets are joined by ``key`` without moving a row.
    """
    spark = df.sparkSession
    table = f"quire_{name}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    df.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(table)
    return table
