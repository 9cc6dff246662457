"""Conversion plans: one row per assessed document, looked up by a left join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import basename
from ..options import CHUNKING_LEVEL, CHUNKING_NESTED


DEALS = 16  # parts that the documents of one basename are dealt to


def conversion_plans(assessed: DataFrame) -> DataFrame:
    """Plan per document: default type = prediction of section 0 (else ``concept``),
    constant chunking, all section predictions, risk and readiness."""
    return assessed.select(
        F.col("path").alias("source"),
        F.struct(
            F.lit(CHUNKING_LEVEL).alias("level"),
            F.lit(CHUNKING_NESTED).alias("nested_topics"),
        ).alias("chunking"),
        F.coalesce(F.get("predictions", 0)["pred"], F.lit("concept")).alias("default_topic_type"),
        F.col("predictions").alias("sections"),
        F.col("conversion_risk").alias("risk"),
        F.col("topicization_readiness").alias("readiness"),
    )


def plan_json(plans: DataFrame, keep: bool = False) -> DataFrame:
    """``(source, plan_file, json)`` — what the plan sink writes, one JSON per document.

    ``plan_file`` is ``<basename>.conversion_plan.json``; two sources with one
    basename give one file name (see :func:`plan_collisions`).  ``keep`` keeps
    the plan columns next to the JSON.
    """
    return plans.select(
        *(plans.columns if keep else ["source"]),
        F.concat(basename(F.col("source")), F.lit(".conversion_plan.json")).alias("plan_file"),
        F.to_json(F.struct("source", "chunking", "default_topic_type", "sections", "risk", "readiness")).alias("json"),
    )


def plan_collisions(plans: DataFrame) -> DataFrame:
    """Basenames shared by more than one source (their plan files would overwrite)."""
    return (
        plans.groupBy(basename(F.col("source")).alias("basename"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        .filter(F.col("n") > 1)
    )


def plan_hints(plans: DataFrame, key: str = "path") -> DataFrame:
    """Lookup table ``(plan_key, plan_type)``.

    ``key='path'`` matches the full source path.  ``key='basename'`` reproduces the
    file-name lookup, where the plan written last (greatest path) wins.
    """
    if key == "path":
        return plans.select(F.col("source").alias("plan_key"), F.col("default_topic_type").alias("plan_type"))
    if key == "basename":
        return plans.groupBy(basename(F.col("source")).alias("plan_key")).agg(
            F.max_by("default_topic_type", "source").alias("plan_type")
        )
    raise ValueError(f"unknown plan key {key!r}")


def join_plans(docs: DataFrame, plans: DataFrame | None, key: str = "path") -> DataFrame:
    """Left join: adds ``plan_type`` (null when the document has no plan)."""
    if plans is None:
        return docs.withColumn("plan_type", F.lit(None).cast("string"))
    hints = plan_hints(plans, key)
    if key == "path":
        return docs.withColumn("plan_key", F.col("path")).join(hints, "plan_key", "left").drop("plan_key")
    # one name may belong to a third of the documents: deal it out, with a copy of its one hint each
    dealt = docs.withColumns({"plan_key": basename(F.col("path")), "deal": F.pmod(F.xxhash64("path"), F.lit(DEALS)).cast("int")})
    copies = hints.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
    return dealt.join(copies, ["plan_key", "deal"], "left").drop("plan_key", "deal")


def join_bucketed(docs: DataFrame, hints: DataFrame) -> DataFrame:
    """:func:`join_plans` by path for two tables bucketed by path: the buckets meet where they lie.

    Neither the intermediates nor the hints are exchanged; a bucket is sorted by path in its
    task (Spark spills that sort), and the merge reads the long column in passing.
    """
    found = hints.select(F.col("path").alias("plan_key"), "plan_type").hint("merge")
    return docs.join(found, docs["path"] == found["plan_key"], "left").drop("plan_key")


PLAN_SCHEMA = (
    "source string, chunking struct<level:int,nested_topics:boolean>, default_topic_type string, "
    "sections array<struct<index:int,title:string,pred:string,confidence:double,reasons:array<string>>>, "
    "risk bigint, readiness bigint"
)


def read_plans(spark, path: str) -> DataFrame:
    """Plan table back from a plan sink folder (``plan_file``, ``json`` lines)."""
    raw = spark.read.schema("plan_file string, json string").json(path)
    return raw.select("plan_file", F.from_json("json", PLAN_SCHEMA).alias("p")).select("plan_file", "p.*")
