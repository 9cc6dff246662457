"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scoped_conf, ship_package, write_and_read


def read_columns(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns of a driver table (the reader prunes the others)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*columns)


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves the remainder ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


#: Spark removes a query's shuffle files when the query ends, not when the driver's garbage collector finds them
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``write_and_read`` whose shuffle files go as soon as the table stands: nothing runs its plan again."""
    with scoped_conf(df.sparkSession, CLEANUP):
        return write_and_read(df, name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the session's shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation) and gives
    later plans fresh size statistics.  The files stay until the folder is cleared, as
    a lazily returned result may still read them; see ``Scratch`` for the others.
    """
    return _written(df, name)[0]


class Scratch:
    """Named tables in the shared folder that are deleted as soon as no later plan reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read back; a table that had the name is deleted after that."""
        out, path = _written(df, name)
        self.drop(name)
        self.paths[name] = path
        return out

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                delete_path(self.spark, self.paths.pop(name))


#: Together they tell rows apart, see ``keyed_rows``; no table of a user has such names
ROW_KEY = ("__quire_row_file", "__quire_row_at")


def keyed_rows(df: DataFrame) -> DataFrame:
    """``df`` with the columns of ``ROW_KEY``, which no two rows share and every reading repeats.

    Rows of a Parquet table as read (columns chosen, rows filtered) are told by file and
    position; anything else is written once with a number.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.child()
    if plan.nodeName() == "LogicalRelation":
        try:
            return df.select("*", F.xxhash64("_metadata.file_path").alias(ROW_KEY[0]), F.col("_metadata.row_index").alias(ROW_KEY[1]))
        except AnalysisException:  # not a format that knows positions
            pass
    return materialize(df.select("*", F.lit(0).cast("bigint").alias(ROW_KEY[0]), F.monotonically_increasing_id().alias(ROW_KEY[1])), "rows")


def bounded_sample(df: DataFrame, key: Column, rows: int, seed: str) -> DataFrame:
    """About ``rows`` rows at most: all of a smaller table, else those whose keyed hash is low."""
    n = df.count()
    if n <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < int((1 << 30) * rows / n))


BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def ready(spark: SparkSession) -> None:
    """Give the workers this package, and rows to Python in small batches.

    Spark's default batch of 10,000 rows is meant for numbers; of texts it takes tens of
    megabytes in the JVM, on the wire and in Python each.  Another setting than the default stays.
    """
    ship_package(spark)
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` by workers that have this package."""
    ready(df.sparkSession)
    return df.mapInPandas(run, schema)


def map_pandas(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` for a function of one pandas frame."""

    def run(batches: Iterator):
        for batch in batches:
            if len(batch):
                yield fn(batch)

    return map_batches(df, run, schema)


def score_texts(docs: DataFrame, model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5), one row per input row.

    ``model.scores(texts)`` gives the scores; a null text counts as empty and is scored
    too.  One narrow pass: only the text travels to Python and only the score comes back.
    Null ids and repeated rows are kept, an empty table gives no rows.  Other columns of
    ``docs`` are not read; ``keep`` must not name the new ones.
    """
    if {"score", "predicted"} & set(keep):
        raise ValueError("keep must not hold score or predicted")
    ready(docs.sparkSession)

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.fillna("")))

    # not deterministic: a filter on the score must not be pushed below, which would score twice
    scored = F.pandas_udf(score, "double").asNondeterministic()
    out = docs.select(*(F.col(f"`{c}`") for c in keep), scored("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def learnable(labels: DataFrame, column: str, held_out: Column) -> DataFrame:
    """``(doc_id, label)`` of the rows that are not held out."""
    return labels.filter(~held_out).select("doc_id", F.col(column).alias("label"))
