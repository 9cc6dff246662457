"""Ordered numbers without gathering a group in one task."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_and_read


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "position") -> DataFrame:
    """``df`` with a column ``name``: the row's place (from 0) in its group, in the order of ``order``.

    The table is cut into ranges of ``(group, order)``, so that a huge group lies in many
    partitions.  Rows are numbered within their part of a partition; the numbers of a group's
    rows in the partitions before, one row for each, give the offset.  A group's windows hold
    one partition's rows, or one row per partition.  Rows that are equal in ``order`` get
    different numbers, in no given order.
    """
    part = f"__part_{uuid.uuid4().hex[:8]}"
    keys = [*group, *order]
    ranged, _ = write_and_read(df.repartitionByRange(*keys).withColumn(part, F.spark_partition_id()), "ranges")
    here = Window.partitionBy(part, *group).orderBy(*order)
    local = ranged.withColumn(name, (F.row_number().over(here) - 1).cast("bigint"))
    sizes = ranged.groupBy(part, *group).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0))).filter(F.col("__before") > 0).drop("__rows")
    # nulls in the group columns are a group of their own
    same = [local[part] == offsets[part], *(local[g].eqNullSafe(offsets[g]) for g in group)]
    place = local[name] + F.coalesce(offsets["__before"], F.lit(0))
    return local.join(offsets, same, "left").select(*(local[c] for c in df.columns), place.alias(name))
