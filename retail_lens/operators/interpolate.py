"""Linear interpolation by position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interpolate(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Fill nulls of ``value`` on the line between the known neighbours in ``order``.

    Positions, not distances in ``order``, weigh the neighbours. Before the first and
    after the last known value the nearest one is taken; a group without any stays null.
    A null in ``order`` comes last, rows with equal ``order`` follow in the order of their other
    columns, known values first. Rows with a null key belong to no group and stay as they are.
    Meant for a table whose grain is (keys, order), such as one row per month: a group is
    then as long as the calendar and no longer.
    """
    others = [F.asc_nulls_last(c) for c in df.columns if c not in (*keys, order, value)]
    group = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(order), F.asc_nulls_last(value), *others)
    has_keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # Both neighbours come from growing frames, one per direction: a frame that shrinks
    # towards the end of the group would be evaluated afresh for every row.
    before = Window.partitionBy(*keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.desc("_pos")).rowsBetween(Window.unboundedPreceding, -1)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_pos").alias("pos"), F.col(value).alias("val")))

    placed = df.where(has_keys).withColumn("_pos", F.row_number().over(group)).withColumn("_known", known)
    placed = placed.withColumn("_prev", F.last("_known", ignorenulls=True).over(before)).withColumn(
        "_next", F.last("_known", ignorenulls=True).over(after)
    )
    filled = F.coalesce(F.col(value), _on_the_line(), F.col("_prev.val"), F.col("_next.val"))
    return placed.withColumn(value, filled).select(*df.columns).unionByName(df.where(~has_keys))


def _on_the_line() -> Column:
    start, end = F.col("_prev"), F.col("_next")
    slope = (end["val"] - start["val"]) / (end["pos"] - start["pos"])
    return start["val"] + slope * (F.col("_pos") - start["pos"])
