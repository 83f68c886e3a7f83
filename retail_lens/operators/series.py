"""Windows over series of any length: each is cut into ranges, and what a range needs of those before it is handed on.

Rows are put into buckets cut at quantiles of the order column, so a window holds one bucket, about one in 256 of a long
series. What crosses borders (number of rows, last and first known value, sum) is one row per bucket; a window over those
hands it on, and it is joined back. A null in the order column comes last; ``ties`` order rows of equal order. Without keys the
frame is one series. Rows with a null key are one series like others. Frames are read more than once and are staged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lens.functions.ordering import BUCKETS, bucketed

Stage = Callable[[DataFrame, str], DataFrame]


def _group(df: DataFrame, keys: Sequence[str]) -> Column:
    """A series' keys as one text, never null."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit("")


def _placed(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], stage: Stage) -> DataFrame:
    """Add _series, _bucket and _at, the place in the bucket."""
    cut = bucketed(df.withColumn("_series", _group(df, keys)), ["_series"], order)
    cut = cut.withColumn("_bucket", F.when(F.col(order).isNull(), BUCKETS).otherwise(F.col("_bucket")))
    inside = Window.partitionBy("_series", "_bucket").orderBy(*[F.asc_nulls_last(c) for c in (order, *ties)])
    return stage(cut.withColumn("_at", F.row_number().over(inside)), "series")


def _handed_on(placed: DataFrame, sums: dict[str, Column], carried: dict[str, Column]) -> DataFrame:
    """Placed rows with _base, the rows in the buckets before, and ``carried``, computed over one row of ``sums`` per bucket."""
    buckets = placed.groupBy("_series", "_bucket").agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in sums.items()])
    before = Window.partitionBy("_series").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return placed.join(buckets.select("_series", "_bucket", "_base", *[c.alias(n) for n, c in carried.items()]), ["_series", "_bucket"])


def _before() -> Window:
    return Window.partitionBy("_series").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)


def _after() -> Window:
    return Window.partitionBy("_series").orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)


def interpolate_series(df: DataFrame, keys: Sequence[str], order: str, value: str, stage: Stage, ties: Sequence[str] = ()) -> DataFrame:
    """``interpolate`` for series of any length: nulls of ``value`` on the line between their known neighbours by position."""
    here = F.when(F.col(value).isNotNull(), F.struct(F.col("_at").alias("pos"), F.col(value).alias("val")))
    placed = _placed(df, keys, order, [value, *ties], stage)
    moved = F.struct((F.col("_base") + F.col("_end.pos")).alias("pos"), F.col("_end.val").alias("val"))
    begun = F.struct((F.col("_base") + F.col("_begin.pos")).alias("pos"), F.col("_begin.val").alias("val"))
    rows = _handed_on(
        placed,
        {"_end": F.max(here), "_begin": F.min(here)},
        {
            "_left": F.last(F.when(F.col("_end").isNotNull(), moved), ignorenulls=True).over(_before()),
            "_right": F.last(F.when(F.col("_begin").isNotNull(), begun), ignorenulls=True).over(_after()),
        },
    ).withColumn("_pos", F.col("_base") + F.col("_at"))
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_pos").alias("pos"), F.col(value).alias("val")))
    inside = Window.partitionBy("_series", "_bucket")
    back = inside.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    on = inside.orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_known", known).withColumns(
        {
            "_prev": F.coalesce(F.last("_known", ignorenulls=True).over(back), F.col("_left")),
            "_next": F.coalesce(F.last("_known", ignorenulls=True).over(on), F.col("_right")),
        }
    )
    start, end = F.col("_prev"), F.col("_next")
    slope = (end["val"] - start["val"]) / (end["pos"] - start["pos"])
    line = start["val"] + slope * (F.col("_pos") - start["pos"])
    return rows.withColumn(value, F.coalesce(F.col(value), line, start["val"], end["val"])).select(*df.columns)


def lag_series(
    df: DataFrame, keys: Sequence[str], order: str, value: str, lags: dict[str, int], stage: Stage, ties: Sequence[str] = ()
) -> DataFrame:
    """Add a column per lag: ``value`` so many rows before, null where there is none.

    Every row is sent on to the places it is the lag of and met there, without a window.
    """
    placed = _placed(df, keys, order, ties, stage)
    rows = stage(_handed_on(placed, {}, {}).withColumn("_pos", F.col("_base") + F.col("_at")), "positions")
    for name, by in lags.items():
        sent = rows.select(F.col("_series").alias("_s"), (F.col("_pos") + by).alias("_p"), F.col(value).alias(name))
        rows = rows.join(sent, (F.col("_series") == F.col("_s")) & (F.col("_pos") == F.col("_p")), "left").drop("_s", "_p")
    return rows.select(*df.columns, *lags)


def running_series(
    df: DataFrame, keys: Sequence[str], order: str, sums: dict[str, str], stage: Stage, ties: Sequence[str] = ()
) -> DataFrame:
    """Add, per name, the sum of its column over the rows up to and with this one. Exact for decimals and integers."""
    placed = _placed(df, keys, order, ties, stage)
    rows = _handed_on(
        placed,
        {f"_sum_{n}": F.sum(c) for n, c in sums.items()},
        {f"_until_{n}": F.sum(f"_sum_{n}").over(_before()) for n in sums},
    )
    inside = Window.partitionBy("_series", "_bucket").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    added = {n: _plus(F.col(f"_until_{n}"), F.sum(c).over(inside)) for n, c in sums.items()}
    return rows.withColumns(added).select(*df.columns, *sums)


def _plus(a: Column, b: Column) -> Column:
    """Sum in which null adds nothing; null if both are."""
    return reduce(lambda x, y: F.coalesce(x + y, x, y), [a, b])
