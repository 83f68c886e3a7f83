"""Order-preserving buckets cut from the data, the basis of exact rank statistics without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
#: Groups with fewer distinct values are one bucket.
SMALL = 4096


def _quantiles(value: str) -> Column:
    """Approximate quantiles by which distinct values are cut into buckets of near equal size."""
    return F.percentile_approx(value, [i / BUCKETS for i in range(1, BUCKETS)], 40 * BUCKETS)


def _place(value: str) -> Column:
    return F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < F.col(value))), F.lit(0))


def bucketed(distinct: DataFrame, keys: Sequence[str], value: str, bucket: str = "_bucket", size: Column | None = None) -> DataFrame:
    """Add an integer that never decreases as ``value`` grows within ``keys``.

    ``distinct`` has one row per keys and value. The cuts follow the values of each group, so
    no bucket holds much more than one in ``BUCKETS`` of a group's distinct values, however
    near to each other they are. ``size`` counts the rows of a group, if not by a plain count. Without keys the whole frame is the group and a null value
    comes before all others.
    """
    if not keys:
        cuts = distinct.agg(_quantiles(value)).scalar()
        place = F.when(F.col(value).isNull(), -1).otherwise(_place(value))
        return distinct.withColumn("_cuts", cuts).withColumn(bucket, place).drop("_cuts")
    cuts = distinct.groupBy(*keys).agg(_quantiles(value).alias("_cuts"), (F.count(F.lit(1)) if size is None else size).alias("_size"))
    cuts = cuts.where(F.col("_size") > SMALL).drop("_size")
    return distinct.join(cuts, list(keys), "left").withColumn(bucket, _place(value)).drop("_cuts")
