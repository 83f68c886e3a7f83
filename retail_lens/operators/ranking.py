"""Competition rank over a whole frame without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_lens.functions.ordering import bucketed


def rank_descending(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """1 for the largest ``value``; ties share a rank, gaps follow, nulls come last.

    Equal values are counted first. Ranks are then running counts inside a bucket, cut at
    approximate quantiles, plus the size of all buckets above it; only the bucket
    sizes, a bounded list, pass through a single task. ``value`` is matched by equality,
    so it has to come from exact (decimal or integer) sums.
    """
    per_value = df.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    per_value = bucketed(per_value, [], "_v")
    above = Window.orderBy(F.desc_nulls_last("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        per_value.groupBy("_bucket")
        .agg(F.sum("_n").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(above), F.lit(0)).alias("_above"))
    )
    higher = (
        Window.partitionBy("_bucket")
        .orderBy(F.desc_nulls_last("_v"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        per_value.withColumn("_higher", F.coalesce(F.sum("_n").over(higher), F.lit(0)))
        .join(offsets.withColumnRenamed("_bucket", "_b"), F.col("_bucket").eqNullSafe(F.col("_b")))
        .select("_v", (F.col("_above") + F.col("_higher") + 1).cast("long").alias(name))
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")
