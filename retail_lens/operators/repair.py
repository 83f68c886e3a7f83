"""Repairs of measured values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repair_sign(col: Column) -> Column:
    return F.abs(col)


def is_outlier(value: Column, median: Column, factor: float = 10.0) -> Column:
    """Strictly more than ``factor`` medians; false when either is null."""
    return F.coalesce(value > median * F.lit(factor), F.lit(False))


def repair_quantity(value: Column, median: Column, factor: float = 10.0) -> Column:
    """Outliers and missing values become the median."""
    return F.when(is_outlier(value, median, factor), median).otherwise(F.coalesce(value, median))


def quantity_flag(value: Column, median: Column, factor: float = 10.0) -> Column:
    return (
        F.when(value.isNull(), "imputed")
        .when(is_outlier(value, median, factor), "outlier_fixed")
        .otherwise("")
    )


def lookup_fill(
    df: DataFrame, column: str, master: DataFrame, key: str, master_value: str, stage=None
) -> DataFrame:
    """Fill nulls of ``column`` with the master's value for ``key``; other rows keep theirs.

    The master is reduced to one value per key, the least, so repeated master keys cannot multiply
    rows (``conflicting_keys`` counts those with several); ``stage`` makes its size known before the
    join is planned. Only rows that lack a value and have a key are joined.
    """
    lookup = (
        master.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(key))
        .agg(F.min(master_value).alias("_found"))
    )
    if stage is not None:
        lookup = stage(lookup, "lookup")
    wanted = F.col(column).isNull() & F.col(key).isNotNull()
    filled = df.where(wanted).join(lookup, key, "left").withColumn(column, F.col("_found"))
    return filled.select(*df.columns).unionByName(df.where(~wanted))


def conflicting_keys(master: DataFrame, key: str, master_value: str) -> DataFrame:
    """Keys of the master with more than one value, and how many: key, values."""
    values = master.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(master_value).alias("values"))
    return values.where("values > 1")
