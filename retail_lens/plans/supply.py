"""Delivery performance: lead time, stock-outs, fill rate."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.functions.months import Period, during, since
from retail_lens.functions.numbers import ratio, round_even, round_up
from retail_lens.plans.model import Focus, sums_by

MEASURES = {
    "avg_lead_days": "lead_time_days",
    "avg_stockout_days": "stockout_days",
    "avg_fill_rate": "fill_rate",
}


def _parts() -> dict[str, Column]:
    """Sum and count of every measure; means of means would weigh products wrongly."""
    parts = {}
    for column in MEASURES.values():
        value = F.col(column).cast("double")
        parts[f"{column}_sum"] = value
        parts[f"{column}_n"] = F.when(value.isNotNull(), 1)
    return parts


def _mean(column: str) -> Column:
    return ratio(F.col(f"{column}_sum"), F.col(f"{column}_n"))


def supply_comparison(
    deliveries: DataFrame,
    products: DataFrame,
    period: Period,
    focus: Focus,
    labels: Sequence[str] = ("Focus", "All other"),
) -> DataFrame:
    """Mean lead time, stock-out days and fill rate of the focus group against the rest."""
    parts = sums_by(during(deliveries, [period]), ["region", "category"], _parts(), products)
    group = F.when(focus.holds(), labels[0]).otherwise(labels[1])
    totals = parts.groupBy(group.alias("group")).agg(*[F.sum(n).alias(n) for n in _parts()])
    means = [round_even(_mean(column), 2).alias(name) for name, column in MEASURES.items()]
    return totals.select("group", *means).orderBy("group")


def supply_by_region_category(deliveries: DataFrame, products: DataFrame, first_day: date) -> DataFrame:
    """The same means per region and category from a date on, most stock-outs first."""
    digits = {"avg_lead_days": 1, "avg_stockout_days": 1, "avg_fill_rate": 2}
    means = [round_up(_mean(column), digits[name]).alias(name) for name, column in MEASURES.items()]
    return (
        sums_by(since(deliveries, first_day), ["region", "category"], _parts(), products)
        .select("region", "category", *means)
        .orderBy(F.desc_nulls_last("avg_stockout_days"), "region", "category")
    )


def supply_measures(deliveries: DataFrame, products: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean lead time and stock-out days, and the fill rate as a ratio of sums."""
    parts = _parts() | {
        "delivered": F.col("qty_delivered").cast("double"),
        "ordered": F.col("qty_ordered").cast("double"),
    }
    return sums_by(deliveries, by, parts, products).select(
        *by,
        _mean("lead_time_days").alias("avg_lead_days"),
        _mean("stockout_days").alias("avg_stockout_days"),
        ratio(F.col("delivered"), F.col("ordered")).alias("fill_rate"),
    )


def fill_rate_ratio(deliveries: DataFrame, by: Sequence[str]) -> DataFrame:
    """Delivered over ordered, which weighs lines by size unlike the mean of line rates."""
    return deliveries.groupBy(*by).agg(
        ratio(
            F.sum(F.col("qty_delivered").cast("double")), F.sum(F.col("qty_ordered").cast("double"))
        ).alias("fill_rate")
    )
