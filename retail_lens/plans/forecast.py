"""Seasonal-naive forecast: same month last year times the growth of the trend period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lens.functions.months import Period, PeriodSpec, during
from retail_lens.functions.numbers import ratio, round_even, round_up
from retail_lens.plans.model import Focus, monthly, period_sums


def _used(spec: PeriodSpec) -> list[Period]:
    return [spec.trend, spec.trend_prior, spec.current, spec.prior, spec.future_prior]


def forecast_detail(sales: DataFrame, products: DataFrame, spec: PeriodSpec) -> DataFrame:
    """Forecast per region, category and month: current months as back-test, then future ones.

    All base and actual months are conditional sums of one monthly roll-up; the months
    are then laid out as rows. No join to a month list and none back to last year.
    """
    rollup = monthly(
        during(sales, _used(spec)), ["region", "category"], products
    ).where("region is not null and category is not null")

    def total(period: Period):
        return F.sum(F.when(period.holds(F.col("month")), F.col("revenue")))

    backtest, future = spec.current.months(), spec.future.months()
    wide = rollup.groupBy("region", "category").agg(
        ratio(total(spec.trend), total(spec.trend_prior)).alias("growth"),
        *[total(Period(m, m).shifted(-12)).alias(f"base_{m:%Y%m}") for m in backtest + future],
        *[total(Period(m, m)).alias(f"actual_{m:%Y%m}") for m in backtest],
    )

    def row(m):
        base = F.coalesce(F.col(f"base_{m:%Y%m}").cast("double"), F.lit(0.0))
        actual = F.coalesce(F.col(f"actual_{m:%Y%m}").cast("double"), F.lit(0.0)) if m in backtest else None
        return F.struct(
            F.lit(f"{m:%Y-%m}").alias("month"),
            round_even(base * F.col("growth")).alias("forecast"),
            (round_even(actual) if actual is not None else F.lit(None).cast("double")).alias("actual"),
        )

    rows = F.explode(F.array(*[row(m) for m in backtest + future])).alias("r")
    return wide.select("region", "category", rows).select("region", "category", "r.*").orderBy(
        "region", "category", "month"
    )


def backtest_mape(detail: DataFrame, excluded: Focus) -> DataFrame:
    """Mean absolute percentage error over back-test months, without the excluded group.

    A month without actual revenue has no percentage error and is left out.
    """
    tested = detail.where(F.col("actual").isNotNull()).where(~excluded.holds())
    error = ratio(F.abs(F.col("actual") - F.col("forecast")), F.col("actual"))
    return tested.agg((F.avg(error) * 100).alias("mape"))


def forecast_bottom_up(detail: DataFrame, future: Period) -> DataFrame:
    """Future revenue by region as the sum of its categories' forecasts."""
    return (
        detail.where(F.col("month") >= f"{future.first:%Y-%m}")
        .groupBy("region")
        .agg(F.sum("forecast").alias("forecast"))
        .orderBy("region")
    )


def forecast_top_down(sales: DataFrame, spec: PeriodSpec) -> DataFrame:
    """Future revenue by region from the region's own growth factor."""
    periods = {"trend": spec.trend, "trend_prior": spec.trend_prior, "base": spec.future_prior}
    used = during(sales, list(periods.values()))
    growth = ratio(F.col("trend"), F.col("trend_prior"))
    return (
        period_sums(used, ["region"], periods)
        .where("region is not null and base is not null")
        .select(
            "region",
            round_up(growth, 3).alias("growth_factor"),
            round_up(F.col("base").cast("double") * growth).alias("forecast"),
        )
        .orderBy(F.desc_nulls_last("forecast"), "region")
    )


def forecast_month_totals(detail: DataFrame) -> DataFrame:
    """Forecast and actual per month over all groups; a month without actuals totals 0."""
    return (
        detail.groupBy("month")
        .agg(F.sum("forecast").alias("forecast"), F.coalesce(F.sum("actual"), F.lit(0.0)).alias("actual"))
        .orderBy("month")
    )
