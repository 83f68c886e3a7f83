"""Where sales grew or fell, against last year and against the trend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_lens.functions.months import PeriodSpec, during, month_text
from retail_lens.functions.numbers import pct_change, ratio, round_even, round_up
from retail_lens.plans.model import Focus, monthly, period_sums


def monthly_revenue_by_region(sales: DataFrame) -> DataFrame:
    return (
        monthly(sales, ["region"])
        .select(month_text(F.col("month")).alias("ym"), "region", round_up(F.col("revenue")).alias("revenue"))
        .orderBy("ym", "region")
    )


def region_yoy(sales: DataFrame, spec: PeriodSpec, digits: int | None = 0) -> DataFrame:
    """Year-on-year change of the current period next to that of the trend, per region.

    The gap is the difference of the two rounded percentages. ``digits`` rounds all
    columns once more at the end, as a printed table does.
    """
    recent = during(sales, list(spec.named().values()))
    table = (
        period_sums(recent, ["region"], spec.named())
        .where("region is not null and (current is not null or prior is not null)")
        .withColumn("yoy_pct", round_even(pct_change(F.col("current"), F.col("prior")), 1))
        .withColumn("trend_yoy_pct", round_even(pct_change(F.col("trend"), F.col("trend_prior")), 1))
        .withColumn("growth_gap_pts", round_even(F.col("yoy_pct") - F.col("trend_yoy_pct"), 1))
        .select(
            "region",
            F.col("current").cast("double").alias("current"),
            F.col("prior").cast("double").alias("prior"),
            "yoy_pct",
            "trend_yoy_pct",
            "growth_gap_pts",
        )
    )
    if digits is not None:
        table = table.select("region", *[round_even(F.col(c), digits).alias(c) for c in table.columns[1:]])
    return table.orderBy("region")


def growth_gap(sales: DataFrame, products: DataFrame, spec: PeriodSpec) -> DataFrame:
    """Growth of the current period minus trend growth per region and category, worst first.

    Every region and category with any sale is listed, with nulls where a period has none;
    this is why the scan is not limited to the periods.
    """
    current, trend = ratio(F.col("current"), F.col("prior")), ratio(F.col("trend"), F.col("trend_prior"))
    return (
        period_sums(sales, ["region", "category"], spec.named(), products)
        .select(
            "region",
            "category",
            round_up((current - 1) * 100, 1).alias("yoy_pct"),
            round_up((trend - 1) * 100, 1).alias("trend_yoy_pct"),
            round_up((current - trend) * 100, 1).alias("growth_gap_pts"),
        )
        .orderBy(F.asc_nulls_last("growth_gap_pts"), "region", "category")
    )


def category_drilldown(
    sales: DataFrame, products: DataFrame, spec: PeriodSpec, region: str, digits: int = 0
) -> DataFrame:
    """Current and prior revenue by category inside one region."""
    periods = {"current": spec.current, "prior": spec.prior}
    inside = during(sales, list(periods.values())).where(F.col("region") == region)
    yoy = round_even(pct_change(F.col("current"), F.col("prior")), 1)
    return (
        period_sums(inside, ["category"], periods, products)
        .select(
            "category",
            round_even(F.col("current"), digits).alias("current"),
            round_even(F.col("prior"), digits).alias("prior"),
            round_even(yoy, digits).alias("yoy_pct"),
        )
        .orderBy("category")
    )


def lost_revenue(sales: DataFrame, products: DataFrame, spec: PeriodSpec, focus: Focus) -> DataFrame:
    """Revenue the trend led to expect in the current period, and what is missing from it."""
    inside = during(sales, list(spec.named().values())).where(F.col("region") == focus.region)
    totals = period_sums(inside, ["region", "category"], spec.named(), products).where(focus.holds())
    actual = F.coalesce(F.col("current").cast("double"), F.lit(0.0))
    expected = F.coalesce(F.col("prior").cast("double"), F.lit(0.0)) * ratio(F.col("trend"), F.col("trend_prior"))
    return totals.select("region", "category", expected.alias("expected"), actual.alias("actual")).select(
        "region",
        "category",
        round_even(F.col("expected")).alias("expected"),
        round_even(F.col("actual")).alias("actual"),
        round_even(F.col("expected") - F.col("actual")).alias("lost"),
        round_even((F.lit(1.0) - ratio(F.col("actual"), F.col("expected"))) * 100).alias("lost_pct"),
    )


def mom_yoy_lag(sales: DataFrame, products: DataFrame, focus: Focus) -> DataFrame:
    """Month-on-month and year-on-year change of one series, by position in the month list."""
    inside = sales.where(F.col("region") == focus.region)
    months = monthly(inside, ["category"], products).where(F.col("category") == focus.category)
    # One row per month is left, so a single ordered window is a calendar-sized sort.
    by_month = Window.orderBy("month")
    revenue = F.col("revenue")
    return months.select(
        month_text(F.col("month")).alias("ym"),
        round_up(revenue).alias("revenue"),
        round_up(pct_change(revenue, F.lag(revenue).over(by_month)), 1).alias("mom_pct"),
        round_up(pct_change(revenue, F.lag(revenue, 12).over(by_month)), 1).alias("yoy_pct"),
    ).orderBy("ym")


def focus_index(
    sales: DataFrame, products: DataFrame, focus: Focus, base_months: int = 6, window: int = 3
) -> DataFrame:
    """Category revenue in the focus region and elsewhere, as smoothed indices.

    Each series is divided by the mean of its first ``base_months`` rows and averaged
    over ``window`` rows; a window that is short or holds a gap gives null.
    """
    of_category = products.where(F.col("category") == focus.category)
    in_focus = F.coalesce(F.col("region") == focus.region, F.lit(False))
    months = (
        monthly(sales, ["region"], of_category)
        .groupBy("month")
        .agg(
            F.sum(F.when(in_focus, F.col("revenue"))).cast("double").alias("focus"),
            F.sum(F.when(~in_focus, F.col("revenue"))).cast("double").alias("other"),
        )
    )
    # From here on there is one row per month.
    by_month = Window.orderBy("month")
    everything = Window.partitionBy()
    trailing = by_month.rowsBetween(1 - window, 0)
    months = months.withColumn("_row", F.row_number().over(by_month))
    for name in ("focus", "other"):
        base = F.avg(F.when(F.col("_row") <= base_months, F.col(name))).over(everything)
        months = months.withColumn(name, F.col(name) / base * 100)
    smoothed = [
        F.when(F.count(name).over(trailing) == window, round_up(F.avg(name).over(trailing), 4)).alias(name)
        for name in ("focus", "other")
    ]
    return months.select("month", *smoothed).orderBy("month")
