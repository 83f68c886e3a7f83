"""Targets against actuals, per rep and per region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.functions.months import Period, PeriodSpec, during, month_start
from retail_lens.functions.numbers import ratio, round_even, round_up
from retail_lens.operators.ranking import rank_descending
from retail_lens.session import unstaged


def actual_by_rep_month(sales: DataFrame) -> DataFrame:
    """Revenue per rep and month; lines without a rep belong to nobody."""
    return (
        sales.where(F.col("sales_rep_id").isNotNull())
        .groupBy(F.col("sales_rep_id").alias("rep_id"), month_start(F.col("order_date")).alias("month_start"))
        .agg(F.sum("revenue").alias("actual"))
    )


def target_vs_actual(targets: DataFrame, sales: DataFrame) -> DataFrame:
    """Every target with the rep's revenue of that month, 0 where there is none.

    Sales are summed to the grain of the targets first, so the join meets each rep and
    month once however many lines a rep has.
    """
    actual = actual_by_rep_month(sales)
    return targets.join(actual, ["rep_id", "month_start"], "left").select(
        "rep_id",
        "month_start",
        F.col("target_amount").cast("decimal(20,4)").alias("target_amount"),
        F.coalesce("actual", F.lit(0).cast("decimal(28,4)")).alias("actual"),
    )


def rep_status(trend_pct: Column, current_pct: Column, low: float = 90.0, high: float = 110.0) -> Column:
    """A null percentage compares as neither low nor high."""
    return (
        F.when(trend_pct < low, "Persistent under-performance")
        .when(current_pct < low, "Recent drop - check supply")
        .when(current_pct >= high, "Star performer")
        .otherwise("On track")
    )


def _attained(period: Period) -> Column:
    inside = period.holds(F.col("month_start"))
    return ratio(F.sum(F.when(inside, F.col("actual"))), F.sum(F.when(inside, F.col("target_amount")))) * 100


def _rep_percentages(targets: DataFrame, sales: DataFrame, spec: PeriodSpec) -> DataFrame:
    periods = [spec.trend, spec.current]
    joined = target_vs_actual(
        during(targets, periods, "month_start"), during(sales, periods)
    )
    return joined.groupBy("rep_id").agg(
        _attained(spec.trend).alias("trend_pct"), _attained(spec.current).alias("current_pct")
    )


def rep_attainment(targets: DataFrame, sales: DataFrame, reps: DataFrame, spec: PeriodSpec) -> DataFrame:
    """Attainment of all reps in two periods; the status follows from the rounded figures."""
    table = reps.select("rep_id", "rep_name", "region").join(
        _rep_percentages(targets, sales, spec), "rep_id", "left"
    )
    return (
        table.withColumn("trend_pct", round_even(F.col("trend_pct"), 1))
        .withColumn("current_pct", round_even(F.col("current_pct"), 1))
        .withColumn("status", rep_status(F.col("trend_pct"), F.col("current_pct")))
        .orderBy(F.asc_nulls_last("current_pct"), "rep_id")
    )


def rep_attainment_ranked(
    targets: DataFrame, sales: DataFrame, reps: DataFrame, spec: PeriodSpec, stage=unstaged
) -> DataFrame:
    """Attainment and rank of reps that have targets; the status follows from the exact figures.

    The rank reads the attainments twice; ``stage`` computes them once.
    """
    # Reps whose targets all lie outside the two periods are listed with nulls.
    everyone = targets.select("rep_id").distinct()
    exact = (
        reps.select("rep_id", "rep_name", "region")
        .join(everyone, "rep_id")
        .join(_rep_percentages(targets, sales, spec), "rep_id", "left")
    )
    return (
        rank_descending(stage(exact, "attainment"), "current_pct", "current_rank")
        .select(
            "rep_id",
            "rep_name",
            "region",
            round_up(F.col("trend_pct"), 1).alias("trend_pct"),
            round_up(F.col("current_pct"), 1).alias("current_pct"),
            "current_rank",
            rep_status(F.col("trend_pct"), F.col("current_pct")).alias("status"),
        )
        .orderBy(F.asc_nulls_last("current_pct"), "rep_id")
    )


def region_attainment(targets: DataFrame, sales: DataFrame, reps: DataFrame, period: Period) -> DataFrame:
    """Attainment by the region of the rep (not of the outlet) in one period."""
    joined = target_vs_actual(
        during(targets, [period], "month_start"), during(sales, [period])
    )
    per_rep = joined.groupBy("rep_id").agg(
        F.sum("actual").alias("actual"), F.sum("target_amount").alias("target_amount")
    )
    return (
        per_rep.join(reps.select("rep_id", "region"), "rep_id")
        .groupBy("region")
        .agg(round_up(ratio(F.sum("actual"), F.sum("target_amount")) * 100, 1).alias("attainment_pct"))
        .orderBy(F.asc_nulls_last("attainment_pct"), "region")
    )
