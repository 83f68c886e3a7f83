"""Months, periods and the calendar. A month is the date of its first day."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM").cast("date")


def month_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def iso_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def shift_month(month: Column, months: int) -> Column:
    """Move a month start; day-of-month clamping cannot occur on the first of a month."""
    return F.add_months(month, months)


def add_to_month(month: date, months: int) -> date:
    total = month.year * 12 + month.month - 1 + months
    return date(total // 12, total % 12 + 1, 1)


@dataclass(frozen=True)
class Period:
    """Closed run of whole months, given by its first and last month."""

    first: date
    last: date

    @classmethod
    def of(cls, first: str, last: str | None = None) -> Period:
        """``Period.of('2026-07', '2026-09')``"""
        return cls(date.fromisoformat(f"{first}-01"), date.fromisoformat(f"{last or first}-01"))

    @property
    def last_day(self) -> date:
        return add_to_month(self.last, 1) - timedelta(days=1)

    def months(self) -> list[date]:
        count = (self.last.year - self.first.year) * 12 + self.last.month - self.first.month + 1
        return [add_to_month(self.first, i) for i in range(count)]

    def shifted(self, months: int) -> Period:
        return Period(add_to_month(self.first, months), add_to_month(self.last, months))

    def holds(self, day: Column) -> Column:
        """Range test on the bare date or timestamp, so that it reaches the file scan; the last day counts whole."""
        return (day >= F.lit(self.first)) & (day < F.lit(add_to_month(self.last, 1)))


@dataclass(frozen=True)
class PeriodSpec:
    """Periods of an analysis: the one looked at, the trend before it, the one to forecast."""

    current: Period
    trend: Period
    future: Period

    @property
    def prior(self) -> Period:
        return self.current.shifted(-12)

    @property
    def trend_prior(self) -> Period:
        return self.trend.shifted(-12)

    @property
    def future_prior(self) -> Period:
        return self.future.shifted(-12)

    def named(self) -> dict[str, Period]:
        return {
            "current": self.current,
            "prior": self.prior,
            "trend": self.trend,
            "trend_prior": self.trend_prior,
        }


def in_any(day: Column, periods: list[Period]) -> Column:
    test = periods[0].holds(day)
    for period in periods[1:]:
        test = test | period.holds(day)
    return test


def during(fact: DataFrame, periods: list[Period], day: str = "order_date") -> DataFrame:
    """Rows of a fact in any of the periods.

    The test is on the bare date, which reaches the file scan; a fact stored in month
    folders is also tested on those, so that folders outside the periods are not opened.
    """
    test = in_any(F.col(day), periods)
    if "month" in fact.columns:
        test = test & in_any(F.col("month"), periods)
    return fact.where(test)


def since(fact: DataFrame, first_day: date, day: str = "order_date") -> DataFrame:
    """Rows of a fact from a day on."""
    test = F.col(day) >= F.lit(first_day)
    if "month" in fact.columns:
        test = test & (F.col("month") >= F.lit(first_day.replace(day=1)))
    return fact.where(test)


def calendar(days: DataFrame, day: str = "order_date") -> DataFrame:
    """One row per day from 1 January of the first year in ``days`` to 31 December of the last.

    Only the two bounds are aggregated from the data; the result has 366 rows a year at most.
    """
    bounds = days.agg(F.trunc(F.min(day), "YEAR").alias("first"), F.max(day).alias("latest"))
    last = F.date_sub(F.add_months(F.trunc("latest", "YEAR"), 12), 1)
    every_day = F.explode(F.sequence(F.col("first"), last, F.expr("interval 1 day")))
    return bounds.select(every_day.alias("date")).select("date", *_attributes())


def _attributes() -> list[Column]:
    return [
        F.year("date").alias("year"),
        F.month("date").alias("month_no"),
        F.date_format("date", "MMM yyyy").alias("month"),
        F.concat(F.lit("Q"), F.quarter("date"), F.lit(" "), F.year("date")).alias("quarter"),
    ]


def calendar_days(spark: SparkSession, years: Period) -> DataFrame:
    """The calendar of whole years as a dimension: the columns of ``calendar``, quarter_no, weekday (1 is Monday) and month_start.

    It is counted off from a range, so its size is known before a join is planned: 366 rows a year at most.
    """
    first, end = date(years.first.year, 1, 1), date(years.last.year + 1, 1, 1)
    numbers = spark.range((end - first).days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
    return numbers.select(
        "date",
        *_attributes(),
        F.quarter("date").alias("quarter_no"),
        (F.weekday("date") + 1).alias("weekday"),
        month_start(F.col("date")).alias("month_start"),
    )


def on_days(fact: DataFrame, days: DataFrame, day: str = "order_date") -> DataFrame:
    """Rows of a fact on one of the ``days`` of a calendar.

    A fact stored in month folders is joined on the month too: Spark then finds the months of the days left at run
    time and opens their folders only. The days are a few thousand rows at most, which Spark broadcasts by their size.
    """
    kept = days.select(F.col("date").alias("_day"), F.col("month_start").alias("_month"))
    test = F.col(day).cast("date") == F.col("_day")
    if "month" in fact.columns:
        test = test & (F.col("month") == F.col("_month"))
    return fact.join(kept, test, "left_semi")
