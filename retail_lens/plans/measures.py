"""Calendar-aware measures over a star.

A measure takes the star and ``by``, the columns it is sliced by; filters are applied to
the star beforehand (``Star.in_period`` and the like). An absent value is null and counts
as 0 in a difference unless both sides are absent.

With ``totals`` a measure also has the rows of a report's subtotals: every combination of the columns in ``by`` is summed
up, from the same totals of the finest slices, and each ratio is taken afresh from its own sums. A column that a row sums up
is null, and ``<column>_total`` is true; where that is false, null is a value like others.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lens.functions.months import Period, add_to_month, during, month_start, shift_month
from retail_lens.functions.numbers import ratio
from retail_lens.plans.model import Star, monthly, period_sums, sums_by

# Colours of the attainment bands.
STAR_COLOUR = "#27AE60"
TRACK_COLOUR = "#7F8C8D"
BELOW_COLOUR = "#C0392B"


def dim_region(customers: DataFrame) -> DataFrame:
    return customers.select("region").distinct()


def total_flags(by: Sequence[str]) -> list[str]:
    return [f"{c}_total" for c in by]


def roll_up(df: DataFrame, by: Sequence[str], sums: dict[str, Column], also: Sequence[str] = ()) -> DataFrame:
    """``sums`` over every subset of ``by``, flagged; ``also`` are keys of every row. ``df`` should have one row per finest slice."""
    sets = [[*also, *kept] for n in range(len(by), -1, -1) for kept in combinations(by, n)]
    flags = [(F.grouping(c) == 1).alias(f) for c, f in zip(by, total_flags(by), strict=True)]
    return df.groupingSets(sets, *also, *by).agg(*flags, *[c.alias(n) for n, c in sums.items()])


def core_totals(star: Star, by: Sequence[str] = (), totals: bool = False) -> DataFrame:
    """Revenue and units; ``by`` may name the month, quarter or year."""
    sums = {"revenue": F.col("revenue"), "units": F.col("quantity")}
    if totals:
        return roll_up(core_totals(star, by), by, {n: F.sum(n) for n in sums})
    if not by:
        return star.sales.agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    month = month_start(F.col("order_date"))
    sales = star.sales.withColumns({c: GRAINS[c](month) for c in by if c in GRAINS})
    attributes = [c for c in by if c not in sales.columns]
    return sums_by(sales, by, sums, star.products if attributes else None)


def gross_margin(star: Star, by: Sequence[str], totals: bool = False) -> DataFrame:
    """Revenue minus units at unit cost, and the margin as a share of revenue.

    Cost is looked up per product total, not per line. Units of a product without a
    known cost cost nothing.
    """
    keys = [c for c in by if c in star.sales.columns and c != "sku"]
    per_product = star.sales.groupBy(*keys, "sku").agg(
        F.sum("revenue").alias("revenue"), F.sum(F.col("quantity").cast("double")).alias("units")
    )
    attributes = [c for c in by if c not in star.sales.columns]
    costed = per_product.join(star.products.select("sku", "unit_cost", *attributes), "sku", "left")
    cost = F.col("units") * F.coalesce(F.col("unit_cost"), F.lit(0)).cast("double")
    sliced = costed.groupBy(*by).agg(F.sum("revenue").alias("revenue"), F.sum(cost).alias("cost"))
    if totals:
        sliced = roll_up(sliced, by, {"revenue": F.sum("revenue"), "cost": F.sum("cost")})
    margin = F.col("revenue").cast("double") - F.col("cost")
    keys = [*by, *(total_flags(by) if totals else [])]
    return sliced.select(*keys, margin.alias("gross_margin"), ratio(margin, F.col("revenue")).alias("gross_margin_pct"))


def _monthly_revenue(
    star: Star, by: Sequence[str], periods: list[Period], totals: bool = False
) -> tuple[DataFrame, list[str]]:
    """Revenue per slice and month of the periods, and the columns of a slice; the scan is bounded by the periods.

    With ``totals`` the sums over every subset of ``by`` are slices as well, told apart by their flags.
    """
    attributes = [c for c in by if c not in star.sales.columns]
    sales = during(star.sales, periods)
    months = monthly(sales, by, star.products if attributes else None).select(*by, "month", "revenue")
    if not totals:
        return months, list(by)
    return roll_up(months, by, {"revenue": F.sum("revenue")}, ["month"]), [*by, *total_flags(by)]


#: Columns of the calendar that a measure can be sliced by instead of the month.
GRAINS = {
    "month": lambda month: month,
    "quarter": lambda month: F.concat(F.lit("Q"), F.quarter(month), F.lit(" "), F.year(month)),
    "year": lambda month: F.year(month),
}


def _spread(
    months: DataFrame,
    by: Sequence[str],
    shifts: dict[str, list[int]],
    calendar: Period,
    constants: Sequence[str] = (),
    grain: str | None = "month",
) -> DataFrame:
    """Per column, the sum of revenue moved on by the given numbers of months.

    Every month is sent to each month it contributes to and summed there, which needs one
    shuffle and no self-join, and also yields months without sales of their own. Months
    outside the calendar are left out. ``grain`` sums the months of a quarter or year, or with
    None of the whole calendar. ``constants`` are columns that are equal throughout a slice and are kept.
    """
    copies = [
        F.struct(
            shift_month(F.col("month"), shift).alias("month"),
            *[F.when(F.lit(shift in s), F.col("revenue")).alias(name) for name, s in shifts.items()],
        )
        for shift in sorted({shift for s in shifts.values() for shift in s})
    ]
    moved = (
        months.select(*by, *constants, F.explode(F.array(*copies)).alias("c"))
        .select(*by, *constants, "c.*")
        .where(F.col("month").between(F.lit(calendar.first), F.lit(calendar.last)))
    )
    at = [] if grain is None else [GRAINS[grain](F.col("month")).alias(grain)]
    return moved.groupBy(*by, *at).agg(
        *[F.sum(name).alias(name) for name in shifts], *[F.max(name).alias(name) for name in constants]
    )


def _reach(calendar: Period, back: int, *more: Period) -> list[Period]:
    """Months that a measure over the calendar reads: ``back`` months before it to its end, and other periods."""
    return [Period(add_to_month(calendar.first, -back), calendar.last), *more]


def revenue_py(
    star: Star, by: Sequence[str], calendar: Period, grain: str | None = "month", totals: bool = False
) -> DataFrame:
    """Revenue of each month (quarter, year, all) and a year before, null where there was none."""
    months, keys = _monthly_revenue(star, by, _reach(calendar, 12), totals)
    return _spread(months, keys, {"revenue": [0], "revenue_py": [12]}, calendar, grain=grain)


def revenue_yoy(
    star: Star, by: Sequence[str], calendar: Period, grain: str | None = "month", totals: bool = False
) -> DataFrame:
    """Change against the year before as a fraction."""
    change = ratio(_or_zero("revenue") - _or_zero("revenue_py"), F.col("revenue_py"))
    return revenue_py(star, by, calendar, grain, totals).withColumn("revenue_yoy", change)


def rolling_revenue(
    star: Star,
    by: Sequence[str],
    calendar: Period,
    months: int = 3,
    grain: str | None = "month",
    totals: bool = False,
) -> DataFrame:
    """Revenue of each month together with the months before it, by the calendar.

    For a quarter, a year or the whole calendar these are the months up to its last one.
    """
    monthly_sums, keys = _monthly_revenue(star, by, _reach(calendar, months - 1), totals)
    rolled = _spread(monthly_sums, keys, {"rolling_revenue": list(range(months))}, calendar)
    if grain == "month":
        return rolled
    ends = rolled.where(F.col("month").isin(_month_ends(calendar, grain)))
    at = [] if grain is None else [GRAINS[grain](F.col("month")).alias(grain)]
    return ends.select(*keys, *at, "rolling_revenue")


def _month_ends(calendar: Period, grain: str | None) -> list[date]:
    """The last month of each quarter or year of the calendar, or of the calendar."""
    size = {"quarter": 3, "year": 12}.get(grain, 0)
    months = calendar.months()
    return [m for m in months if m == months[-1] or (size and m.month % size == 0)]


def growth_factor(star: Star, by: Sequence[str], trend: Period) -> DataFrame:
    """Trend revenue over the year before per slice; a calendar filter has no say in it."""
    attributes = [c for c in by if c not in star.sales.columns]
    sums = period_sums(
        during(star.sales, [trend, trend.shifted(-12)]),
        by,
        {"now": trend, "then": trend.shifted(-12)},
        star.products if attributes else None,
    )
    return sums.select(*by, ratio(F.col("now"), F.col("then")).alias("growth_factor"))


def gap_vs_trend(
    star: Star,
    by: Sequence[str],
    calendar: Period,
    trend: Period,
    grain: str | None = "month",
    totals: bool = False,
) -> DataFrame:
    """Revenue, last year's revenue grown by the trend, and the difference.

    Growth is taken from the same monthly totals, all of them whatever the calendar, so
    the facts are read once. A slice has one row per month by then.
    """
    months, keys = _monthly_revenue(star, by, _reach(calendar, 12, trend, trend.shifted(-12)), totals)
    in_slice = Window.partitionBy(*keys)
    factor = ratio(_during(trend).over(in_slice), _during(trend.shifted(-12)).over(in_slice))
    months = months.withColumn("growth_factor", factor)
    expected = F.col("revenue_py").cast("double") * F.col("growth_factor")
    spread = _spread(months, keys, {"revenue": [0], "revenue_py": [12]}, calendar, ["growth_factor"], grain)
    gap = F.when(
        F.col("revenue").isNotNull() | F.col("expected").isNotNull(),
        _or_zero("revenue").cast("double") - _or_zero("expected"),
    )
    at = [] if grain is None else [grain]
    return spread.withColumn("expected", expected).select(*keys, *at, "revenue", "expected", gap.alias("gap"))


def forecast_measure(star: Star, by: Sequence[str], calendar: Period, trend: Period, future: Period) -> DataFrame:
    """The expected revenue of months still to come."""
    ahead = Period(max(calendar.first, future.first), min(calendar.last, future.last))
    return (
        gap_vs_trend(star, by, ahead, trend)
        .where(F.col("expected").isNotNull())
        .select(*by, "month", F.col("expected").alias("forecast"))
    )


def _during(period: Period) -> Column:
    return F.sum(F.when(period.holds(F.col("month")), F.col("revenue")))


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def attainment(star: Star, by: Sequence[str] = ("rep_id", "month"), totals: bool = False) -> DataFrame:
    """Revenue, target and revenue over target, sliced by rep, by attributes of the rep or of the product, by month, quarter or year.

    Both facts are summed on their own and stacked, never joined line by line; attributes
    are looked up for the sums per rep and product. Targets belong to reps: an attribute of the product slices revenue alone,
    and each such slice is set against the target of the whole. Without ``by`` there is one row.
    """
    items = [c for c in by if star.products is not None and c in star.products.columns]
    shared = [c for c in by if c not in items]
    times = [c for c in shared if c in GRAINS]
    attributes = [c for c in shared if c not in GRAINS and c != "rep_id"]
    sold = star.sales.select(
        F.col("sales_rep_id").alias("rep_id"), month_start(F.col("order_date")).alias("month"), "revenue", *["sku"] * bool(items)
    )
    aimed = star.targets.select(
        "rep_id", F.col("month_start").alias("month"), F.col("target_amount").cast("decimal(20,4)").alias("target")
    )

    def summed(df: DataFrame, name: str, by: Sequence[str]) -> DataFrame:
        at = [GRAINS[c](F.col("month")).alias(c) for c in times]
        keys = [F.col("rep_id")] * ("rep_id" in by or bool(attributes))
        if any(c in items for c in by):
            df = df.groupBy(*keys, *at, "sku").agg(F.sum(name).alias(name))
            df = df.join(star.products.select("sku", *[c for c in items if c != "sku"]), "sku", "left")
        else:
            df = df.groupBy(*keys, *at).agg(F.sum(name).alias(name))
        if attributes:
            df = df.join(star.reps.select("rep_id", *attributes), "rep_id", "left")
        return df.groupBy(*by).agg(F.sum(name).alias(name))

    sides = [(summed(sold, "revenue", by), "revenue", by), (summed(aimed, "target", shared), "target", shared)]
    if totals:
        sides = [(roll_up(df, keys, {name: F.sum(name)}), name, keys) for df, name, keys in sides]
    flags = total_flags(by) if totals else []
    keys, on = [*by, *flags], [*shared, *(total_flags(shared) if totals else [])]
    if items and not on:
        table = sides[0][0].withColumn("target", sides[1][0].scalar())
    elif items:
        table = _full_join(sides[0][0], sides[1][0], on).withColumns(
            {f: F.coalesce(f, F.lit(True)) for f in flags if f not in on}
        )
    else:
        table = _stacked([df for df, _, _ in sides], keys, ["revenue", "target"])
    return table.select(*keys, "revenue", "target").withColumn("attainment", ratio(F.col("revenue"), F.col("target")))


def _full_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join of aggregates in which a null key meets a null key."""
    a, b = left.alias("a"), right.alias("b")
    test = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on])
    keys = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in on]
    rest = [F.col(f"{side}.{c}") for side, df in (("a", left), ("b", right)) for c in df.columns if c not in on]
    return a.join(b, test, "full").select(*keys, *rest)


def attainment_status(share: Column) -> Column:
    """Band of a revenue-to-target share; none for an absent share."""
    return (
        F.when(share.isNull(), F.lit(None).cast("string"))
        .when(share >= 1.1, "Star performer")
        .when(share >= 0.9, "On track")
        .otherwise("Below target")
    )


def attainment_colour(share: Column) -> Column:
    """Colour of the band; an absent share gets the last colour."""
    return F.when(share >= 1.1, STAR_COLOUR).when(share >= 0.9, TRACK_COLOUR).otherwise(BELOW_COLOUR)


def _stacked(parts: list[DataFrame], by: Sequence[str], names: list[str]) -> DataFrame:
    """Full outer combination of aggregates on ``by`` (null keys included) as union and sum."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.groupBy(*by).agg(*[F.sum(name).alias(name) for name in names])


def drill_across(star: Star, by: Sequence[str] = ("month",)) -> DataFrame:
    """Sales and deliveries side by side on conformed columns, and targets by month.

    Targets belong to reps: a region or category slice does not filter them, so each
    slice shows the target of the whole month, or of all months where there is no month in
    ``by``. A month with targets only has a row, whose other columns in ``by`` are null.
    """
    sales = star.sales.withColumn("month", month_start(F.col("order_date")))
    deliveries = star.deliveries.withColumn("month", month_start(F.col("order_date")))
    sold = sums_by(
        sales, by, {"revenue": F.col("revenue"), "units": F.col("quantity")}, _products_for(star, sales, by)
    )
    moved = sums_by(
        deliveries,
        by,
        {
            "delivered": F.col("qty_delivered").cast("double"),
            "ordered": F.col("qty_ordered").cast("double"),
        },
        _products_for(star, deliveries, by),
    )
    table = _stacked([sold, moved], by, ["revenue", "units", "delivered", "ordered"])
    aimed = star.targets.select(F.col("month_start").alias("month"), F.col("target_amount").cast("decimal(20,4)").alias("t"))
    if "month" in by:
        table = table.join(aimed.groupBy("month").agg(F.sum("t").alias("target")), "month", "full")
    else:
        table = table.withColumn("target", aimed.agg(F.sum("t")).scalar())
    rate = ratio(F.col("delivered"), F.col("ordered"))
    return table.select(*by, "revenue", "units", "target", rate.alias("fill_rate"))


def _products_for(star: Star, fact: DataFrame, by: Sequence[str]) -> DataFrame | None:
    return star.products if any(c not in fact.columns for c in by) else None
