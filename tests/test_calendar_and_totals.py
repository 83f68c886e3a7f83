"""The calendar as a dimension, and subtotals of measures."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retail_lens.functions.months import Period, calendar, calendar_days
from retail_lens.plans import measures
from retail_lens.plans.model import Star
from retail_lens.sources.files import write_by_month

SALES = "order_date date, region string, sku string, sales_rep_id string, quantity double, revenue decimal(18,2)"
YEARS = Period.of("2025-01", "2026-12")


@pytest.fixture(scope="module")
def star(spark):
    days = [date(2025 + i // 12, i % 12 + 1, 1 + (i * 5) % 28) for i in range(24)]
    sales = [(d, r, s, rep, 2.0, Decimal(10 + i)) for i, d in enumerate(days) for r, s, rep in (("North", "d", "a"), ("South", "f", "b"))]
    sales += [(date(2026, 7, 4), None, "d", None, 1.0, Decimal(7)), (date(2026, 7, 5), "North", "x", "a", 1.0, Decimal(9))]
    products = spark.createDataFrame([("d", "Drinks", 1.0), ("f", "Food", 2.0), ("x", None, 1.0)], "sku string, category string, unit_cost double")
    reps = spark.createDataFrame([("a", "North"), ("b", "South"), ("c", None)], "rep_id string, region string")
    targets = [(r, d.replace(day=1), 50.0) for d in days for r in ("a", "b", "c")]
    return Star(
        sales=spark.createDataFrame(sales, SALES),
        products=products,
        targets=spark.createDataFrame(targets, "rep_id string, month_start date, target_amount double"),
        reps=reps,
        calendar=calendar_days(spark, YEARS),
    )


def test_calendar_days_are_the_calendar(spark, star):
    days = calendar_days(spark, YEARS)
    whole = calendar(star.sales).collect()
    assert days.select(*calendar(star.sales).columns).orderBy("date").collect() == whole and len(whole) == 730
    assert days.where("weekday = 1").first().date.weekday() == 0


@pytest.mark.parametrize(
    "condition, test",
    [("quarter_no = 3", lambda d: d.month in (7, 8, 9)), ("month_no = 7", lambda d: d.month == 7), ("weekday > 5", lambda d: d.weekday() > 4), ("year = 1990", lambda d: False)],
)
def test_in_calendar_filters_each_fact_by_its_day(star, condition, test):
    kept = star.in_calendar(condition)
    for fact, day in (("sales", "order_date"), ("targets", "month_start")):
        rows = getattr(star, fact).collect()
        assert sorted(map(str, getattr(kept, fact).collect())) == sorted(str(r) for r in rows if test(r[day]))


def test_calendar_filters_add_up_and_need_a_calendar(star):
    twice = star.in_calendar("quarter_no = 3").in_calendar("year = 2026")
    assert {r.order_date.month for r in twice.sales.collect()} == {7, 8, 9} and twice.sales.where("year(order_date) = 2025").isEmpty()
    with pytest.raises(ValueError):
        Star(star.sales, star.products).in_calendar("year = 2026")


def test_calendar_prunes_month_folders_at_run_time(spark, star, tmp_path):
    write_by_month(star.sales, str(tmp_path / "sales"))
    stored = Star(spark.read.parquet(str(tmp_path / "sales")), star.products, calendar=star.calendar)
    july = stored.in_calendar("month_no = 7").sales
    assert "dynamicpruning" in july._jdf.queryExecution().executedPlan().toString()
    assert july.count() == star.in_calendar("month_no = 7").sales.count() == 6
    scans = spark._jvm.scala.collection.mutable.ArrayBuffer()
    july.collect()
    plan = july._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while "QueryStage" in leaf.getClass().getSimpleName():
            leaf = leaf.plan().collectLeaves().apply(0)
        if leaf.getClass().getSimpleName() == "FileSourceScanExec":
            scans.append(leaf.metrics().apply("numPartitions").value())
    assert [scans.apply(i) for i in range(scans.size())] == [2]


def by_key(df, keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_subtotals_tell_null_keys_from_totals(star):
    keys = ["region", "category", "region_total", "category_total"]
    got = by_key(measures.core_totals(star, ["region", "category"], totals=True), keys)
    assert len(got) == 4 + 3 + 3 + 1
    assert got[None, "Drinks", False, False].revenue == 7 and got[None, None, False, True].revenue == 7
    assert got["North", None, False, False].revenue == 9 == got[None, None, True, False].revenue
    whole = star.sales.agg(F.sum("revenue")).first()[0]
    assert got[None, None, True, True].revenue == whole == sum(r.revenue for k, r in got.items() if not k[2] and not k[3])


def test_ratios_of_subtotals_are_their_own(star):
    keys = ["region", "category", "region_total", "category_total", "year"]
    got = by_key(measures.revenue_yoy(star, ["region", "category"], YEARS, "year", totals=True), keys)
    for region, test in (("North", "region = 'North'"), (None, "true")):
        old, new = (star.sales.where(test).where(f"year(order_date) = {y}").agg(F.sum("revenue")).first()[0] for y in (2025, 2026))
        row = got[region, None, region is None, True, 2026]
        assert (row.revenue, row.revenue_py) == (new, old) and row.revenue_yoy == pytest.approx(float((new - old) / old))
    factor = measures.gap_vs_trend(star, ["region"], YEARS, Period.of("2026-01", "2026-06"), None, totals=True)
    alone = measures.gap_vs_trend(star, [], YEARS, Period.of("2026-01", "2026-06"), None).first()
    total = factor.where("region_total").first()
    assert (total.revenue, total.expected, total.gap) == (alone.revenue, alone.expected, alone.gap)


def test_attainment_subtotals(star):
    keys = ["region", "category", "region_total", "category_total"]
    got = by_key(measures.attainment(star, ["region", "category"], totals=True), keys)
    target = 24 * 50
    assert got["North", "Drinks", False, False].target == target  # of the whole region: targets have no category
    assert got[None, "Food", True, False].target == 3 * target == got[None, None, True, True].target
    assert got["South", None, False, True].attainment == pytest.approx(sum(10 + i for i in range(24)) / target)
    # Reps without a region: their targets and the sales without a rep are the slice null, not a total.
    assert got[None, None, False, True].target == target and got[None, None, False, True].revenue == 7
    plain = by_key(measures.attainment(star, ["region", "category"]), ["region", "category"])
    assert {k: v.attainment for k, v in plain.items()} == {k[:2]: v.attainment for k, v in got.items() if not k[2] and not k[3]}
    only = by_key(measures.attainment(star, ["category"]), ["category"])
    assert only["Food",].target == 3 * target


def test_subtotals_of_nothing(star):
    empty = Star(star.sales.where("false"), star.products, targets=star.targets.where("false"), reps=star.reps)
    assert measures.revenue_yoy(empty, ["region"], YEARS, totals=True).count() == 0
    assert measures.attainment(empty, ["region", "category"], totals=True).where("not region_total").count() == 0
