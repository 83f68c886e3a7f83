"""Reports on small hand-made stars, checked against plain Python or pandas."""

from datetime import date
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from retail_lens.functions.months import Period, PeriodSpec
from retail_lens.plans import attainment, forecast, growth, inventory, measures, supply
from retail_lens.plans.model import Focus, Star, monthly_facts

SPEC = PeriodSpec(Period.of("2026-07", "2026-09"), Period.of("2026-01", "2026-06"), Period.of("2026-10", "2026-12"))
FOCUS = Focus("North", "Drinks")
SALES = "order_date date, region string, sku string, sales_rep_id string, quantity double, revenue decimal(18,2)"


def make_sales(spark, months=range(21), skip=()):
    rows = []
    for i in months:
        day = date(2025 + i // 12, i % 12 + 1, 15)
        if day.strftime("%Y-%m") in skip:
            continue
        for region, rep in (("North", "r1"), ("South", "r2")):
            for sku in ("d1", "d2", "f1"):
                units = 10 + (i * 7 + len(rows) * 3) % 11
                rows.append((day, region, sku, rep, float(units), Decimal(units * 25) / 2))
    rows.append((date(2026, 8, 1), "North", "ghost", "r1", 5.0, Decimal("999.99")))
    rows.append((date(2026, 8, 1), None, "d1", None, 5.0, Decimal("77.00")))
    return spark.createDataFrame(rows, SALES)


@pytest.fixture(scope="module")
def sales(spark):
    return make_sales(spark).cache()


@pytest.fixture(scope="module")
def products(spark):
    rows = [("d1", "Drinks", 7.0), ("d2", "Drinks", 8.0), ("f1", "Food", 9.0)]
    return spark.createDataFrame(rows, "sku string, category string, unit_cost double").cache()


@pytest.fixture(scope="module")
def pdf(sales, products):
    frame = sales.toPandas().merge(products.toPandas(), on="sku")
    frame["revenue"] = frame.revenue.astype(float)
    frame["ym"] = pd.to_datetime(frame.order_date).dt.to_period("M")
    return frame


def total(frame, first, last):
    return frame[(frame.ym >= pd.Period(first, "M")) & (frame.ym <= pd.Period(last, "M"))].revenue.sum()


def test_growth_gap(sales, products, pdf):
    got = {(r.region, r.category): r for r in growth.growth_gap(sales, products, SPEC).collect()}
    assert (None, "Drinks") in got and got[None, "Drinks"].growth_gap_pts is None
    for group, part in pdf.dropna(subset=["region"]).groupby(["region", "category"]):
        q = total(part, "2026-07", "2026-09") / total(part, "2025-07", "2025-09")
        h = total(part, "2026-01", "2026-06") / total(part, "2025-01", "2025-06")
        assert got[group].growth_gap_pts == pytest.approx(100 * (q - h), abs=0.051)
        assert got[group].yoy_pct == pytest.approx(100 * (q - 1), abs=0.051)


def test_category_totals_add_up_to_region(sales, products, pdf):
    drill = growth.category_drilldown(sales, products, SPEC, "North").collect()
    north = pdf[pdf.region == "North"]
    assert sum(r.current for r in drill) == pytest.approx(total(north, "2026-07", "2026-09"), abs=1.5)


def test_lost_revenue(sales, products, pdf):
    row = growth.lost_revenue(sales, products, SPEC, FOCUS).first()
    part = pdf[(pdf.region == "North") & (pdf.category == "Drinks")]
    expected = total(part, "2025-07", "2025-09") * total(part, "2026-01", "2026-06") / total(part, "2025-01", "2025-06")
    assert row.expected == round(expected)
    assert row.lost == pytest.approx(expected - total(part, "2026-07", "2026-09"), abs=0.51)


def test_focus_index(sales, products, pdf):
    drinks = pdf[pdf.category == "Drinks"].assign(grp=lambda d: d.region.eq("North").map({True: "focus", False: "other"}))
    wide = drinks.groupby(["ym", "grp"]).revenue.sum().unstack()
    want = (wide / wide.iloc[:6].mean() * 100).rolling(3).mean()
    got = growth.focus_index(sales, products, FOCUS).orderBy("month").toPandas()
    assert len(got) == len(want) and got.focus.isna().sum() == 2
    for name in ("focus", "other"):
        assert got[name].dropna().tolist() == pytest.approx(want[name].dropna().tolist(), abs=1e-4)


def test_forecast_and_backtest(sales, products, pdf):
    detail = forecast.forecast_detail(sales, products, SPEC)
    rows = {(r.region, r.category, r.month): r for r in detail.collect()}
    assert len(rows) == 4 * 6
    part = pdf[(pdf.region == "South") & (pdf.category == "Food")]
    g = total(part, "2026-01", "2026-06") / total(part, "2025-01", "2025-06")
    assert rows["South", "Food", "2026-11"].forecast == round(total(part, "2025-11", "2025-11") * g)
    assert rows["South", "Food", "2026-11"].actual is None
    assert rows["South", "Food", "2026-08"].actual == round(total(part, "2026-08", "2026-08"))
    errors = [abs(r.actual - r.forecast) / r.actual for k, r in rows.items() if r.actual is not None and k[:2] != ("North", "Drinks")]
    assert forecast.backtest_mape(detail, FOCUS).first().mape == pytest.approx(100 * sum(errors) / len(errors))
    by_region = {r.region: r.forecast for r in forecast.forecast_bottom_up(detail, SPEC.future).collect()}
    assert by_region["South"] == sum(r.forecast for k, r in rows.items() if k[0] == "South" and k[2] >= "2026-10")
    months = {r.month: r.actual for r in forecast.forecast_month_totals(detail).collect()}
    assert months["2026-12"] == 0.0


def test_lag_and_calendar_agree_without_gaps_and_differ_after_one(spark, sales, products):
    def both(frame):
        lag = {r.ym: r.yoy_pct for r in growth.mom_yoy_lag(frame, products, FOCUS).collect()}
        star = Star(frame, products).in_region("North").in_category("Drinks")
        calendar = measures.revenue_yoy(star, [], Period.of("2025-01", "2026-12"))
        year = {r.month.strftime("%Y-%m"): r.revenue_yoy for r in calendar.where("revenue is not null").collect()}
        return lag, {m: None if v is None else round(v * 100, 1) for m, v in year.items()}

    lag, year = both(sales)
    assert lag == pytest.approx(year)
    lag, year = both(make_sales(spark, skip=("2025-08",)))
    assert year["2026-08"] is None and lag["2026-08"] is not None


def test_rolling_revenue_skips_the_missing_month(spark, products):
    frame = make_sales(spark, skip=("2025-08",))
    star = Star(frame, products).in_region("South")
    rolling = {r.month: r.rolling_revenue for r in measures.rolling_revenue(star, [], Period.of("2025-01", "2026-12")).collect()}
    by_month = {r.m: r.revenue for r in frame.where("region = 'South'").groupBy(F.trunc("order_date", "MM").alias("m")).agg(F.sum("revenue").alias("revenue")).collect()}
    assert rolling[date(2025, 9, 1)] == by_month[date(2025, 7, 1)] + by_month[date(2025, 9, 1)]
    assert rolling[date(2025, 8, 1)] == by_month[date(2025, 6, 1)] + by_month[date(2025, 7, 1)]


def test_expected_revenue_and_gap(sales, products):
    star = Star(sales.where("region is not null"), products)
    rows = measures.gap_vs_trend(star, ["region"], Period.of("2025-01", "2026-12"), SPEC.trend).collect()
    factor = {r.region: r.growth_factor for r in measures.growth_factor(star, ["region"], SPEC.trend).collect()}
    assert max(r.month for r in rows) == date(2026, 12, 1)
    known = {(r.region, r.month): r.revenue for r in rows}
    for r in rows:
        before = known.get((r.region, date(r.month.year - 1, r.month.month, 1)))
        if before is None:
            assert r.expected is None and r.gap == float(r.revenue)
        else:
            assert r.expected == pytest.approx(float(before) * factor[r.region])
            assert r.gap == pytest.approx(float(r.revenue or 0) - r.expected)


def test_expected_revenue_without_a_slice(sales, products, pdf):
    rows = measures.gap_vs_trend(Star(sales, products), [], Period.of("2026-01", "2026-12"), SPEC.trend).collect()
    assert len(rows) == 12
    frame = sales.toPandas().assign(revenue=lambda d: d.revenue.astype(float), ym=lambda d: pd.to_datetime(d.order_date).dt.to_period("M"))
    growth_factor = total(frame, "2026-01", "2026-06") / total(frame, "2025-01", "2025-06")
    july = next(r for r in rows if r.month == date(2026, 7, 1))
    assert july.expected == pytest.approx(total(frame, "2025-07", "2025-07") * growth_factor)


def test_gross_margin(sales, products, pdf):
    got = measures.gross_margin(Star(sales, products), ["category"]).where("category = 'Food'").first()
    food = pdf[pdf.category == "Food"]
    margin = (food.revenue - food.quantity * food.unit_cost).sum()
    assert got.gross_margin == pytest.approx(margin)
    assert got.gross_margin_pct == pytest.approx(margin / food.revenue.sum())


def test_monthly_facts_give_the_same_reports(sales, products, targets, reps):
    sales = sales.unionByName(sales.withColumn("order_date", F.date_add("order_date", 3)))
    small = monthly_facts(sales)
    assert small.count() < sales.count()
    window = Period.of("2025-07", "2026-06")
    for report in (
        lambda s: growth.growth_gap(s, products, SPEC),
        lambda s: growth.region_yoy(s, SPEC),
        lambda s: growth.lost_revenue(s, products, SPEC, FOCUS),
        lambda s: growth.focus_index(s, products, FOCUS),
        lambda s: forecast.forecast_detail(s, products, SPEC),
        lambda s: attainment.rep_attainment(targets, s, reps, SPEC),
        lambda s: inventory.demand_stats(s, products, FOCUS, window),
    ):
        assert report(small).collect() == report(sales).collect()


TARGETS = "rep_id string, month_start date, target_amount double"


@pytest.fixture(scope="module")
def targets(spark):
    months = [date(2025 + i // 12, i % 12 + 1, 1) for i in range(21)]
    rows = [(rep, m, 500.0 + 10 * m.month) for rep in ("r1", "r2", "idle") for m in months]
    rows.append(("old", date(2025, 1, 1), 100.0))
    return spark.createDataFrame(rows, TARGETS).cache()


@pytest.fixture(scope="module")
def reps(spark):
    rows = [("r1", "Ann", "North"), ("r2", "Bo", "South"), ("idle", "Cy", "South"), ("old", "Di", "North"), ("new", "Ed", "North")]
    return spark.createDataFrame(rows, "rep_id string, rep_name string, region string").cache()


def test_attainment(sales, targets, reps):
    plain = {r.rep_id: r for r in attainment.rep_attainment(targets, sales, reps, SPEC).collect()}
    assert set(plain) == {"r1", "r2", "idle", "old", "new"}
    frame = sales.toPandas()
    mine = frame[(frame.sales_rep_id == "r2") & (pd.to_datetime(frame.order_date) >= "2026-07-01")]
    target = sum(500 + 10 * m for m in (7, 8, 9))
    assert plain["r2"].current_pct == pytest.approx(100 * float(mine.revenue.sum()) / target, abs=0.051)
    assert plain["idle"].current_pct == 0.0 and plain["idle"].status == "Persistent under-performance"
    assert plain["new"].current_pct is None and plain["new"].status == "On track"

    ranked = {r.rep_id: r for r in attainment.rep_attainment_ranked(targets, sales, reps, SPEC).collect()}
    assert set(ranked) == {"r1", "r2", "idle", "old"}
    assert ranked["old"].current_rank == 4 and ranked["old"].current_pct is None
    assert ranked["idle"].current_rank == 3

    regions = {r.region: r.attainment_pct for r in attainment.region_attainment(targets, sales, reps, SPEC.current).collect()}
    assert regions["South"] == pytest.approx(plain["r2"].current_pct / 2, abs=0.1)


def test_status_rule(spark):
    cases = [
        (69.0, 71.7, "Persistent under-performance"),
        (105.3, 88.1, "Recent drop - check supply"),
        (120.2, 118.2, "Star performer"),
        (96.5, 90.8, "On track"),
        (90.0, 110.0, "Star performer"),
        (None, None, "On track"),
        (None, 89.9, "Recent drop - check supply"),
    ]
    df = spark.createDataFrame(cases, "h double, q double, want string")
    assert all(r[0] == r.want for r in df.select(attainment.rep_status(F.col("h"), F.col("q")), "want").collect())


def test_attainment_bands(spark):
    df = spark.createDataFrame([(1.1,), (0.9,), (0.5,), (None,)], "s double")
    got = [tuple(r) for r in df.select(measures.attainment_status(F.col("s")), measures.attainment_colour(F.col("s"))).collect()]
    assert got == [
        ("Star performer", measures.STAR_COLOUR),
        ("On track", measures.TRACK_COLOUR),
        ("Below target", measures.BELOW_COLOUR),
        (None, measures.BELOW_COLOUR),
    ]


DELIVERIES = "sku string, region string, order_date date, qty_ordered double, qty_delivered double, stockout_days double, lead_time_days int, fill_rate double"


@pytest.fixture(scope="module")
def deliveries(spark):
    rows = []
    for i in range(60):
        day = date(2026, 1 + i % 9, 1 + i % 28)
        fill = None if i % 13 == 0 else round(0.5 + i % 50 / 100, 3)
        rows.append((("d1", "d2", "f1")[i % 3], ("North", "South")[i // 3 % 2], day, 100.0, fill and fill * 100, float(i % 4), 2 + i % 7, fill))
    return spark.createDataFrame(rows, DELIVERIES).cache()


def test_supply(deliveries, products):
    frame = deliveries.toPandas().merge(products.toPandas(), on="sku")
    recent = frame[pd.to_datetime(frame.order_date) >= "2026-07-01"]
    focus = recent[(recent.region == "North") & (recent.category == "Drinks")]
    got = {r.group: r for r in supply.supply_comparison(deliveries, products, SPEC.current, FOCUS).collect()}
    assert got["Focus"].avg_lead_days == pytest.approx(focus.lead_time_days.mean(), abs=0.0051)
    assert got["Focus"].avg_fill_rate == pytest.approx(focus.fill_rate.mean(), abs=0.0051)
    table = {(r.region, r.category): r for r in supply.supply_by_region_category(deliveries, products, date(2026, 7, 1)).collect()}
    means = recent.groupby(["region", "category"]).stockout_days.mean()
    assert {k: r.avg_stockout_days for k, r in table.items()} == pytest.approx(means.to_dict(), abs=0.051)
    ratio = {r.region: r.fill_rate for r in supply.fill_rate_ratio(deliveries, ["region"]).collect()}
    sums = frame.groupby("region")[["qty_delivered", "qty_ordered"]].sum()
    assert ratio == pytest.approx((sums.qty_delivered / sums.qty_ordered).to_dict())


def test_safety_stock_formula(spark):
    row = spark.range(1).select(inventory.safety_stock(F.lit(10.0), F.lit(0.0), F.lit(300.0), F.lit(30.0)).alias("s")).first()
    assert round(row.s) == 29


def test_stock_plan(sales, deliveries, products, pdf):
    window = Period.of("2025-07", "2026-06")
    got = {r.sku: r for r in inventory.stock_plan(sales, deliveries, products, FOCUS, window, date(2026, 7, 1)).collect()}
    assert set(got) == {"d1", "d2"}
    part = pdf[(pdf.region == "North") & (pdf.ym >= pd.Period("2025-07", "M")) & (pdf.ym <= pd.Period("2026-06", "M"))]
    units = part.groupby(["sku", "ym"]).quantity.sum().groupby("sku").agg(["mean", "std"]).round(1)
    lead = deliveries.toPandas()
    late = lead[(lead.region == "North") & (pd.to_datetime(lead.order_date) >= "2026-07-01")].groupby("sku").lead_time_days.agg(["mean", "std"])
    for sku, r in got.items():
        d, sd, L, sdL = units["mean"][sku], units["std"][sku], late["mean"][sku], late["std"][sku]
        stock = round(1.65 * ((L / 30) * sd**2 + (d / 30) ** 2 * sdL**2) ** 0.5)
        assert (r.avg_monthly_units, r.sd_monthly_units, r.safety_stock_now) == (d, sd, stock)
        assert r.reorder_point_now == round(d / 30 * L + stock)
    inputs = {r.sku: r for r in inventory.stock_inputs(sales, deliveries, products, FOCUS, window, date(2026, 7, 1)).collect()}
    variance = part.groupby(["sku", "ym"]).quantity.sum().groupby("sku").var(ddof=0)
    assert inputs["d1"].var_monthly_units == pytest.approx(variance["d1"], abs=0.51)


def test_filters_run_from_dimensions_to_facts(sales, products, deliveries, targets):
    star = Star(sales, products, deliveries, targets).in_category("Food").in_period(SPEC.current)
    assert {r.sku for r in star.sales.select("sku").distinct().collect()} == {"f1"}
    assert star.targets.count() == 9
    across = measures.drill_across(star, ["month", "region"]).collect()
    assert {r.target for r in across if r.month == date(2026, 7, 1)} == {Decimal("1710.0000")}
