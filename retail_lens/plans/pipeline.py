"""End to end: raw CSV folder -> clean tables -> reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lens.functions.months import Period, PeriodSpec, add_to_month
from retail_lens.functions.text import null_missing
from retail_lens.plans import attainment, cleaning, forecast, growth, inventory, quality, supply
from retail_lens.plans.cleaning import CleaningRules, Stage
from retail_lens.plans.model import Focus, monthly_facts
from retail_lens.session import Staging, unstaged
from retail_lens.sources.catalog import load_clean
from retail_lens.sources.files import scan_csv_checked, write_csv
from retail_lens.sources.schemas import QUALITY_LOG, RAW
from retail_lens.sources.store import Run, Store


#: Table of raw rows set aside, and the stored roll-up of sales.
REJECTED = "rejected_rows"
MONTHLY = "monthly_sales"
QUALITY_SUMMARY = "quality_summary"
#: Raw file -> the name its table has in the quality log.
LOGGED = dict(zip(RAW, ("sales", "products", "customers", "sales_reps", "targets", "deliveries"), strict=True))


def read_raw(
    spark: SparkSession, folder: str, multi_line: bool = False, stage: Stage = unstaged
) -> dict[str, DataFrame]:
    """The raw tables, missing texts null, and, as ``rejected_rows``, what was no row of theirs. With a real ``stage`` each file is parsed once.

    ``multi_line`` has one task read a whole file.
    """
    tables, rejected = {}, []
    for name, schema in RAW.items():
        rows = scan_csv_checked(spark, f"{folder}/{name}.csv", schema.names, multi_line)
        rows = stage(null_missing(rows), name)
        tables[name] = rows.where("reject is null").drop("reject")
        rejected.append(rows.where("reject is not null").select(F.lit(LOGGED[name]).alias("table"), "reject.*"))
    return tables | {REJECTED: reduce(DataFrame.unionByName, rejected)}


def clean_folder(
    spark: SparkSession,
    raw: str,
    folder: str,
    rules: CleaningRules = CleaningRules(),
    multi_line: bool = False,
    months: Sequence[date] | None = None,
) -> None:
    """Raw CSV files to published clean tables; see ``clean_all``."""
    stage = Staging(spark)
    try:
        clean_all(spark, read_raw(spark, raw, multi_line, stage), folder, rules, months, stored=True)
    finally:
        stage.drop()


def clean_all(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    folder: str,
    rules: CleaningRules = CleaningRules(),
    months: Sequence[date] | None = None,
    stored: bool = False,
) -> None:
    """Write the clean tables, the monthly roll-up, the quality log, the summary and the rejected rows, and publish them together.

    Until the end readers see the tables of the run before, also if this one fails. With ``months`` only these months
    of the sales, the deliveries and the roll-up are written, the others stay as published: for data that came late. Facts are
    in total order: sales and deliveries by day and id, targets by rep and month. ``stored`` raw tables, those of a staged
    ``read_raw``, are searched for copies by digest. Rules are counted while the flagged rows are
    written; the sales log is counted from the marked lines, before prices and reps are filled.
    """
    stage, watch, run = Staging(spark), quality.Watch(), Store(spark, folder).start()
    marks = ["changed", "unknown_label"]
    try:
        run.write(watch("products", cleaning.flag_products(raw["products_raw"], rules)).drop(*marks), "dim_products")
        run.write(watch("customers", cleaning.flag_customers(raw["customers_raw"], rules, stage)).drop(*marks), "dim_customers")
        run.write(watch("sales_reps", cleaning.flag_reps(raw["sales_reps_raw"], rules, stage)).drop(*marks), "dim_reps")
        customers = run.read("dim_customers")
        watch.conflicts(customers)

        targets = stage(watch("targets", cleaning.parse_targets(raw["sales_targets_raw"])), "targets")
        run.write(cleaning.sort_targets(cleaning.fill_targets(targets)), "fact_targets")
        deliveries = cleaning.flag_deliveries(raw["deliveries_raw"], rules, stage, stored)
        deliveries = stage(watch("deliveries", deliveries), "deliveries")
        run.write_months(cleaning.finish_deliveries(deliveries), "fact_deliveries", order=["delivery_id"], months=months)
        marked = cleaning.mark_sales(raw["sales_transactions_raw"], rules, stage, stored)
        marked = stage(watch("sales", marked), "sales_marked")
        sales = stage(cleaning.finish_sales(cleaning.repair_sales(marked, customers, stage)), "sales")
        run.write_months(sales, "fact_sales", order=["order_id"], months=months)
        roll_up_months(run, months)

        if REJECTED in raw:
            run.write(raw[REJECTED], REJECTED)
            watch.rejects(run.read(REJECTED))
        run.write(watch.log(spark), QUALITY_LOG)
        run.write(watch.summary(spark), QUALITY_SUMMARY)
        run.publish()
    except BaseException:
        run.discard()
        raise
    finally:
        stage.drop()


def roll_up_months(run: Run, months: Sequence[date] | None = None) -> None:
    """Bring the run's monthly roll-up up to its sales: all months, or only those that changed, reading no others."""
    sales = run.read("fact_sales")
    if months is not None:
        sales = sales.where(F.col("month").isin(list(months)))
    run.write_months(monthly_facts(sales), MONTHLY, order=["region", "sku"], months=months)


def reports(
    tables: dict[str, DataFrame], spec: PeriodSpec, focus: Focus, shock: date, stage: Stage = unstaged
) -> dict[str, DataFrame]:
    """Report name -> lazy frame, over the clean tables.

    The stored monthly roll-up is read in place of the sales lines where it is among the tables; else, with a real
    ``stage``, the lines are read once, for their monthly sums.
    """
    sales = tables[MONTHLY] if MONTHLY in tables else stage(monthly_facts(tables["fact_sales"]), "monthly_facts")
    products, reps = tables["dim_products"], tables["dim_reps"]
    deliveries, targets = tables["fact_deliveries"], tables["fact_targets"]
    year_before = _year_until(spec)
    detail = stage(forecast.forecast_detail(sales, products, spec), "forecast_detail")
    return {
        "region_yoy": growth.region_yoy(sales, spec),
        "category_yoy": growth.category_drilldown(sales, products, spec, focus.region),
        "growth_gap": growth.growth_gap(sales, products, spec),
        "lost_revenue": growth.lost_revenue(sales, products, spec, focus),
        "monthly_revenue": growth.monthly_revenue_by_region(sales),
        "monthly_change": growth.mom_yoy_lag(sales, products, focus),
        "focus_index": growth.focus_index(sales, products, focus),
        "supply_comparison": supply.supply_comparison(deliveries, products, spec.current, focus),
        "supply_by_region_category": supply.supply_by_region_category(deliveries, products, shock),
        "rep_attainment": attainment.rep_attainment(targets, sales, reps, spec),
        "rep_attainment_ranked": attainment.rep_attainment_ranked(targets, sales, reps, spec, stage),
        "region_attainment": attainment.region_attainment(targets, sales, reps, spec.current),
        "forecast_detail": detail,
        "forecast_by_region": forecast.forecast_bottom_up(detail, spec.future),
        "forecast_top_down": forecast.forecast_top_down(sales, spec),
        "forecast_month_totals": forecast.forecast_month_totals(detail),
        "backtest_mape": forecast.backtest_mape(detail, focus),
        "safety_stock": inventory.stock_plan(sales, deliveries, products, focus, year_before, shock),
        "safety_stock_inputs": inventory.stock_inputs(sales, deliveries, products, focus, year_before, shock),
    }


def _year_until(spec: PeriodSpec) -> Period:
    """The twelve months that end with the trend period."""
    return Period(add_to_month(spec.trend.last, -11), spec.trend.last)


def analyse(spark: SparkSession, clean: str, out: str, spec: PeriodSpec, focus: Focus, shock: date) -> None:
    """Write every report as CSV under ``out``."""
    stage = Staging(spark)
    try:
        tables = load_clean(spark, clean) | {MONTHLY: Store(spark, clean).read(MONTHLY)}
        for name, df in reports(tables, spec, focus, shock, stage).items():
            write_csv(df, f"{out}/{name}")
    finally:
        stage.drop()
