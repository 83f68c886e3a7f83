"""One registered query per operator or report. Each takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DecimalType, IntegerType, ShortType

from retail_lens.functions import months, numbers, text
from retail_lens.functions.months import during, iso_text, month_start, shift_month, since
from retail_lens.functions.numbers import round_up
from retail_lens.functions.text import (
    blank_to_null,
    dated_rows,
    is_missing_token,
    normalise_key,
    null_missing,
    parse_dates,
    title_case,
    to_number,
)
from retail_lens.operators import dedupe, repair
from retail_lens.operators.interpolate import interpolate
from retail_lens.operators.labels import indexed_labels
from retail_lens.operators.medians import attach_median
from retail_lens.operators.repair import quantity_flag, repair_quantity, repair_sign
from retail_lens.operators.series import interpolate_series, lag_series, running_series
from retail_lens.plans import attainment, cleaning, forecast, growth, inventory, measures, model, quality, supply
from retail_lens.plans.maintained import MaintainedMedian, changed_repairs
from retail_lens.plans.model import keep_products, monthly, monthly_facts
from retail_lens.plans.pipeline import MONTHLY
from retail_lens.session import Staging
from retail_lens.sources.catalog import register_views, row_counts
from retail_lens.sources.files import scan_csv, scan_csv_checked, scan_csv_text, write_csv
from retail_lens.sources.schemas import DAY, NUMBER, TEXT, schema
from retail_lens.sources.store import Store
from workload.expressions import QUOTED_NAME, UNEVEN_COLUMNS, UNEVEN_LINE
from workload.inputs import Inputs
from workload.settings import CALENDAR, FOCUS, LONG_LABELS, RULES, SHOCK, SPEC, YEAR

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _output(field) -> Column:
    """Dates as ISO text, exact decimals as doubles, counts as 64-bit integers."""
    column = F.col(field.name)
    if isinstance(field.dataType, DateType):
        column = iso_text(column)
    elif isinstance(field.dataType, DecimalType):
        column = column.cast("double")
    elif isinstance(field.dataType, (ByteType, ShortType, IntegerType)):
        column = column.cast("long")
    return column.alias(field.name)


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = build(Inputs(spark, folder))
        return df.select(*[_output(field) for field in df.schema.fields])

    QUERIES[build.__name__] = run
    return build


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({name: round_up(F.col(name), digits) for name in names})


def _scratch(inp: Inputs, name: str) -> str:
    """A path in the shared folder that is deleted when the application ends."""
    return f"{Staging(inp.spark).root}/{name}"


# ---- sources and sinks ------------------------------------------------------------


@query
def csv_scan_text(inp: Inputs) -> DataFrame:
    raw, path = inp.raw_customers(), _scratch(inp, "customers_raw.csv")
    raw = raw.withColumn("outlet_name", F.expr(QUOTED_NAME))
    write_csv(raw.select(*reversed(raw.columns)), path)
    return scan_csv_text(inp.spark, path, raw.columns, multi_line=True)


@query
def csv_scan_typed(inp: Inputs) -> DataFrame:
    path = _scratch(inp, "orders.csv")
    orders = inp.table("orders").select(
        F.col("o_totalprice").alias("amount"),
        F.lit('a "quoted", text').alias("note"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderkey").cast("string").alias("order_id"),
    )
    write_csv(orders, path)
    return scan_csv(inp.spark, path, schema(order_id=TEXT, order_date=DAY, amount=NUMBER))


@query
def rejected_rows(inp: Inputs) -> DataFrame:
    """Rows of a file that have too few or too many fields."""
    path = _scratch(inp, "lines.csv")
    lines = inp.table("lineitem").select(F.expr(UNEVEN_LINE).alias(",".join(UNEVEN_COLUMNS)))
    # A separator that does not occur: commas are written as they are, also the wrong ones.
    lines.write.options(header=True, sep="\x01").csv(path)
    return scan_csv_checked(inp.spark, path, UNEVEN_COLUMNS).where("reject is not null").select("reject.text", "reject.reason")


@query
def null_token_normalise(inp: Inputs) -> DataFrame:
    raw = dedupe.drop_exact_duplicates(inp.raw_deliveries())
    return raw.select(
        "delivery_id",
        is_missing_token(F.col("qty_delivered")).alias("was_token"),
        blank_to_null(F.col("qty_delivered")).alias("qty_delivered"),
        blank_to_null(F.col("stockout_days")).alias("stockout_days"),
    )


@query
def catalog_row_counts(inp: Inputs) -> DataFrame:
    tables = {
        "fact_sales": inp.sales(),
        "fact_targets": inp.targets(),
        "fact_deliveries": inp.deliveries(),
        "dim_products": inp.products(),
        "dim_customers": inp.customers(),
        "dim_reps": inp.reps(),
    }
    register_views(tables)
    return row_counts({name: inp.spark.table(name) for name in tables})


# ---- cleaning: columns ------------------------------------------------------------


@query
def parse_mixed_dates(inp: Inputs) -> DataFrame:
    return inp.raw_lines().select("order_id", "order_date", parse_dates(F.col("order_date")).alias("parsed"))


@query
def parse_month_start(inp: Inputs) -> DataFrame:
    return inp.raw_targets().select("rep_id", "month", text.parse_month_start(F.col("month")).alias("month_start"))


@query
def standardise_region(inp: Inputs) -> DataFrame:
    return inp.raw_customers().select("customer_id", RULES.region(F.col("region")).alias("region"))


@query
def standardise_channel(inp: Inputs) -> DataFrame:
    return inp.raw_customers().select("customer_id", RULES.channel(F.col("channel")).alias("channel"))


@query
def text_to_number(inp: Inputs) -> DataFrame:
    names = ["quantity", "unit_price", "discount_pct"]
    return inp.raw_lines().select("order_id", *[to_number(F.col(n)).alias(n) for n in names])


@query
def normalise_keys(inp: Inputs) -> DataFrame:
    return inp.raw_lines().select("order_id", normalise_key(F.col("sku")).alias("sku"))


@query
def title_case_labels(inp: Inputs) -> DataFrame:
    return inp.raw_customers().select("customer_id", title_case(F.col("outlet_name")).alias("outlet_name"))


@query
def sign_repair(inp: Inputs) -> DataFrame:
    signed = to_number(F.col("quantity"))
    return inp.raw_lines().select(
        "order_id", repair_sign(signed).alias("quantity"), F.coalesce(signed < 0, F.lit(False)).alias("was_negative")
    )


@query
def default_fill(inp: Inputs) -> DataFrame:
    discount = F.coalesce(to_number(F.col("discount_pct")), F.lit(0.0))
    return inp.raw_lines().select("order_id", discount.alias("discount_pct"))


@query
def line_revenue(inp: Inputs) -> DataFrame:
    names = ["quantity", "unit_price", "discount_pct"]
    typed = inp.raw_lines().select("order_id", *[to_number(F.col(n)).alias(n) for n in names])
    return typed.withColumn("revenue", numbers.line_revenue(*[F.col(n) for n in names]))


@query
def lead_time_days(inp: Inputs) -> DataFrame:
    return inp.dated_deliveries().select("order_id", "line_no", "order_date", "delivery_date", "lead_time_days")


@query
def row_fill_rate(inp: Inputs) -> DataFrame:
    return inp.dated_deliveries().select("order_id", "line_no", "qty_ordered", "qty_delivered", "fill_rate")


@query
def month_bucket(inp: Inputs) -> DataFrame:
    month = month_start(F.col("order_date"))
    return inp.lines().groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("lines"))


# ---- cleaning: tables -------------------------------------------------------------


@query
def drop_exact_duplicates(inp: Inputs) -> DataFrame:
    return dedupe.drop_exact_duplicates(null_missing(inp.raw_sales()))


@query
def drop_invalid_dates(inp: Inputs) -> DataFrame:
    return dated_rows(inp.raw_lines().select("order_id", "order_date"), "order_date")


def _parsed_sales(inp: Inputs, stage: Staging) -> DataFrame:
    parsed = stage(cleaning.parse_sales(inp.raw_sales(), RULES), "sales_parsed")
    return parsed.where(F.col("order_date").isNotNull()).withColumn("quantity", repair_sign(F.col("signed_quantity")))


@query
def group_median_join(inp: Inputs) -> DataFrame:
    stage = Staging(inp.spark)
    keys = ["sku", "channel"]
    with_median = attach_median(_parsed_sales(inp, stage), keys, "quantity", "median_quantity", stage)
    return with_median.select("order_id", *keys, "quantity", "median_quantity")


@query
def outlier_repair(inp: Inputs) -> DataFrame:
    return _repaired(inp).where("qty_flag = 'outlier_fixed'")


@query
def impute_quantity(inp: Inputs) -> DataFrame:
    return _repaired(inp)


def _repaired(inp: Inputs) -> DataFrame:
    stage = Staging(inp.spark)
    rows = attach_median(_parsed_sales(inp, stage), ["sku", "channel"], "quantity", "usual", stage)
    value, usual = F.col("quantity"), F.col("usual")
    return rows.select(
        "order_id",
        "sku",
        "channel",
        repair_quantity(value, usual).alias("quantity"),
        quantity_flag(value, usual).alias("qty_flag"),
    )


@query
def impute_price(inp: Inputs) -> DataFrame:
    stage = Staging(inp.spark)
    parsed = _parsed_sales(inp, stage).withColumn("month", month_start(F.col("order_date")))
    rows = attach_median(parsed, ["sku", "month"], "unit_price", "usual", stage)
    price = F.coalesce("unit_price", "usual").alias("unit_price")
    return rows.select("order_id", "sku", "month", price, F.col("unit_price").isNull().alias("filled"))


@query
def lookup_fill(inp: Inputs) -> DataFrame:
    master = cleaning.clean_customers(inp.raw_customers(), RULES)
    lines = dedupe.drop_exact_duplicates(null_missing(inp.raw_sales())).select(
        "order_id", normalise_key(F.col("customer_id")).alias("customer_id"), "sales_rep_id"
    )
    stage = Staging(inp.spark)
    return repair.lookup_fill(stage(lines, "lines"), "sales_rep_id", master, "customer_id", "rep_id", stage)


@query
def sorted_sales(inp: Inputs) -> DataFrame:
    return cleaning.sort_sales(inp.lines().select("order_id", "line_no", "order_date", "sku", "quantity", "revenue"))


@query
def interpolate_targets(inp: Inputs) -> DataFrame:
    filled = interpolate(inp.gappy_targets(), ["rep_id"], "month_start", "target_amount")
    return rounded(filled, "target_amount")


@query
def clean_sales(inp: Inputs) -> DataFrame:
    customers = cleaning.clean_customers(inp.raw_customers(), RULES)
    return cleaning.clean_sales(inp.raw_sales(), customers, RULES, Staging(inp.spark))


@query
def clean_targets(inp: Inputs) -> DataFrame:
    return rounded(cleaning.clean_targets(inp.raw_targets()), "target_amount")


@query
def clean_deliveries(inp: Inputs) -> DataFrame:
    return cleaning.clean_deliveries(inp.raw_deliveries(), RULES)


@query
def clean_customers(inp: Inputs) -> DataFrame:
    return cleaning.clean_customers(inp.raw_customers(), RULES)


@query
def clean_products(inp: Inputs) -> DataFrame:
    return cleaning.clean_products(inp.raw_products(), RULES)


@query
def clean_reps(inp: Inputs) -> DataFrame:
    return cleaning.clean_reps(inp.raw_reps(), RULES)


@query
def quality_log(inp: Inputs) -> DataFrame:
    watch = _watched(inp)
    watch.conflicts(cleaning.clean_customers(inp.raw_customers(), RULES))
    return watch.log(inp.spark)


def _watched(inp: Inputs, sales: Callable[..., DataFrame] = cleaning.mark_sales) -> quality.Watch:
    """Counts of all six tables, taken as their flagged rows are written."""
    watch = quality.Watch()
    watch.count("products", cleaning.flag_products(inp.raw_products(), RULES))
    watch.count("customers", cleaning.flag_customers(inp.raw_customers(), RULES))
    watch.count("sales_reps", cleaning.flag_reps(inp.raw_reps(), RULES))
    watch.count("sales", sales(inp.raw_sales(), RULES, Staging(inp.spark)))
    watch.count("targets", cleaning.parse_targets(inp.raw_targets()))
    watch.count("deliveries", cleaning.flag_deliveries(inp.raw_deliveries(), RULES))
    return watch


@query
def quality_summary(inp: Inputs) -> DataFrame:
    return _watched(inp).summary(inp.spark)


# ---- filters, labels, joins -------------------------------------------------------


@query
def filter_period(inp: Inputs) -> DataFrame:
    return during(inp.lines(), [SPEC.current, SPEC.prior]).select("order_id", "line_no", "order_date", "revenue")


@query
def filter_since(inp: Inputs) -> DataFrame:
    return since(inp.lines(), SHOCK).select("order_id", "line_no", "order_date")


def _totals(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("lines").alias("lines"), F.sum("revenue").alias("revenue"))


def _region_category_totals(inp: Inputs) -> DataFrame:
    per_product = (
        inp.sales()
        .groupBy("region", "sku")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue"))
    )
    return _totals(model.star_join(per_product, inp.products()), "region", "category")


@query
def filter_exclude_group(inp: Inputs) -> DataFrame:
    return _region_category_totals(inp).where(~FOCUS.holds())


@query
def label_focus_group(inp: Inputs) -> DataFrame:
    label = F.when(FOCUS.holds(), "Focus").otherwise("All other").alias("group")
    return _totals(_region_category_totals(inp).select(label, "lines", "revenue"), "group")


@query
def prior_year_month(inp: Inputs) -> DataFrame:
    own = F.struct("month", "revenue", F.lit(None).cast("decimal(38,4)").alias("prior_revenue"))
    later = F.struct(
        shift_month(F.col("month"), 12).alias("month"),
        F.lit(None).cast("decimal(38,4)").alias("revenue"),
        F.col("revenue").cast("decimal(38,4)").alias("prior_revenue"),
    )
    months = monthly(inp.lines(), []).withColumn("revenue", F.col("revenue").cast("decimal(38,4)"))
    sent = months.select(F.explode(F.array(own, later)).alias("c")).select("c.*")
    both = sent.groupBy("month").agg(F.max("revenue").alias("revenue"), F.max("prior_revenue").alias("prior_revenue"))
    return both.where("revenue is not null").select(
        "month", shift_month(F.col("month"), -12).alias("prior_month"), "revenue", "prior_revenue"
    )


@query
def star_join(inp: Inputs) -> DataFrame:
    lines = inp.lines().select("order_id", "line_no", "sku", "revenue")
    return model.star_join(lines, inp.products().select("sku", "category"))


@query
def target_vs_actual(inp: Inputs) -> DataFrame:
    return attainment.target_vs_actual(inp.targets(), inp.lines())


@query
def semi_join_focus_skus(inp: Inputs) -> DataFrame:
    in_category = inp.products().where(F.col("category") == FOCUS.category)
    return keep_products(inp.dated_deliveries(), in_category).select("order_id", "line_no", "sku", "lead_time_days")


# ---- growth -----------------------------------------------------------------------


@query
def monthly_revenue_by_region(inp: Inputs) -> DataFrame:
    return growth.monthly_revenue_by_region(inp.sales())


@query
def region_yoy(inp: Inputs) -> DataFrame:
    return growth.region_yoy(inp.sales(), SPEC)


@query
def region_yoy_detail(inp: Inputs) -> DataFrame:
    return rounded(growth.region_yoy(inp.sales(), SPEC, digits=None), "current", "prior", digits=2)


@query
def growth_gap(inp: Inputs) -> DataFrame:
    """From the stored monthly roll-up."""
    run = Store(inp.spark, _scratch(inp, "clean")).start()
    run.write_months(monthly_facts(inp.sales()), MONTHLY)
    run.publish()
    return growth.growth_gap(run.store.read(MONTHLY), inp.products(), SPEC)


@query
def late_months_rollup(inp: Inputs) -> DataFrame:
    """A roll-up of which half a year is rewritten after late orders came; the other months stay as stored."""
    store = Store(inp.spark, _scratch(inp, "clean"))
    run = store.start()
    run.write_months(monthly_facts(inp.sales().where(F.col("order_id") % 10 != 0)), MONTHLY)
    run.publish()
    run = store.start()
    run.write_months(monthly_facts(during(inp.sales(), [SPEC.trend])), MONTHLY, months=SPEC.trend.months())
    run.publish()
    return monthly(store.read(MONTHLY), ["region"])


@query
def category_drilldown(inp: Inputs) -> DataFrame:
    return growth.category_drilldown(inp.sales(), inp.products(), SPEC, FOCUS.region)


@query
def lost_revenue(inp: Inputs) -> DataFrame:
    return growth.lost_revenue(inp.sales(), inp.products(), SPEC, FOCUS)


@query
def mom_yoy_lag(inp: Inputs) -> DataFrame:
    return growth.mom_yoy_lag(inp.sales(), inp.products(), FOCUS)


@query
def beverage_index(inp: Inputs) -> DataFrame:
    return growth.focus_index(inp.sales(), inp.products(), FOCUS)


# ---- supply -----------------------------------------------------------------------


@query
def supply_comparison(inp: Inputs) -> DataFrame:
    return supply.supply_comparison(inp.deliveries(), inp.products(), SPEC.current, FOCUS)


@query
def supply_by_region_category(inp: Inputs) -> DataFrame:
    return supply.supply_by_region_category(inp.deliveries(), inp.products(), SHOCK)


@query
def supply_measures(inp: Inputs) -> DataFrame:
    table = supply.supply_measures(inp.deliveries(), inp.products(), ["region", "category"])
    return rounded(table, "avg_lead_days", "avg_stockout_days", "fill_rate")


@query
def fill_rate_ratio(inp: Inputs) -> DataFrame:
    return rounded(supply.fill_rate_ratio(inp.deliveries(), ["region"]), "fill_rate")


# ---- attainment -------------------------------------------------------------------


@query
def rep_attainment(inp: Inputs) -> DataFrame:
    return attainment.rep_attainment(inp.targets(), inp.lines(), inp.reps(), SPEC)


@query
def rep_attainment_sql(inp: Inputs) -> DataFrame:
    return attainment.rep_attainment_ranked(inp.targets(), inp.lines(), inp.reps(), SPEC, Staging(inp.spark))


@query
def rep_status(inp: Inputs) -> DataFrame:
    table = attainment.rep_attainment(inp.targets(), inp.lines(), inp.reps(), SPEC)
    return table.groupBy("status").agg(F.count(F.lit(1)).alias("reps"))


@query
def region_attainment(inp: Inputs) -> DataFrame:
    return attainment.region_attainment(inp.targets(), inp.lines(), inp.reps(), SPEC.current)


# ---- forecast and inventory -------------------------------------------------------


def _detail(inp: Inputs) -> DataFrame:
    return forecast.forecast_detail(inp.sales(), inp.products(), SPEC)


@query
def forecast_detail(inp: Inputs) -> DataFrame:
    return _detail(inp)


@query
def backtest_mape(inp: Inputs) -> DataFrame:
    return rounded(forecast.backtest_mape(_detail(inp), FOCUS), "mape")


@query
def forecast_q4_bottom_up(inp: Inputs) -> DataFrame:
    return forecast.forecast_bottom_up(_detail(inp), SPEC.future)


@query
def forecast_by_region(inp: Inputs) -> DataFrame:
    return forecast.forecast_top_down(inp.sales(), SPEC)


@query
def forecast_month_totals(inp: Inputs) -> DataFrame:
    return forecast.forecast_month_totals(_detail(inp))


@query
def demand_stats(inp: Inputs) -> DataFrame:
    return inventory.demand_stats(inp.sales(), inp.products(), FOCUS, YEAR)


@query
def lead_time_before_after(inp: Inputs) -> DataFrame:
    table = inventory.lead_time_stats(inp.deliveries(), FOCUS.region, SHOCK)
    in_category = inp.products().where(F.col("category") == FOCUS.category)
    return rounded(keep_products(table, in_category), *[c for c in table.columns if c != "sku"])


@query
def safety_stock(inp: Inputs) -> DataFrame:
    return inventory.stock_plan(inp.sales(), inp.deliveries(), inp.products(), FOCUS, YEAR, SHOCK)


@query
def safety_stock_inputs(inp: Inputs) -> DataFrame:
    return inventory.stock_inputs(inp.sales(), inp.deliveries(), inp.products(), FOCUS, YEAR, SHOCK)


# ---- calendar-aware measures ------------------------------------------------------


@query
def calendar(inp: Inputs) -> DataFrame:
    return months.calendar(inp.lines())


@query
def dim_region(inp: Inputs) -> DataFrame:
    return measures.dim_region(inp.customers())


@query
def core_totals(inp: Inputs) -> DataFrame:
    return measures.core_totals(inp.sales_star(), ["region", "category"])


@query
def gross_margin(inp: Inputs) -> DataFrame:
    table = measures.gross_margin(inp.sales_star(), ["region", "category"])
    return rounded(rounded(table, "gross_margin", digits=2), "gross_margin_pct")


@query
def revenue_py(inp: Inputs) -> DataFrame:
    return measures.revenue_py(inp.sales_star(), ["region"], CALENDAR)


@query
def revenue_yoy(inp: Inputs) -> DataFrame:
    return rounded(measures.revenue_yoy(inp.sales_star(), ["region"], CALENDAR), "revenue_yoy")


@query
def rolling_3m_revenue(inp: Inputs) -> DataFrame:
    return measures.rolling_revenue(inp.sales_star(), ["region"], CALENDAR)


@query
def h1_growth_factor(inp: Inputs) -> DataFrame:
    return rounded(measures.growth_factor(inp.sales_star(), ["region", "category"], SPEC.trend), "growth_factor")


@query
def revenue_gap_vs_trend(inp: Inputs) -> DataFrame:
    table = measures.gap_vs_trend(inp.sales_star(), ["region", "category"], CALENDAR, SPEC.trend)
    return rounded(table, "expected", "gap", digits=2)


@query
def forecast_measure(inp: Inputs) -> DataFrame:
    table = measures.forecast_measure(inp.sales_star(), ["region"], CALENDAR, SPEC.trend, SPEC.future)
    return rounded(table, "forecast", digits=2)


@query
def attainment_measure(inp: Inputs) -> DataFrame:
    return rounded(measures.attainment(inp.full_star(), ["rep_id", "month"]), "attainment")


@query
def attainment_status(inp: Inputs) -> DataFrame:
    share = F.col("attainment")
    return measures.attainment(inp.full_star(), ["rep_id"]).select(
        "rep_id",
        measures.attainment_status(share).alias("status"),
        measures.attainment_colour(share).alias("colour"),
    )


@query
def drill_across(inp: Inputs) -> DataFrame:
    return rounded(measures.drill_across(inp.full_star(), ["month", "region"]), "fill_rate")


@query
def revenue_py_by_quarter(inp: Inputs) -> DataFrame:
    return measures.revenue_py(inp.sales_star(), ["region"], CALENDAR, "quarter")


@query
def revenue_yoy_by_year(inp: Inputs) -> DataFrame:
    return rounded(measures.revenue_yoy(inp.sales_star(), ["region"], CALENDAR, "year"), "revenue_yoy")


@query
def revenue_yoy_total(inp: Inputs) -> DataFrame:
    return rounded(measures.revenue_yoy(inp.sales_star(), ["region"], CALENDAR, None), "revenue_yoy")


@query
def rolling_3m_by_quarter(inp: Inputs) -> DataFrame:
    return measures.rolling_revenue(inp.sales_star(), ["region"], CALENDAR, grain="quarter")


@query
def attainment_by_rep_region(inp: Inputs) -> DataFrame:
    return rounded(measures.attainment(inp.full_star(), ["region", "quarter"]), "attainment")


@query
def sales_of_rep_region(inp: Inputs) -> DataFrame:
    star = inp.full_star().of_rep_region("ASIA").of_channel("BUILDING")
    return measures.core_totals(star, ["region", "year"])


# ---- calendar filters and subtotals -----------------------------------------------


@query
def sales_every_q3(inp: Inputs) -> DataFrame:
    star = inp.full_star().in_calendar("quarter_no = 3")
    return measures.core_totals(star, ["region", "category", "year"])


@query
def facts_every_july(inp: Inputs) -> DataFrame:
    return rounded(measures.drill_across(inp.full_star().in_calendar("month_no = 7"), ["month", "region"]), "fill_rate")


@query
def weekend_attainment(inp: Inputs) -> DataFrame:
    star = inp.full_star().in_calendar("year = 2000").in_calendar("weekday > 5")
    return rounded(measures.attainment(star, ["region", "month"]), "attainment")


@query
def core_totals_subtotals(inp: Inputs) -> DataFrame:
    return measures.core_totals(inp.sales_star(), ["region", "category"], totals=True)


@query
def gross_margin_subtotals(inp: Inputs) -> DataFrame:
    table = measures.gross_margin(inp.sales_star(), ["region", "category"], totals=True)
    return rounded(rounded(table, "gross_margin", digits=2), "gross_margin_pct")


@query
def revenue_yoy_subtotals(inp: Inputs) -> DataFrame:
    table = measures.revenue_yoy(inp.sales_star(), ["region", "category"], CALENDAR, "quarter", totals=True)
    return rounded(table, "revenue_yoy")


@query
def rolling_3m_subtotals(inp: Inputs) -> DataFrame:
    return measures.rolling_revenue(inp.sales_star(), ["region", "category"], CALENDAR, totals=True)


@query
def revenue_gap_subtotals(inp: Inputs) -> DataFrame:
    table = measures.gap_vs_trend(inp.sales_star(), ["region", "category"], CALENDAR, SPEC.trend, "year", totals=True)
    return rounded(table, "expected", "gap", digits=2)


@query
def attainment_subtotals(inp: Inputs) -> DataFrame:
    return rounded(measures.attainment(inp.full_star(), ["region", "category"], totals=True), "attainment")


@query
def attainment_subtotals_by_rep(inp: Inputs) -> DataFrame:
    return rounded(measures.attainment(inp.full_star(), ["region", "rep_id", "year"], totals=True), "attainment")


# ---- data that keeps coming, long maps, long series -------------------------------


def _deliver(inp: Inputs) -> tuple[Store, MaintainedMedian, DataFrame, DataFrame]:
    """Sales in two deliveries, with the medians kept up to date: store, medians, first lines, changed groups."""
    stage = Staging(inp.spark)
    lines = _parsed_sales(inp, stage).select("order_id", "sku", "channel", "quantity")
    late = F.col("order_id").endswith("7")
    store = Store(inp.spark, _scratch(inp, "clean"))
    usual = MaintainedMedian("usual_quantity", ("sku", "channel"), "quantity")
    run = store.start()
    usual.add(run, lines.where(~late))
    run.publish()
    run = store.start()
    changes = usual.add(run, lines.where(late))
    run.publish()
    return store, usual, lines.where(~late), changes


@query
def median_after_delivery(inp: Inputs) -> DataFrame:
    store, usual, _, _ = _deliver(inp)
    return usual.medians(store)


@query
def repairs_after_delivery(inp: Inputs) -> DataFrame:
    """First lines whose repair is another since the second delivery."""
    _, _, lines, changes = _deliver(inp)
    return changed_repairs(lines, changes, ["sku", "channel"], "quantity")


@query
def duplicates_by_digest(inp: Inputs) -> DataFrame:
    stage = Staging(inp.spark)
    return dedupe.collapse_by_digest(stage(null_missing(inp.raw_sales()), "raw_sales"), stage=stage)


@query
def standardise_by_index(inp: Inputs) -> DataFrame:
    """The label of each part's name and number from a map of 20,000 keys."""
    parts = inp.table("part").select("p_partkey", F.concat_ws(" No ", "p_name", "p_partkey").alias("name"))
    return indexed_labels(parts, "name", LONG_LABELS, "label", stage=Staging(inp.spark))


@query
def interpolate_long_series(inp: Inputs) -> DataFrame:
    """Targets of all reps as one series, longer than one window should hold."""
    gappy = inp.gappy_targets().where("month_start is not null and rep_id is not null")
    series = gappy.select((F.col("rep_id") * 1000 + F.months_between("month_start", F.lit("1999-01-01").cast("date"))).cast("long").alias("place"), "target_amount")
    once = series.groupBy("place").agg(F.max("target_amount").alias("target_amount"))
    return rounded(interpolate_series(once, [], "place", "target_amount", Staging(inp.spark)), "target_amount")


@query
def daily_series(inp: Inputs) -> DataFrame:
    """Revenue per region and selling day, the one before, the one seven before, and the revenue up to then."""
    stage = Staging(inp.spark)
    days = inp.sales().groupBy("region", "order_date").agg(F.sum("revenue").alias("revenue"))
    days = lag_series(days, ["region"], "order_date", "revenue", {"day_before": 1, "week_before": 7}, stage)
    return running_series(days, ["region"], "order_date", {"so_far": "revenue"}, stage)
