"""Safety stock and reorder points for the products of a focus group."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.functions.months import Period, during
from retail_lens.functions.numbers import round_even, round_up
from retail_lens.plans.model import Focus, keep_products, monthly

# Normal quantile of a 95 % service level, days per month.
SERVICE_FACTOR = 1.65
DAYS_PER_MONTH = 30.0


def _monthly_units(sales: DataFrame, products: DataFrame, focus: Focus, window: Period) -> DataFrame:
    """Units per product and month; a month without a sale has no row."""
    inside = during(sales, [window]).where(F.col("region") == focus.region)
    # Summed before the product filter: the semi-join then meets a product once a month.
    units = monthly(inside, ["sku"])
    return keep_products(units, products.where(F.col("category") == focus.category))


def demand_stats(sales: DataFrame, products: DataFrame, focus: Focus, window: Period) -> DataFrame:
    """Mean and sample standard deviation of monthly units per product."""
    return (
        _monthly_units(sales, products, focus, window)
        .groupBy("sku")
        .agg(
            round_even(F.avg("units"), 1).alias("avg_monthly_units"),
            round_even(F.stddev_samp("units"), 1).alias("sd_monthly_units"),
        )
    )


def lead_time_stats(deliveries: DataFrame, region: str, since: date) -> DataFrame:
    """Mean and sample standard deviation of lead times per product, before and from a date on."""
    late = F.col("order_date") >= F.lit(since)
    early = F.col("order_date") < F.lit(since)
    days = F.col("lead_time_days")
    return (
        deliveries.where(F.col("region") == region)
        .groupBy("sku")
        .agg(
            F.avg(F.when(early, days)).alias("lead_days_normal"),
            F.stddev_samp(F.when(early, days)).alias("sd_lead_normal"),
            F.avg(F.when(late, days)).alias("lead_days_now"),
            F.stddev_samp(F.when(late, days)).alias("sd_lead_now"),
        )
    )


def safety_stock(lead: Column, sd_lead: Column, demand: Column, sd_demand: Column, z: float = SERVICE_FACTOR) -> Column:
    """z * sqrt(lead/30 * sd_demand^2 + (demand/30)^2 * sd_lead^2), demand being monthly."""
    month = F.lit(DAYS_PER_MONTH)
    variance = lead / month * F.pow(sd_demand, F.lit(2.0)) + F.pow(demand / month, F.lit(2.0)) * F.pow(sd_lead, F.lit(2.0))
    return F.lit(z) * F.sqrt(variance)


def stock_plan(
    sales: DataFrame,
    deliveries: DataFrame,
    products: DataFrame,
    focus: Focus,
    window: Period,
    since: date,
    z: float = SERVICE_FACTOR,
) -> DataFrame:
    """Safety stock at normal and at present lead times, and the present reorder point.

    Demand enters as rounded, lead times unrounded.
    """
    plan = demand_stats(sales, products, focus, window).join(
        lead_time_stats(deliveries, focus.region, since), "sku", "left"
    )
    demand, sd_demand = F.col("avg_monthly_units"), F.col("sd_monthly_units")

    def stock(when: str) -> Column:
        return round_even(safety_stock(F.col(f"lead_days_{when}"), F.col(f"sd_lead_{when}"), demand, sd_demand, z))

    reorder = demand / F.lit(DAYS_PER_MONTH) * F.col("lead_days_now") + stock("now")
    return plan.select(
        "sku",
        demand,
        sd_demand,
        round_even(F.col("lead_days_normal"), 1).alias("lead_days_normal"),
        round_even(F.col("lead_days_now"), 1).alias("lead_days_now"),
        stock("normal").alias("safety_stock_normal"),
        stock("now").alias("safety_stock_now"),
        round_even(reorder).alias("reorder_point_now"),
    ).orderBy("sku")


def stock_inputs(
    sales: DataFrame, deliveries: DataFrame, products: DataFrame, focus: Focus, window: Period, since: date
) -> DataFrame:
    """Demand mean and population variance, lead times, and demand during the present lead time."""
    demand = (
        _monthly_units(sales, products, focus, window)
        .groupBy("sku")
        .agg(F.avg("units").alias("mean"), F.var_pop("units").alias("variance"))
    )
    lead = lead_time_stats(deliveries, focus.region, since)
    return (
        demand.join(lead, "sku")
        .select(
            "sku",
            round_up(F.col("mean")).alias("avg_monthly_units"),
            round_up(F.col("variance")).alias("var_monthly_units"),
            round_up(F.col("lead_days_normal"), 1).alias("lead_days_normal"),
            round_up(F.col("lead_days_now"), 1).alias("lead_days_now"),
            round_up(F.col("mean") / F.lit(DAYS_PER_MONTH) * F.col("lead_days_now")).alias("demand_during_lead_time"),
        )
        .orderBy("sku")
    )
