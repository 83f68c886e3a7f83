"""Star schema and the aggregations every report starts from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.functions.months import Period, during, month_start, on_days


@dataclass(frozen=True)
class Focus:
    """A region and category under scrutiny."""

    region: str
    category: str

    def holds(self) -> Column:
        """True or false, never null, so that its negation keeps rows with null keys."""
        both = (F.col("region") == self.region) & (F.col("category") == self.category)
        return F.coalesce(both, F.lit(False))


@dataclass(frozen=True)
class Star:
    """Facts and dimensions. Filters run from dimensions to facts, never between facts."""

    sales: DataFrame
    products: DataFrame
    deliveries: DataFrame | None = None
    targets: DataFrame | None = None
    reps: DataFrame | None = None
    customers: DataFrame | None = None
    calendar: DataFrame | None = None

    def in_calendar(self, condition: Column | str) -> Star:
        """Filter by any column of the calendar (``"quarter_no = 3"``, ``"weekday > 5"``), carried to all three facts.

        Sales and deliveries are kept by their day, targets by the first day of their month, which is the day they
        are dated. The calendar itself is filtered as well, so filters add up.
        """
        if self.calendar is None:
            raise ValueError("this star has no calendar; see months.calendar_days")
        days = self.calendar.where(condition)
        return replace(
            self,
            calendar=days,
            sales=on_days(self.sales, days),
            deliveries=self.deliveries and on_days(self.deliveries, days),
            targets=self.targets and on_days(self.targets, days, "month_start"),
        )

    def in_period(self, period: Period) -> Star:
        """Calendar filter on all three facts."""
        return replace(
            self,
            sales=during(self.sales, [period]),
            deliveries=self.deliveries and during(self.deliveries, [period]),
            targets=self.targets and during(self.targets, [period], "month_start"),
        )

    def in_region(self, region: str) -> Star:
        """Outlet region: reaches sales and deliveries; targets belong to reps and stay whole."""
        test = F.col("region") == region
        return replace(
            self, sales=self.sales.where(test), deliveries=self.deliveries and self.deliveries.where(test)
        )

    def in_category(self, category: str) -> Star:
        """Product filter, carried to sales and deliveries as a semi-join on the product key."""
        products = self.products.where(F.col("category") == category)
        return replace(
            self,
            products=products,
            sales=keep_products(self.sales, products),
            deliveries=self.deliveries and keep_products(self.deliveries, products),
        )

    def of_rep_region(self, region: str) -> Star:
        """Region of the rep: reaches sales and targets, which both carry the rep; deliveries stay whole."""
        reps = self.reps.where(F.col("region") == region)
        ids = reps.select(F.col("rep_id").alias("sales_rep_id"))
        return replace(
            self,
            reps=reps,
            sales=self.sales.join(ids, "sales_rep_id", "left_semi"),
            targets=self.targets and self.targets.join(reps.select("rep_id"), "rep_id", "left_semi"),
        )

    def of_channel(self, channel: str) -> Star:
        """Outlet filter: reaches sales by the customer key."""
        customers = self.customers.where(F.col("channel") == channel)
        keys = customers.select("customer_id")
        return replace(self, customers=customers, sales=self.sales.join(keys, "customer_id", "left_semi"))


def keep_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    return fact.join(products.select("sku"), "sku", "left_semi")


def monthly_facts(sales: DataFrame) -> DataFrame:
    """Sales summed to region, product, rep and month, in the columns of a sales fact.

    Every report over whole months gives the same figures from this frame as from the
    lines, so a run of many reports needs to read the lines only once.
    """
    keys = ["region", "sku", "sales_rep_id"]
    return sales.groupBy(*keys, month_start(F.col("order_date")).alias("order_date")).agg(
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue")
    )


def star_join(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Fact rows with their product's attributes; rows of unknown products are dropped."""
    return fact.join(products, "sku")


def sums_by(
    fact: DataFrame, by: Sequence[str], sums: Mapping[str, Column], products: DataFrame | None = None
) -> DataFrame:
    """Sums of ``sums`` per ``by``, which may name product attributes if ``products`` is given.

    Rows are summed per product before they meet the product table, so the join sees a
    product once per remaining key whatever share of the rows it holds, and attributes
    are attached to totals rather than to every row.
    """
    attributes = [c for c in by if products is not None and c in products.columns and c not in fact.columns]
    keys = [c for c in by if c not in attributes]
    if products is None:
        return fact.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    # The product table filters even when none of its attributes is asked for.
    inner = [c for c in keys if c != "sku"]
    partial = fact.groupBy(*inner, "sku").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    named = partial.join(products.select("sku", *attributes), "sku")
    return named.groupBy(*by).agg(*[F.sum(n).alias(n) for n in sums])


def period_sums(
    fact: DataFrame,
    by: Sequence[str],
    periods: Mapping[str, Period],
    products: DataFrame | None = None,
    value: str = "revenue",
    day: str = "order_date",
) -> DataFrame:
    """One column per period with the sum of ``value`` in it, all in one pass."""
    sums = {name: F.when(p.holds(F.col(day)), F.col(value)) for name, p in periods.items()}
    return sums_by(fact, by, sums, products)


def monthly(
    sales: DataFrame, by: Sequence[str], products: DataFrame | None = None, day: str = "order_date"
) -> DataFrame:
    """revenue and units per ``by`` and month."""
    dated = sales.withColumn("month", month_start(F.col(day)))
    return sums_by(dated, [*by, "month"], {"revenue": F.col("revenue"), "units": F.col("quantity")}, products)
