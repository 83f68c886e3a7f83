"""The given tables as retail tables (Spark side)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lens.functions.months import calendar_days
from retail_lens.functions.numbers import fill_rate, lead_time_days
from retail_lens.plans.model import Star
from workload import expressions as x
from workload.settings import YEARS


def _select(df: DataFrame, columns: dict[str, str], *more: str) -> DataFrame:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()], *more)


def _select_shared(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``_select`` that computes what the columns have in common once a row."""
    parts, columns = x.shared(columns)
    return _select(df.selectExpr("*", *[f"{part} AS {name}" for name, part in parts.items()]), columns)


class Inputs:
    """Frames over one data folder. Joins follow foreign keys; no strategy is forced."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _with_region(self, df: DataFrame, nation: str) -> DataFrame:
        # One table at a time, largest first: a join of joins is estimated as a product of
        # sizes, which would turn the large side into the broadcast one.
        return df.join(self.table("nation"), F.col(nation) == F.col("n_nationkey")).join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    def _orders(self) -> DataFrame:
        """Orders with their outlet."""
        with_customer = self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return self._with_region(with_customer, "c_nationkey").select(
            "o_orderkey", "o_orderdate", "c_custkey", "r_name", "c_mktsegment"
        )

    def _order_lines(self) -> DataFrame:
        """Lines with their order; whether it is small enough to be broadcast is left to Spark's threshold."""
        return self.table("lineitem").join(self._orders(), F.col("l_orderkey") == F.col("o_orderkey"))

    # ---- clean ----

    def lines(self) -> DataFrame:
        """Sales columns that need the line alone."""
        return _select(self.table("lineitem"), x.LINE)

    def sales(self) -> DataFrame:
        return _select(self._order_lines(), x.LINE | x.OUTLET)

    def products(self) -> DataFrame:
        return _select(self.table("part"), x.PRODUCT)

    def reps(self) -> DataFrame:
        return _select(self._with_region(self.table("supplier"), "s_nationkey"), x.REP)

    def customers(self) -> DataFrame:
        return _select(
            self._with_region(self.table("customer"), "c_nationkey"), {"customer_id": "c_custkey"} | x.OUTLET
        )

    def _rep_months(self) -> DataFrame:
        months = F.explode(F.sequence(F.lit(0), F.lit(x.TARGET_MONTHS - 1))).alias("idx")
        return self.table("supplier").select("s_suppkey", months).withColumn(
            "month_start", F.add_months(F.lit("1999-01-01").cast("date"), F.col("idx"))
        )

    def targets(self) -> DataFrame:
        """Targets of every rep and month."""
        return _select(self._rep_months(), {"rep_id": "s_suppkey", "target_amount": x.TARGET}, "month_start")

    def gappy_targets(self) -> DataFrame:
        amount = f"CASE WHEN {x.TARGET_GAP} THEN NULL ELSE CAST({x.TARGET} AS DOUBLE) END"
        rep = f"CASE WHEN {x.TARGET_NOBODY} THEN NULL ELSE s_suppkey END"
        month = (
            f"CASE WHEN {x.TARGET_UNDATED} THEN NULL WHEN {x.TARGET_AGAIN} THEN add_months(month_start, -1)"
            " ELSE month_start END"
        )
        return _select(self._rep_months(), {"rep_id": rep, "target_amount": amount, "month_start": month})

    def dated_deliveries(self) -> DataFrame:
        """Deliveries without a region."""
        joined = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return self._measured(_select(joined, x.DELIVERY))

    def deliveries(self) -> DataFrame:
        return self._measured(_select(self._order_lines(), x.DELIVERY | {"region": "r_name"}))

    @staticmethod
    def _measured(deliveries: DataFrame) -> DataFrame:
        return deliveries.withColumns(
            {
                "lead_time_days": lead_time_days(F.col("order_date"), F.col("delivery_date")),
                "fill_rate": fill_rate(F.col("qty_delivered"), F.col("qty_ordered")),
            }
        )

    def sales_star(self) -> Star:
        return Star(sales=self.sales(), products=self.products())

    def full_star(self) -> Star:
        return replace(
            self.sales_star(),
            deliveries=self.deliveries(),
            targets=self.targets(),
            reps=self.reps(),
            customers=self.customers(),
            calendar=calendar_days(self.spark, YEARS),
        )

    # ---- untidy ----

    def raw_lines(self) -> DataFrame:
        return _select_shared(self.table("lineitem"), {"line_no": "l_linenumber"} | x.line_texts("spark"))

    def raw_sales(self) -> DataFrame:
        return self._copied(self._order_lines(), x.sales_texts("spark"), x.SALES_COPIED)

    def raw_deliveries(self) -> DataFrame:
        return self._copied(self._order_lines(), x.delivery_texts("spark"), x.DELIVERIES_COPIED)

    @staticmethod
    def _copied(df: DataFrame, columns: dict[str, str], twice: str) -> DataFrame:
        """Rows that satisfy ``twice`` occur two times; the source is read once for both."""
        copies = f"explode(CASE WHEN {twice} THEN array(1, 2) ELSE array(1) END)"
        return _select_shared(df, columns | {"copy": copies}).drop("copy")

    def raw_targets(self) -> DataFrame:
        return _select(self._rep_months(), x.target_texts("spark"))

    def raw_products(self) -> DataFrame:
        return _select(self.table("part"), x.product_texts())

    def raw_customers(self) -> DataFrame:
        return _select(self._with_region(self.table("customer"), "c_nationkey"), x.customer_texts())

    def raw_reps(self) -> DataFrame:
        return _select(self._with_region(self.table("supplier"), "s_nationkey"), x.rep_texts("spark"))
