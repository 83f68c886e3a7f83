"""Data-quality log: one row per rule that changed something.

Every table's rules are counted over its flagged rows: while these are written (:class:`Watch`), or in an aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# rule -> (issue, action); the rule is the stable code of a count made below.
PRODUCT_RULES = {"changed": ("columns not written in their standard form", "rewritten")}
_UNKNOWN = {"unknown_label": ("text in which no known label was found", "label left empty")}
CUSTOMER_RULES = {
    "changed": ("columns not written in their standard form", "rewritten"),
    **_UNKNOWN,
    "conflicting_rep": ("outlet listed with several reps", "the first in order is used"),
}
REP_RULES = {"changed": ("columns not written in their standard form", "rewritten"), **_UNKNOWN}
SALES_RULES = {
    "duplicates": ("row occurs again word for word", "one kept"),
    "undated": ("no date can be read", "left out of the fact"),
    "relabelled": ("label not written in its standard form", "rewritten"),
    **_UNKNOWN,
    "negative_quantity": ("quantity below zero", "taken without its sign"),
    "outlier": ("quantity out of proportion to its product and channel", "median instead, flagged"),
    "missing_quantity": ("no quantity", "median instead, flagged"),
    "missing_price": ("no price", "median of product and month instead"),
    "missing_discount": ("no discount", "none assumed"),
    "missing_rep": ("no rep", "rep of the outlet"),
}
TARGET_RULES = {"missing": ("no target amount", "laid on the line between the neighbouring months")}
DELIVERY_RULES = {
    "duplicates": ("row occurs again word for word", "one kept"),
    **_UNKNOWN,
    "token_qty_ordered": ("no quantity ordered", "left empty"),
    "token_qty_delivered": ("no quantity delivered", "left empty"),
    "token_stockout_days": ("no stock-out days", "left empty"),
}

#: Rows set aside before cleaning, of any table.
MALFORMED = {"malformed": ("row with more or fewer fields than the header", "set aside")}

RULES = {
    "products": PRODUCT_RULES,
    "customers": CUSTOMER_RULES,
    "sales_reps": REP_RULES,
    "sales": SALES_RULES,
    "targets": TARGET_RULES,
    "deliveries": DELIVERY_RULES,
}


def _copies_dropped() -> Column:
    return F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))


def _conflicts() -> Column:
    keys = F.struct("customer_id", "rep_id")
    pairs = F.count_distinct(F.when(F.col("customer_id").isNotNull() & F.col("rep_id").isNotNull(), keys))
    return pairs - F.count_distinct(F.when(F.col("rep_id").isNotNull(), F.col("customer_id")))


def _counts(table: str) -> dict[str, Column]:
    counts = {}
    for rule in RULES[table]:
        if rule == "duplicates":
            counts[rule] = _copies_dropped()
        elif rule == "conflicting_rep":
            counts[rule] = _conflicts()
        elif rule == "undated":
            counts[rule] = F.count_if(F.col("order_date").isNull())
        elif table == "sales":
            # Later rules see only the rows that kept a date.
            counts[rule] = F.count_if(F.col("order_date").isNotNull() & F.col(rule))
        else:
            counts[rule] = F.count_if(F.col(rule))
    return counts


def _table_rows(table: str) -> Column:
    if table == "sales":
        return F.count_if(F.col("order_date").isNotNull())
    return F.count(F.lit(1))


def table_log(table: str, flagged: DataFrame) -> DataFrame:
    """Log rows of one table, also those with a zero count."""
    counted = flagged.agg(
        _table_rows(table).alias("table_rows"), *[c.alias(rule) for rule, c in _counts(table).items()]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(issue).alias("issue"),
                F.col(rule).cast("long").alias("rows_affected"),
                F.lit(action).alias("action"),
            )
            for rule, (issue, action) in RULES[table].items()
        ]
    )
    return counted.select(F.lit(table).alias("table"), "table_rows", F.explode(entries).alias("e")).select(
        "table", "e.rule", "e.issue", "e.rows_affected", "e.action", "table_rows"
    )


def quality_log(flagged: Mapping[str, DataFrame]) -> DataFrame:
    """Log over flagged tables, keyed by the names in ``RULES``; only rules that fired."""
    logs = [table_log(table, flagged[table]) for table in RULES if table in flagged]
    return reduce(DataFrame.unionByName, logs).where("rows_affected > 0")


def quality_summary(flagged: Mapping[str, DataFrame]) -> DataFrame:
    """Rows before and after cleaning of the tables whose rows carry ``copies``."""
    parts = []
    for table, df in flagged.items():
        after = F.count_if(F.col("order_date").isNotNull()) if table == "sales" else F.count(F.lit(1))
        parts.append(
            df.agg(F.sum("copies").alias("rows_before"), after.alias("rows_after")).select(
                F.lit(table).alias("table"), "rows_before", "rows_after"
            )
        )
    return reduce(DataFrame.unionByName, parts)


class Watch:
    """Counts each table's rules while its flagged rows are written, without a scan of their own.

    ``watch(table, flagged)`` is the frame to write. The counts are taken in the stage that writes, where Spark counts a task
    once however often it is tried; so there must be no shuffle between the frame and its sink.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}
        self.more: dict[tuple[str, str], int] = {}

    def __call__(self, table: str, flagged: DataFrame) -> DataFrame:
        self._seen[table] = Observation()
        # Distinct values cannot be counted along the way.
        counts = {rule: c for rule, c in _counts(table).items() if rule != "conflicting_rep"}
        before = F.sum("copies") if "copies" in flagged.columns else F.count(F.lit(1))
        return flagged.observe(
            self._seen[table],
            F.coalesce(before, F.lit(0)).alias("rows_before"),
            _table_rows(table).alias("table_rows"),
            *[c.alias(rule) for rule, c in counts.items()],
        )

    def count(self, table: str, flagged: DataFrame) -> None:
        """Count a table that is written nowhere."""
        self(table, flagged).write.format("noop").mode("overwrite").save()

    def conflicts(self, customers: DataFrame) -> None:
        """Outlets with several reps, from the clean customers."""
        self.more["customers", "conflicting_rep"] = customers.agg(_conflicts()).first()[0]

    def rejects(self, rejected: DataFrame) -> None:
        """Rows set aside: a frame with the column ``table``."""
        for r in rejected.where(F.col("table").isin(list(RULES))).groupBy("table").count().collect():
            self.more[r["table"], "malformed"] = r["count"]

    def _got(self, table: str) -> dict[str, int]:
        return self._seen[table].get

    def log(self, spark: SparkSession) -> DataFrame:
        """The quality log of the tables written."""
        rows = []
        for table in (t for t in RULES if t in self._seen):
            got = self._got(table)
            for rule, (issue, action) in (MALFORMED | RULES[table]).items():
                affected = got.get(rule, self.more.get((table, rule), 0))
                if affected:
                    rows.append((table, rule, issue, affected, action, got["table_rows"]))
        return spark.createDataFrame(
            rows, "table string, rule string, issue string, rows_affected long, action string, table_rows long"
        )

    def summary(self, spark: SparkSession) -> DataFrame:
        """Rows of each table before and after cleaning; rows set aside count before."""
        rows = []
        for table in (t for t in RULES if t in self._seen):
            got = self._got(table)
            rows.append((table, got["rows_before"] + self.more.get((table, "malformed"), 0), got["table_rows"]))
        return spark.createDataFrame(rows, "table string, rows_before long, rows_after long")
