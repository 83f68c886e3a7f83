"""Raw text tables to the typed star schema."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lens.functions.months import month_start
from retail_lens.functions.numbers import fill_rate, lead_time_days, line_revenue
from retail_lens.functions.text import (
    match_label,
    normalise_key,
    null_missing,
    parse_dates,
    parse_month_start,
    title_case,
    to_number,
)
from retail_lens.operators.dedupe import collapse_by_digest, collapse_copies
from retail_lens.operators.interpolate import interpolate
from retail_lens.operators.labels import with_label
from retail_lens.operators.medians import group_median
from retail_lens.operators.repair import (
    is_outlier,
    lookup_fill,
    quantity_flag,
    repair_quantity,
    repair_sign,
)
from retail_lens.session import Staging, unstaged
from retail_lens.sources.schemas import CLEAN

Stage = Callable[[DataFrame, str], DataFrame]

# Text looked for -> standard label. The last key found wins.
REGION_LABELS = {
    "accra": "Greater Accra",
    "ashanti": "Ashanti",
    "western": "Western",
    "eastern": "Eastern",
    "northern": "Northern",
    "volta": "Volta",
}
CHANNEL_LABELS = {
    "supermarket": "Supermarket",
    "retail": "Retail Shop",
    "kiosk": "Kiosk",
    "wholesale": "Wholesale",
}


@dataclass(frozen=True)
class CleaningRules:
    """What cleaning depends on apart from the data."""

    regions: Mapping[str, str] = field(default_factory=lambda: REGION_LABELS)
    channels: Mapping[str, str] = field(default_factory=lambda: CHANNEL_LABELS)
    outlier_factor: float = 10.0

    def region(self, col: Column) -> Column:
        return match_label(col, self.regions)

    def channel(self, col: Column) -> Column:
        return match_label(col, self.channels, squeeze=True)

    def labelled(
        self, df: DataFrame, stage: Stage = unstaged, region: str | None = None, channel: str | None = None
    ) -> DataFrame:
        """Add ``_region`` and ``_channel``, the labels of the columns named, however long the maps are."""
        if region:
            df = with_label(df, region, self.regions, "_region", stage=stage)
        if channel:
            df = with_label(df, channel, self.channels, "_channel", squeeze=True, stage=stage)
        return df

    @classmethod
    def from_json(cls, spark: SparkSession, path: str) -> CleaningRules:
        """Rules with the label maps of a JSON file, wherever Spark can read it; a map left out keeps its default."""
        maps = json.loads(spark.read.text(path, wholetext=True).first()["value"])
        return cls(**{name: maps[name] for name in ("regions", "channels") if name in maps})


def _differs(clean: Column, raw: str) -> Column:
    return ~clean.cast("string").eqNullSafe(F.col(raw))


def _unknown(label: Column, raw: str) -> Column:
    """A text that no label was found in."""
    return label.isNull() & F.col(raw).isNotNull()


def flag_products(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Clean product columns and ``changed``: whether any of them differs from its text."""
    raw = null_missing(raw)
    sku, category = normalise_key(F.col("sku")), title_case(F.col("category"))
    price_is_text = F.col("list_price").cast("string").rlike(r"[^0-9.\-]")
    changed = _differs(sku, "sku") | _differs(category, "category") | F.coalesce(price_is_text, F.lit(False))
    return raw.select(
        sku.alias("sku"),
        "product_name",
        category.alias("category"),
        to_number(F.col("list_price")).alias("list_price"),
        F.col("unit_cost").try_cast("double").alias("unit_cost"),
        F.col("pack_size").try_cast("int").alias("pack_size"),
        changed.alias("changed"),
    )


def flag_customers(
    raw: DataFrame, rules: CleaningRules = CleaningRules(), stage: Stage = unstaged
) -> DataFrame:
    raw = rules.labelled(null_missing(raw), stage, region="region", channel="channel")
    key, name = normalise_key(F.col("customer_id")), title_case(F.col("outlet_name"))
    region, channel = F.col("_region"), F.col("_channel")
    changed = (
        _differs(key, "customer_id")
        | _differs(name, "outlet_name")
        | _differs(region, "region")
        | _differs(channel, "channel")
    )
    return raw.select(
        key.alias("customer_id"),
        name.alias("outlet_name"),
        region.alias("region"),
        channel.alias("channel"),
        "rep_id",
        changed.alias("changed"),
        (_unknown(region, "region") | _unknown(channel, "channel")).alias("unknown_label"),
    )


def flag_reps(raw: DataFrame, rules: CleaningRules = CleaningRules(), stage: Stage = unstaged) -> DataFrame:
    raw = rules.labelled(null_missing(raw), stage, region="region")
    name, region = title_case(F.col("rep_name")), F.col("_region")
    hired = parse_dates(F.col("hire_date"))
    changed = _differs(name, "rep_name") | _differs(region, "region") | _differs(hired, "hire_date")
    return raw.select(
        "rep_id",
        name.alias("rep_name"),
        region.alias("region"),
        hired.alias("hire_date"),
        changed.alias("changed"),
        _unknown(region, "region").alias("unknown_label"),
    )


def clean_products(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return flag_products(raw, rules).drop("changed")


def clean_customers(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return flag_customers(raw, rules).drop("changed", "unknown_label")


def clean_reps(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return flag_reps(raw, rules).drop("changed", "unknown_label")


def _distinct(raw: DataFrame, stage: Stage, stored: bool) -> DataFrame:
    """Distinct rows with ``copies``; of a stored table, in which missing texts are null already, by their digests."""
    return collapse_by_digest(raw, stage=stage) if stored else collapse_copies(null_missing(raw), recurring=False)


def parse_sales(
    raw: DataFrame, rules: CleaningRules = CleaningRules(), stage: Stage = unstaged, stored: bool = False
) -> DataFrame:
    """Distinct raw sales lines with typed columns and ``copies``; nothing is repaired yet.

    ``stored`` says that ``raw`` is a table written by ``read_raw``, cheap to read several times.
    """
    raw = rules.labelled(_distinct(raw, stage, stored), stage, region="outlet_region", channel="channel")
    region, channel = F.col("_region"), F.col("_channel")
    return raw.select(
        "order_id",
        parse_dates(F.col("order_date")).alias("order_date"),
        normalise_key(F.col("customer_id")).alias("customer_id"),
        channel.alias("channel"),
        normalise_key(F.col("sku")).alias("sku"),
        to_number(F.col("quantity")).alias("signed_quantity"),
        to_number(F.col("unit_price")).alias("unit_price"),
        to_number(F.col("discount_pct")).alias("discount_pct"),
        "sales_rep_id",
        region.alias("region"),
        (_differs(region, "outlet_region") | _differs(channel, "channel")).alias("relabelled"),
        (_unknown(region, "outlet_region") | _unknown(channel, "channel")).alias("unknown_label"),
        "copies",
    )


def mark_sales(
    raw: DataFrame, rules: CleaningRules = CleaningRules(), stage: Stage = unstaged, stored: bool = False
) -> DataFrame:
    """Sales lines with repaired quantity and one mark per rule; undated lines are still present.

    Prices and reps are not filled yet: no mark depends on that. With a real ``stage`` the
    de-duplicated lines are shuffled and written once, and the medians come back as a scan
    of known size. Lines without a date, product or channel have no median and go past the join.
    """
    parsed = stage(parse_sales(raw, rules, stage, stored), "sales_parsed").withColumns(
        {"quantity": repair_sign(F.col("signed_quantity")), "month": month_start(F.col("order_date"))}
    )
    dated = parsed.where(F.col("order_date").isNotNull())
    usual_quantity = stage(group_median(dated, ["sku", "channel"], "quantity", "usual_quantity"), "quantity")
    quantity, usual = F.col("quantity"), F.col("usual_quantity")
    factor = rules.outlier_factor
    return _join_known(parsed, usual_quantity, ["sku", "channel"]).withColumns(
        {
            "negative_quantity": F.col("signed_quantity") < 0,
            "outlier": is_outlier(quantity, usual, factor),
            "missing_quantity": quantity.isNull(),
            "missing_price": F.col("unit_price").isNull(),
            "missing_discount": F.col("discount_pct").isNull(),
            "missing_rep": F.col("sales_rep_id").isNull(),
            "qty_flag": quantity_flag(quantity, usual, factor),
            "quantity": repair_quantity(quantity, usual, factor),
            "discount_pct": F.coalesce("discount_pct", F.lit(0.0)),
        }
    ).drop("signed_quantity", "usual_quantity")


def _join_known(df: DataFrame, found: DataFrame, keys: list[str], wanted: Column | None = None) -> DataFrame:
    """Left join of the rows with all keys (and that are ``wanted``); the others are added unshuffled."""
    test = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    test = test if wanted is None else test & wanted
    added = {f.name: F.lit(None).cast(f.dataType) for f in found.schema.fields if f.name not in keys}
    return df.where(test).join(found, keys, "left").unionByName(df.where(~test).withColumns(added))


def repair_sales(marked: DataFrame, customers: DataFrame, stage: Stage = unstaged) -> DataFrame:
    """Marked lines with missing prices and reps filled and the revenue; only lines that lack something are joined."""
    dated = marked.where(F.col("order_date").isNotNull())
    usual_price = stage(group_median(dated, ["sku", "month"], "unit_price", "usual_price"), "price")
    priced = _join_known(marked, usual_price, ["sku", "month"], F.col("unit_price").isNull())
    priced = priced.withColumn("unit_price", F.coalesce("unit_price", "usual_price"))
    priced = priced.withColumn("revenue", line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount_pct")))
    return lookup_fill(priced.drop("usual_price", "month"), "sales_rep_id", customers, "customer_id", "rep_id", stage)


def flag_sales(
    raw: DataFrame,
    customers: DataFrame,
    rules: CleaningRules = CleaningRules(),
    stage: Stage = unstaged,
) -> DataFrame:
    """Repaired sales lines with one mark per rule; undated lines are still present."""
    return repair_sales(stage(mark_sales(raw, rules, stage), "sales_marked"), customers, stage)


def finish_sales(flagged: DataFrame) -> DataFrame:
    """Clean sales fact from flagged lines."""
    return flagged.where(F.col("order_date").isNotNull()).select(*CLEAN["fact_sales"].names)


def clean_sales(
    raw: DataFrame,
    customers: DataFrame,
    rules: CleaningRules = CleaningRules(),
    stage: Stage | None = None,
) -> DataFrame:
    """Sales fact: de-duplicated, dated, labelled, repaired, with revenue per line.

    ``customers`` is the clean customer master, which names the rep of an outlet. Intermediate
    results are staged in the shared folder; ``unstaged`` keeps one lazy plan, which computes them several times.
    """
    return finish_sales(flag_sales(raw, customers, rules, stage or Staging(raw.sparkSession)))


def sort_sales(sales: DataFrame) -> DataFrame:
    """Total order by date and order id; the other columns settle ties and spread a hot pair."""
    lead = ["order_date", "order_id"]
    return sales.orderBy(*lead, *[name for name in sales.columns if name not in lead])


def parse_targets(raw: DataFrame) -> DataFrame:
    """Typed targets with gaps and ``missing``."""
    raw = null_missing(raw)
    amount = to_number(F.col("target_amount"))
    return raw.select(
        "rep_id",
        amount.alias("target_amount"),
        parse_month_start(F.col("month")).alias("month_start"),
        amount.isNull().alias("missing"),
    )


def fill_targets(parsed: DataFrame) -> DataFrame:
    """One amount per rep and month; gaps are interpolated between the rep's other months."""
    return interpolate(parsed.drop("missing"), ["rep_id"], "month_start", "target_amount")


def clean_targets(raw: DataFrame) -> DataFrame:
    return fill_targets(parse_targets(raw))


def sort_targets(targets: DataFrame) -> DataFrame:
    """Total order by rep and month."""
    return targets.orderBy("rep_id", "month_start", "target_amount")


def flag_deliveries(
    raw: DataFrame, rules: CleaningRules = CleaningRules(), stage: Stage = unstaged, stored: bool = False
) -> DataFrame:
    """Clean delivery columns, ``copies``, and per measure whether it is missing or its text says so."""
    region = F.col("_region")
    ordered, delivered = to_number(F.col("qty_ordered")), to_number(F.col("qty_delivered"))
    placed, arrived = parse_dates(F.col("order_date")), parse_dates(F.col("delivery_date"))
    measures = ["qty_ordered", "qty_delivered", "stockout_days"]
    return rules.labelled(_distinct(raw, stage, stored), stage, region="region").select(
        "delivery_id",
        normalise_key(F.col("sku")).alias("sku"),
        region.alias("region"),
        placed.alias("order_date"),
        arrived.alias("delivery_date"),
        ordered.alias("qty_ordered"),
        delivered.alias("qty_delivered"),
        to_number(F.col("stockout_days")).alias("stockout_days"),
        lead_time_days(placed, arrived).alias("lead_time_days"),
        fill_rate(delivered, ordered).alias("fill_rate"),
        "copies",
        _unknown(region, "region").alias("unknown_label"),
        *[F.col(name).isNull().alias(f"token_{name}") for name in measures],
    )


def finish_deliveries(flagged: DataFrame) -> DataFrame:
    """Clean deliveries fact from flagged rows."""
    return flagged.select(*CLEAN["fact_deliveries"].names)


def clean_deliveries(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return finish_deliveries(flag_deliveries(raw, rules))
