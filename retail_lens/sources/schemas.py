"""Explicit schemas. Raw tables are text throughout; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

TEXT, NUMBER, DAY, COUNT, MONEY = StringType(), DoubleType(), DateType(), IntegerType(), DecimalType(18, 2)


def schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


def text_schema(*names: str) -> StructType:
    return schema(**dict.fromkeys(names, TEXT))


# Names and order of the columns of the raw files and the clean tables.
RAW = {
    "sales_transactions_raw": text_schema(
        "order_id",
        "order_date",
        "customer_id",
        "outlet_region",
        "channel",
        "sku",
        "quantity",
        "unit_price",
        "discount_pct",
        "sales_rep_id",
    ),
    "products_raw": text_schema("sku", "product_name", "category", "list_price", "unit_cost", "pack_size"),
    "customers_raw": text_schema("customer_id", "outlet_name", "region", "channel", "rep_id"),
    "sales_reps_raw": text_schema("rep_id", "rep_name", "region", "hire_date"),
    "sales_targets_raw": text_schema("rep_id", "month", "target_amount"),
    "deliveries_raw": text_schema(
        "delivery_id",
        "sku",
        "region",
        "order_date",
        "delivery_date",
        "qty_ordered",
        "qty_delivered",
        "stockout_days",
    ),
}

CLEAN = {
    "fact_sales": schema(
        order_id=TEXT,
        order_date=DAY,
        customer_id=TEXT,
        channel=TEXT,
        sku=TEXT,
        quantity=NUMBER,
        unit_price=NUMBER,
        discount_pct=NUMBER,
        sales_rep_id=TEXT,
        region=TEXT,
        qty_flag=TEXT,
        revenue=MONEY,
    ),
    "fact_deliveries": schema(
        delivery_id=TEXT,
        sku=TEXT,
        region=TEXT,
        order_date=DAY,
        delivery_date=DAY,
        qty_ordered=NUMBER,
        qty_delivered=NUMBER,
        stockout_days=NUMBER,
        lead_time_days=COUNT,
        fill_rate=NUMBER,
    ),
    "fact_targets": schema(rep_id=TEXT, target_amount=NUMBER, month_start=DAY),
    "dim_products": schema(
        sku=TEXT, product_name=TEXT, category=TEXT, list_price=NUMBER, unit_cost=NUMBER, pack_size=COUNT
    ),
    "dim_customers": schema(customer_id=TEXT, outlet_name=TEXT, region=TEXT, channel=TEXT, rep_id=TEXT),
    "dim_reps": schema(rep_id=TEXT, rep_name=TEXT, region=TEXT, hire_date=DAY),
}

QUALITY_LOG = "data_quality_log"
