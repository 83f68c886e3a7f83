"""Column expressions that turn the given tables into retail tables, clean and untidy.

They are plain SQL text that Spark and the checking engine both read; only the date and
number formats differ, so those are asked from a small dialect table.
"""

from __future__ import annotations

DIALECTS = {
    "spark": {
        "iso": "date_format({d}, 'yyyy-MM-dd')",
        "slash": "date_format({d}, 'dd/MM/yyyy')",
        "words": "date_format({d}, 'MMM dd, yyyy')",
        "short": "date_format({d}, 'dd-MMM-yy')",
        "month_word": "date_format({d}, 'MMM-yyyy')",
        "month_iso": "date_format({d}, 'yyyy-MM')",
        "thousands": "format_number({x}, 0)",
    },
    "duckdb": {
        "iso": "strftime({d}, '%Y-%m-%d')",
        "slash": "strftime({d}, '%d/%m/%Y')",
        "words": "strftime({d}, '%b %d, %Y')",
        "short": "strftime({d}, '%d-%b-%y')",
        "month_word": "strftime({d}, '%b-%Y')",
        "month_iso": "strftime({d}, '%Y-%m')",
        "thousands": "format('{{:,}}', {x})",
    },
}

# ---- clean tables -----------------------------------------------------------------

LINE = {
    "order_id": "l_orderkey",
    "line_no": "l_linenumber",
    "order_date": "CAST(l_shipdate AS DATE)",
    "sku": "l_partkey",
    "quantity": "l_quantity",
    "discount_pct": "CAST(ROUND(l_discount * 100) AS INT)",
    "sales_rep_id": "l_suppkey",
    "revenue": "CAST(CAST(l_extendedprice AS DECIMAL(18,2))"
    " * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))",
}
OUTLET = {"customer_id": "c_custkey", "region": "r_name", "channel": "c_mktsegment"}

PRODUCT = {
    "sku": "p_partkey",
    "product_name": "p_name",
    "category": "p_type",
    "list_price": "CAST(p_retailprice AS DECIMAL(18,2))",
    "unit_cost": "CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.70 AS DECIMAL(14,4))",
}
REP = {"rep_id": "s_suppkey", "rep_name": "s_name", "region": "r_name"}

LEAD_DAYS = "CAST((l_orderkey + l_linenumber * 3) % 12 + 1 AS INT)"
ORDERED_ON = "CAST(o_orderdate AS DATE)"
DELIVERED_QTY = (
    "CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE FLOOR(l_quantity * (80 + l_partkey % 20) / 100) END"
)
STOCKOUT_DAYS = (
    "CASE WHEN l_orderkey % 59 = 0 THEN NULL ELSE CAST((l_partkey + l_linenumber) % 8 AS DOUBLE) END"
)
DELIVERY = {
    "order_id": "l_orderkey",
    "line_no": "l_linenumber",
    "sku": "l_partkey",
    "order_date": ORDERED_ON,
    "delivery_date": f"{ORDERED_ON} + {LEAD_DAYS}",
    "qty_ordered": "l_quantity",
    "qty_delivered": f"CAST({DELIVERED_QTY} AS DOUBLE)",
    "stockout_days": STOCKOUT_DAYS,
}

TARGET_MONTHS = 24
TARGET = "CAST(300000 + (s_suppkey * 7919 + idx * 104729) % 140000 AS BIGINT)"
TARGET_GAP = "(s_suppkey * 31 + idx) % 61 = 0"
#: Targets without a rep, without a month, and with the month of the target before.
TARGET_NOBODY = "(s_suppkey + idx * 5) % 83 = 7"
TARGET_UNDATED = "(s_suppkey * 3 + idx) % 71 = 9"
TARGET_AGAIN = "(s_suppkey + idx * 11) % 67 = 3"

# ---- untidy tables ----------------------------------------------------------------


#: Numbers that ``picked`` selects by, and other parts that texts spell out several times. None of them can fail for a row.
_PARTS: set[str] = {"CAST(l_shipdate AS DATE)"}


def picked(key: str, salt: int, first: int, count: int) -> str:
    """A scattered selection of ``count`` in a thousand keys; equal salts with disjoint ranges do not overlap."""
    spread = f"((CAST({key} AS BIGINT) * 2654435761 + {salt * 40503}) % 4294967296)"
    # Whole numbers throughout: a division by 65536.0 is one of decimals, by far the dearest part of these texts.
    draw = f"({spread} >> 16) % 1000"
    _PARTS.add(draw)
    return f"{draw} BETWEEN {first} AND {first + count - 1}"


def shared(columns: dict[str, str]) -> tuple[dict[str, str], dict[str, str]]:
    """The parts that ``columns`` have in common, each under a name, and the columns with these names in their place.

    A column spells the number it selects by out once per range. So written, the texts of one table fill a method that the
    JVM does not compile.
    """
    parts = {f"_part{i}": part for i, part in enumerate(sorted(_PARTS)) if any(part in text for text in columns.values())}
    for name, part in parts.items():
        columns = {column: text.replace(part, name) for column, text in columns.items()}
    return parts, columns


_K = "(l_orderkey * 8 + l_linenumber)"
_Q = "CAST(CAST(l_quantity AS INT) AS STRING)"
_Q100 = "CAST(CAST(l_quantity AS INT) * 100 AS STRING)"
_CENTS = "CAST(FLOOR(CAST(ROUND(l_extendedprice * 100) AS BIGINT) / CAST(l_quantity AS INT)) AS BIGINT)"
_D = "CAST(CAST(ROUND(l_discount * 100) AS INT) AS STRING)"
_SKU = "'SKU' || lpad(CAST(l_partkey % 12 + 1 AS STRING), 3, '0')"
_PARTS.add(_SKU)


def _cents_text(cents: str) -> str:
    return (
        f"CAST(CAST(FLOOR(({cents}) / 100) AS BIGINT) AS STRING) || '.' ||"
        f" lpad(CAST(({cents}) % 100 AS STRING), 2, '0')"
    )


def untidy_date(day: str, key: str, dialect: str) -> str:
    fmt = {name: text.replace("{d}", day) for name, text in DIALECTS[dialect].items()}
    return (
        f"CASE WHEN {picked(key, 1, 0, 6)} THEN 'NULL' WHEN {picked(key, 1, 6, 500)} THEN {fmt['iso']}"
        f" WHEN {picked(key, 1, 506, 250)} THEN {fmt['slash']} WHEN {picked(key, 1, 756, 120)} THEN {fmt['words']}"
        f" ELSE {fmt['short']} END"
    )


def untidy_region(region: str, key: str) -> str:
    return (
        f"CASE WHEN {picked(key, 2, 0, 90)} THEN upper({region}) WHEN {picked(key, 2, 90, 120)}"
        f" THEN 'sales area ' || lower({region}) WHEN {picked(key, 2, 210, 80)} THEN {region} || '  '"
        f" WHEN {picked(key, 2, 290, 7)} THEN 'elsewhere' WHEN {picked(key, 2, 297, 5)} THEN 'nan' ELSE {region} END"
    )


def untidy_channel(channel: str, key: str) -> str:
    return (
        f"CASE WHEN {picked(key, 3, 0, 160)} THEN lower({channel}) WHEN {picked(key, 3, 160, 110)}"
        f" THEN substr({channel}, 1, 3) || ' ' || substr({channel}, 4) ELSE {channel} END"
    )


def untidy_sku(sku: str, key: str) -> str:
    return (
        f"CASE WHEN {picked(key, 4, 0, 70)} THEN lower({sku}) WHEN {picked(key, 4, 70, 60)} THEN '  ' || {sku}"
        f" ELSE {sku} END"
    )


QUANTITY_TEXT = (
    f"CASE WHEN {picked(_K, 5, 0, 15)} THEN NULL WHEN {picked(_K, 5, 15, 10)} THEN 'N/A'"
    f" WHEN {picked(_K, 5, 25, 30)} THEN {_Q} || ' pcs' WHEN {picked(_K, 5, 55, 14)} THEN '-' || {_Q}"
    f" WHEN {picked(_K, 5, 69, 3)} THEN {_Q100} ELSE {_Q} END"
)
PRICE_TEXT = (
    f"CASE WHEN {picked(_K, 6, 0, 80)} THEN 'EUR ' || {_cents_text(_CENTS)} WHEN {picked(_K, 6, 80, 22)} THEN NULL"
    f" ELSE {_cents_text(_CENTS)} END"
)
#: The same text with the division written out once.
PRICE_TEXT_ONCE = (
    f"CASE WHEN {picked(_K, 6, 80, 22)} THEN NULL"
    f" ELSE (CASE WHEN {picked(_K, 6, 0, 80)} THEN 'EUR ' ELSE '' END) || {_cents_text(_CENTS)} END"
)
DISCOUNT_TEXT = (
    f"CASE WHEN {picked(_K, 7, 0, 140)} THEN {_D} || ' %' WHEN {picked(_K, 7, 140, 18)} THEN NULL"
    f" WHEN {picked(_K, 7, 158, 9)} THEN '' ELSE {_D} END"
)
SKU_TEXT = untidy_sku(_SKU, _K)
REP_TEXT = (
    f"CASE WHEN {picked(_K, 8, 0, 12)} THEN NULL WHEN {picked(_K, 8, 12, 12)} THEN 'None'"
    " ELSE 'R' || CAST(l_suppkey AS STRING) END"
)
ORDER_TEXT = "'SO-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"


def line_texts(dialect: str) -> dict[str, str]:
    """Untidy sales columns that need the line alone."""
    return {
        "order_id": ORDER_TEXT,
        "order_date": untidy_date("CAST(l_shipdate AS DATE)", "l_orderkey", dialect),
        "sku": SKU_TEXT,
        "quantity": QUANTITY_TEXT,
        "unit_price": PRICE_TEXT_ONCE if dialect == "spark" else PRICE_TEXT,
        "discount_pct": DISCOUNT_TEXT,
        "sales_rep_id": REP_TEXT,
    }


def sales_texts(dialect: str) -> dict[str, str]:
    customer = "'C' || CAST(c_custkey AS STRING)"
    return line_texts(dialect) | {
        "customer_id": f"CASE WHEN {picked('l_orderkey', 9, 0, 60)} THEN lower({customer}) || ' ' ELSE {customer} END",
        "outlet_region": untidy_region("r_name", "l_orderkey"),
        "channel": untidy_channel("c_mktsegment", "l_orderkey"),
    }


SALES_COPIED = picked("l_orderkey", 10, 0, 25)
DELIVERIES_COPIED = picked("l_orderkey", 11, 0, 15)


def delivery_texts(dialect: str) -> dict[str, str]:
    return {
        "delivery_id": "'D' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
        "sku": SKU_TEXT,
        "region": untidy_region("r_name", "l_orderkey"),
        "order_date": untidy_date(ORDERED_ON, "(l_orderkey + 1)", dialect),
        "delivery_date": untidy_date(f"({ORDERED_ON} + {LEAD_DAYS})", "(l_orderkey + 2)", dialect),
        "qty_ordered": _Q,
        "qty_delivered": f"COALESCE(CAST(CAST({DELIVERED_QTY} AS INT) AS STRING), 'N/A')",
        "stockout_days": f"COALESCE(CAST(CAST({STOCKOUT_DAYS} AS INT) AS STRING), 'n/a')",
    }


def target_texts(dialect: str) -> dict[str, str]:
    formats = DIALECTS[dialect]
    word, iso = (formats[name].replace("{d}", "month_start") for name in ("month_word", "month_iso"))
    amount = formats["thousands"].replace("{x}", TARGET).replace("{{", "{").replace("}}", "}")
    word, iso = f"CASE WHEN {TARGET_UNDATED} THEN 'N/A' ELSE {word} END", iso
    return {
        "rep_id": f"CASE WHEN {TARGET_NOBODY} THEN 'NULL' ELSE 'R' || CAST(s_suppkey AS STRING) END",
        "month": f"CASE WHEN idx % 5 = 0 THEN {iso} ELSE {word} END",
        "target_amount": f"CASE WHEN {TARGET_GAP} THEN '' ELSE {amount} END",
    }


def product_texts() -> dict[str, str]:
    price = _cents_text("CAST(ROUND(p_retailprice * 100) AS BIGINT)")
    cost = _cents_text("CAST(FLOOR(CAST(ROUND(p_retailprice * 100) AS BIGINT) * 7 / 10) AS BIGINT)")
    return {
        "sku": untidy_sku("'P' || CAST(p_partkey AS STRING)", "p_partkey"),
        "product_name": "p_name",
        "category": f"CASE WHEN {picked('p_partkey', 13, 0, 300)} THEN lower(p_type)"
        f" WHEN {picked('p_partkey', 13, 300, 150)} THEN p_type || ' ' ELSE p_type END",
        "list_price": f"CASE WHEN {picked('p_partkey', 12, 0, 200)} THEN 'EUR ' || {price} ELSE {price} END",
        "unit_cost": cost,
        "pack_size": "CAST(p_size AS STRING)",
    }


def customer_texts() -> dict[str, str]:
    name = "c_name || '''s store'"
    return {
        "customer_id": f"CASE WHEN {picked('c_custkey', 14, 0, 50)} THEN 'c' || CAST(c_custkey AS STRING) || ' '"
        " ELSE 'C' || CAST(c_custkey AS STRING) END",
        "outlet_name": f"CASE WHEN {picked('c_custkey', 15, 0, 100)} THEN lower({name})"
        f" WHEN {picked('c_custkey', 15, 100, 70)} THEN {name} || '   ' ELSE {name} END",
        "region": untidy_region("r_name", "c_custkey"),
        "channel": untidy_channel("c_mktsegment", "c_custkey"),
        "rep_id": f"CASE WHEN {picked('c_custkey', 16, 0, 20)} THEN 'null' ELSE 'R' || CAST(c_custkey % 100 AS STRING) END",
    }


#: An outlet name with quotes, a comma and a line break.
QUOTED_NAME = "outlet_name || ' \"the 6\", blue' || chr(10) || 'annex'"


def rep_texts(dialect: str) -> dict[str, str]:
    name = "replace(s_name, '#', ' ')"
    hired = "(DATE '2019-01-01' + CAST(s_suppkey * 37 % 1800 AS INT))"
    return {
        "rep_id": "'R' || CAST(s_suppkey AS STRING)",
        "rep_name": f"CASE WHEN {picked('s_suppkey', 17, 0, 180)} THEN lower({name}) || ' '"
        f" WHEN {picked('s_suppkey', 17, 180, 140)} THEN upper({name}) ELSE {name} END",
        "region": untidy_region("r_name", "s_suppkey"),
        "hire_date": untidy_date(hired, "s_suppkey", dialect),
    }


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in columns.items())


#: A line of a file with three columns, of which some have two fields or four.
UNEVEN_COLUMNS = ["order_id", "mode", "part"]
UNEVEN_LINE = """concat_ws(',', CAST(l_orderkey AS string), l_returnflag, CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_partkey AS string) END,
    CASE WHEN l_orderkey % 89 = 0 AND l_orderkey % 97 <> 0 THEN 'left over' END)"""
