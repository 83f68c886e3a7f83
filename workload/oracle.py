"""The same results as plain SQL over the given tables, for checking."""

from __future__ import annotations

from workload import expressions as x

# Spelled out, not taken from the library, whose lists are under test.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
LOG_TEXTS = (
    ("products", "changed", "columns not written in their standard form", "rewritten"),
    ("customers", "changed", "columns not written in their standard form", "rewritten"),
    ("customers", "unknown_label", "text in which no known label was found", "label left empty"),
    ("customers", "conflicting_rep", "outlet listed with several reps", "the first in order is used"),
    ("sales_reps", "changed", "columns not written in their standard form", "rewritten"),
    ("sales_reps", "unknown_label", "text in which no known label was found", "label left empty"),
    ("sales", "duplicates", "row occurs again word for word", "one kept"),
    ("sales", "undated", "no date can be read", "left out of the fact"),
    ("sales", "relabelled", "label not written in its standard form", "rewritten"),
    ("sales", "unknown_label", "text in which no known label was found", "label left empty"),
    ("sales", "negative_quantity", "quantity below zero", "taken without its sign"),
    ("sales", "outlier", "quantity out of proportion to its product and channel", "median instead, flagged"),
    ("sales", "missing_quantity", "no quantity", "median instead, flagged"),
    ("sales", "missing_price", "no price", "median of product and month instead"),
    ("sales", "missing_discount", "no discount", "none assumed"),
    ("sales", "missing_rep", "no rep", "rep of the outlet"),
    ("targets", "missing", "no target amount", "laid on the line between the neighbouring months"),
    ("deliveries", "duplicates", "row occurs again word for word", "one kept"),
    ("deliveries", "unknown_label", "text in which no known label was found", "label left empty"),
    ("deliveries", "token_qty_ordered", "no quantity ordered", "left empty"),
    ("deliveries", "token_qty_delivered", "no quantity delivered", "left empty"),
    ("deliveries", "token_stockout_days", "no stock-out days", "left empty"),
)

S = x.select_list

# ---- building blocks --------------------------------------------------------------

OUTLETS = """
outlets AS (
  SELECT c.*, r_name FROM customer c
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
)"""
ORDER_LINES = f"""{OUTLETS},
order_lines AS (
  SELECT * FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN outlets ON c_custkey = o_custkey
)"""
LINES = f"lines AS (SELECT {S(x.LINE)} FROM lineitem)"
SALES = f"{ORDER_LINES}, sales AS (SELECT {S(x.LINE | x.OUTLET)} FROM order_lines)"
PRODUCTS = f"products AS (SELECT {S(x.PRODUCT)} FROM part)"
REPS = f"""reps AS (
  SELECT {S(x.REP)} FROM supplier
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
)"""
REP_MONTHS = f"""rep_months AS (
  SELECT s_suppkey, idx, CAST(DATE '1999-01-01' + to_months(CAST(idx AS INT)) AS DATE) AS month_start
  FROM supplier, range({x.TARGET_MONTHS}) m(idx)
)"""
TARGETS = f"""{REP_MONTHS},
targets AS (SELECT s_suppkey AS rep_id, {x.TARGET} AS target_amount, month_start FROM rep_months)"""


def even(value: str, digits: int = 0) -> str:
    return f"(round_even(CAST({value} AS DOUBLE) * 1e{digits}, 0) / 1e{digits} + 0.0)"


def up(value: str, digits: int = 0) -> str:
    return f"(round(CAST({value} AS DOUBLE), {digits}) + 0.0)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def iso(day: str) -> str:
    return f"strftime({day}, '%Y-%m-%d')"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


_MEASURED = f"""
  SELECT *, date_diff('day', order_date, delivery_date) AS lead_time_days,
         {even(ratio("qty_delivered", "qty_ordered"), 3)} AS fill_rate
"""
DATED_DELIVERIES = f"""
placed AS (SELECT {S(x.DELIVERY)} FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
deliveries AS ({_MEASURED} FROM placed)"""
DELIVERIES_ONLY = f"""
placed AS (SELECT {S(x.DELIVERY | {"region": "r_name"})} FROM order_lines),
deliveries AS ({_MEASURED} FROM placed)"""
DELIVERIES = f"{ORDER_LINES}, {DELIVERIES_ONLY}"

RAW_LINES = f"raw_lines AS (SELECT {S({'line_no': 'l_linenumber'} | x.line_texts('duckdb'))} FROM lineitem)"
RAW_SALES = f"""{ORDER_LINES},
raw_sales AS (
  SELECT {S(x.sales_texts("duckdb"))} FROM order_lines
  UNION ALL SELECT {S(x.sales_texts("duckdb"))} FROM order_lines WHERE {x.SALES_COPIED}
)"""
RAW_DELIVERIES_ONLY = f"""
raw_deliveries AS (
  SELECT {S(x.delivery_texts("duckdb"))} FROM order_lines
  UNION ALL SELECT {S(x.delivery_texts("duckdb"))} FROM order_lines WHERE {x.DELIVERIES_COPIED}
)"""
RAW_DELIVERIES = f"{ORDER_LINES}, {RAW_DELIVERIES_ONLY}"
RAW_TARGETS = f"{REP_MONTHS}, raw_targets AS (SELECT {S(x.target_texts('duckdb'))} FROM rep_months)"
RAW_PRODUCTS = f"raw_products AS (SELECT {S(x.product_texts())} FROM part)"
RAW_CUSTOMERS_ONLY = f"raw_customers AS (SELECT {S(x.customer_texts())} FROM outlets)"
RAW_CUSTOMERS = f"{OUTLETS}, {RAW_CUSTOMERS_ONLY}"
RAW_REPS = f"""raw_reps AS (
  SELECT {S(x.rep_texts("duckdb"))} FROM supplier
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
)"""


def present(text: str) -> str:
    """Null for a missing-value text."""
    return f"(CASE WHEN trim({text}) IN ({', '.join(repr(t) for t in MISSING_TOKENS)}) THEN NULL ELSE {text} END)"


def all_present(columns) -> str:
    return ", ".join(f"{present(c)} AS {c}" for c in columns)


def parsed_date(text: str) -> str:
    formats = ["%Y-%m-%d", "%d/%m/%Y", "%b %d, %Y", "%d-%b-%y"]
    return "CAST(coalesce(" + ", ".join(f"try_strptime(trim({text}), '{f}')" for f in formats) + ") AS DATE)"


def parsed_month(text: str) -> str:
    return f"CAST(coalesce(try_strptime({text}, '%b-%Y'), try_strptime({text}, '%Y-%m')) AS DATE)"


def number(text: str) -> str:
    return f"try_cast(nullif(regexp_replace({text}, '[^0-9.\\-]', '', 'g'), '') AS DOUBLE)"


def region_label(text: str) -> str:
    found = " ".join(
        f"WHEN contains(lower({text}), '{name.lower()}') THEN '{name}'"
        for name in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    )
    return f"(CASE {found} END)"


def channel_label(text: str) -> str:
    return f"upper(replace({text}, ' ', ''))"


def key(text: str) -> str:
    return f"upper(trim({text}))"


def title(text: str) -> str:
    runs = f"regexp_extract_all(lower(trim({text})), '(\\p{{L}}+|[^\\p{{L}}]+)')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || w[2:]), '')"


PARSED_SALES = f"""{RAW_SALES},
distinct_sales AS (
  SELECT {all_present(x.sales_texts("duckdb"))}, count(*) AS copies FROM raw_sales GROUP BY ALL
),
all_parsed AS (
  SELECT order_id, {parsed_date("order_date")} AS order_date, {key("customer_id")} AS customer_id,
         {channel_label("channel")} AS channel, {key("sku")} AS sku, {number("quantity")} AS signed_quantity,
         {number("unit_price")} AS unit_price, {number("discount_pct")} AS discount_pct, sales_rep_id,
         {region_label("outlet_region")} AS region, copies,
         {region_label("outlet_region")} IS DISTINCT FROM outlet_region
           OR {channel_label("channel")} IS DISTINCT FROM channel AS relabelled,
         ({region_label("outlet_region")} IS NULL AND outlet_region IS NOT NULL) AS unknown_label
  FROM distinct_sales
),
parsed AS (
  SELECT *, abs(signed_quantity) AS quantity, date_trunc('month', order_date) AS month
  FROM all_parsed WHERE order_date IS NOT NULL
),
usual AS (SELECT sku, channel, median(quantity) AS usual FROM parsed GROUP BY ALL),
usual_price AS (SELECT sku, month, median(unit_price) AS usual_price FROM parsed GROUP BY ALL)"""
CLEAN_CUSTOMERS_ONLY = f"""{RAW_CUSTOMERS_ONLY},
clean_customers AS (
  SELECT {key("customer_id")} AS customer_id, {title("outlet_name")} AS outlet_name,
         {region_label("region")} AS region, {channel_label("channel")} AS channel, {present("rep_id")} AS rep_id
  FROM raw_customers
)"""
_REPAIRED = """CASE WHEN quantity > 10 * usual THEN usual ELSE coalesce(quantity, usual) END"""
_FLAG = "CASE WHEN quantity IS NULL THEN 'imputed' WHEN quantity > 10 * usual THEN 'outlier_fixed' ELSE '' END"
REPAIRED_SALES = f"""{PARSED_SALES}, {CLEAN_CUSTOMERS_ONLY},
repaired AS (
  SELECT p.order_id, p.order_date, p.customer_id, p.channel, p.sku, {_REPAIRED} AS quantity,
         coalesce(unit_price, usual_price) AS unit_price, coalesce(discount_pct, 0.0) AS discount_pct,
         coalesce(sales_rep_id, c.rep_id) AS sales_rep_id, p.region, {_FLAG} AS qty_flag,
         relabelled, unknown_label, signed_quantity < 0 AS negative_quantity, quantity IS NULL AS missing_quantity,
         unit_price IS NULL AS missing_price, discount_pct IS NULL AS missing_discount,
         sales_rep_id IS NULL AS missing_rep
  FROM parsed p
  LEFT JOIN usual USING (sku, channel) LEFT JOIN usual_price USING (sku, month)
  LEFT JOIN clean_customers c ON c.customer_id = p.customer_id
)"""
CLEAN_DELIVERIES_SELECT = f"""
  SELECT delivery_id, {key("sku")} AS sku, {region_label("region")} AS region,
         {parsed_date("order_date")} AS order_date, {parsed_date("delivery_date")} AS delivery_date,
         {number("qty_ordered")} AS qty_ordered, {number("qty_delivered")} AS qty_delivered,
         {number("stockout_days")} AS stockout_days
"""


def interpolated(source: str) -> str:
    """Positional linear interpolation by self-joining each gap to its known neighbours."""
    return f"""
placed_targets AS (
  SELECT *, row_number() OVER (PARTITION BY rep_id ORDER BY month_start NULLS LAST, target_amount NULLS LAST) AS pos FROM {source}
),
neighbours AS (
  SELECT t.rep_id, t.month_start, t.target_amount, t.pos,
         max(k.pos) FILTER (WHERE k.pos < t.pos) AS p0, min(k.pos) FILTER (WHERE k.pos > t.pos) AS p1
  FROM placed_targets t
  LEFT JOIN placed_targets k ON k.rep_id = t.rep_id AND k.target_amount IS NOT NULL
  GROUP BY ALL
),
filled AS (
  SELECT n.rep_id, n.month_start,
         coalesce(n.target_amount,
                  a.target_amount + (b.target_amount - a.target_amount) / (p1 - p0) * (n.pos - p0),
                  a.target_amount, b.target_amount) AS target_amount
  FROM neighbours n
  LEFT JOIN placed_targets a ON a.rep_id = n.rep_id AND a.pos = n.p0
  LEFT JOIN placed_targets b ON b.rep_id = n.rep_id AND b.pos = n.p1
)"""


def within(first: str, last: str, day: str = "order_date") -> str:
    return f"strftime({day}, '%Y-%m') BETWEEN '{first}' AND '{last}'"


CUR, PRIOR = within("2000-07", "2000-09"), within("1999-07", "1999-09")
TREND, TREND_PRIOR = within("2000-01", "2000-06"), within("1999-01", "1999-06")
FUTURE_PRIOR = within("1999-10", "1999-12")
FOUR_SUMS = f"""
  sum(CASE WHEN {CUR} THEN revenue END) AS cur, sum(CASE WHEN {PRIOR} THEN revenue END) AS prior,
  sum(CASE WHEN {TREND} THEN revenue END) AS trend, sum(CASE WHEN {TREND_PRIOR} THEN revenue END) AS trend_prior
"""
IN_FOCUS = "(region = 'ASIA' AND category = 'PROMO')"
FULL = "sales JOIN products USING (sku)"

ORACLE: dict[str, str] = {}

# ---- sources ----------------------------------------------------------------------

ORACLE["csv_scan_text"] = f"WITH {RAW_CUSTOMERS} SELECT * REPLACE ({x.QUOTED_NAME} AS outlet_name) FROM raw_customers"
ORACLE["csv_scan_typed"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, {iso("o_orderdate")} AS order_date, o_totalprice AS amount
FROM orders"""
ORACLE["null_token_normalise"] = f"""
WITH {RAW_DELIVERIES}
SELECT delivery_id, qty_delivered = 'N/A' AS was_token, nullif(qty_delivered, 'N/A') AS qty_delivered,
       nullif(stockout_days, 'n/a') AS stockout_days
FROM (SELECT DISTINCT * FROM raw_deliveries)"""
ORACLE["catalog_row_counts"] = f"""
WITH {SALES}, {DELIVERIES_ONLY}, {PRODUCTS}, {REPS}, {TARGETS}
SELECT 'fact_sales' AS "table", count(*) AS row_count FROM sales
UNION ALL SELECT 'fact_targets', count(*) FROM targets
UNION ALL SELECT 'dim_products', count(*) FROM products
UNION ALL SELECT 'dim_customers', count(*) FROM outlets
UNION ALL SELECT 'fact_deliveries', count(*) FROM deliveries
UNION ALL SELECT 'dim_reps', count(*) FROM reps"""

# ---- cleaning: columns ------------------------------------------------------------

ORACLE["parse_mixed_dates"] = f"""
WITH {RAW_LINES}
SELECT order_id, order_date, {iso(parsed_date("order_date"))} AS parsed FROM raw_lines"""
ORACLE["parse_month_start"] = f"""
WITH {RAW_TARGETS}
SELECT rep_id, month, {iso(parsed_month("month"))} AS month_start FROM raw_targets"""
ORACLE["standardise_region"] = f"""
WITH {RAW_CUSTOMERS} SELECT customer_id, {region_label("region")} AS region FROM raw_customers"""
ORACLE["standardise_channel"] = f"""
WITH {RAW_CUSTOMERS} SELECT customer_id, {channel_label("channel")} AS channel FROM raw_customers"""
ORACLE["text_to_number"] = f"""
WITH {RAW_LINES}
SELECT order_id, {number("quantity")} AS quantity, {number("unit_price")} AS unit_price,
       {number("discount_pct")} AS discount_pct
FROM raw_lines"""
ORACLE["normalise_keys"] = f"WITH {RAW_LINES} SELECT order_id, {key('sku')} AS sku FROM raw_lines"
ORACLE["title_case_labels"] = f"""
WITH {RAW_CUSTOMERS} SELECT customer_id, {title("outlet_name")} AS outlet_name FROM raw_customers"""
ORACLE["sign_repair"] = f"""
WITH {RAW_LINES}
SELECT order_id, abs({number("quantity")}) AS quantity, coalesce({number("quantity")} < 0, false) AS was_negative
FROM raw_lines"""
ORACLE["default_fill"] = f"""
WITH {RAW_LINES} SELECT order_id, coalesce({number("discount_pct")}, 0.0) AS discount_pct FROM raw_lines"""
ORACLE["line_revenue"] = f"""
WITH {RAW_LINES},
n AS (SELECT order_id, {number("quantity")} AS quantity, {number("unit_price")} AS unit_price,
             {number("discount_pct")} AS discount_pct FROM raw_lines)
SELECT *, {even("quantity * unit_price * (CAST(1 AS DOUBLE) - discount_pct / 100)", 2)} AS revenue FROM n"""
ORACLE["lead_time_days"] = f"""
WITH {DATED_DELIVERIES}
SELECT order_id, CAST(line_no AS BIGINT) AS line_no, {iso("order_date")} AS order_date,
       {iso("delivery_date")} AS delivery_date, lead_time_days
FROM deliveries"""
ORACLE["row_fill_rate"] = f"""
WITH {DATED_DELIVERIES}
SELECT order_id, CAST(line_no AS BIGINT) AS line_no, qty_ordered, qty_delivered, fill_rate FROM deliveries"""
ORACLE["month_bucket"] = f"""
WITH {LINES}
SELECT strftime(order_date, '%Y-%m-01') AS month, count(*) AS lines FROM lines GROUP BY 1"""

# ---- cleaning: tables -------------------------------------------------------------

ORACLE["drop_exact_duplicates"] = f"""
WITH {RAW_SALES} SELECT DISTINCT {all_present(x.sales_texts("duckdb"))} FROM raw_sales"""
ORACLE["drop_invalid_dates"] = f"""
WITH {RAW_LINES},
d AS (SELECT order_id, {parsed_date("order_date")} AS order_date FROM raw_lines)
SELECT order_id, {iso("order_date")} AS order_date FROM d WHERE order_date IS NOT NULL"""
ORACLE["group_median_join"] = f"""
WITH {PARSED_SALES}
SELECT order_id, sku, channel, quantity, usual AS median_quantity
FROM parsed LEFT JOIN usual USING (sku, channel)"""
ORACLE["impute_quantity"] = f"""
WITH {PARSED_SALES}
SELECT order_id, sku, channel, {_REPAIRED} AS quantity, {_FLAG} AS qty_flag
FROM parsed LEFT JOIN usual USING (sku, channel)"""
ORACLE["outlier_repair"] = f"SELECT * FROM ({ORACLE['impute_quantity']}) WHERE qty_flag = 'outlier_fixed'"
ORACLE["impute_price"] = f"""
WITH {PARSED_SALES}
SELECT order_id, sku, {iso("month")} AS month, coalesce(unit_price, usual_price) AS unit_price,
       unit_price IS NULL AS filled
FROM parsed LEFT JOIN usual_price USING (sku, month)"""
ORACLE["lookup_fill"] = f"""
WITH {RAW_SALES}, {CLEAN_CUSTOMERS_ONLY}
SELECT s.order_id, {key("s.customer_id")} AS customer_id, coalesce(s.sales_rep_id, c.rep_id) AS sales_rep_id
FROM (SELECT DISTINCT {all_present(x.sales_texts("duckdb"))} FROM raw_sales) s LEFT JOIN clean_customers c ON c.customer_id = {key("s.customer_id")}"""
ORACLE["sorted_sales"] = f"""
WITH {LINES}
SELECT order_id, CAST(line_no AS BIGINT) AS line_no, {iso("order_date")} AS order_date, sku, quantity,
       {dbl("revenue")} AS revenue
FROM lines ORDER BY order_date, order_id"""
ORACLE["interpolate_targets"] = f"""
WITH {REP_MONTHS},
gappy AS (
  SELECT CASE WHEN {x.TARGET_NOBODY} THEN NULL ELSE s_suppkey END AS rep_id,
         CAST(CASE WHEN {x.TARGET_UNDATED} THEN NULL WHEN {x.TARGET_AGAIN} THEN month_start - INTERVAL 1 MONTH
              ELSE month_start END AS DATE) AS month_start, CASE WHEN {x.TARGET_GAP} THEN NULL ELSE {dbl(x.TARGET)} END AS target_amount
  FROM rep_months
), {interpolated("gappy")}
SELECT rep_id, {iso("month_start")} AS month_start, {up("target_amount", 4)} AS target_amount FROM filled"""
ORACLE["clean_sales"] = f"""
WITH {REPAIRED_SALES}
SELECT order_id, {iso("order_date")} AS order_date, customer_id, channel, sku, quantity, unit_price, discount_pct,
       sales_rep_id, region, qty_flag,
       {even("quantity * unit_price * (CAST(1 AS DOUBLE) - discount_pct / 100)", 2)} AS revenue
FROM repaired"""
ORACLE["clean_targets"] = f"""
WITH {RAW_TARGETS},
typed AS (
  SELECT {present("rep_id")} AS rep_id, {parsed_month("month")} AS month_start, {number("target_amount")} AS target_amount FROM raw_targets
), {interpolated("typed")}
SELECT rep_id, {up("target_amount", 4)} AS target_amount, {iso("month_start")} AS month_start FROM filled"""
ORACLE["clean_deliveries"] = f"""
WITH {RAW_DELIVERIES}, placed AS ({CLEAN_DELIVERIES_SELECT} FROM (SELECT DISTINCT * FROM raw_deliveries)),
deliveries AS ({_MEASURED} FROM placed)
SELECT delivery_id, sku, region, {iso("order_date")} AS order_date, {iso("delivery_date")} AS delivery_date,
       qty_ordered, qty_delivered, stockout_days, lead_time_days, fill_rate
FROM deliveries"""
ORACLE["clean_customers"] = f"WITH {OUTLETS}, {CLEAN_CUSTOMERS_ONLY} SELECT * FROM clean_customers"
ORACLE["clean_products"] = f"""
WITH {RAW_PRODUCTS}
SELECT {key("sku")} AS sku, product_name, {title("category")} AS category, {number("list_price")} AS list_price,
       {dbl("unit_cost")} AS unit_cost, CAST(pack_size AS BIGINT) AS pack_size
FROM raw_products"""
ORACLE["clean_reps"] = f"""
WITH {RAW_REPS}
SELECT rep_id, {title("rep_name")} AS rep_name, {region_label("region")} AS region,
       {iso(parsed_date("hire_date"))} AS hire_date
FROM raw_reps"""

_LOG_CTES = f"""{REPAIRED_SALES}, {RAW_DELIVERIES_ONLY}, {RAW_PRODUCTS}, {RAW_REPS}, {RAW_TARGETS},
distinct_deliveries AS (
  SELECT {all_present(x.delivery_texts("duckdb"))}, count(*) AS copies FROM raw_deliveries GROUP BY ALL
),
log("table", rule, rows_affected, table_rows) AS (
  SELECT 'products', 'changed',
         count(*) FILTER (WHERE {key("sku")} <> sku OR {title("category")} <> category
                            OR regexp_matches(list_price, '[^0-9.\\-]')), count(*) FROM raw_products
  UNION ALL
  SELECT 'customers', 'changed',
         count(*) FILTER (WHERE {key("customer_id")} <> customer_id OR {title("outlet_name")} <> outlet_name
                            OR {region_label("region")} IS DISTINCT FROM {present("region")}
                            OR {channel_label("channel")} <> channel), count(*) FROM raw_customers
  UNION ALL
  SELECT 'customers', 'unknown_label',
         count(*) FILTER (WHERE {region_label("region")} IS NULL AND {present("region")} IS NOT NULL), count(*)
  FROM raw_customers
  UNION ALL
  SELECT 'sales_reps', 'changed',
         count(*) FILTER (WHERE {title("rep_name")} <> rep_name
                            OR {region_label("region")} IS DISTINCT FROM {present("region")}
                            OR {iso(parsed_date("hire_date"))} IS DISTINCT FROM {present("hire_date")}), count(*)
  FROM raw_reps
  UNION ALL
  SELECT 'sales_reps', 'unknown_label',
         count(*) FILTER (WHERE {region_label("region")} IS NULL AND {present("region")} IS NOT NULL), count(*)
  FROM raw_reps
  UNION ALL
  SELECT 'sales', 'duplicates', CAST(sum(copies - 1) AS BIGINT), count(order_date) FROM all_parsed
  UNION ALL
  SELECT 'sales', 'undated', count(*) FILTER (WHERE order_date IS NULL), count(order_date) FROM all_parsed
  UNION ALL
  SELECT 'sales', unnest(['relabelled', 'unknown_label', 'negative_quantity', 'outlier', 'missing_quantity',
                          'missing_price', 'missing_discount', 'missing_rep']),
         unnest([count(*) FILTER (WHERE relabelled), count(*) FILTER (WHERE unknown_label),
                 count(*) FILTER (WHERE negative_quantity), count(*) FILTER (WHERE qty_flag = 'outlier_fixed'),
                 count(*) FILTER (WHERE missing_quantity), count(*) FILTER (WHERE missing_price),
                 count(*) FILTER (WHERE missing_discount), count(*) FILTER (WHERE missing_rep)]), count(*)
  FROM repaired
  UNION ALL
  SELECT 'targets', 'missing', count(*) FILTER (WHERE target_amount = ''), count(*) FROM raw_targets
  UNION ALL
  SELECT 'deliveries', unnest(['duplicates', 'unknown_label', 'token_qty_delivered', 'token_stockout_days']),
         unnest([CAST(sum(copies - 1) AS BIGINT),
                 count(*) FILTER (WHERE {region_label("region")} IS NULL AND region IS NOT NULL),
                 count(*) FILTER (WHERE qty_delivered IS NULL), count(*) FILTER (WHERE stockout_days IS NULL)]),
         count(*)
  FROM distinct_deliveries
)"""
_LOG_TEXTS = ", ".join(f"('{table}', '{rule}', '{issue}', '{action}')" for table, rule, issue, action in LOG_TEXTS)
ORACLE["quality_log"] = f"""
WITH {_LOG_CTES}
SELECT * FROM log JOIN (VALUES {_LOG_TEXTS}) t("table", rule, issue, action) USING ("table", rule)
WHERE rows_affected > 0"""
ORACLE["quality_summary"] = f"""
WITH {PARSED_SALES}, {RAW_DELIVERIES_ONLY}
SELECT 'sales' AS "table", (SELECT count(*) FROM raw_sales) AS rows_before, (SELECT count(*) FROM parsed) AS rows_after
UNION ALL
SELECT 'deliveries', (SELECT count(*) FROM raw_deliveries),
       (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_deliveries))
UNION ALL SELECT 'products', count(*), count(*) FROM part
UNION ALL SELECT 'customers', count(*), count(*) FROM customer
UNION ALL SELECT 'sales_reps', count(*), count(*) FROM supplier
UNION ALL SELECT 'targets', count(*) * {x.TARGET_MONTHS}, count(*) * {x.TARGET_MONTHS} FROM supplier"""

# ---- filters, labels, joins -------------------------------------------------------

ORACLE["filter_period"] = f"""
WITH {LINES}
SELECT order_id, CAST(line_no AS BIGINT) AS line_no, {iso("order_date")} AS order_date, {dbl("revenue")} AS revenue
FROM lines WHERE {CUR} OR {PRIOR}"""
ORACLE["filter_since"] = f"""
WITH {LINES}
SELECT order_id, CAST(line_no AS BIGINT) AS line_no, {iso("order_date")} AS order_date
FROM lines WHERE order_date >= DATE '2000-07-01'"""
_RC = f"""{SALES}, {PRODUCTS},
t AS (SELECT region, category, count(*) AS lines, sum(revenue) AS revenue FROM {FULL} GROUP BY ALL)"""
ORACLE["filter_exclude_group"] = f"""
WITH {_RC} SELECT region, category, lines, {dbl("revenue")} AS revenue FROM t WHERE NOT {IN_FOCUS}"""
ORACLE["label_focus_group"] = f"""
WITH {_RC}
SELECT CASE WHEN {IN_FOCUS} THEN 'Focus' ELSE 'All other' END AS "group", CAST(sum(lines) AS BIGINT) AS lines,
       {dbl("sum(revenue)")} AS revenue
FROM t GROUP BY 1"""
ORACLE["prior_year_month"] = f"""
WITH {LINES},
m AS (SELECT date_trunc('month', order_date) AS month, sum(revenue) AS revenue FROM lines GROUP BY 1)
SELECT {iso("m.month")} AS month, {iso("m.month - INTERVAL 12 MONTH")} AS prior_month,
       {dbl("m.revenue")} AS revenue, {dbl("p.revenue")} AS prior_revenue
FROM m LEFT JOIN m p ON p.month = m.month - INTERVAL 12 MONTH"""
ORACLE["star_join"] = f"""
WITH {LINES}, {PRODUCTS}
SELECT order_id, CAST(line_no AS BIGINT) AS line_no, sku, {dbl("revenue")} AS revenue, category
FROM lines JOIN products USING (sku)"""
_ACTUAL = """actual AS (
  SELECT sales_rep_id AS rep_id, CAST(date_trunc('month', order_date) AS DATE) AS month_start, sum(revenue) AS actual
  FROM lines GROUP BY ALL
),
joined AS (
  SELECT t.rep_id, t.month_start, t.target_amount, coalesce(a.actual, 0) AS actual
  FROM targets t LEFT JOIN actual a USING (rep_id, month_start)
)"""
ORACLE["target_vs_actual"] = f"""
WITH {LINES}, {TARGETS}, {_ACTUAL}
SELECT rep_id, {iso("month_start")} AS month_start, {dbl("target_amount")} AS target_amount, {dbl("actual")} AS actual
FROM joined"""
ORACLE["semi_join_focus_skus"] = f"""
WITH {DATED_DELIVERIES}
SELECT order_id, CAST(line_no AS BIGINT) AS line_no, sku, lead_time_days FROM deliveries
WHERE sku IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')"""

# ---- growth -----------------------------------------------------------------------

ORACLE["monthly_revenue_by_region"] = f"""
WITH {SALES}
SELECT strftime(order_date, '%Y-%m') AS ym, region, {up("sum(revenue)")} AS revenue FROM sales GROUP BY 1, 2"""


def _pct(a: str, b: str) -> str:
    return f"(({ratio(a, b)} - 1) * 100)"


_REGION_YOY = f"""
WITH {SALES},
agg AS (SELECT region, {FOUR_SUMS} FROM sales GROUP BY region),
y AS (
  SELECT region, cur, prior, {even(_pct("cur", "prior"), 1)} AS yoy_pct,
         {even(_pct("trend", "trend_prior"), 1)} AS trend_yoy_pct
  FROM agg WHERE cur IS NOT NULL OR prior IS NOT NULL
),
g AS (SELECT *, {even("yoy_pct - trend_yoy_pct", 1)} AS growth_gap_pts FROM y)"""
ORACLE["region_yoy"] = f"""{_REGION_YOY}
SELECT region, {even("cur")} AS "current", {even("prior")} AS prior, {even("yoy_pct")} AS yoy_pct,
       {even("trend_yoy_pct")} AS trend_yoy_pct, {even("growth_gap_pts")} AS growth_gap_pts
FROM g"""
ORACLE["region_yoy_detail"] = f"""{_REGION_YOY}
SELECT region, {up("cur", 2)} AS "current", {up("prior", 2)} AS prior, yoy_pct, trend_yoy_pct, growth_gap_pts FROM g"""
ORACLE["growth_gap"] = f"""
WITH {SALES}, {PRODUCTS},
agg AS (SELECT region, category, {FOUR_SUMS} FROM {FULL} GROUP BY region, category)
SELECT region, category, {up(_pct("cur", "prior"), 1)} AS yoy_pct,
       {up(_pct("trend", "trend_prior"), 1)} AS trend_yoy_pct,
       {up(f"({ratio('cur', 'prior')} - {ratio('trend', 'trend_prior')}) * 100", 1)} AS growth_gap_pts
FROM agg ORDER BY growth_gap_pts"""
ORACLE["category_drilldown"] = f"""
WITH {SALES}, {PRODUCTS},
agg AS (SELECT category, {FOUR_SUMS} FROM {FULL} WHERE region = 'ASIA' GROUP BY category)
SELECT category, {even("cur")} AS "current", {even("prior")} AS prior,
       {even(even(_pct("cur", "prior"), 1))} AS yoy_pct
FROM agg WHERE cur IS NOT NULL OR prior IS NOT NULL"""
ORACLE["lost_revenue"] = f"""
WITH {SALES}, {PRODUCTS},
agg AS (SELECT region, category, {FOUR_SUMS} FROM {FULL} WHERE {IN_FOCUS} GROUP BY ALL),
e AS (SELECT region, category, CAST(prior AS DOUBLE) * {ratio("trend", "trend_prior")} AS expected,
             CAST(cur AS DOUBLE) AS actual FROM agg)
SELECT region, category, {even("expected")} AS expected, {even("actual")} AS actual,
       {even("expected - actual")} AS lost, {even("(1 - actual / expected) * 100")} AS lost_pct
FROM e"""
ORACLE["mom_yoy_lag"] = f"""
WITH {SALES}, {PRODUCTS},
m AS (SELECT strftime(order_date, '%Y-%m') AS ym, sum(revenue) AS revenue FROM {FULL} WHERE {IN_FOCUS} GROUP BY 1),
l AS (SELECT *, lag(revenue) OVER (ORDER BY ym) AS before, lag(revenue, 12) OVER (ORDER BY ym) AS year_before FROM m)
SELECT ym, {up("revenue")} AS revenue, {up(_pct("revenue", "before"), 1)} AS mom_pct,
       {up(_pct("revenue", "year_before"), 1)} AS yoy_pct
FROM l"""
ORACLE["beverage_index"] = f"""
WITH {SALES}, {PRODUCTS},
m AS (
  SELECT date_trunc('month', order_date) AS month,
         CAST(sum(revenue) FILTER (WHERE region = 'ASIA') AS DOUBLE) AS focus,
         CAST(sum(revenue) FILTER (WHERE region <> 'ASIA') AS DOUBLE) AS other
  FROM {FULL} WHERE category = 'PROMO' GROUP BY 1
),
first6 AS (SELECT avg(focus) AS f, avg(other) AS o FROM (SELECT * FROM m ORDER BY month LIMIT 6)),
i AS (SELECT month, focus / f * 100 AS focus, other / o * 100 AS other FROM m, first6)
SELECT {iso("month")} AS month,
       CASE WHEN count(focus) OVER w = 3 THEN {up("avg(focus) OVER w", 4)} END AS focus,
       CASE WHEN count(other) OVER w = 3 THEN {up("avg(other) OVER w", 4)} END AS other
FROM i WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""

# ---- supply -----------------------------------------------------------------------

ORACLE["supply_comparison"] = f"""
WITH {DELIVERIES}, {PRODUCTS}
SELECT CASE WHEN {IN_FOCUS} THEN 'Focus' ELSE 'All other' END AS "group",
       {even("avg(lead_time_days)", 2)} AS avg_lead_days, {even("avg(stockout_days)", 2)} AS avg_stockout_days,
       {even("avg(fill_rate)", 2)} AS avg_fill_rate
FROM deliveries JOIN products USING (sku) WHERE {CUR} GROUP BY 1"""
ORACLE["supply_by_region_category"] = f"""
WITH {DELIVERIES}, {PRODUCTS}
SELECT region, category, {up("avg(lead_time_days)", 1)} AS avg_lead_days,
       {up("avg(stockout_days)", 1)} AS avg_stockout_days, {up("avg(fill_rate)", 2)} AS avg_fill_rate
FROM deliveries JOIN products USING (sku) WHERE order_date >= DATE '2000-07-01' GROUP BY region, category"""
ORACLE["supply_measures"] = f"""
WITH {DELIVERIES}, {PRODUCTS}
SELECT region, category, {up("avg(lead_time_days)", 4)} AS avg_lead_days,
       {up("avg(stockout_days)", 4)} AS avg_stockout_days,
       {up(ratio("sum(qty_delivered)", "sum(qty_ordered)"), 4)} AS fill_rate
FROM deliveries JOIN products USING (sku) GROUP BY region, category"""
ORACLE["fill_rate_ratio"] = f"""
WITH {DELIVERIES}
SELECT region, {up(ratio("sum(qty_delivered)", "sum(qty_ordered)"), 4)} AS fill_rate FROM deliveries GROUP BY region"""

# ---- attainment -------------------------------------------------------------------

_T_CUR, _T_TREND = within("2000-07", "2000-09", "month_start"), within("2000-01", "2000-06", "month_start")


def _attained(period: str) -> str:
    return (
        ratio(f"sum(CASE WHEN {period} THEN actual END)", f"sum(CASE WHEN {period} THEN target_amount END)") + " * 100"
    )


_ATT = f"""{LINES}, {TARGETS}, {REPS}, {_ACTUAL},
att AS (SELECT rep_id, {_attained(_T_TREND)} AS trend_raw, {_attained(_T_CUR)} AS current_raw FROM joined GROUP BY 1)"""


def _status(trend: str, current: str) -> str:
    return (
        f"CASE WHEN {trend} < 90 THEN 'Persistent under-performance' WHEN {current} < 90"
        f" THEN 'Recent drop - check supply' WHEN {current} >= 110 THEN 'Star performer' ELSE 'On track' END"
    )


_ROUNDED_ATT = f"""{_ATT},
r AS (
  SELECT reps.*, {even("trend_raw", 1)} AS trend_pct, {even("current_raw", 1)} AS current_pct
  FROM reps LEFT JOIN att USING (rep_id)
)"""
ORACLE["rep_attainment"] = f"""
WITH {_ROUNDED_ATT} SELECT *, {_status("trend_pct", "current_pct")} AS status FROM r ORDER BY current_pct"""
ORACLE["rep_attainment_sql"] = f"""
WITH {_ATT}
SELECT rep_id, rep_name, region, {up("trend_raw", 1)} AS trend_pct, {up("current_raw", 1)} AS current_pct,
       rank() OVER (ORDER BY current_raw DESC NULLS LAST) AS current_rank,
       {_status("trend_raw", "current_raw")} AS status
FROM att JOIN reps USING (rep_id) ORDER BY current_raw"""
ORACLE["rep_status"] = f"""
WITH {_ROUNDED_ATT}
SELECT {_status("trend_pct", "current_pct")} AS status, count(*) AS reps FROM r GROUP BY 1"""
ORACLE["region_attainment"] = f"""
WITH {LINES}, {TARGETS}, {REPS}, {_ACTUAL}
SELECT region, {up(ratio("sum(actual)", "sum(target_amount)") + " * 100", 1)} AS attainment_pct
FROM joined JOIN reps USING (rep_id) WHERE {_T_CUR} GROUP BY region"""

# ---- forecast and inventory -------------------------------------------------------

_DETAIL = f"""{SALES}, {PRODUCTS},
mon AS (
  SELECT region, category, strftime(order_date, '%Y-%m') AS ym, sum(revenue) AS revenue FROM {FULL} GROUP BY ALL
),
growth AS (
  SELECT region, category,
         {ratio("sum(revenue) FILTER (WHERE ym BETWEEN '2000-01' AND '2000-06')",
                "sum(revenue) FILTER (WHERE ym BETWEEN '1999-01' AND '1999-06')")} AS g
  FROM mon GROUP BY ALL
),
wanted(month, base_month) AS (
  VALUES ('2000-07', '1999-07'), ('2000-08', '1999-08'), ('2000-09', '1999-09'),
         ('2000-10', '1999-10'), ('2000-11', '1999-11'), ('2000-12', '1999-12')
),
detail AS (
  SELECT growth.region, growth.category, month, {even("coalesce(CAST(b.revenue AS DOUBLE), 0) * g")} AS forecast,
         CASE WHEN month <= '2000-09' THEN {even("coalesce(a.revenue, 0)")} END AS actual
  FROM growth CROSS JOIN wanted
  LEFT JOIN mon b ON b.region = growth.region AND b.category = growth.category AND b.ym = base_month
  LEFT JOIN mon a ON a.region = growth.region AND a.category = growth.category AND a.ym = month
)"""
ORACLE["forecast_detail"] = f"WITH {_DETAIL} SELECT * FROM detail"
ORACLE["backtest_mape"] = f"""
WITH {_DETAIL}
SELECT {up("avg(abs(actual - forecast) / nullif(actual, 0)) * 100", 4)} AS mape
FROM detail WHERE actual IS NOT NULL AND NOT {IN_FOCUS}"""
ORACLE["forecast_q4_bottom_up"] = f"""
WITH {_DETAIL} SELECT region, sum(forecast) AS forecast FROM detail WHERE month >= '2000-10' GROUP BY region"""
ORACLE["forecast_month_totals"] = f"""
WITH {_DETAIL}
SELECT month, sum(forecast) AS forecast, coalesce(sum(actual), 0) AS actual FROM detail GROUP BY month"""
ORACLE["forecast_by_region"] = f"""
WITH {SALES},
m AS (SELECT region, strftime(order_date, '%Y-%m') AS ym, sum(revenue) AS revenue FROM sales GROUP BY ALL),
g AS (
  SELECT region, {ratio("sum(CASE WHEN ym BETWEEN '2000-01' AND '2000-06' THEN revenue END)",
                        "sum(CASE WHEN ym BETWEEN '1999-01' AND '1999-06' THEN revenue END)")} AS growth
  FROM m GROUP BY region
)
SELECT m.region, {up("g.growth", 3)} AS growth_factor, {up("sum(CAST(m.revenue AS DOUBLE) * g.growth)")} AS forecast
FROM m JOIN g ON g.region = m.region WHERE m.ym IN ('1999-10', '1999-11', '1999-12')
GROUP BY m.region, g.growth"""
_UNITS_CTES = f"""{SALES}, {PRODUCTS},
units AS (
  SELECT sku, strftime(order_date, '%Y-%m') AS ym, sum(quantity) AS units
  FROM {FULL} WHERE {IN_FOCUS} AND {within("1999-07", "2000-06")} GROUP BY ALL
)"""
_STATS = f"""
stats AS (
  SELECT sku, {even("avg(units)", 1)} AS avg_monthly_units, {even("stddev_samp(units)", 1)} AS sd_monthly_units
  FROM units GROUP BY sku
)"""
_LEAD = """
lead_stats AS (
  SELECT sku, avg(lead_time_days) FILTER (WHERE order_date < DATE '2000-07-01') AS l0,
         stddev_samp(lead_time_days) FILTER (WHERE order_date < DATE '2000-07-01') AS s0,
         avg(lead_time_days) FILTER (WHERE order_date >= DATE '2000-07-01') AS l1,
         stddev_samp(lead_time_days) FILTER (WHERE order_date >= DATE '2000-07-01') AS s1
  FROM deliveries WHERE region = 'ASIA' GROUP BY sku
)"""
ORACLE["demand_stats"] = f"WITH {_UNITS_CTES}, {_STATS} SELECT * FROM stats"
ORACLE["lead_time_before_after"] = f"""
WITH {DELIVERIES}, {_LEAD}
SELECT sku, {up("l0", 4)} AS lead_days_normal, {up("s0", 4)} AS sd_lead_normal,
       {up("l1", 4)} AS lead_days_now, {up("s1", 4)} AS sd_lead_now
FROM lead_stats WHERE sku IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')"""


def _safety(lead: str, sd: str) -> str:
    return (
        f"1.65 * sqrt({lead} / 30 * pow(sd_monthly_units, 2) + pow(avg_monthly_units / 30, 2) * pow({sd}, 2))"
    )


ORACLE["safety_stock"] = f"""
WITH {_UNITS_CTES}, {_STATS}, {DELIVERIES_ONLY}, {_LEAD},
p AS (
  SELECT s.*, l0, l1, {even(_safety("l0", "s0"))} AS ss0, {even(_safety("l1", "s1"))} AS ss1
  FROM stats s LEFT JOIN lead_stats USING (sku)
)
SELECT sku, avg_monthly_units, sd_monthly_units, {even("l0", 1)} AS lead_days_normal, {even("l1", 1)} AS lead_days_now,
       ss0 AS safety_stock_normal, ss1 AS safety_stock_now,
       {even("avg_monthly_units / 30 * l1 + ss1")} AS reorder_point_now
FROM p"""
ORACLE["safety_stock_inputs"] = f"""
WITH {_UNITS_CTES}, {DELIVERIES_ONLY}, {_LEAD},
demand AS (
  SELECT sku, avg(units) AS mean, avg(units * units) - avg(units) * avg(units) AS variance FROM units GROUP BY sku
)
SELECT sku, {up("mean")} AS avg_monthly_units, {up("variance")} AS var_monthly_units, {up("l0", 1)} AS lead_days_normal,
       {up("l1", 1)} AS lead_days_now, {up("mean / 30.0 * l1")} AS demand_during_lead_time
FROM demand JOIN lead_stats USING (sku)"""

# ---- calendar-aware measures ------------------------------------------------------

ORACLE["calendar"] = f"""
WITH {LINES},
b AS (
  SELECT date_trunc('year', min(order_date)) AS a, date_trunc('year', max(order_date)) + INTERVAL 1 YEAR AS z FROM lines
),
d AS (SELECT unnest(generate_series(a, z - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day FROM b)
SELECT {iso("day")} AS date, year(day) AS year, month(day) AS month_no, strftime(day, '%b %Y') AS month,
       'Q' || quarter(day) || ' ' || year(day) AS quarter
FROM d"""
ORACLE["dim_region"] = f"WITH {OUTLETS} SELECT DISTINCT r_name AS region FROM outlets"
ORACLE["core_totals"] = f"""
WITH {SALES}, {PRODUCTS}
SELECT region, category, {dbl("sum(revenue)")} AS revenue, sum(quantity) AS units FROM {FULL} GROUP BY ALL"""
ORACLE["gross_margin"] = f"""
WITH {SALES}, {PRODUCTS},
m AS (
  SELECT region, category, sum(CAST(revenue AS DOUBLE) - quantity * CAST(unit_cost AS DOUBLE)) AS margin,
         sum(revenue) AS revenue
  FROM {FULL} GROUP BY region, category
)
SELECT region, category, {up("margin", 2)} AS gross_margin, {up(ratio("margin", "revenue"), 4)} AS gross_margin_pct
FROM m"""


def _cells(by: list[str]) -> str:
    """Every slice and calendar month with its revenue and the one a year before."""
    cols, source = ", ".join(by), FULL if "category" in by else "sales"
    same = " AND ".join(f"{{a}}.{c} = s.{c}" for c in by)
    return f"""
rev AS (
  SELECT {cols}, CAST(date_trunc('month', order_date) AS DATE) AS month, sum(revenue) AS revenue FROM {source} GROUP BY ALL
),
months AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '1999-01-01', TIMESTAMP '2000-12-01', INTERVAL 1 MONTH)) AS DATE) AS month
),
slices AS (SELECT DISTINCT {cols} FROM rev),
cells AS (
  SELECT {", ".join("s." + c for c in by)}, months.month, a.revenue, p.revenue AS revenue_py
  FROM slices s CROSS JOIN months
  LEFT JOIN rev a ON {same.format(a="a")} AND a.month = months.month
  LEFT JOIN rev p ON {same.format(a="p")} AND p.month = months.month - INTERVAL 1 YEAR
)"""


ORACLE["revenue_py"] = f"""
WITH {SALES}, {_cells(["region"])}
SELECT region, {iso("month")} AS month, {dbl("revenue")} AS revenue, {dbl("revenue_py")} AS revenue_py
FROM cells WHERE revenue IS NOT NULL OR revenue_py IS NOT NULL"""
ORACLE["revenue_yoy"] = f"""
WITH {SALES}, {_cells(["region"])}
SELECT region, {iso("month")} AS month, {dbl("revenue")} AS revenue, {dbl("revenue_py")} AS revenue_py,
       {up(ratio("coalesce(revenue, 0) - revenue_py", "revenue_py"), 4)} AS revenue_yoy
FROM cells WHERE revenue IS NOT NULL OR revenue_py IS NOT NULL"""
ORACLE["rolling_3m_revenue"] = f"""
WITH {SALES}, {_cells(["region"])}
SELECT c.region, {iso("c.month")} AS month, {dbl("sum(r.revenue)")} AS rolling_revenue
FROM cells c JOIN rev r ON r.region = c.region AND r.month <= c.month AND r.month > c.month - INTERVAL 3 MONTH
GROUP BY c.region, c.month"""
ORACLE["h1_growth_factor"] = f"""
WITH {SALES}, {PRODUCTS}
SELECT region, category,
       {up(ratio(f"sum(CASE WHEN {TREND} THEN revenue END)", f"sum(CASE WHEN {TREND_PRIOR} THEN revenue END)"), 4)}
         AS growth_factor
FROM {FULL} GROUP BY region, category"""


def _gap(by: list[str]) -> str:
    cols = ", ".join(by)
    trend, before = within("2000-01", "2000-06", "month"), within("1999-01", "1999-06", "month")
    growth = ratio(f"sum(revenue) FILTER (WHERE {trend})", f"sum(revenue) FILTER (WHERE {before})")
    return f"""{_cells(by)},
growth AS (SELECT {cols}, {growth} AS g FROM rev GROUP BY ALL),
gap AS (
  SELECT cells.*, CAST(revenue_py AS DOUBLE) * g AS expected FROM cells LEFT JOIN growth USING ({cols})
  WHERE revenue IS NOT NULL OR revenue_py IS NOT NULL
)"""


ORACLE["revenue_gap_vs_trend"] = f"""
WITH {SALES}, {PRODUCTS}, {_gap(["region", "category"])}
SELECT region, category, {iso("month")} AS month, {dbl("revenue")} AS revenue, {up("expected", 2)} AS expected,
       CASE WHEN revenue IS NOT NULL OR expected IS NOT NULL
            THEN {up("coalesce(CAST(revenue AS DOUBLE), 0) - coalesce(expected, 0)", 2)} END AS gap
FROM gap"""
ORACLE["forecast_measure"] = f"""
WITH {SALES}, {_gap(["region"])}
SELECT region, {iso("month")} AS month, {up("expected", 2)} AS forecast
FROM gap WHERE month BETWEEN DATE '2000-10-01' AND DATE '2000-12-01' AND expected IS NOT NULL"""
_SHARE = f"""{LINES}, {TARGETS},
sold AS (
  SELECT sales_rep_id AS rep_id, CAST(date_trunc('month', order_date) AS DATE) AS month, sum(revenue) AS revenue
  FROM lines GROUP BY ALL
)"""
ORACLE["attainment_measure"] = f"""
WITH {_SHARE}
SELECT coalesce(s.rep_id, t.rep_id) AS rep_id, {iso("coalesce(month, month_start)")} AS month,
       {dbl("revenue")} AS revenue, {dbl("target_amount")} AS target,
       {up(ratio("revenue", "target_amount"), 4)} AS attainment
FROM sold s FULL JOIN targets t ON t.rep_id = s.rep_id AND month_start = month"""
ORACLE["attainment_status"] = f"""
WITH {_SHARE},
r AS (SELECT rep_id, sum(revenue) AS revenue FROM sold GROUP BY 1),
t AS (SELECT rep_id, sum(target_amount) AS target FROM targets GROUP BY 1),
a AS (SELECT coalesce(r.rep_id, t.rep_id) AS rep_id, {ratio("revenue", "target")} AS share FROM r FULL JOIN t USING (rep_id))
SELECT rep_id, CASE WHEN share IS NULL THEN NULL WHEN share >= 1.1 THEN 'Star performer' WHEN share >= 0.9 THEN 'On track'
                    ELSE 'Below target' END AS status,
       CASE WHEN share >= 1.1 THEN '#27AE60' WHEN share >= 0.9 THEN '#7F8C8D' ELSE '#C0392B' END AS colour
FROM a"""
ORACLE["drill_across"] = f"""
WITH {SALES}, {DELIVERIES_ONLY}, {TARGETS},
sold AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, region, sum(revenue) AS revenue, sum(quantity) AS units
  FROM sales GROUP BY ALL
),
moved AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, region,
         {ratio("sum(qty_delivered)", "sum(qty_ordered)")} AS fill_rate
  FROM deliveries GROUP BY ALL
),
aimed AS (SELECT month_start AS month, sum(target_amount) AS target FROM targets GROUP BY 1),
both_facts AS (SELECT month, region, revenue, units, fill_rate FROM sold FULL JOIN moved USING (month, region))
SELECT {iso("month")} AS month, region, {dbl("revenue")} AS revenue, units, {dbl("target")} AS target,
       {up("fill_rate", 4)} AS fill_rate
FROM both_facts FULL JOIN aimed USING (month)"""
_MONTHS = f"""{SALES},
m AS (SELECT region, CAST(date_trunc('month', order_date) AS DATE) AS month, sum(revenue) AS revenue FROM sales GROUP BY ALL),
cal AS (SELECT CAST(unnest(range(DATE '1999-01-01', DATE '2001-01-01', INTERVAL 1 MONTH)) AS DATE) AS month),
slices AS (SELECT DISTINCT region FROM m),
py AS (
  SELECT region, month, a.revenue, b.revenue AS revenue_py
  FROM slices CROSS JOIN cal LEFT JOIN m a USING (region, month)
  LEFT JOIN (SELECT region, CAST(month + INTERVAL 1 YEAR AS DATE) AS month, revenue FROM m) b USING (region, month)
)"""
_QUARTER = "'Q' || quarter(month) || ' ' || year(month)"
ORACLE["revenue_py_by_quarter"] = f"""
WITH {_MONTHS}
SELECT region, {_QUARTER} AS quarter, {dbl("sum(revenue)")} AS revenue, {dbl("sum(revenue_py)")} AS revenue_py
FROM py GROUP BY 1, 2 HAVING count(revenue) + count(revenue_py) > 0"""
ORACLE["revenue_yoy_by_year"] = f"""
WITH {_MONTHS}
SELECT region, year(month) AS year, {dbl("sum(revenue)")} AS revenue, {dbl("sum(revenue_py)")} AS revenue_py,
       {up(ratio("coalesce(sum(revenue), 0) - coalesce(sum(revenue_py), 0)", "sum(revenue_py)"), 4)} AS revenue_yoy
FROM py GROUP BY 1, 2 HAVING count(revenue) + count(revenue_py) > 0"""
ORACLE["revenue_yoy_total"] = f"""
WITH {_MONTHS}
SELECT region, {dbl("sum(revenue)")} AS revenue, {dbl("sum(revenue_py)")} AS revenue_py,
       {up(ratio("coalesce(sum(revenue), 0) - coalesce(sum(revenue_py), 0)", "sum(revenue_py)"), 4)} AS revenue_yoy
FROM py GROUP BY 1 HAVING count(revenue) + count(revenue_py) > 0"""
ORACLE["rolling_3m_by_quarter"] = f"""
WITH {_MONTHS},
ends AS (SELECT month AS last FROM cal WHERE month(month) % 3 = 0)
SELECT region, {_QUARTER.replace("month", "last")} AS quarter, {dbl("sum(revenue)")} AS rolling_revenue
FROM ends JOIN m ON month BETWEEN CAST(last - INTERVAL 2 MONTH AS DATE) AND last GROUP BY 1, 2"""
ORACLE["attainment_by_rep_region"] = f"""
WITH {_SHARE}, {REPS},
r AS (SELECT region, {_QUARTER} AS quarter, sum(revenue) AS revenue
      FROM sold LEFT JOIN reps USING (rep_id) GROUP BY ALL),
t AS (SELECT region, {_QUARTER.replace("month", "month_start")} AS quarter, sum(target_amount) AS target
      FROM targets LEFT JOIN reps USING (rep_id) GROUP BY ALL)
SELECT region, quarter, {dbl("revenue")} AS revenue, {dbl("target")} AS target,
       {up(ratio("revenue", "target"), 4)} AS attainment
FROM r FULL JOIN t USING (region, quarter)"""
ORACLE["sales_of_rep_region"] = f"""
WITH {SALES}, {REPS}
SELECT s.region, year(order_date) AS year, {dbl("sum(revenue)")} AS revenue, sum(quantity) AS units
FROM sales s JOIN reps r ON r.rep_id = s.sales_rep_id
WHERE r.region = 'ASIA' AND s.channel = 'BUILDING' GROUP BY 1, 2"""

# ---- calendar filters and subtotals -----------------------------------------------

ORACLE["sales_every_q3"] = f"""
WITH {SALES}, {PRODUCTS}
SELECT region, category, year(order_date) AS year, {dbl("sum(revenue)")} AS revenue, sum(quantity) AS units
FROM {FULL} WHERE quarter(order_date) = 3 AND year(order_date) BETWEEN 1995 AND 2002 GROUP BY ALL"""
_JULY = "month({}) = 7 AND year({}) BETWEEN 1995 AND 2002"
ORACLE["facts_every_july"] = (
    ORACLE["drill_across"]
    .replace("FROM sales GROUP BY", f"FROM sales WHERE {_JULY.format('order_date', 'order_date')} GROUP BY")
    .replace("FROM deliveries GROUP BY", f"FROM deliveries WHERE {_JULY.format('order_date', 'order_date')} GROUP BY")
    .replace("FROM targets GROUP BY", f"FROM targets WHERE {_JULY.format('month_start', 'month_start')} GROUP BY")
)
ORACLE["weekend_attainment"] = f"""
WITH {LINES}, {TARGETS}, {REPS},
s AS (SELECT region, CAST(date_trunc('month', order_date) AS DATE) AS month, sum(revenue) AS revenue
      FROM lines LEFT JOIN reps ON rep_id = sales_rep_id WHERE year(order_date) = 2000 AND isodow(order_date) > 5 GROUP BY ALL),
t AS (SELECT region, month_start AS month, sum(target_amount) AS target
      FROM targets LEFT JOIN reps USING (rep_id) WHERE year(month_start) = 2000 AND isodow(month_start) > 5 GROUP BY ALL)
SELECT region, {iso("month")} AS month, {dbl("revenue")} AS revenue, {dbl("target")} AS target,
       {up(ratio("revenue", "target"), 4)} AS attainment
FROM s FULL JOIN t USING (region, month)"""
_SUB = "region, category, grouping(region) = 1 AS region_total, grouping(category) = 1 AS category_total"
_CUBE = "GROUP BY GROUPING SETS ((region, category), (region), (category), ())"
ORACLE["core_totals_subtotals"] = f"""
WITH {SALES}, {PRODUCTS}
SELECT {_SUB}, {dbl("sum(revenue)")} AS revenue, sum(quantity) AS units FROM {FULL} {_CUBE}"""
ORACLE["gross_margin_subtotals"] = f"""
WITH {SALES}, {PRODUCTS},
m AS (
  SELECT {_SUB}, sum(CAST(revenue AS DOUBLE) - quantity * CAST(unit_cost AS DOUBLE)) AS margin, sum(revenue) AS revenue
  FROM {FULL} {_CUBE}
)
SELECT region, category, region_total, category_total, {up("margin", 2)} AS gross_margin,
       {up(ratio("margin", "revenue"), 4)} AS gross_margin_pct
FROM m"""
# Every level's own months, laid beside those of a year before.
_LEVELS = f"""{SALES}, {PRODUCTS},
lv AS (
  SELECT {_SUB}, CAST(date_trunc('month', order_date) AS DATE) AS month, sum(revenue) AS revenue
  FROM {FULL} GROUP BY GROUPING SETS ((region, category, month), (region, month), (category, month), (month))
),
keyed AS (SELECT *, concat_ws('|', coalesce(region, '-'), coalesce(category, '-'), region_total, category_total) AS id FROM lv),
ids AS (SELECT DISTINCT id, region, category, region_total, category_total FROM keyed),
cal AS (SELECT CAST(unnest(range(DATE '1999-01-01', DATE '2001-01-01', INTERVAL 1 MONTH)) AS DATE) AS month),
cells AS (
  SELECT ids.*, cal.month, a.revenue, b.revenue AS revenue_py
  FROM ids CROSS JOIN cal LEFT JOIN keyed a ON a.id = ids.id AND a.month = cal.month
  LEFT JOIN keyed b ON b.id = ids.id AND b.month = CAST(cal.month - INTERVAL 1 YEAR AS DATE)
)"""
_KEYS = "region, category, region_total, category_total"
ORACLE["revenue_yoy_subtotals"] = f"""
WITH {_LEVELS}
SELECT {_KEYS}, {_QUARTER} AS quarter, {dbl("sum(revenue)")} AS revenue, {dbl("sum(revenue_py)")} AS revenue_py,
       {up(ratio("coalesce(sum(revenue), 0) - coalesce(sum(revenue_py), 0)", "sum(revenue_py)"), 4)} AS revenue_yoy
FROM cells GROUP BY ALL HAVING count(revenue) + count(revenue_py) > 0"""
ORACLE["rolling_3m_subtotals"] = f"""
WITH {_LEVELS}
SELECT {", ".join("c." + k for k in _KEYS.split(", "))}, {iso("c.month")} AS month, {dbl("sum(r.revenue)")} AS rolling_revenue
FROM cells c JOIN keyed r ON r.id = c.id AND r.month <= c.month AND r.month > CAST(c.month - INTERVAL 3 MONTH AS DATE)
GROUP BY ALL"""
ORACLE["revenue_gap_subtotals"] = f"""
WITH {_LEVELS},
growth AS (
  SELECT id, {ratio("sum(revenue) FILTER (WHERE month BETWEEN DATE '2000-01-01' AND DATE '2000-06-01')",
                    "sum(revenue) FILTER (WHERE month BETWEEN DATE '1999-01-01' AND DATE '1999-06-01')")} AS g
  FROM keyed GROUP BY id
),
y AS (
  SELECT id, {_KEYS}, year(month) AS year, sum(revenue) AS revenue, CAST(sum(revenue_py) AS DOUBLE) AS py FROM cells
  GROUP BY ALL HAVING count(revenue) + count(revenue_py) > 0
)
SELECT {_KEYS}, year, {dbl("revenue")} AS revenue, {up("py * g", 2)} AS expected,
       CASE WHEN revenue IS NOT NULL OR py * g IS NOT NULL
            THEN {up("coalesce(CAST(revenue AS DOUBLE), 0) - coalesce(py * g, 0)", 2)} END AS gap
FROM y LEFT JOIN growth USING (id)"""
ORACLE["attainment_subtotals"] = f"""
WITH {LINES}, {TARGETS}, {REPS}, {PRODUCTS},
s AS (SELECT reps.region, category, revenue FROM lines LEFT JOIN reps ON rep_id = sales_rep_id LEFT JOIN products USING (sku)),
r AS (SELECT {_SUB}, sum(revenue) AS revenue FROM s {_CUBE}),
t AS (SELECT region, grouping(region) = 1 AS region_total, sum(target_amount) AS target
      FROM targets LEFT JOIN reps USING (rep_id) GROUP BY GROUPING SETS ((region), ()))
SELECT coalesce(r.region, t.region) AS region, category, coalesce(r.region_total, t.region_total) AS region_total,
       coalesce(category_total, true) AS category_total, {dbl("revenue")} AS revenue, {dbl("target")} AS target,
       {up(ratio("revenue", "target"), 4)} AS attainment
FROM r FULL JOIN t ON r.region IS NOT DISTINCT FROM t.region AND r.region_total = t.region_total"""
_BY_REP = "GROUP BY GROUPING SETS ((region, rep_id, year), (region, rep_id), (region, year), (rep_id, year), (region), (rep_id), (year), ())"
ORACLE["attainment_subtotals_by_rep"] = f"""
WITH {LINES}, {TARGETS}, {REPS},
u AS (
  SELECT region, sales_rep_id AS rep_id, year(order_date) AS year, revenue, NULL AS target
  FROM lines LEFT JOIN reps ON rep_id = sales_rep_id
  UNION ALL SELECT region, rep_id, year(month_start), NULL, target_amount FROM targets LEFT JOIN reps USING (rep_id)
)
SELECT region, rep_id, year, grouping(region) = 1 AS region_total, grouping(rep_id) = 1 AS rep_id_total,
       grouping(year) = 1 AS year_total, {dbl("sum(revenue)")} AS revenue, {dbl("sum(target)")} AS target,
       {up(ratio("sum(revenue)", "sum(target)"), 4)} AS attainment
FROM u {_BY_REP}"""

# ---- storage ----------------------------------------------------------------------

ORACLE["rejected_rows"] = f"""
SELECT {x.UNEVEN_LINE} AS text,
       CASE WHEN l_orderkey % 97 = 0 THEN '2 fields instead of 3' ELSE '4 fields instead of 3' END AS reason
FROM lineitem WHERE l_orderkey % 97 = 0 OR l_orderkey % 89 = 0"""
ORACLE["late_months_rollup"] = f"""
WITH {SALES}
SELECT region, strftime(date_trunc('month', order_date), '%Y-%m-%d') AS month, {dbl("sum(revenue)")} AS revenue, sum(quantity) AS units
FROM sales WHERE order_id % 10 <> 0 OR order_date BETWEEN DATE '2000-01-01' AND DATE '2000-06-30' GROUP BY ALL"""

# ---- data that keeps coming, long maps, long series -------------------------------

ORACLE["median_after_delivery"] = f"""
WITH {PARSED_SALES}
SELECT sku, channel, usual AS median FROM usual WHERE sku IS NOT NULL AND channel IS NOT NULL AND usual IS NOT NULL"""
ORACLE["repairs_after_delivery"] = f"""
WITH {PARSED_SALES},
first_lines AS (SELECT order_id, sku, channel, quantity FROM parsed WHERE order_id NOT LIKE '%7'),
then_usual AS (SELECT sku, channel, median(quantity) AS then_usual FROM first_lines GROUP BY ALL)
SELECT order_id, sku, channel, quantity, {_REPAIRED} AS repaired, {_FLAG} AS qty_flag
FROM first_lines JOIN usual USING (sku, channel) LEFT JOIN then_usual USING (sku, channel)
WHERE ({_REPAIRED}) IS DISTINCT FROM ({_REPAIRED.replace("usual", "then_usual")})
   OR ({_FLAG}) IS DISTINCT FROM ({_FLAG.replace("usual", "then_usual")})"""
ORACLE["duplicates_by_digest"] = f"""
WITH {RAW_SALES} SELECT {all_present(x.sales_texts("duckdb"))}, count(*) AS copies FROM raw_sales GROUP BY ALL"""
ORACLE["standardise_by_index"] = """
WITH names AS (SELECT p_partkey, p_name || ' No ' || p_partkey AS name FROM part)
SELECT p_partkey, name, 'label ' || (max(i) % 1000) AS label
FROM names JOIN range(20000) r(i) ON contains(name, CAST(i AS VARCHAR)) GROUP BY ALL"""
ORACLE["interpolate_long_series"] = f"""
WITH {REP_MONTHS},
gappy AS (
  SELECT s_suppkey * 1000 + idx - CASE WHEN {x.TARGET_AGAIN} THEN 1 ELSE 0 END AS place,
         CASE WHEN {x.TARGET_GAP} THEN NULL ELSE {dbl(x.TARGET)} END AS target_amount
  FROM rep_months WHERE NOT ({x.TARGET_NOBODY}) AND NOT ({x.TARGET_UNDATED})
),
one AS (SELECT 1 AS rep_id, place AS month_start, max(target_amount) AS target_amount FROM gappy GROUP BY place), {interpolated("one")}
SELECT CAST(month_start AS BIGINT) AS place, {up("target_amount", 4)} AS target_amount FROM filled"""
ORACLE["daily_series"] = f"""
WITH {SALES},
d AS (SELECT region, order_date, sum(revenue) AS revenue FROM sales GROUP BY ALL)
SELECT region, {iso("order_date")} AS order_date, {dbl("revenue")} AS revenue,
       {dbl("lag(revenue) OVER w")} AS day_before, {dbl("lag(revenue, 7) OVER w")} AS week_before,
       {dbl("sum(revenue) OVER (PARTITION BY region ORDER BY order_date)")} AS so_far
FROM d WINDOW w AS (PARTITION BY region ORDER BY order_date)"""
