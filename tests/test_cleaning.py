"""Cleaning pipelines, the quality log and the end-to-end run on a small untidy set."""

import os
from datetime import date
from decimal import Decimal

import duckdb
import pytest

from retail_lens.functions.months import Period, PeriodSpec, during
from retail_lens.plans import cleaning, pipeline, quality
from retail_lens.plans.model import Focus
from retail_lens.session import Staging, unstaged
from retail_lens.sources.catalog import load_clean, load_clean_csv, register_views, row_counts
from retail_lens.sources.store import Store
from retail_lens.sources.files import malformed_rows, scan_csv_text, write_csv
from retail_lens.sources.schemas import CLEAN, RAW

CUSTOMERS = [
    ("C001", "NANA'S MINI MART", "ASHANTI", "Super Market", "R1"),
    (" c002", "  Unity Store  ", "Gt. Accra", "retail", "R2"),
]
PRODUCTS = [("sku001", "Water", "beverages", "GHS 18.00", "12.5", "12"), ("SKU002 ", "Rice", "FOOD", "88.0", "68.0", "1")]
REPS = [("R1", "JANE MILLER", "ashanti region", "15/05/2020"), ("R2", " joe smith", "Accra", "2021-01-02")]
TARGETS = [
    ("R1", "Jan-2026", "1,000"),
    ("R1", "2026-02", ""),
    ("R1", "Mar-2026", "3,000"),
    ("R2", "Jan-2026", ""),
    ("R2", "Feb-2026", "500"),
]
SALES = [
    ("S1", "2026-01-05", "C001", "Ashanti ", "supermarket", "SKU001", "8", "10.00", "5", "R1"),
    ("S1", "2026-01-05", "C001", "Ashanti ", "supermarket", "SKU001", "8", "10.00", "5", "R1"),
    ("S2", "06/01/2026", " c001 ", "Ashanti", "Supermarket", "sku001 ", "-8", "GHS 12.00", "5%", None),
    ("S3", "Jan 07, 2026", "C001", "Ashanti", "Supermarket", "SKU001", "800", None, None, "R1"),
    ("S4", "08-Jan-26", "C001", "Ashanti", "Supermarket", "SKU001", None, "11.00", "0", "R1"),
    ("S5", "N/A", "C001", "Ashanti", "Supermarket", "SKU001", "9000", "1.00", "0", None),
    ("S6", "2026-02-01", "C002", "accra", "Retail shop", "SKU002", "3 ctn", "90.25", "10", "N/A"),
    ("S7", "2026-02-02", "C777", "Nowhere", "Kiosk", "SKU002", "4", "90", "0", None),
]
DELIVERIES = [
    ("D1", "SKU001", "ashanti", "2026-01-01", "05/01/2026", "100", "80", "2"),
    ("D1", "SKU001", "ashanti", "2026-01-01", "05/01/2026", "100", "80", "2"),
    ("D2", "sku002 ", "Volta Region", "2026-01-02", "Jan 04, 2026", "3", "N/A", "n/a"),
]
ROWS = {
    "customers_raw": CUSTOMERS,
    "products_raw": PRODUCTS,
    "sales_reps_raw": REPS,
    "sales_targets_raw": TARGETS,
    "sales_transactions_raw": SALES,
    "deliveries_raw": DELIVERIES,
}


@pytest.fixture(scope="module")
def raw(spark):
    return {name: spark.createDataFrame(rows, RAW[name]) for name, rows in ROWS.items()}


def test_clean_dimensions(raw):
    customers = cleaning.clean_customers(raw["customers_raw"]).orderBy("customer_id").collect()
    assert [tuple(r) for r in customers] == [
        ("C001", "Nana'S Mini Mart", "Ashanti", "Supermarket", "R1"),
        ("C002", "Unity Store", "Greater Accra", "Retail Shop", "R2"),
    ]
    products = cleaning.clean_products(raw["products_raw"]).orderBy("sku").collect()
    assert [tuple(r) for r in products] == [
        ("SKU001", "Water", "Beverages", 18.0, 12.5, 12),
        ("SKU002", "Rice", "Food", 88.0, 68.0, 1),
    ]
    reps = cleaning.clean_reps(raw["sales_reps_raw"]).orderBy("rep_id").collect()
    assert [tuple(r) for r in reps] == [
        ("R1", "Jane Miller", "Ashanti", date(2020, 5, 15)),
        ("R2", "Joe Smith", "Greater Accra", date(2021, 1, 2)),
    ]


@pytest.mark.parametrize("staged", [False, True])
def test_clean_sales(spark, raw, staged):
    customers = cleaning.clean_customers(raw["customers_raw"])
    stage = {"stage": Staging(spark) if staged else unstaged}
    rows = {r.order_id: r for r in cleaning.clean_sales(raw["sales_transactions_raw"], customers, **stage).collect()}
    assert set(rows) == {"S1", "S2", "S3", "S4", "S6", "S7"}
    assert rows["S1"].revenue == Decimal("76.00")
    assert (rows["S2"].quantity, rows["S2"].sales_rep_id, rows["S2"].sku) == (8.0, "R1", "SKU001")
    # median of 8, 8, 800 is 8; the undated 9000 takes no part
    assert (rows["S3"].quantity, rows["S3"].qty_flag, rows["S3"].unit_price) == (8.0, "outlier_fixed", 11.0)
    assert (rows["S4"].quantity, rows["S4"].qty_flag) == (8.0, "imputed")
    assert (rows["S6"].quantity, rows["S6"].sales_rep_id, rows["S6"].region) == (3.0, "R2", "Greater Accra")
    assert rows["S6"].revenue == Decimal("243.68") or rows["S6"].revenue == Decimal("243.67")
    assert (rows["S7"].sales_rep_id, rows["S7"].region) == (None, None)


def test_clean_targets_and_deliveries(raw):
    targets = {(r.rep_id, r.month_start.month): r.target_amount for r in cleaning.clean_targets(raw["sales_targets_raw"]).collect()}
    assert targets == {("R1", 1): 1000, ("R1", 2): 2000, ("R1", 3): 3000, ("R2", 1): 500, ("R2", 2): 500}
    deliveries = {r.delivery_id: r for r in cleaning.clean_deliveries(raw["deliveries_raw"]).collect()}
    assert (deliveries["D1"].lead_time_days, deliveries["D1"].fill_rate) == (4, 0.8)
    assert (deliveries["D2"].qty_delivered, deliveries["D2"].fill_rate, deliveries["D2"].sku) == (None, None, "SKU002")


def test_quality_log(raw):
    customers = cleaning.flag_customers(raw["customers_raw"])
    log = quality.quality_log(
        {
            "customers": customers,
            "sales": cleaning.mark_sales(raw["sales_transactions_raw"]),
            "targets": cleaning.parse_targets(raw["sales_targets_raw"]),
            "deliveries": cleaning.flag_deliveries(raw["deliveries_raw"]),
        }
    )
    counts = {(r.table, r.rule): r.rows_affected for r in log.collect()}
    assert {rule: counts.get(("sales", rule), 0) for rule in quality.SALES_RULES} == {
        "duplicates": 1,
        "undated": 1,
        "relabelled": 3,
        "unknown_label": 1,
        "negative_quantity": 1,
        "outlier": 1,
        "missing_quantity": 1,
        "missing_price": 1,
        "missing_discount": 1,
        "missing_rep": 3,
    }
    assert counts["targets", "missing"] == 2
    assert counts["deliveries", "duplicates"] == 1
    assert counts["deliveries", "token_stockout_days"] == 1
    assert ("deliveries", "token_qty_ordered") not in counts
    summary = quality.quality_summary({"sales": cleaning.parse_sales(raw["sales_transactions_raw"])}).first()
    assert (summary.rows_before, summary.rows_after) == (8, 6)


def test_cleaning_clean_data_changes_nothing(spark, raw):
    once = cleaning.clean_customers(raw["customers_raw"])
    assert once.exceptAll(cleaning.clean_customers(once)).count() == 0
    assert cleaning.flag_customers(once).where("changed").count() == 0


def test_csv_round_trip_keeps_blanks_and_nulls(spark, raw, tmp_path):
    path = str(tmp_path / "customers.csv")
    write_csv(raw["customers_raw"], path)
    again = scan_csv_text(spark, path, RAW["customers_raw"].names)
    assert sorted(map(tuple, again.collect())) == sorted(CUSTOMERS)


def test_end_to_end(spark, raw, tmp_path):
    for name, df in raw.items():
        write_csv(df, str(tmp_path / f"raw/{name}.csv"))
    clean, out = str(tmp_path / "clean"), str(tmp_path / "out")
    for _ in range(2):  # a rerun replaces the first result
        pipeline.clean_all(spark, pipeline.read_raw(spark, str(tmp_path / "raw")), clean)
    tables = load_clean(spark, clean)
    stored = {name: [c for c in df.columns if c != "month"] for name, df in tables.items()}
    assert stored == {name: schema.names for name, schema in CLEAN.items()}
    recent = during(tables["fact_sales"], [Period.of("2026-02")])
    assert recent.count() == 2
    plan = recent._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(order_date)" in plan
    register_views(tables)
    assert {r.table: r.row_count for r in row_counts(tables).collect()} == {
        "fact_sales": 6,
        "fact_deliveries": 2,
        "fact_targets": 5,
        "dim_products": 2,
        "dim_customers": 2,
        "dim_reps": 2,
    }
    by_month = spark.sql(
        "SELECT date_format(order_date, 'yyyy-MM') AS ym, SUM(revenue) AS revenue FROM fact_sales GROUP BY ym ORDER BY ym"
    ).collect()
    assert [r.ym for r in by_month] == ["2026-01", "2026-02"]
    assert Store(spark, clean).read("data_quality_log").where("table = 'sales'").count() == 10

    spec = PeriodSpec(Period.of("2026-02"), Period.of("2026-01"), Period.of("2026-03"))
    pipeline.analyse(spark, clean, out, spec, Focus("Ashanti", "Beverages"), date(2026, 2, 1))
    assert set(os.listdir(out)) == set(pipeline.reports(tables, spec, Focus("Ashanti", "Beverages"), date(2026, 2, 1)))

    for name, df in tables.items():
        write_csv(df, str(tmp_path / f"csv/{name}.csv"))
    from_csv = load_clean_csv(spark, str(tmp_path / "csv"))
    assert from_csv["fact_targets"].exceptAll(tables["fact_targets"]).count() == 0


def test_quality_log_joins_no_price_and_no_master(raw):
    plan = quality.quality_log({"sales": cleaning.mark_sales(raw["sales_transactions_raw"])})._jdf.queryExecution().toString()
    assert "usual_quantity" in plan and "usual_price" not in plan and "_found" not in plan


def test_missing_texts_are_nulls_before_copies_are_counted(spark):
    rows = [("D1", "SKU1", "Ashanti", "2026-01-01", "2026-01-02", "1", text, "0") for text in ("N/A", "", None, " null ", "#N/A")]
    flagged = cleaning.flag_deliveries(spark.createDataFrame(rows, RAW["deliveries_raw"])).collect()
    assert [(r.copies, r.token_qty_delivered, r.qty_delivered) for r in flagged] == [(5, True, None)]


def test_labels_from_a_file(spark, tmp_path):
    (tmp_path / "labels.json").write_text('{"regions": {"north": "North"}}')
    rules = cleaning.CleaningRules.from_json(spark, str(tmp_path / "labels.json"))
    assert rules.regions == {"north": "North"} and rules.channels == cleaning.CHANNEL_LABELS
    df = spark.createDataFrame([("C1", "a", "Far North", "kiosk", "R1"), ("C2", "a", "South", "kiosk", "R1"), ("C2", "a", "north", "shop", "R2")], RAW["customers_raw"])
    log = {r.rule: r.rows_affected for r in quality.quality_log({"customers": cleaning.flag_customers(df, rules)}).collect()}
    assert log["unknown_label"] == 2 and log["conflicting_rep"] == 1


def test_csv_by_header_with_quotes_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "p.csv")
    df = spark.createDataFrame([('6" tube, blue', "a", 1.5), ("two\nlines", "b", None)], "name string, sku string, price double")
    write_csv(df, path)
    back = scan_csv_text(spark, path, ["sku", "name"], multi_line=True)
    assert sorted(map(tuple, back.collect())) == [("a", '6" tube, blue'), ("b", "two\nlines")]
    con = duckdb.connect()
    read = con.execute(f"SELECT sku, name FROM read_csv('{path}/*.csv', header=true, quote='\"', escape='\"') ORDER BY 1").fetchall()
    assert read == [("a", '6" tube, blue'), ("b", "two\nlines")]
    with pytest.raises(Exception, match="missing_column"):
        scan_csv_text(spark, path, ["missing_column"], multi_line=True)
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n3\n4,5,6\n7,8\n")
    assert malformed_rows(spark, str(tmp_path / "bad.csv")).first()[0] == 2
