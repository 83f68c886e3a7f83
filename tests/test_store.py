"""Publishing of clean tables: failed runs, late months, row order, rejected rows, counts taken while writing."""

import csv
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from retail_lens.plans import cleaning, pipeline, quality
from retail_lens.plans.model import monthly_facts
from retail_lens.sources.files import file_borders, scan_csv_checked
from retail_lens.sources.schemas import CLEAN, RAW
from retail_lens.sources.store import Store

HEADERS = {name: schema.names for name, schema in RAW.items()}
SALES = [
    [f"O{i:03d}", f"2026-0{1 + i % 3}-{1 + i * 7 % 28:02d}", f"C{i % 3}", "Accra", "kiosk", f"SKU{i % 2}", str(1 + i % 5), "10", "0", f"R{i % 2}"]
    for i in range(60)
]


def write_raw(folder, sales=SALES, broken=()):
    rows = {
        "sales_transactions_raw": [*sales, *sales[:2], *broken],
        "products_raw": [["sku0", "a", "beverages", "GHS 5", "3", "6"], ["sku1", "b", "Snacks", "7", "4", "6"]],
        "customers_raw": [["c0", "x", "Accra", "kiosk", "R0"], ["c1", "y", "Volta", "retail", "R1"], ["c1", "y", "Volta", "retail", "R2"]],
        "sales_reps_raw": [["R0", "a", "Accra", "2020-01-01"], ["R1", "b", "Volta", "2021-01-01"]],
        "sales_targets_raw": [[r, m, a] for r in ("R1", "R0") for m, a in (("2026-02", ""), ("2026-01", "100"), ("2026-03", "300"))],
        "deliveries_raw": [[f"D{i}", "sku0", "Accra", f"2026-0{1 + i % 3}-02", f"2026-0{1 + i % 3}-09", "10", "9", "N/A"] for i in range(6)],
    }
    os.makedirs(folder, exist_ok=True)
    for name, lines in rows.items():
        with open(f"{folder}/{name}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows([HEADERS[name], *lines])
    return str(folder)


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    raw = write_raw(root / "raw", broken=[["O900", "2026-01-01"], ["O901", *SALES[0][1:], "and, more"]])
    pipeline.clean_folder(spark, raw, str(root / "clean"))
    return Store(spark, str(root / "clean"))


def folders(store, table):
    top = f"{store.root}/{table}"
    return {f"{run}/{month}": sorted(os.listdir(f"{top}/{run}/{month}")) for run in os.listdir(top) for month in os.listdir(f"{top}/{run}") if month.startswith("month=")}


def rows(df):
    return sorted(map(str, df.collect()))


def test_files_in_name_order_are_in_row_order(spark, published):
    store = published
    for table, keys in (("fact_sales", ["order_date", "order_id"]), ("fact_targets", ["rep_id", "month_start"])):
        stored = store.read(table)
        borders = file_borders(stored, keys).collect()
        assert borders and all(b.in_order for b in borders)
        read = [r for b in borders for r in spark.read.parquet(b.file).select(*keys).toPandas().itertuples(index=False)]
        assert read == sorted(read) and len(read) == stored.count()


def test_row_order_survives_many_tasks(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("order_id"), F.expr("date_add(DATE '2026-01-01', int(id % 50))").alias("order_date"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run = Store(spark, str(tmp_path)).start()
        run.write_months(df, "t", order=["order_id"])
        run.publish()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    borders = file_borders(Store(spark, str(tmp_path)).read("t"), ["order_date", "order_id"]).collect()
    assert len(borders) > 3 and all(b.in_order for b in borders)


def test_rejected_rows_are_kept_and_logged(spark, published, tmp_path):
    rejected = {r.text: r for r in published.read("rejected_rows").collect()}
    assert {(r.table, r.reason) for r in rejected.values()} == {("sales", "2 fields instead of 10"), ("sales", "11 fields instead of 10")}
    assert "O900,2026-01-01" in rejected and all(r.file.endswith("sales_transactions_raw.csv") and r.block == 0 for r in rejected.values())
    assert published.read("fact_sales").where("order_id like 'O9%'").isEmpty()
    log = {(r.table, r.rule): r.rows_affected for r in published.read("data_quality_log").collect()}
    assert log["sales", "malformed"] == 2 and log["sales", "duplicates"] == 2 and log["customers", "conflicting_rep"] == 1
    path = tmp_path / "w.csv"
    path.write_text('b,a,c\n1,2,3\n"x,y",5,6\n7\n"8,9",10\n1,2,3,4\n,,\n')
    found = scan_csv_checked(spark, str(path), ["a"]).collect()
    assert [(r.a, r.reject and r.reject.reason) for r in found if not r.reject] == [("2", None), ("5", None), (None, None)]
    assert sorted(r.reject.text for r in found if r.reject) == ['"8,9",10', "1,2,3,4", "7"]


def test_counts_taken_while_writing_equal_an_aggregation(spark, published, tmp_path):
    raw = pipeline.read_raw(spark, write_raw(tmp_path / "raw"))
    flagged = {
        "products": cleaning.flag_products(raw["products_raw"]),
        "customers": cleaning.flag_customers(raw["customers_raw"]),
        "sales_reps": cleaning.flag_reps(raw["sales_reps_raw"]),
        "sales": cleaning.mark_sales(raw["sales_transactions_raw"]),
        "targets": cleaning.parse_targets(raw["sales_targets_raw"]),
        "deliveries": cleaning.flag_deliveries(raw["deliveries_raw"]),
    }
    stored = published.read("data_quality_log").where("rule <> 'malformed'")
    assert rows(stored) == rows(quality.quality_log(flagged))
    summary = {r.table: (r.rows_before, r.rows_after) for r in published.read("quality_summary").collect()}
    assert summary == {"sales": (64, 60), "products": (2, 2), "customers": (3, 3), "sales_reps": (2, 2), "targets": (6, 6), "deliveries": (6, 6)}


def test_counts_of_empty_tables(spark):
    watch = quality.Watch()
    watch.count("sales_reps", cleaning.flag_reps(spark.createDataFrame([], RAW["sales_reps_raw"])))
    watch.count("deliveries", cleaning.flag_deliveries(spark.createDataFrame([], RAW["deliveries_raw"])))
    assert watch.log(spark).isEmpty()
    assert {tuple(r) for r in watch.summary(spark).collect()} == {("sales_reps", 0, 0), ("deliveries", 0, 0)}


def test_a_failed_run_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    raw, clean = write_raw(tmp_path / "raw"), str(tmp_path / "clean")
    pipeline.clean_folder(spark, raw, clean)
    store = Store(spark, clean)
    before = {name: rows(store.read(name)) for name in CLEAN}
    reading = store.read("fact_sales")
    write_raw(tmp_path / "raw", sales=SALES[:5])

    def broken(*args, **kwargs):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(quality.Watch, "log", broken)  # after all facts and dimensions
        with pytest.raises(OSError):
            pipeline.clean_folder(spark, raw, clean)
    assert {name: rows(store.read(name)) for name in CLEAN} == before
    pipeline.clean_folder(spark, raw, clean)
    assert store.read("fact_sales").count() == 5
    assert reading.count() == 60  # a reader at work keeps its folders
    old = store.drop_unpublished(keep=1)
    assert old and store.read("fact_sales").count() == 5 and all(len(os.listdir(f"{clean}/{t}")) == 1 for t in CLEAN)


def test_two_runs_at_once(spark, tmp_path):
    store, one = Store(spark, str(tmp_path)), spark.range(1)
    a, b = store.start(), store.start()
    for run in (a, b):
        run.write(one, "t")
    a.publish()
    with pytest.raises(RuntimeError, match="another run"):
        b.publish()
    with pytest.raises(FileNotFoundError):
        store.read("unknown")


def test_a_late_month_rewrites_its_folder_alone(spark, published, tmp_path):
    raw, clean = write_raw(tmp_path / "raw", sales=[r for r in SALES if not r[0].endswith("7")]), str(tmp_path / "clean")
    pipeline.clean_folder(spark, raw, clean)
    store = Store(spark, clean)
    tables = ["fact_sales", "monthly_sales"]
    before, old = {t: folders(store, t) for t in tables}, rows(store.read("fact_sales").where("month <> DATE '2026-02-01'"))
    write_raw(tmp_path / "raw")  # the rest of the orders has come
    pipeline.clean_folder(spark, raw, clean, months=[date(2026, 2, 1)])
    for t in tables:
        after = folders(store, t)
        assert {k: after[k] for k in before[t]} == before[t]
        assert [k.split("/")[1] for k in after if k not in before[t]] == ["month=2026-02-01"]
    late = store.read("fact_sales")
    assert rows(late.where("month <> DATE '2026-02-01'")) == old
    assert late.where("month = DATE '2026-02-01'").count() == sum(r[1].startswith("2026-02") for r in SALES)
    # The roll-up refreshed for one month equals one made anew.
    assert rows(store.read("monthly_sales").drop("month")) == rows(monthly_facts(late))
    february = F.col("month") == date(2026, 2, 1)
    assert rows(late.where(february)) == rows(published.read("fact_sales").where(february))
    # A month that lost all its rows is gone.
    run = store.start()
    run.write_months(late.drop("month").where("false"), "fact_sales", months=[date(2026, 2, 1)])
    pipeline.roll_up_months(run, [date(2026, 2, 1)])
    run.publish()
    assert store.read("fact_sales").where(february).isEmpty() and store.read("monthly_sales").where(february).isEmpty()
    assert rows(store.read("fact_sales")) == old


def test_a_long_label_map_cleans_like_a_short_one(spark, tmp_path):
    more = {f"no such place {i}": "x" for i in range(200)}
    rules = cleaning.CleaningRules(regions=more | cleaning.REGION_LABELS, channels=more | cleaning.CHANNEL_LABELS)
    raw = pipeline.read_raw(spark, write_raw(tmp_path / "raw"))
    for flag, table in ((cleaning.flag_customers, "customers_raw"), (cleaning.parse_sales, "sales_transactions_raw"), (cleaning.flag_deliveries, "deliveries_raw")):
        assert rows(flag(raw[table], rules)) == rows(flag(raw[table]))
