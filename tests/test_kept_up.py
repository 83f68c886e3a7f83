"""Medians that take in deliveries, duplicates by digest, long label maps, long series."""

import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lens.functions import ordering
from retail_lens.functions.text import dated_rows, match_label, parse_dates
from retail_lens.operators.dedupe import collapse_by_digest, collapse_copies
from retail_lens.operators.interpolate import interpolate
from retail_lens.operators.labels import CHAIN, indexed_labels, with_label
from retail_lens.operators.medians import group_median
from retail_lens.operators.series import interpolate_series, lag_series, running_series
from retail_lens.plans.cleaning import CHANNEL_LABELS, REGION_LABELS
from retail_lens.plans.maintained import MaintainedMedian, changed_repairs
from retail_lens.session import Staging
from retail_lens.sources.store import Store


def rows(df):
    return sorted(map(str, df.collect()))


# ---- medians ----------------------------------------------------------------------


def test_medians_kept_up_equal_a_full_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordering, "SMALL", 20)
    rnd = random.Random(4)
    lots = [
        [(rnd.choice([None, "a", "b"]), rnd.choice(groups), rnd.choice([None, float("nan"), 1.0, 2.0, 3.5, 4.0, 900.0, float(rnd.randint(0, 99))])) for _ in range(n)]
        for n, groups in ((300, "xyz"), (40, "x"), (0, "x"), (25, "yw"), (1, "q"))
    ]
    usual = MaintainedMedian("usual", ("sku", "channel"), "quantity")
    store, seen = Store(spark, str(tmp_path)), []
    for lot in lots:
        schema = "sku string, channel string, quantity double"
        old = {tuple(r)[:2]: r.median for r in usual.medians(store).collect()} if seen else {}
        before = spark.createDataFrame(seen, schema)
        run = store.start()
        changes = usual.add(run, spark.createDataFrame(lot, schema))
        run.publish()
        seen += lot
        want = {tuple(r)[:2]: r.median for r in group_median(spark.createDataFrame(seen, schema), ["sku", "channel"], "quantity").collect()}
        assert {tuple(r)[:2]: r.median for r in usual.medians(store).collect()} == want
        moved = {tuple(r)[:2]: (r.before, r.after) for r in changes.collect()}
        assert moved == {k: (old.get(k), m) for k, m in want.items() if old.get(k) != m}
        assert set(moved) <= {r[:2] for r in lot}
        if old:
            listed = changed_repairs(before, changes, ["sku", "channel"], "quantity", factor=3.0)

            def repaired(quantity, median):
                if quantity is None:
                    return median, "imputed"
                return (median, "outlier_fixed") if median is not None and not quantity <= 3 * median else (quantity, "")

            expect = [
                (*r, *repaired(r[2], want.get(r[:2])))
                for r in before.collect()
                if None not in r[:2] and str(repaired(r[2], old.get(r[:2]))) != str(repaired(r[2], want.get(r[:2])))
            ]
            assert rows(listed) == sorted(map(str, spark.createDataFrame(expect, listed.schema).collect()))


def test_a_delivery_looks_up_its_own_groups_only(spark, tmp_path):
    usual, store, schema = MaintainedMedian("usual", ("sku",), "v"), Store(spark, str(tmp_path)), "sku string, v double"
    for lot in ([("a", 1.0), ("b", 2.0)], [("b", 4.0)]):
        run = store.start()
        usual.add(run, spark.createDataFrame(lot, schema))
        run.publish()
    assert len(os.listdir(tmp_path / "usual_counts")) == 2  # counts are added to, not written again
    assert {tuple(r) for r in store.read("usual_counts").collect()} == {("a", 1.0, 1), ("b", 2.0, 1), ("b", 4.0, 1)}


# ---- duplicates -------------------------------------------------------------------


@pytest.mark.parametrize("digest", ["own", "colliding", "constant"])
def test_duplicates_by_digest_are_the_same_rows(spark, digest):
    rnd = random.Random(1)
    data = [(rnd.choice([None, "", "a", "b"]), rnd.choice([None, "", "a"]), rnd.choice([None, str(rnd.randint(0, 400))])) for _ in range(900)]
    df = spark.createDataFrame(data, "a string, b string, `odd.name` string").repartition(5)
    more = {"colliding": lambda d: F.pmod(F.hash("a"), F.lit(3)), "constant": lambda d: F.lit(1)}
    got = collapse_by_digest(df, stage=Staging(spark), **({"digest": more[digest]} if digest in more else {}))
    assert rows(got) == rows(df.groupBy("a", "b", "`odd.name`").agg(F.count("*").alias("copies")))
    assert collapse_by_digest(df.where("false")).isEmpty() and rows(collapse_copies(df.limit(0))) == []


SHUFFLE = """
import sys
from pyspark.sql import functions as F
from retail_lens.operators.dedupe import collapse_by_digest, collapse_copies
from retail_lens.session import Staging, get_spark
way, folder = sys.argv[1:]
spark = get_spark(master="local[4]", spark__ui__enabled="false", spark__eventLog__enabled="true", spark__eventLog__dir=folder,
                  spark__eventLog__compress="false", spark__sql__shuffle__partitions="4")
sales = spark.range(60_000).select(*[F.concat(F.lit(n), F.sha1(F.concat(F.lit(n), F.col("id").cast("string")))).substr(1, 14).alias(n) for n in "abcdefghij"])
sales = sales.unionByName(sales.where("a < 'a08'"))
stage = Staging(spark)
raw = stage(sales, "raw")
df = collapse_copies(raw) if way == "rows" else collapse_by_digest(raw, stage=stage)
df.write.format("noop").mode("overwrite").save()
spark.stop()
"""


def test_duplicates_by_digest_shuffle_a_fifth(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    written = {}
    for way in ("rows", "digest"):
        (tmp_path / way).mkdir()
        subprocess.run([sys.executable, "-c", SHUFFLE, way, str(tmp_path / way)], cwd=root, check=True, capture_output=True, timeout=200)
        logs = [os.path.join(d, f) for d, _, files in os.walk(tmp_path / way) for f in files if not f.startswith((".", "appstatus"))]
        events = [json.loads(line) for log in logs for line in open(log)]
        written[way] = sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in events if e["Event"] == "SparkListenerTaskEnd")
    assert 0 < written["digest"] * 5 <= written["rows"], written


# ---- labels -----------------------------------------------------------------------


@pytest.mark.parametrize("squeeze", [False, True])
def test_indexed_labels_equal_the_chain(spark, squeeze):
    rnd = random.Random(2)
    letters = "ab c"
    texts = [None, "", " ", "GT. ACCRA ", "Retail  Shop", "whole sale", *("".join(rnd.choices(letters, k=rnd.randint(0, 9))) for _ in range(200))] * 2
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, t string, _key string")
    maps = [REGION_LABELS, CHANNEL_LABELS, {}, {"": "any", "ab": "AB"}, {"".join(rnd.choices(letters, k=rnd.randint(1, 5))): str(i) for i in range(60)}]
    for labels in maps:
        got = indexed_labels(df, "t", labels, "label", squeeze, Staging(spark)) if labels else with_label(df, "t", labels, "label", squeeze)
        assert rows(got) == rows(df.withColumn("label", match_label(F.col("t"), labels, squeeze)))


def test_labels_by_the_thousand(spark):
    labels = {f"outlet {i:05d}": f"L{i % 9}" for i in range(20_000)} | {"outlet 0": "any"}
    assert len(labels) > CHAIN
    df = spark.createDataFrame([(f"the OUTLET {i * 37:05d} north",) for i in range(500)] + [("nothing",), (None,)], "t string")
    got = {r.t: r.label for r in with_label(df, "t", labels, "label").collect()}
    for text, label in got.items():
        hits = [v for k, v in labels.items() if text and k in text.lower()]
        assert label == (hits[-1] if hits else None)


# ---- series -----------------------------------------------------------------------

SERIES = "k string, at int, v decimal(12,2), n int"


@pytest.fixture
def series(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SMALL", 10)
    rnd = random.Random(6)
    data = [(k, at, rnd.choice([None, None, rnd.randint(0, 999)]), i) for k, size in (("long", 900), ("short", 6), (None, 300), ("none", 0)) for i, at in enumerate(rnd.sample(range(5000), size))]
    data += [("long", None, 5, 1), ("long", None, None, 2), ("long", 17, 3, 1), ("long", 17, 9, 2), ("blank", 1, None, 1), ("blank", 2, None, 2)]
    return spark.createDataFrame([(k, at, None if v is None else __import__("decimal").Decimal(v), n) for k, at, v, n in data], SERIES).repartition(4)


def test_interpolation_over_buckets_equals_one_window(spark, series):
    known = series.where("k is not null").withColumn("v", F.col("v").cast("double"))
    got = interpolate_series(known, ["k"], "at", "v", Staging(spark), ties=["n"])
    want = interpolate(known, ["k"], "at", "v")
    digits = [F.round("v", 6).alias("v") if c == "v" else c for c in known.columns]
    assert rows(got.select(*digits)) == rows(want.select(*digits))
    plan = got._jdf.queryExecution().toString()
    assert "_bucket" in plan and interpolate_series(known.where("false"), ["k"], "at", "v", Staging(spark)).isEmpty()


@pytest.mark.parametrize("keys", [["k"], []])
def test_lags_and_running_sums_over_buckets_equal_one_window(spark, series, keys):
    rest = [c for c in ("v", "n", "k") if c not in keys]
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("at"), *[F.asc_nulls_last(c) for c in rest])
    got = lag_series(series, keys, "at", "v", {"one": 1, "year": 365}, Staging(spark), ties=rest)
    assert rows(got) == rows(series.withColumns({"one": F.lag("v", 1).over(order), "year": F.lag("v", 365).over(order)}))
    got = running_series(series, keys, "at", {"so_far": "v"}, Staging(spark), ties=rest)
    assert rows(got) == rows(series.withColumn("so_far", F.sum("v").over(order.rowsBetween(Window.unboundedPreceding, 0))))


def test_a_long_series_is_spread(spark):
    df = spark.range(200_000).select(F.col("id").alias("at"), F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).alias("v"))
    got = interpolate_series(df, [], "at", "v", Staging(spark))
    assert got.where("abs(v - at) > 0.001").count() == 1  # after the last known value it stays
    cut = ordering.bucketed(df.withColumn("k", F.lit("")), ["k"], "at").groupBy("_bucket").count()
    assert cut.agg(F.max("count")).first()[0] < 3 * 200_000 / ordering.BUCKETS


def test_dated_rows_parse_once(spark):
    df = spark.createDataFrame([("a", "2026-01-02"), ("b", "31/12/2025"), ("c", "?"), ("d", None)], "id string, day string")
    got = dated_rows(df, "day")
    assert got.columns == ["id", "day"] and rows(got) == rows(df.withColumn("day", parse_dates(F.col("day"))).where("day is not null"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MMM d, yyyy") <= df.select(parse_dates(F.col("day")))._jdf.queryExecution().optimizedPlan().toString().count("MMM d, yyyy")


def test_median_counts_are_shuffled_once(spark, tmp_path):
    spark.range(2000).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").cast("double").alias("v")).write.parquet(str(tmp_path / "rows"))
    median = group_median(spark.read.parquet(str(tmp_path / "rows")), ["k"], "v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = median._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
    assert {r.k: r.median for r in median.collect()} == {"0": 999.0, "1": 1000.0, "2": 999.5}
