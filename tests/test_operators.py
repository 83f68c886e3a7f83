import math
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from retail_lens.functions.ordering import bucketed
from retail_lens.operators.dedupe import collapse_copies, drop_exact_duplicates
from retail_lens.operators.interpolate import interpolate
from retail_lens.operators.medians import attach_median, group_median
from retail_lens.operators.ranking import rank_descending
from retail_lens.operators.repair import conflicting_keys, is_outlier, lookup_fill, quantity_flag, repair_quantity


def random_rows(seed, n=3000):
    """A third of the rows in one group, values from tiny to huge, nulls in keys and values."""
    rng = random.Random(seed)
    draws = [
        lambda: float(rng.randint(-5, 5)),
        lambda: rng.uniform(-1e9, 1e9),
        lambda: round(rng.uniform(10, 11), 2),
        lambda: None,
    ]
    rows = []
    for _ in range(n):
        group = "hot" if rng.random() < 1 / 3 else rng.choice(["a", "b", "c", None])
        rows.append((group, rng.choice(["x", "y"]), rng.choice(draws)()))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_group_median_against_brute_force(spark, seed):
    rows = random_rows(seed) + [("one", "x", 4.0), ("two", "x", 4.0), ("two", "x", 7.0), ("none", "x", None), ("two", "x", math.nan)]
    groups = defaultdict(list)
    for g, h, v in rows:
        if g is not None and v is not None and not math.isnan(v):
            groups[g, h].append(v)
    df = spark.createDataFrame(rows, "g string, h string, v double")
    got = {(r.g, r.h): r["median"] for r in group_median(df, ["g", "h"], "v").collect()}
    assert got == {k: statistics.median(v) for k, v in groups.items()}


def test_attach_median_keeps_every_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None)], "g string, v double")
    got = {(r.g, r.v, r.m) for r in attach_median(df, ["g"], "v", "m").collect()}
    assert got == {("a", 1.0, 2.0), ("a", 3.0, 2.0), (None, 5.0, None), ("b", None, None)}


@pytest.mark.parametrize("seed", range(3))
def test_rank_descending_against_brute_force(spark, seed):
    rng = random.Random(seed)
    values = [0.0 if rng.random() < 1 / 3 else rng.choice([None, round(rng.uniform(-50, 250), 1)]) for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = {r.i: r.rank for r in rank_descending(df, "v").collect()}
    known = [v for v in values if v is not None]
    want = {i: 1 + (sum(k > v for k in known) if v is not None else len(known)) for i, v in enumerate(values)}
    assert got == want


def test_interpolate(spark):
    rows = [("a", i, v) for i, v in enumerate([None, 10.0, None, None, 40.0, None])]
    rows += [("b", i, None) for i in range(3)] + [("c", i, v) for i, v in enumerate([5.0, None, 1.0])]
    df = spark.createDataFrame(rows, "k string, m int, v double").repartition(3)
    got = defaultdict(list)
    for r in interpolate(df, ["k"], "m", "v").orderBy("k", "m").collect():
        got[r.k].append(r.v)
    assert got == {"a": [10, 10, 20, 30, 40, 40], "b": [None] * 3, "c": [5, 3, 1]}


def test_duplicates(spark):
    rows = [("a", None)] * 5 + [("a", 1), ("b", 1), ("b", 1)]
    df = spark.createDataFrame(rows, "k string, v int")
    once = drop_exact_duplicates(df)
    assert once.count() == 3
    assert drop_exact_duplicates(once).count() == 3
    assert {(r.k, r.v): r.copies for r in collapse_copies(df).collect()} == {("a", None): 5, ("a", 1): 1, ("b", 1): 2}


def test_quantity_repair(spark):
    rows = [(80.0, 8.0), (81.0, 8.0), (None, 8.0), (5.0, None), (None, None)]
    df = spark.createDataFrame(rows, "q double, m double")
    q, m = F.col("q"), F.col("m")
    got = [tuple(r) for r in df.select(repair_quantity(q, m), quantity_flag(q, m), is_outlier(q, m)).collect()]
    assert got == [
        (80.0, "", False),
        (8.0, "outlier_fixed", True),
        (8.0, "imputed", False),
        (5.0, "", False),
        (None, "imputed", False),
    ]


def test_lookup_fill(spark):
    df = spark.createDataFrame([(1, "c1", None), (2, "c1", "r9"), (3, "zz", None), (4, None, None)], "i int, c string, r string")
    master = spark.createDataFrame([("c1", "r1"), ("c1", "r1"), ("c2", "r2")], "c string, rep string")
    got = {r.i: r.r for r in lookup_fill(df, "r", master, "c", "rep").collect()}
    assert got == {1: "r1", 2: "r9", 3: None, 4: None}


def test_near_equal_values_spread_over_buckets(spark):
    n = 200_000
    for shape in ("id / 1e9", "100 + id / 2e7", "5e12 + id"):
        df = spark.range(n).selectExpr("'a' AS k", f"CAST({shape} AS DOUBLE) AS v")
        sizes = bucketed(df, ["k"], "v").groupBy("_bucket").count().agg(F.max("count"), F.count("*")).first()
        assert sizes[0] <= 2 * n / 256 and sizes[1] >= 200
        assert group_median(df, ["k"], "v").first()["median"] == df.agg(F.median("v")).first()[0]
    whole = bucketed(df.select("v").union(spark.sql("SELECT CAST(NULL AS DOUBLE)")), [], "v")
    assert whole.groupBy("_bucket").count().agg(F.max("count")).first()[0] <= 2 * n / 256
    assert whole.where("v IS NULL").first()["_bucket"] == -1


def test_interpolation_of_odd_rows(spark):
    rows = [("a", None, None), ("a", "2024-02-01", 20.0), ("a", None, 100.0), (None, "2024-01-01", None), (None, "2024-02-01", 7.0)]
    rows += [("b", "2024-01-01", 1.0), ("b", "2024-01-01", None), ("b", "2024-03-01", 5.0)]
    df = spark.createDataFrame(rows, "k string, m string, v double").repartition(3)
    got = sorted(map(tuple, interpolate(df, ["k"], "m", "v").collect()), key=repr)
    want = [("a", None, 100.0), ("a", None, 100.0), ("a", "2024-02-01", 20.0), (None, "2024-01-01", None), (None, "2024-02-01", 7.0)]
    want += [("b", "2024-01-01", 1.0), ("b", "2024-01-01", 3.0), ("b", "2024-03-01", 5.0)]
    assert got == sorted(want, key=repr)


def test_conflicting_keys(spark):
    master = spark.createDataFrame([("c1", "r1"), ("c1", "r2"), ("c2", "r1"), ("c2", None), (None, "r1")], "c string, r string")
    assert [tuple(r) for r in conflicting_keys(master, "c", "r").collect()] == [("c1", 2)]


def test_rows_without_copies_are_dealt_before_they_are_grouped(spark):
    nan = float("nan")
    data = [("a", None, 0.0), ("a", None, -0.0), ("a", "", nan), ("a", "", nan), (None, None, None), (None, None, None), ("b", "", 1.0)]
    df = spark.createDataFrame(data, "k string, `odd.name` string, v double").repartition(3)
    plain = df.groupBy("k", "`odd.name`", "v").agg(F.count("*").alias("copies"))
    assert sorted(map(str, collapse_copies(df, recurring=False).collect())) == sorted(map(str, plain.collect()))
    assert sorted(map(str, drop_exact_duplicates(df).collect())) == sorted(map(str, plain.drop("copies").collect()))
    texts = df.select("k", "`odd.name`")
    for dealt in (drop_exact_duplicates(texts), collapse_copies(texts, recurring=False)):
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        # No map of rows on the near side of the one shuffle by columns.
        assert plan.count("HashAggregate") == 2 and plan.rindex("HashAggregate") < plan.index("Exchange hashpartitioning")
