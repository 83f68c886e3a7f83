from datetime import date
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from retail_lens.functions import numbers
from retail_lens.functions.months import Period, PeriodSpec, calendar, shift_month


def test_round_even_equals_array_rounding(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(0, 1000, 500), rng.integers(-999, 999, 500) / 8, [2.5, 3.5, 0.125, -0.0]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for digits in (0, 1, 2):
        got = [r[0] for r in df.select(numbers.round_even(F.col("v"), digits)).collect()]
        assert got == list(np.round(values, digits) + 0.0)


def test_line_revenue_equals_array_rounding(spark):
    rng = np.random.default_rng(3)
    q = rng.integers(1, 60, 2000).astype(float)
    p = rng.integers(100, 20000, 2000) / 100
    d = rng.choice([0.0, 5.0, 10.0], 2000)
    df = spark.createDataFrame(list(zip(q.tolist(), p.tolist(), d.tolist())), "q double, p double, d double")
    got = [r[0] for r in df.select(numbers.line_revenue(F.col("q"), F.col("p"), F.col("d"))).collect()]
    want = np.round(q * p * (1 - d / 100), 2)
    assert got == [Decimal(repr(float(w))).quantize(Decimal("0.01")) for w in want]


def test_ratio_and_round_up(spark):
    row = spark.range(1).select(
        numbers.ratio(F.lit(1), F.lit(0)).alias("zero"),
        numbers.ratio(F.lit(1), F.lit(None).cast("int")).alias("null"),
        numbers.round_up(F.lit(2.25), 1).alias("up"),
        numbers.round_up(F.lit(-0.01), 1).alias("no_minus"),
        numbers.fill_rate(F.lit(2), F.lit(3)).alias("fill"),
        numbers.lead_time_days(F.lit(date(2025, 1, 30)), F.lit(date(2025, 2, 2))).alias("lead"),
    ).first()
    assert (row.zero, row.null, row.up, row.fill, row.lead) == (None, None, 2.3, 0.667, 3)
    assert str(row.no_minus) == "0.0"


def test_periods():
    spec = PeriodSpec(Period.of("2026-07", "2026-09"), Period.of("2026-01", "2026-06"), Period.of("2026-10", "2026-12"))
    assert spec.prior == Period.of("2025-07", "2025-09")
    assert spec.future_prior.months() == [date(2025, 10, 1), date(2025, 11, 1), date(2025, 12, 1)]
    assert Period.of("2024-02").last_day == date(2024, 2, 29)
    assert len(Period.of("2025-01", "2026-12").months()) == 24


def test_calendar_covers_whole_years(spark):
    days = spark.createDataFrame([(date(2024, 5, 3),), (date(2025, 2, 1),), (None,)], "order_date date")
    rows = calendar(days).orderBy("date").collect()
    assert len(rows) == 366 + 365
    assert rows[0].asDict() == {"date": date(2024, 1, 1), "year": 2024, "month_no": 1, "month": "Jan 2024", "quarter": "Q1 2024"}
    assert rows[-1].date == date(2025, 12, 31)


def test_shift_month(spark):
    row = spark.range(1).select(shift_month(F.lit(date(2024, 2, 1)), 12).alias("a"), shift_month(F.lit(date(2024, 2, 1)), -2).alias("b")).first()
    assert (row.a, row.b) == (date(2025, 2, 1), date(2023, 12, 1))
