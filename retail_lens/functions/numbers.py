"""Arithmetic column functions: rounding, ratios, revenue, delivery measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def round_even(col: Column, digits: int = 0) -> Column:
    """Round a double as array libraries do: scale, nearest integer with ties to even, unscale."""
    scale = float(10**digits)
    return F.rint(col.cast("double") * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def round_up(col: Column, digits: int = 0) -> Column:
    """Round as SQL does (ties away from zero) to a double; ``+ 0.0`` turns -0.0 into 0.0."""
    return F.round(col.cast("double"), digits) + F.lit(0.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as doubles; null when the denominator is null or zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct_change(new: Column, old: Column) -> Column:
    return (ratio(new, old) - F.lit(1.0)) * F.lit(100.0)


def line_revenue(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """quantity x price x (1 - discount/100) to the cent, kept as an exact decimal."""
    net = quantity * unit_price * (F.lit(1.0) - discount_pct / F.lit(100.0))
    return round_even(net, 2).cast(MONEY)


def lead_time_days(order_date: Column, delivery_date: Column) -> Column:
    return F.datediff(delivery_date, order_date)


def fill_rate(delivered: Column, ordered: Column) -> Column:
    return round_even(ratio(delivered, ordered), 3)
