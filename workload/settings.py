"""Periods, focus and label maps of the registered queries."""

from __future__ import annotations

from datetime import date

from retail_lens.functions.months import Period, PeriodSpec
from retail_lens.plans.cleaning import CleaningRules
from retail_lens.plans.model import Focus

SPEC = PeriodSpec(
    current=Period.of("2000-07", "2000-09"),
    trend=Period.of("2000-01", "2000-06"),
    future=Period.of("2000-10", "2000-12"),
)
FOCUS = Focus("ASIA", "PROMO")
SHOCK = date(2000, 7, 1)
YEAR = Period.of("1999-07", "2000-06")
CALENDAR = Period.of("1999-01", "2000-12")
YEARS = Period.of("1995-01", "2002-12")

RULES = CleaningRules(
    regions={
        "africa": "AFRICA",
        "america": "AMERICA",
        "asia": "ASIA",
        "europe": "EUROPE",
        "middle east": "MIDDLE EAST",
    },
    channels={
        "automobile": "AUTOMOBILE",
        "building": "BUILDING",
        "furniture": "FURNITURE",
        "household": "HOUSEHOLD",
        "machinery": "MACHINERY",
    },
)

#: A map too long for a condition per label: the digits of a number, as they are counted.
LONG_LABELS = {str(i): f"label {i % 1000}" for i in range(20_000)}
