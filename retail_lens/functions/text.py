"""Column functions for messy text: dates, labels, numbers, keys."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Accepted date spellings, tried in this order.
DATE_FORMATS = ("yyyy-M-d", "d/M/yyyy", "MMM d, yyyy", "d-MMM-yy")
MONTH_FORMATS = ("MMM-yyyy", "yyyy-M")

# Texts that stand for a missing value, as common table readers take them.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

_FIELD_SHAPES = {"yyyy": r"\d{4}", "yy": r"\d{2}", "MMM": "[A-Za-z]{3}", "M": r"\d{1,2}", "d": r"\d{1,2}"}
_BLANKS = " \t\n\r\f\v"
_NUMBER_SIGNS = "0123456789.-"


def strip(col: Column) -> Column:
    """Remove white space of any kind at both ends (plain ``trim`` removes spaces only)."""
    return F.btrim(col, F.lit(_BLANKS))


def _parse_one(text: Column, fmt: str) -> Column:
    """Date in one format, null for any other text.

    The shape test keeps the parser away from text of another format: a failed parse
    raises and catches an exception per row inside the JVM. All-digit formats are
    rearranged to ISO text, for which the cast to date is much the fastest parser.
    """
    parts = re.split("(yyyy|yy|MMM|M|d)", fmt)
    shape = "^" + "".join(f"({_FIELD_SHAPES[p]})" if p in _FIELD_SHAPES else re.escape(p) for p in parts) + "$"
    fields = [p for p in parts if p in _FIELD_SHAPES]
    if set(fields) == {"yyyy", "M", "d"}:
        iso_order = "-".join(f"${fields.index(p) + 1}" for p in ("yyyy", "M", "d"))
        iso = text if fmt == "yyyy-M-d" else F.regexp_replace(text, shape, iso_order)
        return F.when(text.rlike(shape), iso.try_cast("date"))
    parsed = F.when(text.rlike(shape), F.try_to_date(text, fmt))
    if "yy" in fields:
        # Two-digit years 69-99 belong to the twentieth century.
        parsed = F.add_months(parsed, F.when(F.year(parsed) >= 2069, -1200).otherwise(0))
    return parsed


def parse_dates(col: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text in any of ``formats`` to a date; the first format that fits wins, else null."""
    text = strip(col)
    return F.coalesce(*[_parse_one(text, fmt) for fmt in formats])


def dated_rows(df: DataFrame, column: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Rows whose ``column`` can be read as a date, which replaces the text.

    The date is handed on as the one element of an array: a filter on a plain projection would be moved below it, and
    the text parsed twice.
    """
    others = [c for c in df.columns if c != column]
    once = F.explode(F.array(parse_dates(F.col(column), formats))).alias(column)
    return df.select(*others, once).where(F.col(column).isNotNull()).select(*df.columns)


def parse_month_start(col: Column, formats: Sequence[str] = MONTH_FORMATS) -> Column:
    """Month text to the first day of that month."""
    return F.trunc(parse_dates(col, formats), "MM")


def match_label(col: Column, labels: Mapping[str, str], squeeze: bool = False) -> Column:
    """Standard label whose key occurs in the lower-cased text; of several, the last key wins.

    ``squeeze`` drops the blanks inside the text before matching.
    """
    text = F.lower(col)
    text = F.replace(text, F.lit(" "), F.lit("")) if squeeze else strip(text)
    result = None
    for key, label in reversed(list(labels.items())):
        found = text.contains(key)
        result = F.when(found, label) if result is None else result.when(found, label)
    return F.lit(None).cast("string") if result is None else result


def to_number(col: Column) -> Column:
    """Number inside a text such as ``'EUR 7.25'``, ``'-3 pcs'``, ``'40 %'``, ``'1,250'``.

    Everything but digits, point and minus is deleted first, so ``'1e5'`` reads as 15.
    """
    # Most texts are bare numbers; only the others pay for the regular expression.
    bare = F.translate(col, _NUMBER_SIGNS, "") == ""
    digits = F.when(bare, col).otherwise(F.regexp_replace(col, r"[^0-9.\-]", ""))
    return F.nullif(digits, F.lit("")).try_cast("double")


def normalise_key(col: Column) -> Column:
    return F.upper(strip(col))


def title_case(col: Column, after_any_symbol: bool = True) -> Column:
    """Stripped text with capitalised words.

    A word starts after any character that is not a letter (``Nana'S``); with
    ``after_any_symbol=False`` only after white space (``Nana's``).
    """
    text = F.lower(strip(col))
    if not after_any_symbol:
        return F.initcap(text)
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def is_missing_token(col: Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    # Most texts begin like no token; only the others pay for the stripping.
    starts = sorted({ord(c) for c in _BLANKS} | {ord(t[0]) if t else 0 for t in tokens})
    return F.coalesce(F.ascii(col).isin(starts) & strip(col).isin(*tokens), F.lit(False))


def null_missing(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Null for every missing-value text in every text column, so that rows that differ in it alone are equal."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: blank_to_null(F.col(c), tokens) for c in texts})


def blank_to_null(col: Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    return F.when(~is_missing_token(col, tokens), col)
