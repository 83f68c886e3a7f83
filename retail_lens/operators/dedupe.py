"""Exact duplicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.session import unstaged


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def _dealt(df: DataFrame) -> DataFrame:
    """Rows dealt by all their columns, before anything is grouped.

    Where most rows have no copy, combining before the shuffle saves nothing and holds every row of a task, wider than it
    was read, in memory. Dealt first, a task holds the rows of one partition, whose size adaptive execution sees.
    """
    return df.repartition(*_columns(df)) if df.columns else df


def collapse_copies(df: DataFrame, copies: str = "copies", recurring: bool = True) -> DataFrame:
    """One row per distinct row plus how often it occurred.

    The count combines before the shuffle, so a row copied any number of times sends
    one record per input partition. ``recurring=False`` says that few rows have copies: rows are then shuffled as they
    are and combined behind, in less memory.
    """
    df = df if recurring else _dealt(df)
    return df.groupBy(*_columns(df)).agg(F.count(F.lit(1)).alias(copies))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Distinct rows of a table in which few have copies; of others, ``collapse_copies`` combines before the shuffle."""
    return _dealt(df).distinct()


def row_digest(df: DataFrame) -> Column:
    """64 bits of a whole row; a null differs from every value and from a null in another column."""
    nulls = [F.when(c.isNull(), "0").otherwise("1") for c in _columns(df)]
    return F.xxhash64(F.concat(*nulls), *_columns(df))


def collapse_by_digest(
    df: DataFrame,
    copies: str = "copies",
    stage: Callable[[DataFrame, str], DataFrame] = unstaged,
    digest: Callable[[DataFrame], Column] = row_digest,
) -> DataFrame:
    """``collapse_copies`` that shuffles a digest of most rows instead of the rows.

    Digests are counted first. A row whose digest is alone has no copy and goes through; only rows whose digest
    recurs are grouped by all their columns, so rows with equal digests by chance stay apart. ``df`` is
    read three times and should be a stored table; ``stage`` makes the size of the recurring digests known, which Spark then
    broadcasts if they are few.
    """
    marked = df.withColumn("_digest", digest(df))
    again = marked.groupBy("_digest").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    again = stage(again.select("_digest", F.lit(True).alias("_again")), "recurring")
    rows = marked.join(again, "_digest", "left")
    alone = rows.where(F.col("_again").isNull()).select(*_columns(df), F.lit(1).cast("long").alias(copies))
    return alone.unionByName(collapse_copies(rows.where(F.col("_again")).select(*_columns(df)), copies))
