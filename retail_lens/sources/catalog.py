"""Clean tables as SQL views."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lens.sources.files import scan_csv
from retail_lens.sources.schemas import CLEAN, QUALITY_LOG
from retail_lens.sources.store import Store


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Create or replace one view per table, in name order; the quality log is not a view."""
    for name in sorted(tables):
        if name != QUALITY_LOG:
            tables[name].createOrReplaceTempView(name)


def load_clean_csv(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Clean tables written as CSV under ``folder``."""
    return {name: scan_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in CLEAN.items()}


def load_clean(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Clean tables as the pipeline published them last; sales and deliveries carry their month folder."""
    store = Store(spark, folder)
    return {name: store.read(name) for name in CLEAN}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table, row_count"""
    counts = [
        tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        for name in sorted(tables)
    ]
    return reduce(DataFrame.unionByName, counts)
