"""Group medians that are kept up to date as deliveries of rows come in."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.operators.medians import median_of_counts, merge_counts, value_counts
from retail_lens.operators.repair import quantity_flag, repair_quantity
from retail_lens.session import Staging
from retail_lens.sources.store import Run, Store


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys])


@dataclass(frozen=True)
class MaintainedMedian:
    """Median of ``value`` per ``keys`` in a store.

    Two tables: ``<name>_counts``, to which each delivery adds how often its values occur, and ``<name>_medians``. A
    delivery is counted alone; the counts of its groups, and of no others, are then merged and looked up. Keys
    must not be called value or times.
    """

    name: str
    keys: tuple[str, ...]
    value: str

    def add(self, run: Run, rows: DataFrame) -> DataFrame:
        """Take in a delivery of rows and return the groups whose median changed: keys, before, after (null: none)."""
        stage, keys = Staging(rows.sparkSession), list(self.keys)
        fresh = stage(value_counts(rows, keys, self.value), f"{self.name}_fresh")
        old = self._medians(run)
        run.append(fresh, f"{self.name}_counts")
        touched = stage(fresh.select(*keys).distinct(), f"{self.name}_touched")
        counts = merge_counts(run.read(f"{self.name}_counts").join(touched, keys, "left_semi"), keys)
        renewed = stage(median_of_counts(counts, keys, "median"), f"{self.name}_renewed")
        if old is None:
            run.write(renewed, f"{self.name}_medians")
            return renewed.select(*keys, F.lit(None).cast("double").alias("before"), F.col("median").alias("after"))
        run.write(old.join(touched, keys, "left_anti").unionByName(renewed), f"{self.name}_medians")
        a, b = renewed.alias("a"), old.alias("b")
        changes = a.join(b, _same(keys), "left").where(~F.col("a.median").eqNullSafe(F.col("b.median")))
        return changes.select(*[F.col(f"a.{k}") for k in keys], F.col("b.median").alias("before"), F.col("a.median").alias("after"))

    def _medians(self, run: Run) -> DataFrame | None:
        table = f"{self.name}_medians"
        return run.store.read(table) if table in run.before["tables"] else None

    def medians(self, store: Store) -> DataFrame:
        """keys, median"""
        return store.read(f"{self.name}_medians")


def changed_repairs(lines: DataFrame, changes: DataFrame, keys: Sequence[str], value: str, factor: float = 10.0) -> DataFrame:
    """Lines whose repaired value or flag is another after the medians changed, with ``repaired`` and ``qty_flag`` as they are now.

    ``lines`` are those taken in before, ``value`` as it was read. Only lines of changed groups are compared.
    """
    met = lines.join(changes, list(keys))
    v, old, new = F.col(value), F.col("before"), F.col("after")
    now, flag = repair_quantity(v, new, factor), quantity_flag(v, new, factor)
    differs = ~now.eqNullSafe(repair_quantity(v, old, factor)) | ~flag.eqNullSafe(quantity_flag(v, old, factor))
    return met.where(differs).select(*lines.columns, now.alias("repaired"), flag.alias("qty_flag"))
