"""What several operators share: word counts, staging that cleans up, and sums over large groups."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_lens.session import Staging

#: A word is a longest run of bytes other than space and the five control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> SparkSession:
    """Let the Python workers of a local session find this library, whatever folder it was started in.

    On a cluster the library is shipped or installed with the job, as any other.
    """
    context = spark.sparkContext
    if re.fullmatch(r"local(\[.*\])?", context.master):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        known = context.environment.get("PYTHONPATH", "")
        if root not in known.split(os.pathsep):
            context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


class Leaving(Staging):
    """Staging after which a query leaves no shuffle files: what it wrote is read from the staged frame.

    Otherwise Spark keeps them until the driver happens to collect its garbage, for all steps of a job together.
    """

    SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        was = self.spark.conf.get(self.SETTING, None)
        self.spark.conf.set(self.SETTING, "true")
        try:
            return super().__call__(df, name)
        finally:
            if was is None:
                self.spark.conf.unset(self.SETTING)
            else:
                self.spark.conf.set(self.SETTING, was)


def staging(spark: SparkSession) -> Staging:
    """Staging in the shared folder, deleted when the application ends."""
    return Leaving(importable(spark))


class Recent:
    """A bounded memory of results: ``new`` holds the latest, ``old`` what was new before.

    When ``new`` is full it becomes ``old``; what is asked for again moves back to ``new``.
    So common entries stay, rare ones go, and at most twice ``size`` entries are held.
    """

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_bits(rows: int) -> int:
    """Leading hash bits that cut ``rows`` rows into about sqrt(rows) buckets of sqrt(rows) rows."""
    return max(1, math.ceil(math.log2(max(rows, 2)) / 2))


def running_sum(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in its group.

    ``order`` is a hash (long, not null), rows are taken by it and then by ``ties``. No
    task sees a whole group: leading bits of the hash cut every group into buckets, whose
    totals are summed first, so a window holds about sqrt(rows) rows in either step.
    ``df`` is read twice and should be staged. ``keys`` must not be null.
    """
    bits = hash_bits(df.count())
    cut = df.withColumn("_bucket", F.shiftrightunsigned(F.col(order), 64 - bits))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        cut.groupBy(*keys, "_bucket")
        .agg(F.sum(value).alias("_total"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.join(totals, [*keys, "_bucket"])
        .withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_bucket", "_base")
    )


def join_spread(left: DataFrame, right: DataFrame, on: str, weight: str, share: int = 1000) -> DataFrame:
    """Left join where one key may hold a large part of ``left``.

    ``right`` has one row per key, with the number of left rows of that key in ``weight``
    and must be staged. Keys with more than a ``share``-th of all left rows are fewer than
    ``share``, whatever the data, so that part of ``right`` is broadcast; the rest of the
    keys go through an ordinary join. Left rows with a null key find nothing.
    """
    rows = right.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * share > rows
    names = [c for c in right.columns if c not in (on, weight)]
    few = right.filter(hot).select(F.col(on).alias("_hot"), *names)
    key = F.col(on) if isinstance(on, str) else on
    near = left.join(F.broadcast(few), key == F.col("_hot"), "left")
    found = near.filter(F.col("_hot").isNotNull()).select(*left.columns, *names)
    rest = near.filter(F.col("_hot").isNull()).select(*left.columns)
    return found.unionByName(rest.join(right.filter(~hot).drop(weight), on, "left").select(*left.columns, *names))
