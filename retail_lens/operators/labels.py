"""Standard labels by the thousand."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.functions.text import match_label, strip
from retail_lens.session import unstaged

#: Length of the pieces of text that keys are looked up by.
GRAM = 3
#: Up to so many labels, a chain of conditions is the faster way to the same result.
CHAIN = 64


def _normal(col: Column, squeeze: bool) -> Column:
    text = F.lower(col)
    return F.replace(text, F.lit(" "), F.lit("")) if squeeze else strip(text)


def _grams(text: Column, sizes: Column) -> Column:
    """All pieces of a text of the given lengths, each once."""
    def of_size(n: Column) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(text, i, n))

    return F.array_distinct(F.flatten(F.transform(sizes, of_size)))


def indexed_labels(
    df: DataFrame,
    column: str,
    labels: Mapping[str, str],
    into: str,
    squeeze: bool = False,
    stage: Callable[[DataFrame, str], DataFrame] = unstaged,
) -> DataFrame:
    """Add ``into``: what ``match_label`` gives for ``column``, whatever the number of labels.

    A key is filed under the one of its pieces of three letters that the fewest distinct texts have; a text meets the keys filed
    under its own pieces, and is searched for those. Keys of less than three letters are pieces themselves; the empty
    key is in every text. So the work grows with the distinct texts and the keys that share a rare piece with them.
    """
    spark = df.sparkSession
    rows = [(i, key, label) for i, (key, label) in enumerate(labels.items())]
    keys = spark.createDataFrame(rows, "_place long, _key string, _label string")
    texts = stage(df.where(F.col(column).isNotNull()).select(F.col(column).alias("_text")).distinct(), "texts")
    texts = texts.withColumn("_normal", _normal(F.col("_text"), squeeze))
    pieces = texts.select("_text", "_normal", F.explode(_grams(F.col("_normal"), F.sequence(F.lit(1), F.lit(GRAM)))).alias("_gram"))
    spread = pieces.groupBy("_gram").agg(F.count(F.lit(1)).alias("_texts"))
    own = keys.where(F.col("_key") != "").select(
        "*", F.explode(_grams(F.col("_key"), F.array(F.least(F.lit(GRAM), F.length("_key"))))).alias("_gram")
    )
    # A key of which some piece is in no text is in none either.
    known = own.join(spread, "_gram", "left").withColumn("_texts", F.coalesce("_texts", F.lit(0)))
    filed = known.groupBy("_place", "_key", "_label").agg(F.min(F.struct("_texts", "_gram")).alias("_best"))
    filed = filed.where("_best._texts > 0").select("_place", "_key", "_label", "_best._gram")
    met = pieces.join(filed, "_gram").where(F.contains("_normal", "_key")).select("_text", "_place", "_label")
    empty = keys.where(F.col("_key") == "").select("_place", "_label").collect()
    for r in empty:  # one at most, as keys are unique
        met = met.unionByName(texts.select("_text", F.lit(r["_place"]).alias("_place"), F.lit(r["_label"]).alias("_label")))
    found = stage(met.groupBy("_text").agg(F.max_by("_label", "_place").alias(into)), "labels")
    return df.join(found, F.col(column) == F.col("_text"), "left").drop("_text")


def with_label(
    df: DataFrame,
    column: str,
    labels: Mapping[str, str],
    into: str,
    squeeze: bool = False,
    stage: Callable[[DataFrame, str], DataFrame] = unstaged,
) -> DataFrame:
    """Add the standard label of a text column: by a chain of conditions for a short map, by an index for a long one; the result is the same."""
    if len(labels) <= CHAIN:
        return df.withColumn(into, match_label(F.col(column), labels, squeeze))
    return indexed_labels(df, column, labels, into, squeeze, stage)
