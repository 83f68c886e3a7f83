"""File scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from retail_lens.sources.schemas import text_schema


# Quotes as spreadsheets and data tools write them: a quote inside a field is doubled.
_QUOTES = {"header": True, "quote": '"', "escape": '"'}
CORRUPT = "_corrupt_record"


def _scan(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """All columns of the file's own header as text."""
    return spark.read.options(**_QUOTES, inferSchema=False, multiLine=multi_line).csv(path)


def scan_csv_text(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False) -> DataFrame:
    """CSV scan that keeps every column as the text found in the file.

    Columns are found by the header, in any order; a missing one is an error, others are not
    read. ``multi_line`` allows line breaks in quoted fields, at the price that a file is read by one task.
    """
    return _scan(spark, path, multi_line).select(*[F.col(f"`{c}`") for c in columns])


def scan_csv(
    spark: SparkSession, path: str, schema: StructType, date_format: str = "yyyy-MM-dd", multi_line: bool = False
) -> DataFrame:
    """Typed CSV scan by header; dates are parsed by ``date_format``, what does not fit a type is null."""

    def typed(field: StructField) -> Column:
        text = F.col(f"`{field.name}`")
        value = F.try_to_date(text, date_format) if isinstance(field.dataType, DateType) else text.try_cast(field.dataType)
        return value.alias(field.name)

    return scan_csv_text(spark, path, schema.names, multi_line).select(*[typed(f) for f in schema.fields])


#: What is kept of a row that has not as many fields as the header.
REJECT = "file string, block long, text string, reason string"


def scan_csv_checked(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False) -> DataFrame:
    """``scan_csv_text`` with a column ``reject``, null for a row with as many fields as the header.

    For others it is a struct of the file, where the block that Spark read it in begins, the text and the reason, and the columns
    are not to be used. The rows should be written once (``Staging``) before good and rejected ones go their ways.
    """
    names = _scan(spark, path, multi_line).columns
    rows = (
        spark.read.schema(text_schema(*names, CORRUPT))
        .options(**_QUOTES, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .csv(path)
    )
    bare = F.regexp_replace(F.col(CORRUPT), '"([^"]|"")*"', "")
    reason = F.concat(F.size(F.split(bare, ",")).cast("string"), F.lit(f" fields instead of {len(names)}"))
    reject = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col(CORRUPT).alias("text"),
        reason.alias("reason"),
    )
    # Columns that nobody reads would not be parsed, and a row of wrong width not noticed: the length, never negative, reads all.
    parsed = F.length(F.concat_ws("", *[f"`{n}`" for n in names])) >= 0
    return rows.select(*[F.col(f"`{c}`") for c in columns], F.when(F.col(CORRUPT).isNotNull() & parsed, reject).alias("reject"))


def malformed_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Number of rows with more or fewer fields than the header: malformed_rows."""
    names = _scan(spark, path, multi_line).columns
    rows = scan_csv_checked(spark, path, names, multi_line)
    return rows.agg(F.count_if(F.col("reject").isNotNull()).alias("malformed_rows"))


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` with the rows of ``df`` in their order, dates as ISO text, blanks kept, quotes doubled."""
    (
        df.write.mode("overwrite")
        .options(**_QUOTES)
        .option("dateFormat", "yyyy-MM-dd")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_by_month(df: DataFrame, path: str, day: str = "order_date", order: Sequence[str] = ()) -> None:
    """Replace the table at ``path``, one folder per month, in total order by day, ``order`` and the other columns.

    Read in the order of their names, folders and the files in them give the rows in that order: each task writes
    one range of it. The other columns spread a day, or a key, too large for one task. The ranges are cut at
    a sample, for which Spark computes the rows once more, so ``df`` should be staged.
    """
    keys = [day, *order]
    (
        df.withColumn("month", F.trunc(day, "MM"))
        .orderBy("month", *keys, *[c for c in df.columns if c not in keys])
        .write.mode("overwrite")
        .partitionBy("month")
        .parquet(path)
    )


def file_borders(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per file of a stored table, in name order: file, first, last, and whether it begins where the one before ended, or after."""
    at = F.struct(*keys)
    files = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(at).alias("first"), F.max(at).alias("last"))
    # One row per file.
    before = F.lag("last").over(Window.orderBy("file"))
    return files.withColumn("in_order", F.coalesce(F.col("first") >= before, F.lit(True)))
