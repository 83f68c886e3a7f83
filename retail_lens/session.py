"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(
    app: str = "retail_lens", master: str | None = None, partitions: int | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the plans are written for.

    Adaptive execution sizes the shuffles and splits skewed join partitions at run
    time, also where the split costs one more exchange downstream. It merges small
    partitions but does not split those of an aggregation, so for very large inputs
    ``partitions``, the number it starts from, should be about the input size over 256 MB.

    The JVM never compiles a method of more than 8,000 bytes, and a stage fused into one such method is
    interpreted row by row, several times slower than the same stage in pieces. With the limit below Spark does
    not fuse such stages; cleaning text in many columns makes them.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def file_system(spark: SparkSession, folder: str):
    """A path and the file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where it is unset a local session (tests) gets a fresh temporary folder; a
    cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="retail_lens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Have Spark delete ``folder`` when the application ends; for results that are still to be read."""
    path, files = file_system(spark, folder)
    files.mkdirs(path)  # only an existing path is remembered
    files.deleteOnExit(path)


class Staging:
    """Writes an intermediate frame once and hands back a scan of it.

    A staged frame is computed a single time however often it is read, survives the
    loss of executors, and has a size Spark knows from its files, so the next join
    broadcasts it only when it is under ``spark.sql.autoBroadcastJoinThreshold``. What is
    not dropped before is deleted when the application ends.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.root = f"{folder or shared_folder(spark)}/retail_lens/{uuid.uuid4().hex}"
        remove_at_exit(spark, self.root)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete what this object wrote; for jobs whose results are stored elsewhere."""
        path, files = file_system(self.spark, self.root)
        files.delete(path, True)


def unstaged(df: DataFrame, name: str) -> DataFrame:
    """Stand-in for :class:`Staging` that keeps the whole plan lazy."""
    return df
