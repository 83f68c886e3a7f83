"""Clean tables that are replaced together.

A run writes its tables to folders of its own, ``<root>/<table>/run=<id>``, and publishes them at the end by one new
numbered file in ``<root>/_published`` that names the folders every table consists of. Readers follow the newest such file. So a
run that fails half-way changes nothing for them, and readers at work keep the folders they started with. A run may take
over tables, or months of a table, from the one before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from retail_lens.session import file_system
from retail_lens.sources.files import write_by_month

PUBLISHED = "_published"

#: A table's folders: run -> its months, or None for a table that is not stored by month.
Parts = dict[str, list[str] | None]


class Store:
    """Published tables under a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _published(self) -> list[str]:
        path, files = file_system(self.spark, f"{self.root}/{PUBLISHED}")
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        return sorted(n for n in names if n.endswith(".json"))

    def _load(self, name: str) -> dict:
        path, files = file_system(self.spark, f"{self.root}/{PUBLISHED}/{name}")
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """Number and content of the newest publication; (0, no tables) before the first."""
        names = self._published()
        return (int(names[-1].split(".")[0]), self._load(names[-1])) if names else (0, {"tables": {}, "schemas": {}})

    def read(self, table: str) -> DataFrame:
        """A published table; one stored by month has the column ``month``, its folder, at the end."""
        _, content = self.latest()
        if table not in content["tables"]:
            raise FileNotFoundError(f"no table {table} is published in {self.root}")
        return self.open(table, content["tables"][table], StructType.fromJson(content["schemas"][table]))

    def open(self, table: str, parts: Parts, schema: StructType) -> DataFrame:
        folder, paths = f"{self.root}/{table}", []
        for run, months in parts.items():
            paths += [f"{folder}/run={run}"] if months is None else [f"{folder}/run={run}/month={m}" for m in months]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", folder).schema(schema).parquet(*paths).select(*schema.names)

    def start(self) -> Run:
        return Run(self)

    def drop_unpublished(self, keep: int = 2) -> list[str]:
        """Delete runs that none of the last ``keep`` publications uses: older ones and those that failed. Not while a run is at work.

        Returns the folders deleted.
        """
        names = self._published()
        used = {(t, r) for n in names[-keep:] for t, parts in self._load(n)["tables"].items() for r in parts}
        root, files = file_system(self.spark, self.root)
        gone = []
        for table in files.listStatus(root) if files.exists(root) else []:
            name = table.getPath().getName()
            for run in files.listStatus(table.getPath()) if table.isDirectory() and name != PUBLISHED else []:
                if (name, run.getPath().getName().removeprefix("run=")) not in used:
                    files.delete(run.getPath(), True)
                    gone.append(f"{name}/{run.getPath().getName()}")
        for n in names[:-keep]:
            files.delete(file_system(self.spark, f"{self.root}/{PUBLISHED}/{n}")[0], False)
        return gone


class Run:
    """One run's tables; nobody else sees them before :meth:`publish`."""

    def __init__(self, store: Store):
        self.store, self.id = store, f"r{uuid.uuid4().hex}"
        self.number, before = store.latest()
        self.before = before
        self.tables: dict[str, Parts] = {}
        self.schemas: dict[str, dict] = {}

    def _folder(self, table: str) -> str:
        return f"{self.store.root}/{table}/run={self.id}"

    def write(self, df: DataFrame, table: str) -> None:
        """A whole table, in the row order of ``df``."""
        df.write.parquet(self._folder(table))
        self.tables[table] = {self.id: None}
        self.schemas[table] = df.schema.jsonValue()

    def append(self, df: DataFrame, table: str) -> None:
        """More rows for a table that is not stored by month; those published before stay."""
        df.write.parquet(self._folder(table))
        self.tables[table] = self.before["tables"].get(table, {}) | {self.id: None}
        self.schemas[table] = df.schema.jsonValue()

    def write_months(
        self, df: DataFrame, table: str, day: str = "order_date", order: Sequence[str] = (), months: Sequence[date] | None = None
    ) -> None:
        """A table stored by month. With ``months`` these alone are written, the others are those published before.

        A month that is named and has no rows is empty from then on.
        """
        known = dict(self.before["tables"].get(table, {}))
        if months is not None:
            df = df.where(F.trunc(day, "MM").isin(list(months)))
        write_by_month(df, self._folder(table), day, order)
        path, files = file_system(self.store.spark, self._folder(table))
        names = [s.getPath().getName() for s in files.listStatus(path)]
        written = sorted(n.removeprefix("month=") for n in names if n.startswith("month="))
        if months is None:
            self.tables[table] = {self.id: written}
        else:
            replaced = {m.isoformat() for m in months}
            kept = {run: [m for m in of if m not in replaced] for run, of in known.items()}
            self.tables[table] = {run: of for run, of in kept.items() if of} | {self.id: written}
        self.schemas[table] = StructType([*df.schema.fields, StructField("month", DateType())]).jsonValue()

    def read(self, table: str) -> DataFrame:
        """A table as this run will publish it."""
        return self.store.open(table, self.tables[table], StructType.fromJson(self.schemas[table]))

    def publish(self) -> None:
        """Make the run's tables the current ones, together; tables that it did not write stay as they were."""
        content = {
            "run": self.id,
            "tables": self.before["tables"] | self.tables,
            "schemas": self.before["schemas"] | self.schemas,
        }
        name = f"{self.store.root}/{PUBLISHED}/{self.number + 1:09d}"
        final, files = file_system(self.store.spark, f"{name}.json")
        if files.exists(final):
            raise RuntimeError(f"another run was published in {self.store.root} since this one started")
        draft, _ = file_system(self.store.spark, f"{name}.{self.id}.draft")
        stream = files.create(draft, True)
        try:
            stream.writeBytes(json.dumps(content))
        finally:
            stream.close()
        if not files.rename(draft, final):
            raise RuntimeError(f"{final} could not be published")

    def discard(self) -> None:
        """Delete what an unpublished run wrote."""
        for table in self.tables:
            path, files = file_system(self.store.spark, self._folder(table))
            files.delete(path, True)
