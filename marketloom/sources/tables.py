"""Reading and fully refreshing the layered tables.

An overwrite never touches what readers see: the new version is written beside the old one, checked,
and then put in its place by one atomic step (a renamed pointer file, or a replaced view).  If the
write or the check fails, the old rows stay.  The version before is kept until the next overwrite, so
a reader that has begun can end.

A table has one writer at a time: a second one is refused before it writes anything, so no writer
removes what another is filling.  After a driver has died while writing, ``unlock`` frees the table.
The rename is one step on HDFS and local disks; plain object stores have no such step, so there a
table format with its own log, or ``CatalogStore``, is the right choice.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketloom.contracts import LAYERS, conform
from marketloom.sources.scratch import open_folders

# Large tables that are read by date: written in one folder per month of this column.
MONTHLY = {("silver", "fact_orders"): "order_date", ("silver", "fact_reviews"): "review_date"}
MONTH = "_month"

# Months that a task writes side by side; rows of further ones are sorted by month first.
OPEN_MONTHS = 16


class NullsInRequiredColumns(ValueError):
    """A table was not published because columns that are declared NOT NULL hold NULLs."""


class ConcurrentWrite(RuntimeError):
    """Another writer is at work on the table, or has died there; see ``unlock``."""


@dataclass(frozen=True)
class Published:
    """What an overwrite has written: rows, rows left out by the ``keep`` flag, NULLs in required columns."""

    rows: int
    dropped: int
    nulls: dict[str, int]


def _prepared(df: DataFrame, layer: str, table: str, keep: str | None) -> tuple[DataFrame, Observation]:
    """The frame as it is written, with its rows, dropped rows and NULLs counted in the writing stage.

    Everything is observed after the last shuffle: an earlier stage that is run again after a loss
    would count twice.  That is why rows to be dropped come along, flagged, until here.
    """
    contract = LAYERS[layer][table]
    shape = type(contract)(list(contract))
    frame = conform(df, shape.add(keep, "boolean") if keep else shape)
    frame = _monthly(frame, layer, table)
    kept = F.coalesce(F.col(keep), F.lit(False)) if keep else F.lit(True)
    nulls = [F.count_if(kept & F.col(f.name).isNull()).alias(f"null {f.name}") for f in contract if not f.nullable]
    watch = Observation()
    frame = frame.observe(watch, F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("kept"), *nulls)
    return (frame.where(kept).drop(keep) if keep else frame), watch


def _published(watch: Observation) -> Published:
    seen = watch.get
    nulls = {name.removeprefix("null "): n for name, n in seen.items() if name.startswith("null ") and n}
    return Published(seen["kept"], seen["rows"] - seen["kept"], nulls)


def _refuse(layer: str, table: str, found: dict[str, int]) -> None:
    raise NullsInRequiredColumns(f"{layer}.{table} was not published: NULLs in {found}")


def _monthly(df: DataFrame, layer: str, table: str) -> DataFrame:
    """A month folder for tables that have one; ``rebalance`` splits a large month and merges small ones."""
    day = MONTHLY.get((layer, table))
    if day is None:
        return df
    return df.withColumn(MONTH, F.date_format(day, "yyyy-MM")).hint("rebalance", F.col(MONTH))


def _months_between(df: DataFrame, since: dt.date | None, until: dt.date | None) -> DataFrame:
    if since:
        df = df.where(F.col(MONTH) >= f"{since:%Y-%m}")
    if until:
        df = df.where(F.col(MONTH) <= f"{until:%Y-%m}")
    return df


@dataclass(frozen=True)
class PathStore:
    """Tables as folders ``<root>/<layer>/<table>/<version>``; ``_current`` names the version."""

    spark: SparkSession
    root: str
    format: str = "parquet"

    def _folder(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def _hadoop(self, path: str):
        package = self.spark._jvm.org.apache.hadoop.fs
        where = package.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration()), package

    def _current(self, folder: str) -> str | None:
        pointer, system, _ = self._hadoop(f"{folder}/_current")
        if not system.exists(pointer):
            return None
        stream = system.open(pointer)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _switch(self, folder: str, version: str) -> None:
        """Write the new pointer beside the old one and rename it over that, which is one step."""
        fresh, system, package = self._hadoop(f"{folder}/_next-{version}")
        stream = system.create(fresh, True)
        try:
            stream.write(bytearray(version.encode()))
        finally:
            stream.close()
        context = package.FileContext.getFileContext(fresh.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fresh, package.Path(f"{folder}/_current"), options)

    def read(
        self, layer: str, table: str, since: dt.date | None = None, until: dt.date | None = None
    ) -> DataFrame:
        """The current version; with ``since`` and ``until`` only the months of a monthly table between them."""
        folder = self._folder(layer, table)
        version = self._current(folder)
        if version is None:
            raise FileNotFoundError(f"no table {layer}.{table} in {self.root}")
        contract = LAYERS[layer][table]
        # The contract is the schema, which saves a footer-reading job.
        schema = contract
        if (layer, table) in MONTHLY:
            schema = type(contract)(list(contract)).add(MONTH, "string")
        frame = self.spark.read.format(self.format).schema(schema).load(f"{folder}/{version}")
        if (layer, table) in MONTHLY:
            frame = _months_between(frame, since, until)
        return frame.select(*contract.names)

    def overwrite(
        self, layer: str, table: str, df: DataFrame, allow_nulls: bool = False, keep: str | None = None
    ) -> Published:
        """Publish a new version; with ``keep``, a flag column, only the rows that it marks."""
        folder, version = self._folder(layer, table), f"v-{uuid.uuid4().hex}"
        frame, watch = _prepared(df, layer, table, keep)
        writer = frame.write.format(self.format)
        writer = writer.partitionBy(MONTH) if (layer, table) in MONTHLY else writer
        with self._claimed(layer, table):
            before = self._current(folder)
            try:
                with open_folders(self.spark, OPEN_MONTHS):
                    writer.save(f"{folder}/{version}")
                done = _published(watch)
                if done.nulls and not allow_nulls:
                    _refuse(layer, table, done.nulls)
                self._switch(folder, version)
            except BaseException:
                self._drop(folder, keep={before})
                raise
            self._drop(folder, keep={before, version})
        return done

    @contextlib.contextmanager
    def _claimed(self, layer: str, table: str):
        """Hold the file that marks the table's only writer."""
        lock, system, _ = self._hadoop(f"{self._folder(layer, table)}/_writer")
        try:
            system.create(lock, False).close()
        except Py4JJavaError as refused:
            if not system.exists(lock):
                raise
            raise ConcurrentWrite(f"{layer}.{table} in {self.root} is being written") from refused
        try:
            yield
        finally:
            system.delete(lock, False)

    def unlock(self, layer: str, table: str) -> None:
        """Free a table whose writer has died; call it only when that is certain."""
        lock, system, _ = self._hadoop(f"{self._folder(layer, table)}/_writer")
        system.delete(lock, False)

    def _drop(self, folder: str, keep: set[str | None]) -> None:
        where, system, package = self._hadoop(folder)
        for status in system.listStatus(where) if system.exists(where) else ():
            name = status.getPath().getName()
            if name.startswith(("v-", "_next-")) and name not in keep:
                system.delete(status.getPath(), True)


@dataclass(frozen=True)
class CatalogStore:
    """Views ``<prefix><layer>.<table>`` in the session catalog, each over a table that holds one version."""

    spark: SparkSession
    prefix: str = ""
    format: str = "parquet"

    def _name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def _versions(self, layer: str, table: str) -> list[str]:
        tables = self.spark.sql(f"SHOW TABLES IN {self.prefix}{layer} LIKE '{table}__v*'").collect()
        return [r.tableName for r in tables]

    def _current(self, layer: str, table: str) -> str | None:
        if not self.spark.catalog.tableExists(self._name(layer, table)):
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._name(layer, table)}").collect()
        return next((r.value for r in rows if r.key == "version"), None)

    def read(
        self, layer: str, table: str, since: dt.date | None = None, until: dt.date | None = None
    ) -> DataFrame:
        """As with ``PathStore``; a monthly table is read from the table of its version."""
        contract = LAYERS[layer][table]
        if (layer, table) not in MONTHLY or not (since or until):
            return self.spark.table(self._name(layer, table))
        frame = self.spark.table(f"{self.prefix}{layer}.{self._current(layer, table)}")
        return _months_between(frame, since, until).select(*contract.names)

    def overwrite(
        self, layer: str, table: str, df: DataFrame, allow_nulls: bool = False, keep: str | None = None
    ) -> Published:
        """As with ``PathStore``."""
        name, version = self._name(layer, table), f"{table}__v{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}")
        frame, watch = _prepared(df, layer, table, keep)
        writer = frame.write.format(self.format)
        writer = writer.partitionBy(MONTH) if (layer, table) in MONTHLY else writer
        with self._claimed(layer, table):
            before = self._current(layer, table)
            try:
                with open_folders(self.spark, OPEN_MONTHS):
                    writer.saveAsTable(f"{self.prefix}{layer}.{version}")
                done = _published(watch)
                if done.nulls and not allow_nulls:
                    _refuse(layer, table, done.nulls)
                columns = ", ".join(f"`{c}`" for c in LAYERS[layer][table].names)
                self.spark.sql(
                    f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('version' = '{version}') "
                    f"AS SELECT {columns} FROM {self.prefix}{layer}.{version}"
                )
            except BaseException:
                self._drop(layer, table, keep={before})
                raise
            self._drop(layer, table, keep={before, version})
        return done

    @contextlib.contextmanager
    def _claimed(self, layer: str, table: str):
        """Hold the empty table that marks the only writer; the catalog creates it for one of them."""
        lock = f"{self._name(layer, table)}__writer"
        try:
            self.spark.sql(f"CREATE TABLE {lock} (held boolean) USING parquet")
        except AnalysisException as refused:
            if refused.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
            raise ConcurrentWrite(f"{self._name(layer, table)} is being written") from refused
        try:
            yield
        finally:
            self.unlock(layer, table)

    def unlock(self, layer: str, table: str) -> None:
        """Free a table whose writer has died; call it only when that is certain."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(layer, table)}__writer")

    def _drop(self, layer: str, table: str, keep: set[str | None]) -> None:
        for version in self._versions(layer, table):
            if version not in keep:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.prefix}{layer}.{version}")
