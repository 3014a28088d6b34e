"""The record of past refreshes: an append-only table of counts per run and table."""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SUCCEEDED, FAILED = "succeeded", "failed"
SCHEMA = (
    "run_id string, attempt int, status string, error string, run_ts timestamp, as_of date, "
    "table_name string, rows_written long, rows_dropped long, rows_rejected long, nulls_published map<string,bigint>"
)
_MESSAGE = 500  # characters of an error that are kept


class AlreadyRecorded(RuntimeError):
    """Another driver has recorded the same attempt of a run meanwhile."""


class RunLedger:
    """One folder per attempt of a run, put in place by one rename that never replaces anything.

    A run is repeated until it succeeds; once it has, further attempts add nothing.  Every record
    holds one row per table that was written, or a single row without a table for a run that failed
    before the first one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _system(self):
        package = self.spark._jvm.org.apache.hadoop.fs
        root = package.Path(self.root)
        return package, root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _attempts(self, run_id: str) -> int:
        package, root, system = self._system()
        if not system.exists(root):
            return 0
        prefix = f"run={quote(run_id, safe='')},"
        return sum(s.getPath().getName().startswith(prefix) for s in system.listStatus(root))

    def read(self) -> DataFrame:
        """All records; empty before the first run."""
        package, root, system = self._system()
        folders = [s.getPath().toString() for s in system.listStatus(root)] if system.exists(root) else []
        kept = [f for f in folders if f.rsplit("/", 1)[1].startswith("run=")]
        if not kept:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*kept)

    def rows_of(self, run_id: str, status: str = SUCCEEDED) -> list:
        """The record of a run with that status, or nothing."""
        if not self._attempts(run_id):
            return []
        return self.read().where((F.col("run_id") == run_id) & (F.col("status") == status)).collect()

    def record(self, run_id: str, report, run_ts: dt.datetime, as_of: dt.date, error: BaseException | None = None) -> bool:
        """Append the outcome of an attempt; False (and no row) if the run has succeeded before."""
        if self.rows_of(run_id):
            return False
        attempt = self._attempts(run_id) + 1
        status = FAILED if error else SUCCEEDED
        message = f"{type(error).__name__}: {error}"[:_MESSAGE] if error else None
        rows = [
            (run_id, attempt, status, message, run_ts, as_of, table, report.rows_written.get(table),
             report.rows_dropped.get(table), report.rows_rejected.get(table), report.nulls_published.get(table, {}))
            for table in report.rows_written
        ] or [(run_id, attempt, status, message, run_ts, as_of, *[None] * 5)]
        package, root, system = self._system()
        fresh = package.Path(f"{self.root}/_next-{uuid.uuid4().hex}")
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(fresh.toString())
        place = package.Path(f"{self.root}/run={quote(run_id, safe='')},attempt={attempt}")
        context = package.FileContext.getFileContext(fresh.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fresh, place, options)  # fails if the place is taken
        except Exception as taken:
            system.delete(fresh, True)
            raise AlreadyRecorded(f"attempt {attempt} of run {run_id}") from taken
        return True


def run_history(records: DataFrame) -> DataFrame:
    """One row per run and table: the last attempt, and the rows against the run before that succeeded.

    Failed runs are listed with what they had written.  The window holds one row per run of a table.
    """
    last = Window.partitionBy("run_id")
    latest = records.withColumn("attempts", F.max("attempt").over(last)).where(F.col("attempt") == F.col("attempts"))
    done = F.when(F.col("status") == SUCCEEDED, F.col("rows_written"))
    nulls = F.aggregate(F.map_values("nulls_published"), F.lit(0).cast("long"), lambda total, n: total + n)
    before = (
        Window.partitionBy("table_name").orderBy("run_ts", "run_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    return latest.withColumn("previous_rows", F.last(done, ignorenulls=True).over(before)).select(
        "run_id", "attempts", "status", "error", "table_name", "rows_written", "rows_dropped", "rows_rejected",
        nulls.alias("nulls_published"), "previous_rows", (F.col("rows_written") - F.col("previous_rows")).alias("rows_change"),
    )
