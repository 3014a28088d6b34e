"""CSV landing files -> raw all-text tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketloom.contracts import BRONZE, file_schema
from marketloom.functions.base import ladder
from marketloom.sources.scratch import open_folders

# Fixed value: a quote inside a quoted field is doubled.
CSV_OPTIONS = {"escape": '"'}

# Tables whose free text may hold line breaks.
MULTILINE_TABLES = frozenset({"product_reviews"})


def read_landing(
    spark: SparkSession, table: str, path: str, corrupt_column: str | None = None
) -> DataFrame:
    """Read one landing data set (a file, a folder or a glob) with its fixed schema.

    Permissive: short rows are padded with NULL, surplus fields are dropped,
    an empty field is NULL.  With ``corrupt_column`` the raw text of malformed
    rows is kept in that extra column.

    Spark reads a file with line breaks inside fields in one task, so such a
    data set should land as many files.
    """
    schema, options = file_schema(table), dict(CSV_OPTIONS)
    if corrupt_column:
        schema = schema.add(corrupt_column, "string")
        options["columnNameOfCorruptRecord"] = corrupt_column
    if table in MULTILINE_TABLES:
        options["multiLine"] = "true"
    return spark.read.options(header=True, **options).schema(schema).csv(path)


RAW, FILE, REJECTED = "_raw_record", "_source_file", "_rejected"

# Why a record is not a row of its table.
SHORT, SURPLUS, OPEN_QUOTE, MALFORMED = "too few fields", "too many fields", "quote not closed", "malformed"


def reject_reason(raw: Column, fields: int) -> Column:
    """What is wrong with a record that the reader could not fit into so many fields; NULL for NULL."""
    bare = F.regexp_replace(raw, '"(?:[^"]|"")*+"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    steps = [
        (raw.isNull(), F.lit(None).cast("string")),
        (F.contains(bare, F.lit('"')), OPEN_QUOTE),
        (commas < fields - 1, SHORT),
        (commas > fields - 1, SURPLUS),
    ]
    return ladder(steps, MALFORMED)


def split_landing(spark: SparkSession, table: str, path: str, into: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Read a landing data set once and write good rows and rejected records apart, below ``into``.

    Returns the good rows (columns of the file), the rejects (table_name, source_file, raw_record,
    reason) and the counts of both; their sum is the number of records in the files.  A record is
    rejected if it has too few or too many fields or a quote that is not closed; one job reads the
    files and fills both folders, without sorting the rows.  What is in ``into`` is replaced.
    """
    names, watch = file_schema(table).names, Observation()
    read = read_landing(spark, table, path, corrupt_column=RAW)
    rejected = F.col(RAW).isNotNull()
    flagged = read.withColumn(FILE, F.when(rejected, F.col("_metadata.file_path"))).withColumn(REJECTED, rejected)
    counted = flagged.observe(watch, F.count_if(~F.col(REJECTED)).alias("good"), F.count_if(REJECTED).alias("rejected"))
    with open_folders(spark, 2):
        counted.write.mode("overwrite").partitionBy(REJECTED).parquet(into)
    schema = file_schema(table).add(RAW, "string").add(FILE, "string").add(REJECTED, "boolean")
    split = spark.read.schema(schema).parquet(into)
    rejects = split.where(REJECTED).select(
        F.lit(table).alias("table_name"), F.col(FILE).alias("source_file"),
        F.regexp_replace(RAW, r"[\r\n]+$", "").alias("raw_record"),
        reject_reason(F.col(RAW), len(names)).alias("reason"),
    )
    return split.where(~F.col(REJECTED)).select(*names), rejects, watch.get


def check_landing(spark: SparkSession, landing: Mapping[str, str]) -> None:
    """Fail before anything is written if a table has no landing path or no file there."""
    missing = [table for table in BRONZE if table not in landing]
    for table in (t for t in BRONZE if t in landing):
        try:
            if landing_files(spark, landing[table]).isEmpty():
                missing.append(table)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(table)
    if missing:
        raise FileNotFoundError(f"no landing files for {missing}")


def with_ingestion_date(df: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Stamp every row with the load time; the caller supplies it, so reruns repeat."""
    return df.withColumn("ingestion_date", F.lit(load_ts).cast("timestamp"))


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and time of each landing file; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            F.col("path").alias("file_path"),
            F.col("length").alias("file_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def landing_file_audit(df: DataFrame) -> DataFrame:
    """Rows read per landing file, with its size.

    ``df`` must come straight from a file source.  Counts are combined in each
    map task, so one huge file is no hot key.
    """
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_bytes"),
        )
        .groupBy("file_path", "file_bytes")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
