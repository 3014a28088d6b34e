"""Full refresh: landing files -> bronze -> silver -> golden.

Each layer is read back from storage by the next one, so a lost executor costs
the current table at most.  Every table is written by one job, and the store
counts its rows during that job, in the writing stage itself: shuffle stages
that are recomputed after a loss cannot count twice.  Landing paths are checked
before the first write, and a table whose required columns hold NULLs is not published.

With a ledger every run leaves a record under its id, also when it fails; a run
that has succeeded is not repeated.  With a quarantine folder, records that do
not fit their table are kept there and do not become padded or cut rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from marketloom.contracts import BRONZE, SILVER
from marketloom.plans import golden, silver
from marketloom.sources.landing import check_landing, read_landing, split_landing, with_ingestion_date
from marketloom.sources.ledger import RunLedger
from marketloom.sources.scratch import discard, scratch_path, stored
from marketloom.sources.tables import CatalogStore, PathStore


@dataclass
class RefreshReport:
    rows_written: dict[str, int] = field(default_factory=dict)
    rows_dropped: dict[str, int] = field(default_factory=dict)
    nulls_published: dict[str, dict[str, int]] = field(default_factory=dict)
    rows_rejected: dict[str, int] = field(default_factory=dict)


def _publish(
    store, layer: str, table: str, df: DataFrame, allow_nulls: Collection[str], report: RefreshReport,
    keep: str | None = None,
) -> None:
    name = f"{layer}.{table}"
    done = store.overwrite(layer, table, df, allow_nulls=layer in allow_nulls, keep=keep)
    report.rows_written[name] = done.rows
    if keep:
        report.rows_dropped[name] = done.dropped
    if done.nulls:
        report.nulls_published[name] = done.nulls


def load_bronze(
    spark: SparkSession, landing: Mapping[str, str], store, load_ts: dt.datetime,
    report: RefreshReport, allow_nulls: Collection[str] = (), quarantine: str | None = None,
) -> None:
    """Landing paths (one per table) -> all-text tables with their load time.

    With ``quarantine`` (a new folder) each landing set is read once into good rows and rejected
    records; the latter stay in ``<quarantine>/<table>``.
    """
    for table in BRONZE:
        if quarantine is None:
            raw = read_landing(spark, table, landing[table])
        else:
            into = f"{quarantine.rstrip('/')}/{table}"
            raw, _, counts = split_landing(spark, table, landing[table], into)
            report.rows_rejected[f"bronze.{table}"] = counts["rejected"]
        _publish(store, "bronze", table, with_ingestion_date(raw, load_ts), allow_nulls, report)
        if quarantine is not None:
            discard(spark, f"{into}/_rejected=false")


def load_silver(
    store, run_ts: dt.datetime, report: RefreshReport, allow_nulls: Collection[str] = ()
) -> None:
    """Deduplicate, validate and type each table.

    Dimensions are written by the stage after the key shuffle.  Facts are dealt
    once more, by month, because reports read few months of them.
    """
    for table, spec in silver.REFINEMENTS.items():
        newest = silver.latest(store.read("bronze", spec.source), table)
        _publish(store, "silver", table, silver.flagged(newest, table, run_ts), allow_nulls, report, silver.KEPT)


# Tables that are read by ranges of these columns, and written in such ranges.
# The customer table is looked up by customer, which its last join has already
# spread and sorted, the monthly sentiment by product, which its window has.
READ_ORDER = {
    "agg_sales_summary": ("order_date_dt", "shipping_country"),
    "agg_product_performance": ("rating_rank", "product_id"),
}


def load_golden(
    spark: SparkSession, store, as_of: dt.date, report: RefreshReport, allow_nulls: Collection[str] = ()
) -> None:
    """Build and write the four aggregates; there is no global sort.

    The product scorecard is read twice, so it is stored for the time of the load.
    """
    scorecard = scratch_path(spark, "scorecard")
    try:
        _load_golden(store, as_of, report, allow_nulls, scorecard)
    finally:
        discard(spark, scorecard)


def _load_golden(store, as_of, report, allow_nulls, scorecard) -> None:
    customers, products, orders, reviews = (store.read("silver", t) for t in SILVER)
    tables = {
        "agg_sales_summary": lambda: golden.sales_summary(orders),
        "agg_product_performance": lambda: golden.product_performance(
            products, reviews, cut=lambda df: stored(df, path=scorecard)
        ),
        "agg_customer_360": lambda: golden.customer_360(customers, orders, reviews, as_of),
        "agg_review_sentiment": lambda: golden.review_sentiment(reviews, products),
    }
    for table, build in tables.items():
        frame = build()
        if table in READ_ORDER:
            keys = READ_ORDER[table]
            frame = frame.repartitionByRange(*keys).sortWithinPartitions(*keys)
        _publish(store, "golden", table, frame, allow_nulls, report)


def _recorded(rows: list) -> RefreshReport:
    """The report of a run from its record."""
    report = RefreshReport()
    for row in rows:
        report.rows_written[row.table_name] = row.rows_written
        for into, value in ((report.rows_dropped, row.rows_dropped), (report.rows_rejected, row.rows_rejected)):
            if value is not None:
                into[row.table_name] = value
        if row.nulls_published:
            report.nulls_published[row.table_name] = row.nulls_published
    return report


def full_refresh(
    spark: SparkSession,
    landing: Mapping[str, str],
    store: PathStore | CatalogStore,
    load_ts: dt.datetime,
    run_ts: dt.datetime,
    as_of: dt.date,
    allow_nulls: Collection[str] = (),
    quarantine: str | None = None,
    ledger: RunLedger | None = None,
    run_id: str | None = None,
) -> RefreshReport:
    """Run all layers.  ``allow_nulls`` names layers that are published although required columns
    hold NULLs; these are then counted in the report.

    With ``ledger`` the outcome is recorded under ``run_id`` (the default is the date of ``run_ts``),
    with an error if there was one.  If that run has succeeded before, nothing is read or written and
    its recorded report is returned.
    """
    report, run_id = RefreshReport(), run_id or f"{run_ts:%Y-%m-%d}"
    if ledger and (done := ledger.rows_of(run_id)):
        return _recorded(done)
    try:
        check_landing(spark, landing)
        load_bronze(spark, landing, store, load_ts, report, allow_nulls, quarantine)
        load_silver(store, run_ts, report, allow_nulls)
        load_golden(spark, store, as_of, report, allow_nulls)
    except Exception as error:
        if ledger:
            ledger.record(run_id, report, run_ts, as_of, error)
        raise
    if ledger:
        ledger.record(run_id, report, run_ts, as_of)
    return report
