"""CSV reading, stores and the full refresh."""

import datetime as dt
import contextlib
import gzip
import io
import os
import re
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marketloom.contracts import BRONZE, GOLDEN, LAYERS, SILVER
from marketloom.plans import marts, silver
from marketloom.plans.refresh import READ_ORDER, RefreshReport, full_refresh
from marketloom.sources import landing
from marketloom.sources.ledger import AlreadyRecorded, RunLedger, run_history
from marketloom.sources.scratch import recorded, scratch_root
from marketloom.sources.tables import OPEN_MONTHS, CatalogStore, ConcurrentWrite, NullsInRequiredColumns, PathStore, _prepared
from retail_fixture import AS_OF, LOAD_TS, Bridge

SF_DIR = "/root/testdata/sf0.001"
PLANTED = ("bronze",)  # the raw frames hold NULL keys on purpose



def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


CUSTOMERS = (
    "customer_id,name,email,gender,signup_date,country\n"
    '1,"Ann ""The"" Lee",a@b.co,F,2024-01-05,Peru\n'
    "2,Bob\n"
    "3,Cid,,M,2024-01-06,Chad,surplus\n"
)
REVIEWS = (
    "review_id,product_id,customer_id,rating,review_text,review_date\n"
    '1,7,9,5,"two\nlines, ""quoted""",2024-01-05\n'
    "2,7,9,4,plain,2024-01-06\n"
)


def test_permissive_csv(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    rows = {r.customer_id: r for r in landing.read_landing(spark, "customers", str(tmp_path / "customers.csv")).collect()}
    assert rows["1"].name == 'Ann "The" Lee'
    assert rows["2"].name == "Bob" and rows["2"].email is None and rows["2"].country is None
    assert rows["3"].email is None and rows["3"].country == "Chad"


def test_corrupt_rows_can_be_kept(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    frame = landing.read_landing(spark, "customers", str(tmp_path), corrupt_column="raw")
    raw = {r.customer_id: r.raw for r in frame.cache().collect()}
    assert raw["1"] is None and raw["2"] == "2,Bob" and raw["3"].endswith("surplus")


def test_multiline_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text(REVIEWS)
    rows = {r.review_id: r for r in landing.read_landing(spark, "product_reviews", str(tmp_path)).collect()}
    assert len(rows) == 2
    assert rows["1"].review_text == 'two\nlines, "quoted"' and rows["1"].review_date == "2024-01-05"


def test_landing_audit(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CUSTOMERS)
    (tmp_path / "b.csv").write_text(CUSTOMERS.splitlines(keepends=True)[0] + "9,Zed,z@z.zz,M,2024-01-01,Mali\n")
    audit = {r.file_path.rsplit("/", 1)[1]: r for r in
             landing.landing_file_audit(landing.read_landing(spark, "customers", str(tmp_path))).collect()}
    assert (audit["a.csv"].row_count, audit["b.csv"].row_count) == (3, 1)
    sizes = {r.file_path.rsplit("/", 1)[1]: r.file_bytes for r in landing.landing_files(spark, str(tmp_path)).collect()}
    assert sizes == {name: row.file_bytes for name, row in audit.items()}


def test_missing_landing_path_fails_before_writing(spark, tmp_path):
    with pytest.raises(AnalysisException):
        landing.read_landing(spark, "orders", str(tmp_path / "nowhere"))


def test_ingestion_date_does_not_depend_on_the_session_zone(spark):
    frame = landing.with_ingestion_date(spark.range(1), LOAD_TS)
    assert frame.selectExpr("unix_seconds(ingestion_date)").first()[0] == int(LOAD_TS.timestamp())


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    return {table: Bridge(spark, SF_DIR).land_csv(table, root) for table in BRONZE}


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_full_refresh(spark, landed, tmp_path, kind):
    store = PathStore(spark, str(tmp_path)) if kind == "path" else CatalogStore(spark, "refresh_")
    run_ts = dt.datetime(2001, 8, 3, tzinfo=dt.timezone.utc)
    first = full_refresh(spark, landed, store, LOAD_TS, run_ts, AS_OF, PLANTED)
    for layer, tables in LAYERS.items():
        for table, contract in tables.items():
            frame = store.read(layer, table)
            assert frame.columns == contract.names
            assert [f.dataType for f in frame.schema] == [f.dataType for f in contract]
            assert frame.count() == first.rows_written[f"{layer}.{table}"]
    for table in SILVER:
        key = store.read("silver", table).columns[0]
        ids = store.read("silver", table).select(key)
        assert ids.distinct().count() == ids.count()
    assert first.rows_dropped["silver.dim_customers"] > 0
    assert first.nulls_published["bronze.orders"]["customer_id"] > 0 and set(first.nulls_published) <= {
        f"bronze.{t}" for t in BRONZE}
    scratch = spark.conf.get("spark.checkpoint.dir")
    assert not [name for name in os.listdir(scratch) if name.startswith("scorecard")]
    sales = store.read("golden", "agg_sales_summary").groupBy().sum("total_orders").first()[0]
    assert sales == first.rows_written["silver.fact_orders"]
    if kind == "catalog":  # the tables exist now
        assert full_refresh(spark, landed, store, LOAD_TS, run_ts, AS_OF, PLANTED) == first


def test_refresh_equals_composition(spark, landed, tmp_path):
    """Golden tables read back from storage equal the ones built in one go from the same files."""
    store = PathStore(spark, str(tmp_path))
    full_refresh(spark, landed, store, LOAD_TS, LOAD_TS, AS_OF, PLANTED)
    layers = entry.Layers(spark, SF_DIR)
    for table in BRONZE:
        layers._built[table] = landing.with_ingestion_date(
            landing.read_landing(spark, table, landed[table]), LOAD_TS)
    for table in GOLDEN:
        have = sorted(map(repr, store.read("golden", table).collect()))
        assert have == sorted(map(repr, layers(table).select(*GOLDEN[table].names).collect()))


def test_reviews_are_read_alike_however_they_land(spark, tmp_path):
    """A stray quote, a packed file and a file in a subfolder; nothing depends on sizes."""
    header = REVIEWS.splitlines()[0] + "\n"
    lines = [f"{i},7,9,5,text {i},2024-01-05\n" for i in range(10)]
    lines[3] = '3,7,9,5,text 3 5" tv,2024-01-05\n'
    (tmp_path / "plain.csv").write_text(header + "".join(lines))
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as packed:
        packed.write(header + "".join(line.replace("text", "packed") for line in lines))
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "x.csv").write_text(header + "99,7,9,5,deep,2024-01-05\n" * 2000)
    rows = landing.read_landing(spark, "product_reviews", str(tmp_path)).collect()
    assert len(rows) == 20 and {r.review_date for r in rows} == {"2024-01-05"}
    assert {r.review_text for r in rows if r.review_id == "3"} == {'text 3 5" tv', 'packed 3 5" tv'}
    kept = landing.read_landing(spark, "product_reviews", str(tmp_path), corrupt_column="raw").cache()
    assert kept.count() == 20 and kept.where("raw IS NOT NULL").count() == 0


def test_every_fact_of_the_given_tables_is_used(spark):
    """Raw orders are all orders and their outdated copies; raw reviews are all line items."""
    given = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("orders", "lineitem", "customer", "part")}
    raw = Bridge(spark, SF_DIR)
    n = {t: df.count() for t, df in given.items()}
    assert raw.bronze("orders").count() == n["orders"] + given["orders"].where("o_orderkey % 10 = 0").count()
    assert raw.bronze("product_reviews").count() == n["lineitem"]
    layers = entry.Layers(spark, SF_DIR)
    assert layers("agg_customer_360").where("coalesce(total_orders, 0) = 0").count() > 0
    assert layers("agg_product_performance").where("review_count = 0").count() > 0
    enriched = entry.queries()["reviews_enriched"](spark, SF_DIR)
    assert enriched.where("category IS NULL").count() > 0
    everything = raw.bronze("customers")
    assert everything.where("coalesce(name, email, gender, signup_date, country) IS NULL").count() > 0


def _customers(spark, *names, key="1"):
    rows = [(key, n, "a@b.co", "M", "2001-01-01", "Peru", LOAD_TS) for n in names]
    return spark.createDataFrame(rows, LAYERS["bronze"]["customers"].simpleString().replace("struct<", "").rstrip(">").replace(":", " "))


def _stores(spark, tmp_path):
    return [PathStore(spark, str(tmp_path)), CatalogStore(spark, f"over_{tmp_path.name.replace('-', '_')}_")]


def test_a_failed_overwrite_keeps_the_old_rows(spark, tmp_path):
    for store in _stores(spark, tmp_path):
        store.overwrite("bronze", "customers", _customers(spark, "a", "b", "c"))
        early = store.read("bronze", "customers")
        failing = _customers(spark, "x", "y").repartition(2).withColumn("name", F.expr("raise_error('half-way')").cast("string"))
        with pytest.raises(Exception, match="half-way"):
            store.overwrite("bronze", "customers", failing)
        assert {r.name for r in store.read("bronze", "customers").collect()} == {"a", "b", "c"}
        store.overwrite("bronze", "customers", _customers(spark, "d"))
        assert {r.name for r in early.collect()} == {"a", "b", "c"}, "a reader from before the switch can end"
        assert [r.name for r in store.read("bronze", "customers").collect()] == ["d"]


def test_null_keys_are_not_published(spark, tmp_path):
    layers = entry.Layers(spark, SF_DIR)
    for store in _stores(spark, tmp_path):
        store.overwrite("bronze", "customers", _customers(spark, "a"))
        bad = _customers(spark, "b", key=None)
        with pytest.raises(NullsInRequiredColumns, match="customer_id"):
            store.overwrite("bronze", "customers", bad)
        assert [r.name for r in store.read("bronze", "customers").collect()] == ["a"]
        assert store.overwrite("bronze", "customers", bad, allow_nulls=True).nulls == {"customer_id": 1}
        orders = layers("fact_orders").limit(5)
        with pytest.raises(NullsInRequiredColumns, match="order_id"):
            store.overwrite("silver", "fact_orders", orders.withColumn("order_id", F.lit(None).cast("string")))


def test_a_missing_landing_table_stops_the_refresh_before_any_write(spark, landed, tmp_path):
    store = PathStore(spark, str(tmp_path / "store"))
    broken = {**landed, "product_reviews": str(tmp_path / "nowhere")}
    with pytest.raises(FileNotFoundError, match="product_reviews"):
        full_refresh(spark, broken, store, LOAD_TS, LOAD_TS, AS_OF, PLANTED)
    assert not (tmp_path / "store").exists()


def test_two_weeks_read_two_months_of_the_stored_fact(spark, landed, tmp_path):
    layers = entry.Layers(spark, SF_DIR)
    want = marts.kpi_week_vs_prev(layers("fact_orders"), AS_OF).collect()
    for store in _stores(spark, tmp_path):
        store.overwrite("silver", "fact_orders", layers("fact_orders"))
        recent = store.read("silver", "fact_orders", *marts.two_weeks(AS_OF))
        months = {f.split("_month=")[1].split("/")[0] for f in recent.inputFiles()}
        assert recent.count() < store.read("silver", "fact_orders").count()
        result = marts.kpi_week_vs_prev(recent, AS_OF)
        text = plan(result)
        assert re.search(r"PartitionFilters: \[[^\]]*_month", text), text
        assert result.collect() == want
        read = recent.select(F.input_file_name().alias("f")).distinct().collect()
        assert {r.f.split("_month=")[1].split("/")[0] for r in read} <= {"2001-07", "2001-08"} <= months
        assert store.read("silver", "fact_orders").where("order_date IS NULL").count() > 0


# --- rejects, ledger, one writer ---------------------------------------------

def test_rejects_are_kept_apart_in_one_pass(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(CUSTOMERS + '4,"Dan, Dee",d@d.dd,M,2024-01-07,Mali\n')
    (tmp_path / "in" / "b.csv").write_text(CUSTOMERS.splitlines(keepends=True)[0] + "9,Zed,z@z.zz,M,2024-01-01,Mali\n")
    good, rejects, counts = landing.split_landing(spark, "customers", str(tmp_path / "in"), str(tmp_path / "out"))
    assert {r.customer_id for r in good.collect()} == {"1", "4", "9"}
    assert {(r.table_name, r.source_file.rsplit("/", 1)[1], r.raw_record, r.reason) for r in rejects.collect()} == {
        ("customers", "a.csv", "2,Bob", landing.SHORT),
        ("customers", "a.csv", "3,Cid,,M,2024-01-06,Chad,surplus", landing.SURPLUS)}
    assert counts == {"good": 3, "rejected": 2}
    assert landing.read_landing(spark, "customers", str(tmp_path / "in")).count() == 5


def test_rejects_of_records_with_line_breaks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.csv").write_text(REVIEWS + '3,7,9,5,"two\nlines, ""quoted""",2024-01-05,more\n4,7\n5,7,9,4,"never\nclosed,2024-01-06\n')
    good, rejects, counts = landing.split_landing(spark, "product_reviews", str(tmp_path / "in"), str(tmp_path / "out"))
    assert {r.review_id for r in good.collect()} == {"1", "2"}
    found = {r.reason: r.raw_record for r in rejects.collect()}
    assert found[landing.SURPLUS] == '3,7,9,5,"two\nlines, ""quoted""",2024-01-05,more'
    assert found[landing.SHORT] == "4,7"
    assert counts["good"] + counts["rejected"] == landing.read_landing(spark, "product_reviews", str(tmp_path / "in")).count()


def test_reject_reasons(spark):
    raws = [None, "a,b", '"a,b",c,d', 'a,"b""",c', 'a,"b', "a,b,c,d", "a,b,c"]
    frame = spark.createDataFrame([(r,) for r in raws], "raw string")
    reasons = [r[0] for r in frame.select(landing.reject_reason(F.col("raw"), 3)).collect()]
    assert reasons == [None, landing.SHORT, landing.MALFORMED, landing.MALFORMED, landing.OPEN_QUOTE, landing.SURPLUS, landing.MALFORMED]


def test_refresh_with_ledger_and_quarantine(spark, tmp_path):
    bridge = Bridge(spark, SF_DIR)
    paths = {table: bridge.land_csv(table, str(tmp_path / "landing")) for table in BRONZE}
    clean = {table: landing.read_landing(spark, table, path).count() for table, path in paths.items()}
    for table, path in paths.items():
        bridge.land_malformed(table, path)
    store, ledger = PathStore(spark, str(tmp_path / "store")), RunLedger(spark, str(tmp_path / "ledger"))
    assert ledger.read().count() == 0

    def refresh(run_id, day, landed=paths):
        run_ts = dt.datetime(2001, 8, day, tzinfo=dt.timezone.utc)
        return full_refresh(spark, landed, store, LOAD_TS, run_ts, AS_OF, PLANTED, str(tmp_path / "bad"), ledger, run_id)

    with pytest.raises(FileNotFoundError):
        refresh("w/1", 2, {**paths, "orders": str(tmp_path / "nowhere")})
    failed = ledger.read().collect()
    assert [(r.run_id, r.attempt, r.status, r.table_name) for r in failed] == [("w/1", 1, "failed", None)]
    assert "orders" in failed[0].error
    first = refresh("w/1", 2)
    assert {t: first.rows_written[f"bronze.{t}"] for t in BRONZE} == clean
    assert all(first.rows_rejected[f"bronze.{t}"] > 0 for t in BRONZE)
    assert ledger.read().count() == 13
    assert refresh("w/1", 2) == first and ledger.read().count() == 13, "a rerun of a run adds nothing"
    assert not ledger.record("w/1", first, LOAD_TS, AS_OF, RuntimeError("late"))
    assert not (tmp_path / "bad" / "orders" / "_rejected=false").exists()
    assert (tmp_path / "bad" / "orders" / "_rejected=true").exists()
    second = refresh("w/2", 9)
    history = {(r.run_id, r.table_name): r for r in run_history(ledger.read()).collect()}
    assert len(history) == 24 and {r.attempts for (run, _), r in history.items() if run == "w/1"} == {2}
    for table, rows in second.rows_written.items():
        row = history["w/2", table]
        assert (row.rows_written, row.previous_rows, row.rows_change) == (rows, first.rows_written[table], rows - first.rows_written[table])
    assert history["w/1", "bronze.orders"].nulls_published == sum(first.nulls_published["bronze.orders"].values())


def test_a_failure_half_way_is_recorded_with_what_was_written(spark, landed, tmp_path):
    class Broken(PathStore):
        def overwrite(self, layer, table, *args, **kwargs):
            if table == "fact_orders":
                raise OSError("disk full")
            return super().overwrite(layer, table, *args, **kwargs)

    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    with pytest.raises(OSError):
        full_refresh(spark, landed, Broken(spark, str(tmp_path / "s")), LOAD_TS, LOAD_TS, AS_OF, PLANTED, ledger=ledger, run_id="x")
    rows = ledger.read().collect()
    assert {r.table_name for r in rows} == {*(f"bronze.{t}" for t in BRONZE), "silver.dim_customers", "silver.dim_products"}
    assert {(r.status, r.error) for r in rows} == {("failed", "OSError: disk full")}


def test_an_attempt_is_recorded_once(spark, tmp_path, monkeypatch):
    ledger, report = RunLedger(spark, str(tmp_path)), RefreshReport({"bronze.orders": 3})
    assert ledger.record("r", report, LOAD_TS, AS_OF, ValueError("first"))
    monkeypatch.setattr(RunLedger, "_attempts", lambda self, run: 0)
    with pytest.raises(AlreadyRecorded):
        ledger.record("r", report, LOAD_TS, AS_OF)
    assert [name for name in os.listdir(tmp_path) if name.startswith("_next")] == []


def test_a_second_writer_is_refused(spark, tmp_path):
    for store in _stores(spark, tmp_path):
        store.overwrite("bronze", "customers", _customers(spark, "a"))
        with store._claimed("bronze", "customers"):
            with pytest.raises(ConcurrentWrite):
                store.overwrite("bronze", "customers", _customers(spark, "b"))
            assert [r.name for r in store.read("bronze", "customers").collect()] == ["a"]
        store.overwrite("bronze", "customers", _customers(spark, "c"))
        dead = store._claimed("bronze", "customers")
        dead.__enter__()  # a driver that dies here
        with pytest.raises(ConcurrentWrite):
            store.overwrite("bronze", "customers", _customers(spark, "d"))
        store.unlock("bronze", "customers")
        store.overwrite("bronze", "customers", _customers(spark, "e"))
        assert [r.name for r in store.read("bronze", "customers").collect()] == ["e"]


def test_counts_are_taken_after_the_last_shuffle(spark):
    """The observation stands above the rebalance by month, and dropped rows are counted there too."""
    layers = entry.Layers(spark, SF_DIR)
    flagged = silver.flagged(silver.latest(layers("orders"), "fact_orders"), "fact_orders", LOAD_TS)
    frame, _ = _prepared(flagged, "silver", "fact_orders", silver.KEPT)
    text = plan(frame)
    assert text.index("CollectMetrics") < text.index("REBALANCE_PARTITIONS_BY_COL")
    assert text.count("CollectMetrics") == 1


def test_scratch_tables_never_go_to_a_local_disk_of_a_cluster():
    def session(master, warehouse, checkpoint=None, context_dir=None):
        settings = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": checkpoint}
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: context_dir)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default), sparkContext=context)

    assert scratch_root(session("yarn", "file:/w", "hdfs://x/c/")) == "hdfs://x/c"
    assert scratch_root(session("yarn", "file:/w", None, "s3://y")) == "s3://y"
    assert scratch_root(session("yarn", "hdfs://z/w/")) == "hdfs://z/w/_scratch"
    assert scratch_root(session("local[4]", "file:/w")) == scratch_root(session("local", "file:/w/")) == "file:/w/_scratch"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_root(session("local-cluster[2,1,1024]", warehouse))


# --- work per row ---------------------------------------------------------------

def test_malformed_records_are_chosen_before_anything_is_joined(spark):
    text = plan(Bridge(spark, SF_DIR, every=500).product_reviews())
    below = text[text.index("Join"):]
    assert re.search(r"Filter .*l_orderkey#\d+L? % 500", below) and "RoundRobin" not in text and "REPARTITION" not in text
    chosen = Bridge(spark, SF_DIR, every=500).product_reviews().collect()
    want = Bridge(spark, SF_DIR).product_reviews().where("int(split(review_id, '-')[0]) % 500 = 0").collect()
    assert chosen and sorted(map(repr, chosen)) == sorted(map(repr, want))
    for table, every in (("customers", 50), ("products", 50), ("orders", 500)):
        key = LAYERS["bronze"][table].names[0]
        number = F.try_to_number(F.col(key), F.lit("9999999999"))
        have = getattr(Bridge(spark, SF_DIR, every), table)().where(F.col(key).isNotNull()).collect()
        want = getattr(Bridge(spark, SF_DIR), table)().where(number % every == 0).collect()
        assert have and sorted(map(repr, have)) == sorted(map(repr, want))


def test_records_are_split_without_a_sort(spark, tmp_path, monkeypatch):
    """Both folders stay open while a task writes; Spark sorts by folder where that is not allowed."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(CUSTOMERS)
    conf, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (seen.append(spark.conf.get(conf)), write(self, *a, **b))[1])
    before = spark.conf.get(conf)
    _, rejects, counts = landing.split_landing(spark, "customers", str(tmp_path / "in"), str(tmp_path / "out"))
    assert seen == ["2"] and spark.conf.get(conf) == before
    assert counts == {"good": 1, "rejected": 2} and rejects.where("source_file LIKE '%a.csv'").count() == 2


def test_months_are_written_side_by_side(spark, tmp_path, monkeypatch):
    """Few months per task are not sorted; a task with more months than that writes every row as well."""
    conf, seen, save = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **b: (seen.append(spark.conf.get(conf)), save(self, *a, **b))[1])
    layers = entry.Layers(spark, SF_DIR)
    orders = layers("fact_orders").coalesce(1)
    months = orders.select(F.date_format("order_date", "yyyy-MM")).distinct().count()
    store = PathStore(spark, str(tmp_path))
    monkeypatch.setattr("marketloom.sources.tables._monthly", lambda df, layer, table: df.withColumn("_month", F.date_format("order_date", "yyyy-MM")))
    store.overwrite("silver", "fact_orders", orders)
    assert months > OPEN_MONTHS and seen == [str(OPEN_MONTHS)]
    assert sorted(map(repr, store.read("silver", "fact_orders").collect())) == sorted(map(repr, orders.collect()))


def test_the_sentiment_table_is_not_dealt_by_range(spark, landed, tmp_path):
    """Its window has spread it by product already; each file is sorted by product and month."""
    store = PathStore(spark, str(tmp_path))
    full_refresh(spark, landed, store, LOAD_TS, LOAD_TS, AS_OF, PLANTED)
    assert "agg_review_sentiment" not in READ_ORDER
    frame = store.read("golden", "agg_review_sentiment").select(F.input_file_name().alias("f"), "product_id", "review_month")
    files, ordered = {}, {}
    for row in frame.collect():
        files.setdefault(row.product_id, set()).add(row.f)
        ordered.setdefault(row.f, []).append((row.product_id, row.review_month or ""))
    assert len(ordered) >= 1 and all(len(found) == 1 for found in files.values())
    assert all(rows == sorted(rows) for rows in ordered.values())


def test_a_landing_with_malformed_records_reconciles(spark, tmp_path):
    """Malformed records are stored once, as few rows, and two are landed for each of them."""
    bridge = Bridge(spark, SF_DIR)
    path = bridge.land_csv("products", str(tmp_path))
    clean = landing.read_landing(spark, "products", path).count()
    with recorded() as scratch:
        bridge.land_malformed("products", path)
    assert len(scratch) == 1
    chosen = spark.read.parquet(scratch[0]).count()
    _, _, counts = landing.split_landing(spark, "products", path, str(tmp_path / "split"))
    assert chosen > 0 and counts == {"good": clean, "rejected": 2 * chosen}
