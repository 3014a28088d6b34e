"""Star-schema parquet tables -> the four raw retail frames (see FIXTURES.md).

The star schema has no e-mails, genders, ratings or payment names, so these
are derived by fixed expressions; malformed, missing, duplicate and outdated
values are planted on purpose.  All value columns are text, as in landing files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.contracts import BRONZE, file_schema
from marketloom.sources.landing import CSV_OPTIONS
from marketloom.sources.scratch import scratch_path, stored

# Reference date and load time of the derived data.
AS_OF = dt.date(2001, 8, 2)
LOAD_TS = dt.datetime(2001, 8, 2, tzinfo=dt.timezone.utc)

INGESTED = (
    "timestamp(if(stale, timestamp_ntz'2001-08-01', timestamp_ntz'2001-08-02')) AS ingestion_date"
)

# Columns of the star schema that are used here.  Declaring them
# saves a schema-inference job per table.
STAR_SCHEMA = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _decimal_text(cents: str) -> str:
    """SQL for whole cents as text with two decimals."""
    return f"concat(if({cents} < 0, '-', ''), abs({cents}) div 100, '.', lpad(abs({cents}) % 100, 2, '0'))"


# Keys of added rows that no fact refers to, and of rows without any value.
LONE, BLANK = 1_000_000_000, 2_000_000_000


def _with_copies(df: DataFrame, key: str, lone: int | None = None, blank: int | None = None) -> DataFrame:
    """Add rows without a second scan: an outdated copy (``stale``) of every tenth key, a copy under a
    new key of every ``lone``-th one, and one that loses all values (``blank``) of every ``blank``-th one."""
    def only(every: int, variant: str) -> str:
        return f"if({key} % {every} = 0, array({variant}), array())"

    variants = ["array(named_struct('stale', false, 'blank', false, 'shift', 0L))",
                only(10, "named_struct('stale', true, 'blank', false, 'shift', 0L)")]
    if lone:
        variants.append(only(lone, f"named_struct('stale', false, 'blank', false, 'shift', {LONE}L)"))
    if blank:
        variants.append(only(blank, f"named_struct('stale', false, 'blank', true, 'shift', {BLANK}L)"))
    return (
        df.withColumn("copy", F.expr(f"explode(concat({', '.join(variants)}))"))
        .select(*[(F.col(key) + F.col("copy.shift")).alias(key) if c == key else c for c in df.columns], "copy.stale", "copy.blank")
    )


class Bridge:
    """The raw frames derived from the parquet tables in ``folder``.

    With ``every`` only those of keys divisible by it, which are chosen before anything is joined.
    """

    def __init__(self, spark: SparkSession, folder: str, every: int = 1):
        self.spark, self.folder, self.every = spark, folder.rstrip("/"), every

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMA[name]).parquet(f"{self.folder}/{name}.parquet")

    def _chosen(self, name: str, key: str) -> DataFrame:
        table = self._table(name)
        return table if self.every == 1 else table.where(F.col(key) % self.every == 0)

    def _fact(self, name: str, key: str) -> DataFrame:
        """A fact table, spread by ``key`` if it comes in fewer files than there are cores.

        A parquet file of one row group is read by one task; a table of many
        files is left as it is, and so are a few chosen rows.
        """
        table, cores = self._chosen(name, key), self.spark.sparkContext.defaultParallelism
        return table.repartition(cores, key) if self.every == 1 and len(table.inputFiles()) < cores else table

    def customers(self) -> DataFrame:
        joined = self._chosen("customer", "c_custkey").join(
            self._table("nation"), F.expr("c_nationkey = n_nationkey"), "left"
        )
        return _with_copies(joined, "c_custkey", lone=50, blank=100).selectExpr(
            "string(c_custkey) AS customer_id",
            "if(blank, NULL, concat('  ', lower(c_name), if(stale, ' old', ' '))) AS name",
            """CASE WHEN blank OR c_custkey % 23 = 0 THEN NULL
                    WHEN c_custkey % 17 = 0 THEN concat('bad.', c_custkey)
                    ELSE concat(' USER', c_custkey, '@Example.COM ') END AS email""",
            """if(blank, NULL, element_at(array('M', 'f', 'male', ' female ', 'Other', NULL),
                                         int(c_custkey % 6) + 1)) AS gender""",
            """CASE WHEN blank THEN NULL WHEN c_custkey % 29 = 0 THEN '2000-13-01'
                    ELSE concat(1995 + c_custkey % 5, '-0', 1 + c_custkey % 9, '-', 10 + c_custkey % 10)
               END AS signup_date""",
            "if(blank, NULL, n_name) AS country",
            INGESTED,
        )

    def orders(self) -> DataFrame:
        joined = (
            self._fact("orders", "o_orderkey")
            .join(self._table("customer"), F.expr("o_custkey = c_custkey"), "left")
            .join(self._table("nation"), F.expr("c_nationkey = n_nationkey"), "left")
        )
        amount = _decimal_text("(bigint(rint(o_totalprice * 100)) div 1000)")
        return _with_copies(joined, "o_orderkey").selectExpr(
            "string(o_orderkey) AS order_id",
            "if(o_orderkey % 211 <> 0, string(o_custkey), NULL) AS customer_id",
            "if(o_orderkey % 83 = 0, 'bad-date', string(date(o_orderdate))) AS order_date",
            f"""CASE WHEN o_orderkey % 97 = 0 THEN '-1.00' WHEN o_orderkey % 89 = 0 THEN 'n/a'
                     WHEN stale THEN '0.01' ELSE {amount} END AS total_amount""",
            """CASE o_orderpriority WHEN '1-URGENT' THEN ' Credit Card' WHEN '2-HIGH' THEN 'PayPal'
                    WHEN '3-MEDIUM' THEN 'CASH ' WHEN '4-NOT SPECIFIED' THEN 'Bank Transfer'
                    ELSE 'Voucher' END AS payment_method""",
            "n_name AS shipping_country",
            INGESTED,
        )

    def products(self) -> DataFrame:
        price = _decimal_text("((bigint(rint(p_retailprice * 100)) - 90000) * 5)")
        return _with_copies(self._chosen("part", "p_partkey"), "p_partkey", lone=40).selectExpr(
            "if(p_partkey % 199 <> 0, string(p_partkey), NULL) AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            f"""CASE WHEN p_partkey % 71 = 0 THEN '-5.00' WHEN p_partkey % 73 = 0 THEN 'n/a'
                     WHEN stale THEN '0.01' ELSE {price} END AS price""",
            "if(p_partkey % 79 = 0, '-1', string((p_size - 1) * 20)) AS stock_quantity",
            "p_brand AS brand",
            INGESTED,
        )

    def product_reviews(self) -> DataFrame:
        joined = (
            self._fact("lineitem", "l_orderkey")
            .join(self._table("orders"), F.expr("l_orderkey = o_orderkey"), "left")
        )
        text = "concat(l_returnflag, l_linestatus, ' review of ', l_partkey)"
        return joined.selectExpr(
            "concat(l_orderkey, '-', l_linenumber) AS review_id",
            "string(l_partkey) AS product_id",
            "if(l_orderkey % 211 <> 0, string(o_custkey), NULL) AS customer_id",
            """CASE WHEN l_linenumber = 7 THEN '9' WHEN l_orderkey % 101 = 0 THEN 'five'
                    ELSE string(ceil(l_quantity / 10)) END AS rating""",
            f"""CASE WHEN l_suppkey % 13 = 0 THEN NULL
                     WHEN l_suppkey % 11 = 0
                     THEN concat({text}, ': "fine", they say', char(10), 'and more')
                     ELSE {text} END AS review_text""",
            "string(date(l_shipdate)) AS review_date",
            "timestamp(l_shipdate) AS ingestion_date",
        )

    def bronze(self, table: str) -> DataFrame:
        assert table in BRONZE, table
        return getattr(self, table)()

    def land_csv(self, table: str, root: str | None = None) -> str:
        """Write one frame as landing CSV files (the audit column is not part of them)."""
        path = f"{root or scratch_path(self.spark, 'landing')}/{table}"
        (
            self.bronze(table)
            .select(*file_schema(table).names)
            .write.mode("overwrite")
            .options(header=True, **CSV_OPTIONS, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
            .csv(path)
        )
        return path

    def land_malformed(self, table: str, path: str) -> None:
        """Add records that do not fit the table to its landing folder: two fields only, or one too many.

        They are made of the rows of every 50th key (orders and reviews: of every 500th order), read once.
        """
        names = file_schema(table).names
        every = 500 if table in ("orders", "product_reviews") else 50
        raw = Bridge(self.spark, self.folder, every).bronze(table).select(*names)
        chosen = stored(raw.where(F.col(names[0]).isNotNull()), "chosen")
        surplus = chosen.withColumn("surplus", F.lit("more"))
        for frame in (chosen.select(*names[:2]), surplus):
            writer = frame.write.mode("append").options(header=True, **CSV_OPTIONS)
            writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
