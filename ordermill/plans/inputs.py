"""Orders, events, segments, staging and the other inputs, derived from the given tables.

Defects (NULL users, negative amounts, repeated ids, lost and doubled rows) are planted by
expression. Tables the operators expect to find stored (staging, production, landed files)
are written once per session and folder, to the work folder all executors share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.functions.columns import row_hash
from ordermill.operators import writing
from ordermill.operators.enrichment import enrich, finish, join_profiles
from ordermill.session import work_folder
from ordermill.sources.listing import open_filesystem
from ordermill.sources.tables import read_files

AS_OF = "2024-01-31 00:00:00"
RUN_TS = "2024-01-30 12:00:00"
LACKING_DAY, BAD_DAY = "2025-01-01", "2025-01-02"
LOST_MONTH, HALF_MONTH, DOUBLED_MONTH = "1995-01-01", "1995-02-01", "1995-03-01"

_GIVEN = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}

# (application, folder, name) → path of a table written in this session, and its DataFrame,
# kept because listing the files of a partitioned table takes a job of its own
_written: dict[tuple[str, str, str], str] = {}
_opened: dict[tuple[str, str, str], DataFrame] = {}


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def naive(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock time (the session runs in UTC)."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def given(self, name: str) -> DataFrame:
        return self.spark.read.schema(_GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    def fresh(self, label: str) -> str:
        return work_folder(self.spark, label)

    def stored(self, name: str, write: Callable[[str], None]) -> str:
        """Path of a table that ``write`` produces on first use."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _written:
            path = self.fresh(name)
            write(path)
            _written[key] = path
        return _written[key]

    def opened(self, name: str, path: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _opened:
            _opened[key] = read_files(self.spark, [path], schemas.ENRICHED)
        return _opened[key]

    # Sources

    def orders(self) -> DataFrame:
        """Orders with defects; every hundredth comes twice, the copy (seq 1) with other values."""
        return self.given("orders").selectExpr(
            "*", "explode(if(o_orderkey % 100 = 3, array(0, 1), array(0))) AS seq"
        ).selectExpr(
            "concat('ORD-', o_orderkey) AS order_id",
            "if(seq = 0 AND o_orderkey % 200 = 7, NULL, cast(o_custkey AS string)) AS user_id",
            "CASE WHEN seq = 1 THEN o_totalprice + 1 WHEN o_orderkey % 5000 = 42 THEN -o_totalprice "
            "ELSE o_totalprice END AS amount",
            "if(seq = 1, 'USD', elt(o_orderkey % 5 + 1, 'USD', 'EUR', 'GBP', 'INR', 'JPY')) AS currency",
            "CASE WHEN seq = 1 OR o_orderstatus = 'F' THEN 'completed' "
            "WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'refunded' END AS status",
            "o_orderdate AS created_at",
            "trunc(o_orderdate, 'month') AS process_date",
            "seq",
        )

    def events(self) -> DataFrame:
        """Events; every hundredth comes twice, the copy a minute later and with another user."""
        return self.given("events").selectExpr(
            "event_id", "user_id", "event_type", "ts",
            "explode(if(event_id % 100 = 5, array(0, 1), array(0))) AS copy",
        ).selectExpr(
            "concat('EVT-', event_id) AS event_id",
            "cast(user_id + copy AS string) AS user_id",
            "event_type",
            "ts + make_dt_interval(0, 0, copy) AS ts",
        )

    def segments(self) -> DataFrame:
        """All customers; only those with a high balance have the id of a user with orders."""
        customers = self.given("customer")
        nation = self.given("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return customers.join(nation, "c_nationkey", "left").selectExpr(
            "if(c_acctbal >= 8000, cast(c_custkey AS string), concat('store-', c_custkey)) AS user_id",
            "c_mktsegment AS segment",
            "c_acctbal AS lifetime_value",
            "n_name AS country",
        )

    def enriched(self) -> DataFrame:
        return enrich(self.orders(), self.events(), self.segments(), run_ts=run_ts())

    # Stored tables

    def staging_path(self) -> str:
        def write(path: str) -> None:
            rows = join_profiles(self.orders(), self.events(), self.segments())
            writing.write_enriched(rows, path, finish=lambda laid_out: finish(laid_out, run_ts()))

        return self.stored("staging", write)

    def staging(self) -> DataFrame:
        return self.opened("staging", self.staging_path())

    def production_path(self) -> str:
        return self.stored("production", lambda p: writing.write_in_place(self._production(), p))

    def _production(self) -> DataFrame:
        """Staging with one month lost, one without its pending orders and one doubled."""
        copies = f"""CASE WHEN process_date = DATE '{LOST_MONTH}' THEN 0
            WHEN process_date = DATE '{HALF_MONTH}' AND status = 'pending' THEN 0
            WHEN process_date = DATE '{DOUBLED_MONTH}' THEN 2 ELSE 1 END"""
        return self.staging().selectExpr("*", f"explode(array_repeat(1, {copies})) AS _copy").drop("_copy")

    def production(self) -> DataFrame:
        return self.opened("production", self.production_path())

    def merge_source(self) -> DataFrame:
        return self.staging().where("status <> 'refunded'")

    def merge_target(self) -> DataFrame:
        """What an earlier load left: no pending orders, amounts one lower, an older stamp."""
        earlier = F.lit("2024-01-01 00:00:00").cast("timestamp")
        return (
            self.staging()
            .where("status <> 'pending'")
            .withColumn("amount", F.expr("amount - 1"))
            .withColumns({"row_hash": row_hash(), "created_at": earlier, "updated_at": earlier})
        )

    # Job history, storage, files

    def jobs(self) -> DataFrame:
        return self.given("events").selectExpr(
            "cast(event_id AS string) AS job_id",
            "concat('SELECT ', event_type) AS query",
            "cast(ts AS timestamp) AS creation_time",
            "if(event_type = 'error', 'LOAD', 'QUERY') AS job_type",
            "if(user_id % 10 = 9, 'RUNNING', 'DONE') AS state",
            "cast(floor(value * 1e9D) AS bigint) AS total_bytes_billed",
            "cast(floor(value * 1000) AS bigint) AS total_slot_ms",
            """CASE user_id % 3 WHEN 0 THEN cast(array() AS array<struct<table_id:string>>)
               WHEN 1 THEN array(named_struct('table_id', event_type))
               ELSE array(named_struct('table_id', event_type), named_struct('table_id', 'dim'))
               END AS referenced_tables""",
        )

    def table_storage(self) -> DataFrame:
        return self.given("part").selectExpr(
            "p_brand AS table_schema", "p_size * 1000000000L AS total_logical_bytes"
        )

    def files(self) -> DataFrame:
        """One landed file per document: name, size and what its head shows."""
        return self.given("documents").selectExpr(
            "doc_id", "n_chars",
            "elt(doc_id % 4 + 1, 'orders', 'events', 'user_segments', 'other') AS lands_as",
            "CASE WHEN doc_id % 7 = 0 THEN '.csv' WHEN doc_id % 11 = 0 THEN '.json' "
            "ELSE '.parquet' END AS suffix",
            "elt(doc_id % 3 + 1, 'order_id,user_id,amount,currency,process_date', "
            "'user_id,segment,country,order_id', "
            "'event_id,user_id,event_type,timestamp,process_date') AS head",
            "doc_id % 50 = 0 AS is_empty",
        ).selectExpr(
            "concat('source=', lands_as, '/dt=2026-03-19/', doc_id, suffix) AS file_name",
            "if(is_empty, 0L, n_chars) AS length",
            "if(is_empty, NULL, split(head, ',')) AS columns",
            "if(is_empty, NULL, n_chars) AS rows",
            "if(NOT is_empty AND suffix = '.parquet' AND doc_id % 97 = 0, "
            "'Corrupt Parquet: no footer', NULL) AS error",
        )

    def ledger(self) -> DataFrame:
        """Files handled before: those of the labelled documents."""
        named = self.files().selectExpr(
            "file_name", r"cast(regexp_extract(file_name, '/(\\d+)\\.[a-z]+$', 1) AS bigint) AS doc_id"
        )
        return named.join(self.given("labels"), "doc_id").selectExpr(
            "file_name",
            "TIMESTAMP '2024-01-01 00:00:00' AS processed_at",
            "if(quality = 1, 'validated', 'quarantined:empty') AS status",
        )

    def landing_path(self) -> str:
        return self.stored("landing", self._write_landing)

    def _write_landing(self, root: str) -> None:
        """Landed files: orders, events (Parquet, and CSV without its time column), segments, a
        source the registry does not know, and bad files of events on days of their own."""
        iso = "yyyy-MM-dd'T'HH:mm:ss"
        orders = self.orders().select(
            "order_id", "user_id", "amount", "currency", "status",
            F.date_format("created_at", iso).alias("created_at"),
            F.col("process_date").cast("string").alias("process_date"),
            F.col("process_date").alias("dt"),
        )
        events = self.events().select(
            "event_id", "user_id", "event_type",
            F.date_format("ts", iso).alias("timestamp"),
            F.to_date("ts").cast("string").alias("process_date"),
            F.to_date("ts").alias("dt"),
        )

        def by_day(df: DataFrame):
            return df.hint("rebalance", F.col("dt")).write.mode("append").partitionBy("dt")

        by_day(orders).parquet(f"{root}/source=orders")
        by_day(events).parquet(f"{root}/source=events")
        by_day(events.withColumnRenamed("timestamp", "ts")).option("header", True).csv(
            f"{root}/source=events"
        )
        self.segments().hint("rebalance").write.mode("append").parquet(f"{root}/source=user_segments/latest")
        self.given("nation").hint("rebalance").write.mode("append").parquet(f"{root}/source=nations/latest")
        lacking = events.where("dt = DATE '2024-01-01'").drop("timestamp", "dt").hint("rebalance")
        lacking.write.mode("append").parquet(
            f"{root}/source=events/dt={LACKING_DAY}"
        )
        filesystem, base = open_filesystem(root)
        for name, content in (("corrupt", b"PAR1 no footer here PAR1"), ("empty", b"")):
            folder = f"{base}/source=events/dt={BAD_DAY}"
            filesystem.create_dir(folder, recursive=True)
            with filesystem.open_output_stream(f"{folder}/{name}.parquet") as out:
                out.write(content)
