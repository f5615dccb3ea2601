"""The registered queries: each runs an operator over whole tables and returns its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.functions import columns as C
from ordermill.operators import (
    cleaning,
    enrichment,
    incremental,
    landing,
    ledger,
    merging,
    quality,
    reports,
    retention,
    writing,
)
from ordermill.plans import inputs as I
from ordermill.plans.inputs import Inputs, as_of, run_ts
from ordermill.settings import Thresholds
from ordermill.sources import listing, synthetic, tables
from ordermill.streaming import intake, new_files

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}

_AUDIT = ("created_at", "updated_at")
_ONE_DAY = "1995-04-01"


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function):
        return lambda spark, folder: I.naive(function(Inputs(spark, folder)))

    return {name: bind(function) for name, function in _QUERIES.items()}


def _read(i: Inputs, path: str) -> DataFrame:
    return tables.read_files(i.spark, [path], schemas.ENRICHED)


# Scans, sinks, layout


@query
def scan_orders(i: Inputs) -> DataFrame:
    return i.orders()


@query
def scan_partition(i: Inputs) -> DataFrame:
    return tables.read_landed(i.spark, i.landing_path(), "orders", _ONE_DAY)


@query
def scan_latest_dim(i: Inputs) -> DataFrame:
    return tables.read_latest(i.spark, i.landing_path()).drop("signup_date")


@query
def scan_latest_csv(i: Inputs) -> DataFrame:
    """A snapshot landed as CSV; files of the one before are still there and not read."""
    root = i.fresh("snapshots")
    folder = f"{root}/source=user_segments/latest"
    old = i.segments().withColumn("segment", F.lit("old"))
    old.write.parquet(folder)
    i.segments().write.mode("append").option("header", True).csv(folder)
    new = listing.list_files(i.spark, root).where("file_name LIKE '%.csv'").select("file_name").collect()
    tables.set_snapshot(root, "user_segments", [r["file_name"] for r in new])
    return tables.read_latest(i.spark, root).drop("signup_date")


@query
def scan_day_both_formats(i: Inputs) -> DataFrame:
    """A day whose settled orders came as Parquet and as CSV, its pending ones as CSV only."""
    root = i.fresh("landed")
    folder = tables.landed_folder(root, "orders", _ONE_DAY)
    orders = tables.read_landed(i.spark, i.landing_path(), "orders", _ONE_DAY)
    settled, pending = orders.where("status <> 'pending'"), orders.where("status = 'pending'")
    settled.write.parquet(folder)
    settled.write.mode("append").option("header", True).csv(folder)
    pending.write.mode("append").option("header", True).csv(folder)
    return tables.read_day(i.spark, root, "orders", _ONE_DAY)


@query
def scan_csv(i: Inputs) -> DataFrame:
    path = i.fresh("csv")
    i.staging().select("order_id", "user_id", "amount", "currency", "status").write.option(
        "header", True
    ).csv(path)
    return tables.read_csv(
        i.spark, path, "order_id string, user_id string, amount double, currency string, status string"
    )


@query
def sink_partition_overwrite(i: Inputs) -> DataFrame:
    """Writes all dates, then one date again with other amounts; the other dates stay."""
    path = i.fresh("processed")
    day = F.col("process_date") == F.lit(_ONE_DAY).cast("date")
    writing.write_enriched(i.staging(), path)
    writing.write_enriched(i.staging().where(day).withColumn("amount", F.col("amount") + 1), path)
    return _read(i, path)


@query
def sink_csv_and_parquet(i: Inputs) -> DataFrame:
    path = i.fresh("dual")
    rows = i.staging().select("order_id", "amount")
    writing.write_csv_and_parquet(rows, path)
    schema = "order_id string, amount double"
    back = tables.read_csv(i.spark, f"{path}/csv", schema).select("*", F.lit("csv").alias("format"))
    return back.unionByName(
        i.spark.read.schema(schema).parquet(f"{path}/parquet").withColumn("format", F.lit("parquet"))
    )


@query
def load_staging_truncate(i: Inputs) -> DataFrame:
    """Loads one date of the processed table over an older staging table."""
    path = i.fresh("staging")
    writing.load_staging(i.merge_target(), path)
    day = tables.read_partitions(i.spark, i.staging_path(), _ONE_DAY, _ONE_DAY)
    writing.load_staging(day, path)
    return _read(i, path)


@query
def load_staging_multifile(i: Inputs) -> DataFrame:
    """Bag union of two folders, one of which lacks a column."""
    first, second = i.fresh("part-a"), i.fresh("part-b")
    early = F.col("process_date") < F.lit(I.LOST_MONTH).cast("date")
    i.staging().where(early).drop("country").write.parquet(first)
    i.staging().where(~early).write.parquet(second)
    path = i.fresh("staging")
    writing.load_staging(tables.read_files(i.spark, [first, second], schemas.ENRICHED), path)
    return _read(i, path)


@query
def verify_staging_count(i: Inputs) -> DataFrame:
    return writing.row_count(i.staging())


@query
def not_null_gate(i: Inputs) -> DataFrame:
    """Good rows pass the NOT NULL check of the table definition unchanged."""
    return writing.enforce_not_null(i.staging())


@query
def clustered_layout(i: Inputs) -> DataFrame:
    path = i.fresh("clustered")
    writing.write_enriched(i.staging(), path, clustered=True)
    return _read(i, path)


@query
def guarded_partition_read(i: Inputs) -> DataFrame:
    return tables.read_partitions(i.spark, i.production_path(), "1995-01-01", "1996-12-31")


@query
def guarded_view(i: Inputs) -> DataFrame:
    """The SQL view of production, which takes a query that bounds the date and no other."""
    tables.register_views(i.spark, i.staging_path(), i.production_path(), as_of())
    return i.spark.sql(
        "SELECT order_id, user_id, amount, process_date FROM enriched_orders "
        "WHERE process_date >= DATE '1995-01-01' AND process_date < DATE '1996-01-01'"
    )


@query
def view_last_90d(i: Inputs) -> DataFrame:
    newest = i.staging().agg(F.max("process_date")).scalar()
    return tables.last_days(i.staging(), newest, 90)


@query
def stg_projection(i: Inputs) -> DataFrame:
    text = F.when(F.col("status") == "refunded", "bad-date").otherwise(
        F.col("process_date").cast("string")
    )
    return tables.staging_view(i.staging().withColumn("process_date", text))


@query
def expire_partitions(i: Inputs) -> DataFrame:
    zones = F.explode(F.array(*[F.lit(z) for z in ("raw", "quarantine", "staging", "validated")]))
    found = i.given("events").select(F.to_date("ts").alias("dt")).distinct()
    return retention.expired_partitions(
        found.select(zones.alias("zone"), "dt"), F.lit("2024-02-06").cast("date")
    )


@query
def synth_orders(i: Inputs) -> DataFrame:
    rows = i.given("orders").select(F.col("o_orderkey").alias("row"))
    return synthetic.synth_orders(rows)


@query
def synth_events(i: Inputs) -> DataFrame:
    rows = i.given("events").select(F.col("event_id").alias("row"))
    return synthetic.synth_events(rows)


@query
def synth_segments(i: Inputs) -> DataFrame:
    users = i.given("customer").select(F.col("c_custkey").alias("row"))
    population = users.count()
    return synthetic.synth_segments(users, population, population // 10)


# Landing


@query
def file_inventory(i: Inputs) -> DataFrame:
    """Landed files of each source, day and format, and how many of them are empty."""
    files = landing.with_day(landing.with_source(listing.list_files(i.spark, i.landing_path())))
    kind = F.regexp_extract("file_name", r"\.([a-z]+)$", 1)
    return files.groupBy("source", "dt", kind.alias("format")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") == 0).alias("empty_files")
    )


@query
def pending_transfer(i: Inputs) -> DataFrame:
    return landing.pending(i.files().select("file_name", "length"), i.ledger())


@query
def pending_validation(i: Inputs) -> DataFrame:
    return landing.pending(i.files().select("file_name", "length"), i.ledger(), True)


@query
def ledger_upsert(i: Inputs) -> DataFrame:
    entries = landing.ledger_entries(landing.judge(i.files()), run_ts())
    return landing.upsert_ledger(i.ledger(), entries)


@query
def ledger_compacted(i: Inputs) -> DataFrame:
    """The stored ledger after several runs and a compaction: the newest entry of each file."""
    path = i.fresh("ledger")
    known = i.ledger().withColumn("run", F.pmod(F.crc32("file_name"), F.lit(3)))
    for run in range(3):
        landing.append_ledger(known.where(F.col("run") == run), path)
    landing.append_ledger(landing.ledger_entries(landing.judge(i.files()), run_ts()), path)
    ledger.compact(i.spark, path, max_runs=1)
    return landing.latest_entries(landing.read_ledger(i.spark, path))


@query
def detect_source(i: Inputs) -> DataFrame:
    paths = i.files().select("file_name").unionAll(
        i.given("documents").select(F.concat(F.col("source"), F.lit("/x.parquet")))
    )
    return landing.with_source(paths)


@query
def reject_empty_file(i: Inputs) -> DataFrame:
    judged = landing.judge(i.files())
    return judged.where(F.col("length") == 0).select("file_name", "status")


def _checked_files(i: Inputs, suffix: str) -> DataFrame:
    files = listing.list_files(i.spark, i.landing_path()).where(F.col("file_name").endswith(suffix))
    judged = landing.with_day(
        landing.judge(listing.inspect_files(files, i.landing_path(), count_csv_rows=True))
    )
    header = F.when(F.col("file_name").endswith(".csv"), 1).otherwise(0)
    return judged.groupBy("source", "dt", "is_valid").agg(
        F.max(F.array_join("missing", ",")).alias("missing"),
        F.sum(F.col("rows") - header).alias("rows"),
    )


@query
def schema_check_parquet(i: Inputs) -> DataFrame:
    return _checked_files(i, ".parquet")


@query
def schema_check_csv(i: Inputs) -> DataFrame:
    return _checked_files(i, ".csv")


@query
def missing_required(i: Inputs) -> DataFrame:
    missing = landing.missing_columns(F.col("source"), F.col("columns"))
    return landing.with_source(i.files()).select(
        "file_name", F.array_join(missing, ",").alias("missing"), F.size(missing).alias("n_missing")
    )


@query
def registry_lookup(i: Inputs) -> DataFrame:
    required = schemas.required_columns(F.col("source"))
    return landing.with_source(i.files()).select(
        "file_name", "source", F.array_join(required, ",").alias("required")
    )


@query
def format_dispatch(i: Inputs) -> DataFrame:
    return landing.judge(i.files()).select("file_name", "is_valid", "message")


@query
def route_files(i: Inputs) -> DataFrame:
    return landing.route(landing.judge(i.files())).select("file_name", "status", "zone")


@query
def validation_summary(i: Inputs) -> DataFrame:
    known = i.ledger().select("file_name", F.lit(True).alias("known"))
    judged = landing.judge(i.files()).join(known, "file_name", "left")
    status = F.when(F.col("known"), landing.SKIPPED).otherwise(F.col("status"))
    return landing.summarize(judged.withColumn("status", status))


@query
def quarantine_rate(i: Inputs) -> DataFrame:
    return landing.quarantine_rate(landing.judge(i.files()))


@query
def quarantine_rows(i: Inputs) -> DataFrame:
    _, bad = cleaning.split_by_contract(i.orders())
    return bad.select("order_id", "seq", "amount", F.array_join("reasons", "; ").alias("reasons"))


@query
def good_rows(i: Inputs) -> DataFrame:
    good, _ = cleaning.split_by_contract(i.orders())
    return good


@query
def schema_drift(i: Inputs) -> DataFrame:
    """Landed files of all sources against the contract, by what the files themselves say."""
    root = i.landing_path()
    files = listing.inspect_files(listing.list_files(i.spark, root), root, read_pages=False, count_csv_rows=False)
    return landing.schema_drift(schemas.contract_frame(i.spark), landing.file_columns(files))


@query
def schema_drift_by_day(i: Inputs) -> DataFrame:
    """Landed files of dated sources against the contract, with how many files of a day differ."""
    root = i.landing_path()
    files = listing.inspect_files(listing.list_files(i.spark, root), root, read_pages=False, count_csv_rows=False)
    drift = landing.drift_by_day(schemas.contract_frame(i.spark), landing.file_signatures(files))
    return drift.where("dt IS NOT NULL")


@query
def stream_new_files(i: Inputs) -> DataFrame:
    """Two runs of the stream over landed orders; the second finds nothing new."""
    target, checkpoint = i.fresh("stream"), i.fresh("stream-state")
    for _ in range(2):
        rows = new_files.new_files(i.spark, i.landing_path(), "orders")
        new_files.append_new_files(rows, target, checkpoint, cleaning.valid_orders).awaitTermination()
    return i.spark.read.schema(schemas.ORDERS).parquet(target).drop("dt")


@query
def stream_validated(i: Inputs) -> DataFrame:
    """Two runs of the judged intake over landed events: files that lack a column or are damaged stay out,
    and the second run finds nothing new."""
    target, state, path = i.fresh("intake"), i.fresh("intake-state"), i.fresh("intake-ledger")
    for _ in range(2):
        intake.take_in(i.spark, i.landing_path(), "events", target, state, path)
    like = i.spark.createDataFrame([], schemas.EVENTS)
    return intake.taken(i.spark, target, state, like).drop("page_url", "session_id")


# Filters and projections


@query
def filter_positive_amount(i: Inputs) -> DataFrame:
    return cleaning.positive_amounts(i.orders())


@query
def filter_user_not_null(i: Inputs) -> DataFrame:
    return cleaning.known_users(i.orders())


@query
def null_key_filter(i: Inputs) -> DataFrame:
    return cleaning.null_keys(i.orders(), "user_id")


@query
def narrow_dimension(i: Inputs) -> DataFrame:
    return enrichment.segment_columns(i.segments())


@query
def project_enriched(i: Inputs) -> DataFrame:
    return i.enriched()


@query
def run_date_column(i: Inputs) -> DataFrame:
    """The run date in place of the orders' own date."""
    rows = enrichment.enrich(i.orders(), i.events(), i.segments(), "2026-03-19", run_ts())
    return rows.select("order_id", "process_date")


@query
def audit_columns(i: Inputs) -> DataFrame:
    return merging.stamped(i.merge_target(), run_ts()).select("order_id", *_AUDIT)


@query
def one_date(i: Inputs) -> DataFrame:
    return tables.read_partitions(i.spark, i.production_path(), _ONE_DAY, _ONE_DAY)


@query
def incremental_watermark(i: Inputs) -> DataFrame:
    orders = i.orders().withColumn("updated_at", F.col("created_at"))
    return incremental.newer_than(orders, "1997-06-30 00:00:00")


@query
def watermark_state(i: Inputs) -> DataFrame:
    """Two advances of the state table, then the mark the next run starts from."""
    path = i.fresh("watermarks")
    orders = i.orders().withColumn("updated_at", F.col("created_at").cast("timestamp"))
    pending = orders.where(F.col("status") == "pending")
    incremental.advance_watermark(pending, path, "orders")
    incremental.advance_watermark(orders, path, "orders")
    mark = incremental.read_watermark(i.spark, path, "orders", "1970-01-01 00:00:00")
    return orders.agg(
        F.lit(mark).cast("timestamp").alias("watermark"),
        F.count_if(F.col("updated_at") > F.lit(mark)).alias("rows_after"),
    )


@query
def incremental_max_date(i: Inputs) -> DataFrame:
    newest = incremental.newest_partition(
        i.spark, i.production_path(), floor="1990-01-01", before=I.DOUBLED_MONTH
    )
    return incremental.since_date(i.staging(), newest)


@query
def recent_done_queries(i: Inputs) -> DataFrame:
    return reports.recent_done_queries(i.jobs(), as_of(), 48).drop("referenced_tables")


@query
def case_labels(i: Inputs) -> DataFrame:
    metrics = reports.pipeline_metrics(_staging_with_copies(i), i.production(), as_of())
    return metrics.select("process_date", "completeness_status", "uniqueness_status")


# Dedup, joins, aggregates


@query
def dedup_orders(i: Inputs) -> DataFrame:
    return cleaning.dedup_orders(i.orders())


@query
def dedup_events(i: Inputs) -> DataFrame:
    return cleaning.dedup_events(i.events())


@query
def join_segments_broadcast(i: Inputs) -> DataFrame:
    return enrichment.join_segments(i.orders(), i.segments())


@query
def join_event_aggregates(i: Inputs) -> DataFrame:
    return enrichment.join_event_counts(i.orders(), enrichment.events_per_user(i.events()))


@query
def enriched_orders(i: Inputs) -> DataFrame:
    return i.enriched().drop(*_AUDIT)


@query
def enriched_orders_exact(i: Inputs) -> DataFrame:
    """With distinct event types and the two-digit amount in the hash."""
    rows = enrichment.enrich(
        i.orders(), i.events(), i.segments(), event_types="set", exact_amount=True
    )
    return rows.select("order_id", "event_types", "row_hash")


@query
def join_reconcile(i: Inputs) -> DataFrame:
    joined = reports.reconcile(i.staging(), i.production())
    return joined.select("process_date", "staging_rows", "production_rows", "last_updated_at")


@query
def unnest_tables(i: Inputs) -> DataFrame:
    return reports.by_referenced_table(i.jobs()).select("job_id", "table_id")


@query
def events_per_user(i: Inputs) -> DataFrame:
    return enrichment.events_per_user(i.events()).drop("event_types")


@query
def event_types_list(i: Inputs) -> DataFrame:
    return enrichment.events_per_user(i.events()).drop("event_count")


@query
def event_types_set(i: Inputs) -> DataFrame:
    return enrichment.events_per_user(i.events(), "set").drop("event_count")


@query
def row_hash(i: Inputs) -> DataFrame:
    return i.orders().select(
        "order_id",
        "seq",
        C.row_hash().alias("row_hash"),
        C.row_hash(exact_amount=True).alias("row_hash_exact"),
    )


@query
def concat_skip_nulls(i: Inputs) -> DataFrame:
    return i.orders().select("order_id", "seq", F.concat_ws("||", "order_id", "user_id").alias("joined"))


@query
def amount_text(i: Inputs) -> DataFrame:
    amount = F.col("amount")
    return i.orders().select(
        "order_id", "seq", amount.cast("string").alias("shown"),
        C.money(amount).cast("string").alias("exact"),
    )


@query
def date_literal(i: Inputs) -> DataFrame:
    day = F.lit(_ONE_DAY).cast("date")
    return i.staging().where(F.col("process_date") == day).agg(
        F.max(day).alias("process_date"), F.count(F.lit(1)).alias("row_count")
    )


# Reports


def _staging_with_copies(i: Inputs) -> DataFrame:
    """Staging with one month's rows twice."""
    doubled = F.col("process_date") == F.lit("1995-04-01").cast("date")
    times = F.when(doubled, 2).otherwise(1)
    return i.staging().select("*", F.explode(F.array_repeat(F.lit(1), times)).alias("_c")).drop("_c")


@query
def global_counts(i: Inputs) -> DataFrame:
    return reports.global_counts(i.orders(), "user_id")


@query
def staging_stats(i: Inputs) -> DataFrame:
    return reports.staging_stats(_staging_with_copies(i))


@query
def production_stats(i: Inputs) -> DataFrame:
    return reports.production_stats(i.production())


@query
def pipeline_metrics(i: Inputs) -> DataFrame:
    return reports.pipeline_metrics(_staging_with_copies(i), i.production(), as_of())


@query
def report_by_date(i: Inputs) -> DataFrame:
    """Newest date first."""
    return reports.production_stats(i.production()).select("process_date", "production_rows").orderBy(
        F.desc("process_date")
    )


@query
def revenue_variance(i: Inputs) -> DataFrame:
    return reports.revenue_variance(i.staging(), i.production())


@query
def stage_row_reconcile(i: Inputs) -> DataFrame:
    return reports.stage_counts(i.orders(), i.staging(), i.production())


@query
def defect_profile(i: Inputs) -> DataFrame:
    return reports.defect_profile(i.orders(), i.events())


@query
def cost_by_table(i: Inputs) -> DataFrame:
    return reports.cost_by_table(i.jobs(), as_of(), 24 * 30)


@query
def sort_cost_desc(i: Inputs) -> DataFrame:
    return reports.cost_by_table(i.jobs(), as_of(), 24 * 30).select("table_id", "gb_billed")


@query
def slot_usage_hourly(i: Inputs) -> DataFrame:
    return reports.slot_usage_hourly(i.jobs(), as_of(), 24 * 30)


@query
def storage_cost(i: Inputs) -> DataFrame:
    return reports.storage_cost(i.table_storage())


@query
def top_scans(i: Inputs) -> DataFrame:
    return reports.top_scans(i.jobs(), as_of(), 24 * 30)


# Merge


@query
def merge_upsert(i: Inputs) -> DataFrame:
    return merging.merge_rows(
        i.merge_target(), i.merge_source(), ["order_id", "process_date"], run_ts()
    )


@query
def merge_idempotent(i: Inputs) -> DataFrame:
    keys = ["order_id", "process_date"]
    once = merging.merge_rows(i.merge_target(), i.merge_source(), keys, run_ts())
    twice = merging.merge_rows(once, i.merge_source(), keys, as_of())
    return twice.drop("updated_at")


@query
def merge_ambiguous_guard(i: Inputs) -> DataFrame:
    return merging.ambiguous_keys(i.production())


@query
def late_arrival_merge(i: Inputs) -> DataFrame:
    """Late rows of one past date, published over the stored table."""
    path = i.fresh("production")
    writing.write_enriched(i.merge_target(), path)
    late = i.merge_source().where(F.col("process_date") == F.lit(_ONE_DAY).cast("date"))
    merging.publish_day(i.spark, late, path, _ONE_DAY, run_ts())
    return _read(i, path)


@query
def first_run_publish(i: Inputs) -> DataFrame:
    path = i.fresh("production")
    merging.publish_across_days(i.spark, i.staging(), path, as_of())
    return _read(i, path)


@query
def incremental_merge(i: Inputs) -> DataFrame:
    """Whole-row replacement over all dates; one month's orders all move to the next."""
    path = i.fresh("production")
    writing.write_enriched(i.merge_target(), path)
    moved = F.when(
        F.col("process_date") == F.lit(I.LOST_MONTH).cast("date"), F.lit(I.HALF_MONTH).cast("date")
    ).otherwise(F.col("process_date"))
    newest = incremental.newest_partition(i.spark, path, floor="1990-01-01", before=I.HALF_MONTH)
    source = incremental.since_date(i.staging(), newest).withColumn("process_date", moved)
    merging.publish_across_days(i.spark, source, path, run_ts())
    return _read(i, path)


@query
def table_materialise(i: Inputs) -> DataFrame:
    """A report replaced as a whole on every run."""
    path = i.fresh("metrics")
    for _ in range(2):
        report = reports.production_stats(i.production()).drop("total_production_revenue")
        writing.replace_table(report, path)
    return i.spark.read.schema(report.schema).parquet(path)


@query
def changed_rows(i: Inputs) -> DataFrame:
    return merging.changed_rows(i.merge_target(), i.merge_source())


@query
def merge_verify(i: Inputs) -> DataFrame:
    return merging.verify_merge(i.staging(), i.production())


# Gates, checks, tests


@query
def gate_nonempty(i: Inputs) -> DataFrame:
    return quality.nonempty_gate(quality.key_audit(i.staging()))


@query
def gate_row_explosion(i: Inputs) -> DataFrame:
    """Every user's segment comes twice, so the join doubles those orders and the gate fails."""
    doubled = i.segments().unionAll(i.segments())
    rows = enrichment.join_segments(cleaning.dedup_orders(i.orders()), doubled)
    return quality.row_explosion_gate(quality.key_audit(rows), Thresholds(max_row_growth=1.05))


@query
def gate_premerge(i: Inputs) -> DataFrame:
    return quality.premerge_gates(quality.key_audit(i.production()))


@query
def gate_thresholds(i: Inputs) -> DataFrame:
    """Limits read from configuration values."""
    limits = Thresholds.from_mapping({"min_row_count": 10**15, "max_duplicate_rate": 0.5})
    audit = quality.key_audit(i.production())
    return quality.nonempty_gate(audit, limits)


@query
def gate_message(i: Inputs) -> DataFrame:
    nulls = reports.global_counts(i.orders(), "user_id")
    return nulls.select(F.format_string(quality.NULL_KEYS, "null_keys").alias("message"))


def _checks(i: Inputs, by: tuple[str, ...] = ("process_date",)) -> DataFrame:
    return quality.run_checks(i.production(), quality.production_checks(as_of()), by)


def _one_check(i: Inputs, position: int) -> DataFrame:
    check = quality.production_checks(as_of())[position]
    return quality.run_checks(i.production(), [check], ["process_date"])


@query
def dq_row_count(i: Inputs) -> DataFrame:
    return _one_check(i, 0)


@query
def dq_null_pk(i: Inputs) -> DataFrame:
    return _one_check(i, 1)


@query
def dq_negative_amount(i: Inputs) -> DataFrame:
    return _one_check(i, 2)


@query
def dq_duplicate_rate(i: Inputs) -> DataFrame:
    return _one_check(i, 3)


@query
def dq_segment_coverage(i: Inputs) -> DataFrame:
    return _one_check(i, 4)


@query
def dq_amount_range(i: Inputs) -> DataFrame:
    return _one_check(i, 5)


@query
def dq_freshness(i: Inputs) -> DataFrame:
    return _one_check(i, 6)


@query
def dq_suite(i: Inputs) -> DataFrame:
    return _checks(i)


@query
def dq_suite_total(i: Inputs) -> DataFrame:
    return _checks(i, ())


@query
def dq_suite_apart(i: Inputs) -> DataFrame:
    """The checks with one that names a lost column and one that raises: the others still run."""
    broken = [
        quality.Check("Discounts Known", F.count("discount"), lambda v: v > 0),
        quality.Check("Currency Is A Number", F.sum(F.col("currency").cast("int")), lambda v: v > 0),
    ]
    checks = [*broken, *quality.production_checks(as_of())]

    def keep(rows: DataFrame) -> DataFrame:
        path = i.fresh("checks")
        rows.write.parquet(path)
        return i.spark.read.schema(rows.schema).parquet(path)

    return quality.run_checks_apart(i.production(), checks, keep)


@query
def dq_score(i: Inputs) -> DataFrame:
    return quality.quality_score(_checks(i), ["process_date"])


@query
def test_unique(i: Inputs) -> DataFrame:
    return quality.not_unique(i.production(), "order_id")


@query
def test_not_null(i: Inputs) -> DataFrame:
    return quality.is_null(i.orders(), "user_id")


@query
def column_tests(i: Inputs) -> DataFrame:
    return quality.column_tests(i.orders(), "user_id")
