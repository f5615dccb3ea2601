"""The daily jobs, each from stored tables to stored tables.

validate → enrich → load → publish → report → test; every step may be run again on its own.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.functions.columns import partition_day
from ordermill.operators import (
    enrichment,
    incremental,
    landing,
    merging,
    quality,
    reports,
    retention,
    writing,
)
from ordermill.session import size_shuffles, work_folder
from ordermill.settings import Locations, Settings
from ordermill.sources import listing, synthetic, tables

log = logging.getLogger("ordermill")


def _run(df: DataFrame) -> None:
    """Runs a plan for what its tasks do; the rows themselves are not needed."""
    df.write.format("noop").mode("overwrite").save()


def _held(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared work folder, so that later steps do not run the plan,
    with its reads of the landing zone, again."""
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def make_samples(
    spark: SparkSession,
    at: Locations,
    plan: synthetic.SynthPlan = synthetic.SynthPlan(),
    orders: int = 100_000,
    events: int = 500_000,
    segments: int = 1_000,
) -> None:
    """Lands synthetic orders, events (Parquet and CSV) and segments (Parquet)."""
    day = F.lit(plan.run_date).alias("dt")
    for source, rows in (
        ("orders", synthetic.synth_orders(synthetic.row_numbers(spark, orders), plan)),
        ("events", synthetic.synth_events(synthetic.row_numbers(spark, events), plan)),
    ):
        dated = rows.select("*", day)
        path = f"{at.raw}/source={source}"
        dated.write.mode("append").partitionBy("dt").parquet(path)
        dated.write.mode("append").option("header", True).partitionBy("dt").csv(path)
    users = synthetic.row_numbers(spark, plan.users)
    sample = synthetic.synth_segments(users, plan.users, min(segments, plan.users), plan)
    writing.replace_table(sample, f"{at.raw}/source=user_segments/latest")


def transfer(spark: SparkSession, origin: str, at: Locations) -> int:
    """Copies files of ``origin`` that the ledger does not know yet into the raw zone."""
    ledger_path = f"{at.ledger}-transfer"
    files = listing.list_files(spark, origin)
    new = landing.pending(files, landing.read_ledger(spark, ledger_path))
    new = _held(new.withColumn("zone", F.lit("raw")), "transfer")
    _run(landing.move_files(new, origin, {"raw": at.raw}, keep_raw=True))
    entries = new.withColumn("status", F.lit("transferred"))
    landing.append_ledger(landing.ledger_entries(entries), ledger_path)
    return new.count()


def validate(
    spark: SparkSession, at: Locations, keep_raw: bool = False, quick: bool = False
) -> DataFrame:
    """Judges new raw files, moves them to their zone and records them; returns the summary.

    Files are moved before they are recorded: a run that fails between the two judges what is
    left in the raw zone again and loses nothing. A new snapshot of a dimension replaces the one
    before as a whole. Columns that drift from the contract are logged. ``quick`` reads Parquet
    footers and CSV headers only, so damaged pages pass.
    """
    ledger = landing.read_ledger(spark, at.ledger)
    judged = _held(landing.validate(spark, at.raw, ledger, not quick, not quick), "judged")
    report_drift(spark, judged)
    zones = {"validated": at.validated, "quarantine": at.quarantine}
    _run(landing.move_files(judged, at.raw, zones, keep_raw))
    for source, files in landing.new_snapshots(judged).items():
        tables.set_snapshot(at.validated, source, files)
    outdated = landing.outdated_snapshots(listing.list_files(spark, at.validated), judged)
    _run(retention.drop_folders(_held(outdated, "outdated"), zones))
    landing.append_ledger(landing.ledger_entries(judged), at.ledger)
    return landing.summarize(judged)


def report_drift(spark: SparkSession, judged: DataFrame) -> list[str]:
    """Logs how the columns of the judged files differ from the contract, by source and day."""
    signatures = landing.file_signatures(judged.drop("source"))
    drift = landing.drift_by_day(schemas.contract_frame(spark), signatures)  # a row per column and day
    found = [
        f"{r['source']}.{r['column_name']}: {r['change']} ({r['dt'] or 'undated'}: {r['files']} of {r['of_files']} files)"
        for r in drift.sort("source", "column_name", "dt", "change").collect()
    ]
    for line in found:
        log.warning("schema drift: %s", line)
    return found


def enrich(
    spark: SparkSession,
    at: Locations,
    day: str,
    settings: Settings = Settings(),
    event_types: str = "list",
    clustered: bool = False,
) -> None:
    """Enriches one day of validated files into the processed table.

    The day is written to a folder of this run and audited there; only a day that passes replaces
    the one in the processed table. A failed gate leaves that table as it was.
    """
    landed = [tables.landed_folder(at.validated, source, day) for source in ("orders", "events")]
    size_shuffles(spark, sum(folder_bytes(spark, folder) for folder in landed))
    rows = enrichment.join_profiles(*tables.read_inputs(spark, at.validated, day), day)
    stored = _held(rows, "enriched")
    quality.require(quality.output_gates(quality.key_audit(stored), settings.thresholds))
    writing.write_enriched(
        stored, at.processed, clustered, lambda laid_out: enrichment.finish(laid_out, event_types=event_types)
    )


def folder_bytes(spark: SparkSession, folder: str) -> int:
    files = listing.list_files(spark, folder, tasks=spark.sparkContext.defaultParallelism)
    return files.agg(F.sum("length")).first()[0] or 0


def gate_processed(
    spark: SparkSession, at: Locations, day: str, settings: Settings = Settings()
) -> None:
    """The gates on a day that is in the processed table."""
    written = tables.read_partitions(spark, at.processed, day, day)
    quality.require(quality.output_gates(quality.key_audit(written), settings.thresholds))


def load(spark: SparkSession, at: Locations, day: str) -> int:
    """Loads one processed day into staging and returns the rows found there."""
    writing.load_staging(tables.read_partitions(spark, at.processed, day, day), at.staging)
    rows = writing.row_count(staging(spark, at)).first()[0]
    if rows == 0:
        log.warning("staging table is empty")
    return rows


def staging(spark: SparkSession, at: Locations) -> DataFrame:
    return tables.read_files(spark, [at.staging], schemas.ENRICHED)


def publish(spark: SparkSession, at: Locations, day: str) -> DataFrame:
    """Upserts staging into one date of production; returns the verification row."""
    published = folder_bytes(spark, f"{at.production}/process_date={day}")
    size_shuffles(spark, folder_bytes(spark, at.staging) + published)
    rows = staging(spark, at)
    merging.publish_day(spark, rows, at.production, day)
    return merging.verify_merge(rows, tables.read_partitions(spark, at.production, day, day))


def publish_incremental(spark: SparkSession, at: Locations, settings: Settings = Settings()) -> None:
    """Upserts staging rows on or after production's newest date by key over all dates; loads
    staging in full when production has no date yet, or none from ``date_floor`` on."""
    # All of staging moves; of production, keys and dates do, and the touched dates as a whole.
    size_shuffles(spark, folder_bytes(spark, at.staging) + folder_bytes(spark, at.production) // 4)
    rows = tables.staging_view(staging(spark, at))
    merging.finish_drops(spark, at.production)
    newest = incremental.newest_partition(spark, at.production, floor=settings.date_floor)
    rows = incremental.since_date(rows, newest)
    merging.publish_across_days(spark, rows, at.production)


def changed_since_watermark(spark: SparkSession, at: Locations, settings: Settings) -> DataFrame:
    """Processed rows changed after the recorded watermark."""
    mark = incremental.read_watermark(spark, at.watermarks, "orders", settings.watermark_default)
    processed = tables.read_table(spark, at.processed, schemas.ENRICHED)
    if processed is None:
        raise FileNotFoundError(f"nothing processed yet under {at.processed}")
    return incremental.newer_than(processed, mark)


def publish_changes(spark: SparkSession, at: Locations, settings: Settings = Settings()) -> int:
    """Upserts rows changed since the watermark over all dates, then advances the watermark."""
    changed = _held(changed_since_watermark(spark, at, settings), "changes")
    rows = writing.row_count(changed).first()[0]
    if rows:
        merging.publish_across_days(spark, changed, at.production)
        incremental.advance_watermark(changed, at.watermarks, "orders")
    return rows


def report(spark: SparkSession, at: Locations, date_from: str, date_to: str) -> DataFrame:
    """Rebuilds the health report over a date range and returns it."""
    staged = staging(spark, at).where(tables.between_dates(F.col("process_date"), date_from, date_to))
    produced = tables.read_partitions(spark, at.production, date_from, date_to)
    metrics = reports.pipeline_metrics(staged, produced)
    writing.replace_table(metrics, at.metrics)
    return spark.read.schema(metrics.schema).parquet(at.metrics)


def test_columns(spark: SparkSession, at: Locations, date_from: str, date_to: str) -> DataFrame:
    """Failures of the column tests on production's key within a date range."""
    produced = tables.read_partitions(spark, at.production, date_from, date_to)
    return quality.column_tests(produced, "order_id")


def check(spark: SparkSession, at: Locations, day: str, settings: Settings = Settings()) -> DataFrame:
    """The quality checks on one production date."""
    produced = tables.read_partitions(spark, at.production, day, day)
    checks = quality.production_checks(limits=settings.thresholds)
    return quality.run_checks_apart(produced, checks, lambda df: _held(df, "checks"))


def expire(spark: SparkSession, at: Locations, as_of: str, settings: Settings = Settings()) -> DataFrame:
    """Drops dated landing folders, and files of staging, past their retention; returns those dropped.

    Landing folders are found by their names, without listing what is in them. Staging has no dated
    folders: a file expires by the day it was written.
    """
    roots = {"raw": at.raw, "quarantine": at.quarantine, "staging": at.staging}
    written = listing.list_files(spark, at.staging)
    found = written.select(
        F.lit("staging").alias("zone"), F.col("file_name").alias("folder"), F.to_date("modified_at").alias("dt")
    )
    for zone in ("raw", "quarantine"):
        folders = listing.list_folders(spark, roots[zone], 2)
        dated = folders.select(F.lit(zone).alias("zone"), "folder", partition_day(F.col("folder")).alias("dt"))
        found = found.unionByName(dated.where("dt IS NOT NULL"))
    expired = retention.expired_partitions(found, F.lit(as_of).cast("date"), settings.retention)
    expired = _held(expired, "expired")
    _run(retention.drop_folders(expired, roots))
    return expired


def daily(spark: SparkSession, at: Locations, day: str, settings: Settings = Settings()) -> None:
    """The whole day in order. A failed gate or test raises and stops what follows."""
    validate(spark, at)
    enrich(spark, at, day, settings)
    load(spark, at, day)
    publish_incremental(spark, at, settings)
    report(spark, at, day, day)
    failed = test_columns(spark, at, day, day).where(F.col("failures") > 0).collect()
    if failed:
        raise quality.GateFailed("; ".join(f"{r['test']}: {r['failures']}" for r in failed))
