"""Landing validation: one row per file, judged by expressions, routed and recorded."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.functions.columns import partition_day, source_name
from ordermill.operators import ledger as ledgers
from ordermill.operators.ledger import latest_entries
from ordermill.schemas import LEDGER, required_columns
from ordermill.sources.listing import inspect_files, list_files, open_filesystem, task_count

# File states and messages.
VALIDATED = "validated"
SKIPPED = "skipped"
QUARANTINED_PREFIX = "quarantined:"
NO_SCHEMA_PARQUET = "No schema registered (passed by default)"
NO_SCHEMA_CSV = "No schema registered"
UNKNOWN_FORMAT = "Unknown format (passed)"


def pending(files: DataFrame, ledger: DataFrame, retry_quarantined: bool = False) -> DataFrame:
    """Files the ledger has no entry for. ``retry_quarantined`` also takes back failed ones."""
    return files.join(
        settled(ledger, retry_quarantined).select("file_name"), "file_name", "left_anti"
    )


def settled(ledger: DataFrame, retry_quarantined: bool = False) -> DataFrame:
    """Ledger entries that keep a file from being checked again: all, or all but failed ones."""
    if not retry_quarantined:
        return ledger
    return latest_entries(ledger).where(~F.col("status").startswith(QUARANTINED_PREFIX))


def upsert_ledger(ledger: DataFrame, entries: DataFrame) -> DataFrame:
    return latest_entries(ledger.unionByName(entries.select(*ledger.columns)))


def append_ledger(entries: DataFrame, path: str) -> None:
    """Adds entries to the stored ledger (see :mod:`ordermill.operators.ledger`)."""
    ledgers.append(entries, path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    ledger = ledgers.read(spark, path)
    return spark.createDataFrame([], LEDGER) if ledger is None else ledger


def with_source(files: DataFrame) -> DataFrame:
    """Adds the source named in the path, NULL if the path names none."""
    return files.withColumn("source", source_name(F.col("file_name")))


def missing_columns(source: Column, columns: Column) -> Column:
    """Required columns a file lacks, in order; NULL for an unregistered source."""
    return F.array_sort(F.array_except(required_columns(source), columns))


def _as_set_text(names: Column) -> Column:
    return F.concat(F.lit("{'"), F.array_join(names, "', '"), F.lit("'}"))


def judge(files: DataFrame, footers_only: bool = False) -> DataFrame:
    """Adds source, missing, is_valid, message and status to files.

    Takes file_name, length and, from :func:`inspect_files`, columns, rows and error. The
    first rule that applies decides: empty, corrupt, unregistered source, missing columns.
    ``footers_only`` says that pages were not decoded, which the message then names.
    """
    # The messages.
    parquet_good = "Footer OK" if footers_only else "Schema OK"
    name = F.col("file_name")
    is_parquet, is_csv = name.endswith(".parquet"), name.endswith(".csv")
    is_empty = F.col("length") == 0
    lacks = F.size("missing") > 0
    unregistered = required_columns(F.col("source")).isNull()
    n_columns = F.size("columns")
    message = (
        F.when(is_empty, "empty")
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(is_parquet & unregistered, NO_SCHEMA_PARQUET)
        .when(is_csv & unregistered, NO_SCHEMA_CSV)
        .when(
            (is_parquet | is_csv) & lacks,
            F.concat(F.lit("Missing required columns: "), _as_set_text(F.col("missing"))),
        )
        .when(is_parquet, F.format_string(f"{parquet_good} (%d rows, %d columns)", "rows", n_columns))
        .when(is_csv & F.col("rows").isNull(), "Header OK")
        .when(is_csv, F.format_string("Header OK (%d rows)", "rows"))
        .otherwise(UNKNOWN_FORMAT)
    )
    failed = is_empty | F.col("error").isNotNull() | ((is_parquet | is_csv) & lacks)
    return (
        with_source(files)
        .withColumn("missing", missing_columns(F.col("source"), F.col("columns")))
        .withColumn("is_valid", ~F.coalesce(failed, F.lit(False)))
        .withColumn("message", message)
        .withColumn(
            "status",
            F.when(F.col("is_valid"), VALIDATED).otherwise(
                F.concat(F.lit(QUARANTINED_PREFIX), F.col("message"))
            ),
        )
    )


def route(judged: DataFrame) -> DataFrame:
    """Adds the zone each file belongs to: validated or quarantine."""
    return judged.withColumn(
        "zone", F.when(F.col("status") == VALIDATED, "validated").otherwise("quarantine")
    )


def status_class(status: Column) -> Column:
    """validated, quarantined or skipped, without the reason."""
    return F.substring_index(status, ":", 1)


def summarize(judged: DataFrame) -> DataFrame:
    """Files per status class."""
    return judged.groupBy(status_class(F.col("status")).alias("status_class")).agg(
        F.count(F.lit(1)).alias("files")
    )


def quarantine_rate(judged: DataFrame, limit: float = 0.01) -> DataFrame:
    """Share of quarantined files per source, and whether it is high enough to alert."""
    bad = F.col("status").startswith(QUARANTINED_PREFIX)
    return (
        judged.where(F.col("status") != SKIPPED)
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.count_if(bad).alias("quarantined"),
            F.avg(bad.cast("double")).alias("rate"),
        )
        .withColumn("alert", F.col("rate") > limit)
    )


def validate(
    spark: SparkSession,
    root: str,
    ledger: DataFrame,
    read_pages: bool = True,
    count_csv_rows: bool = True,
    retry_quarantined: bool = False,
) -> DataFrame:
    """Judges and routes every file below ``root``; files of the ledger come out as skipped.

    The folders are listed once and known files are carried along unread. New files are read whole
    unless ``read_pages`` or ``count_csv_rows`` is turned off.
    Columns: file_name, length, source, missing, is_valid, message, status, zone, columns, types.
    """
    done = settled(ledger, retry_quarantined).select("file_name", F.lit(True).alias("known"))
    files = list_files(spark, root).join(done.distinct(), "file_name", "left")
    files = files.withColumn("known", F.coalesce("known", F.lit(False)))
    judged = route(judge(inspect_files(files, root, read_pages, count_csv_rows), not read_pages))
    new = ~F.col("known")
    return judged.select(
        "file_name",
        "length",
        "source",
        F.when(new, F.col("missing")).alias("missing"),
        F.when(new, F.col("is_valid")).alias("is_valid"),
        F.when(new, F.col("message")).otherwise("already processed").alias("message"),
        F.when(new, F.col("status")).otherwise(SKIPPED).alias("status"),
        F.when(new, F.col("zone")).alias("zone"),
        "columns",
        "types",
    )


def ledger_entries(judged: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Ledger rows of the files judged in this run."""
    now = F.current_timestamp() if processed_at is None else processed_at
    return judged.where(F.col("status") != SKIPPED).select(
        "file_name", now.alias("processed_at"), "status"
    )


_MOVED = "file_name string, zone string, length bigint"


def move_files(
    routed: DataFrame,
    raw: str,
    zones: dict[str, str],
    keep_raw: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Moves each routed file to the root of its zone, spread over ``tasks`` tasks.

    A file is copied under a name that listings leave out and then renamed, so a target is either
    the old file or the new one, whole. A source already gone was moved by an earlier attempt, so
    a task may run twice. ``keep_raw`` leaves the landed file in place.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source_fs, source_base = open_filesystem(raw)
        targets = {zone: open_filesystem(root) for zone, root in zones.items()}
        for batch in batches:
            for name, zone in zip(batch["file_name"], batch["zone"]):
                target_fs, target_base = targets[zone]
                src, dst = f"{source_base}/{name}", f"{target_base}/{name}"
                if source_fs.get_file_info(src).type == fs.FileType.NotFound:
                    continue
                target_fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
                part = f"{dst}.{uuid.uuid4().hex}.inprogress"
                try:
                    fs.copy_files(
                        src, part, source_filesystem=source_fs, destination_filesystem=target_fs
                    )
                except FileNotFoundError:  # another attempt has moved it in the meantime
                    continue
                target_fs.move(part, dst)
                if not keep_raw:
                    with contextlib.suppress(FileNotFoundError):
                        source_fs.delete_file(src)
            yield batch

    return (
        routed.where(F.col("zone").isNotNull())
        .select("file_name", "zone", "length")
        .repartition(task_count(routed.sparkSession, tasks), "file_name")
        .mapInPandas(run, _MOVED)
    )


def new_snapshots(judged: DataFrame) -> dict[str, list[str]]:
    """Validated files of undated snapshots, by source: what a dimension consists of from now on."""
    folder = F.regexp_extract("file_name", r"^source=([^/]*)/latest/[^/]*$", 1)
    new = judged.where(F.col("zone") == "validated").select(folder.alias("source"), "file_name")
    rows = new.where("source <> ''").groupBy("source").agg(F.sort_array(F.collect_set("file_name")))
    return {r[0]: r[1] for r in rows.collect()}  # a row per dimension; paths its reader needs


def outdated_snapshots(files: DataFrame, moved: DataFrame) -> DataFrame:
    """Files (zone, folder) of undated snapshot folders that a new snapshot has just replaced: those
    beside the moved files that were not moved with them. ``files`` lists the validated zone."""
    folder = F.regexp_extract("file_name", r"^(.*/latest)/[^/]*$", 1)
    new = moved.where(F.col("zone") == "validated").select("file_name", folder.alias("snapshot"))
    new = new.where("snapshot <> ''")
    there = files.select("file_name", folder.alias("snapshot"))
    return (
        there.join(new.select("snapshot").distinct(), "snapshot", "left_semi")
        .join(new.select("file_name"), "file_name", "left_anti")
        .select(F.lit("validated").alias("zone"), F.col("file_name").alias("folder"))
    )


def file_columns(inspected: DataFrame) -> DataFrame:
    """source, column_name, data_type found in the files, each once. CSV files tell no types, so
    their columns come with a NULL one."""
    kind = F.when(F.col("types").isNotNull(), F.try_element_at("types", F.col("at") + 1))
    return (
        with_source(inspected)
        .select("source", "types", F.posexplode("columns").alias("at", "column_name"))
        .select("source", "column_name", kind.alias("data_type"))
        .distinct()
    )


def schema_drift(contract: DataFrame, actual: DataFrame) -> DataFrame:
    """Columns that differ from the contract: source, column_name, change, is_breaking.

    Both sides hold source, column_name and data_type; a NULL type matches any. A removed or retyped
    column breaks the contract, an added one does not. A column is removed if no file of its source
    has it; sources without a file are left aside.
    """
    contract = contract.join(actual.select("source").distinct(), "source", "left_semi")
    actual = actual.join(contract.select("source").distinct(), "source", "left_semi")
    c, a = contract.alias("c"), actual.alias("a")
    both = c.join(
        a,
        (F.col("c.source") == F.col("a.source")) & (F.col("c.column_name") == F.col("a.column_name")),
        "full_outer",
    )
    change = (
        F.when(F.col("a.column_name").isNull(), "removed")
        .when(F.col("c.column_name").isNull(), "added")
        .when(F.col("a.data_type") != F.col("c.data_type"), "retyped")
    )
    return (
        both.select(
            F.coalesce("c.source", "a.source").alias("source"),
            F.coalesce("c.column_name", "a.column_name").alias("column_name"),
            change.alias("change"),
        )
        .where(F.col("change").isNotNull())
        .distinct()
        .withColumn("is_breaking", F.col("change") != "added")
    )


def file_signatures(inspected: DataFrame) -> DataFrame:
    """source, dt, columns, types and files: how many files of a source and day show the same columns and
    types. Files that could not be read have none; undated ones have no ``dt``."""
    return (
        with_day(with_source(inspected))
        .where("columns IS NOT NULL")
        .groupBy("source", "dt", "columns", "types")
        .agg(F.count(F.lit(1)).alias("files"))
    )


def drift_by_day(contract: DataFrame, signatures: DataFrame) -> DataFrame:
    """Differences from the contract per source and day: source, dt, column_name, change, is_breaking,
    files (that differ so) and of_files (files of the source that day).

    Each signature is compared with the contract on its own, so a column that is gone from some files only
    is reported with their number. Files of unregistered sources are left aside. CSV files tell no types,
    so their columns are never retyped.
    """
    wanted = contract.groupBy("source").agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "data_type"))).alias("wanted")
    )
    found = signatures.join(F.broadcast(wanted), "source").withColumn(
        "of_files", F.sum("files").over(Window.partitionBy("source", "dt"))
    )
    types = F.coalesce(F.col("types"), F.transform("columns", lambda c: F.lit(None).cast("string")))
    there = F.map_from_entries(F.arrays_zip(F.col("columns").alias("name"), types.alias("kind")))

    def change(name: Column, label: str) -> Column:
        return F.struct(name.alias("column_name"), F.lit(label).alias("change"))

    removed = F.transform(F.array_except(F.map_keys("wanted"), "columns"), lambda c: change(c, "removed"))
    added = F.transform(F.array_except("columns", F.map_keys("wanted")), lambda c: change(c, "added"))
    retyped = F.transform(
        F.filter(F.array_intersect("columns", F.map_keys("wanted")), lambda c: F.col("there")[c] != F.col("wanted")[c]),
        lambda c: change(c, "retyped"),
    )
    return (
        found.withColumn("there", there)
        .select("source", "dt", "files", "of_files", F.inline(F.concat(removed, added, retyped)))
        .groupBy("source", "dt", "column_name", "change")
        .agg(F.sum("files").alias("files"), F.first("of_files").alias("of_files"))
        .withColumn("is_breaking", F.col("change") != "added")
    )


def with_day(files: DataFrame) -> DataFrame:
    """Adds the day named in the path, NULL for undated files."""
    return files.withColumn("dt", partition_day(F.col("file_name")))
