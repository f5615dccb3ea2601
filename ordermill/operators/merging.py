"""Upserts on Parquet: compute the merged rows, then replace only the partitions they touch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.functions.labels import merge_outcome
from ordermill.operators import quality, writing
from ordermill.sources import partition_index
from ordermill.sources.tables import read_partitions, read_table

_HIT = "_hit"


def stamped(source: DataFrame, run_ts: Column) -> DataFrame:
    """Source rows as they are inserted: both audit columns set to the run time."""
    stamps = {c: run_ts for c in ("created_at", "updated_at") if c in source.columns}
    return source.withColumns(stamps)


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = ("order_id",),
    run_ts: Column | None = None,
    keep: Sequence[str] = ("created_at",),
) -> DataFrame:
    """Rows of ``target`` after an upsert from ``source``, in the target's columns.

    A matched row takes the source's values but for the keys and the ``keep`` columns, and
    ``updated_at`` becomes the run time. Unmatched source rows are inserted. ``source`` must
    hold each key once (see :func:`ambiguous_keys`).

    Two joins instead of a full outer one: with one source row per key, Spark may broadcast a
    small source and leave the target unshuffled, and may split hot or NULL keys of the
    target. Target keys are made distinct in the map tasks before the second join.
    """
    now = F.current_timestamp() if run_ts is None else run_ts
    keys = list(keys)
    columns = target.columns
    incoming = stamped(source, now).select(*columns)
    match = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    joined = target.alias("t").join(
        incoming.withColumn(_HIT, F.lit(True)).alias("s"), F.expr(match), "left"
    )
    updated = joined.selectExpr(
        *[
            f"t.`{c}`" if c in keys or c in keep else f"if(s.{_HIT}, s.`{c}`, t.`{c}`) AS `{c}`"
            for c in columns
        ]
    )
    inserted = incoming.join(target.select(*keys).distinct(), keys, "left_anti")
    return updated.unionByName(inserted.select(*columns))


def replace_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str] = ("order_id",),
    run_ts: Column | None = None,
) -> DataFrame:
    """Rows of ``target`` after whole-row replacement: every source row replaces the target rows
    with its key wherever they are, audit columns included."""
    now = F.current_timestamp() if run_ts is None else run_ts
    keys = list(keys)
    kept = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(stamped(source, now).select(*target.columns))


def ambiguous_keys(source: DataFrame, keys: Sequence[str] = ("order_id",)) -> DataFrame:
    """Keys that more than one source row claims; an upsert from such a source must not run."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def change_classes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = ("order_id",),
    compare: Sequence[str] = ("row_hash",),
) -> DataFrame:
    """Keys of ``source`` with ``change``: new, changed or same, by null-safe comparison."""
    keys = list(keys)
    old = {c: f"_old_{n}" for n, c in enumerate(compare)}
    known = target.selectExpr(*keys, *[f"`{c}` AS {o}" for c, o in old.items()], f"true AS {_HIT}")
    same = " AND ".join(f"`{c}` <=> {o}" for c, o in old.items())
    change = f"CASE WHEN {_HIT} IS NULL THEN 'new' WHEN {same} THEN 'same' ELSE 'changed' END"
    return source.join(known, keys, "left").selectExpr(*keys, f"{change} AS change")


def changed_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = ("order_id",),
    compare: Sequence[str] = ("row_hash",),
) -> DataFrame:
    return change_classes(target, source, keys, compare).where(F.col("change") != "same")


def verify_merge(staging: DataFrame, production: DataFrame) -> DataFrame:
    """One row: staging_rows, production_rows, status."""
    flags = staging.select(F.lit(1).alias("s"), F.lit(0).alias("p")).unionAll(
        production.select(F.lit(0).alias("s"), F.lit(1).alias("p"))
    )
    counts = flags.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("staging_rows"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("production_rows"),
    )
    outcome = merge_outcome(F.col("staging_rows"), F.col("production_rows"))
    return counts.withColumn("status", outcome)


def publish_day(
    spark: SparkSession,
    staging: DataFrame,
    target_path: str,
    process_date: str | dt.date,
    run_ts: Column | None = None,
) -> None:
    """Gated upsert of staging into one date of production.

    All staging rows go to ``process_date``, whatever date they carry. Only that partition is
    read and rewritten, so late data for a past date is a plain re-run, and a repeated run
    leaves the same rows. Without a table yet, the rows are simply written.
    """
    quality.require(quality.premerge_gates(quality.key_audit(staging)))
    now = F.current_timestamp() if run_ts is None else run_ts
    day = F.lit(str(process_date)).cast("date")
    source = staging.withColumn("process_date", day).select(*schemas.ENRICHED_COLUMNS)
    if read_table(spark, target_path, schemas.ENRICHED) is None:
        rows = stamped(source, now)
    else:
        target = read_partitions(spark, target_path, process_date, process_date)
        rows = merge_rows(target, source, ["order_id"], now)
    writing.write_enriched(rows, target_path)


def touched_dates(target: DataFrame, source: DataFrame, key: str = "order_id") -> DataFrame:
    """Dates of the target that an upsert over all dates takes rows from: process_date, replaced.

    Reads the key and the date of the target only. A semi join lets Spark filter the target's keys by
    those of the source before they are shuffled, so untouched history stays where it is.
    """
    keys = source.select(key).where(F.col(key).isNotNull()).distinct()
    hits = target.select(key, "process_date").join(keys, key, "left_semi")
    return hits.groupBy("process_date").agg(F.count(F.lit(1)).alias("replaced"))


def emptied_dates(
    target: DataFrame, replaced: dict[dt.date, int], arriving: set[dt.date],
    index: partition_index.Partitions | None = None,
) -> list[dt.date]:
    """Dates that keep no row: all of theirs are replaced and none arrive. The rows of a date come from
    the table's index, else those dates alone are counted."""
    lost = [d for d in replaced if d is not None and d not in arriving]
    if not lost:
        return []
    if index is not None:
        rows = {d: index.get(str(d), (None, 0))[0] for d in lost}
    else:
        counts = target.where(F.col("process_date").isin(lost)).groupBy("process_date").agg(
            F.count(F.lit(1)).alias("rows")
        )
        rows = dict(map(tuple, counts.collect()))
    return [d for d in lost if rows.get(d) == replaced[d]]


PENDING = "process_date date"
#: A row that leaves a date for another: its key, both dates and the stamp it gets there.
MOVES = "moved_key string, left_date date, went_to date, stamp timestamp"


def _pending_path(target_path: str) -> str:
    return f"{target_path.rstrip('/')}_pending_drops"


def _moves_path(target_path: str) -> str:
    return f"{target_path.rstrip('/')}_pending_moves"


def planned_moves(target: DataFrame, source: DataFrame, days: list[dt.date], now: Column, key: str) -> DataFrame:
    """Where the rows of ``days`` go in an upsert from ``source``. Reads those dates of the target alone."""
    leaving = target.where(F.col("process_date").isin(days)).select(
        F.col(key).alias("moved_key"), F.col("process_date").alias("left_date")
    )
    coming = source.select(F.col(key).alias("moved_key"), F.col("process_date").alias("went_to"))
    return leaving.distinct().join(coming, "moved_key").select(
        F.col("moved_key").cast("string"), "left_date", "went_to", now.cast("timestamp").alias("stamp")
    )


def not_moved(target: DataFrame, moves: DataFrame, key: str) -> DataFrame:
    """Dates with a planned move that is not in the target. Reads the dates that rows went to alone."""
    days = [r[0] for r in moves.select("went_to").distinct().collect()]
    there = target.where(F.col("process_date").isin(days)).select(
        F.col(key).cast("string").alias("moved_key"), F.col("process_date").alias("went_to"),
        F.col("updated_at").alias("stamp"),
    )
    return moves.join(there, ["moved_key", "went_to", "stamp"], "left_anti").select("left_date").distinct()


def finish_drops(
    spark: SparkSession, target_path: str, key: str = "order_id", moved: Sequence[dt.date] | None = None
) -> None:
    """Ends an upsert over all dates, here or for a run that failed between its write and its drops.

    The dates it meant to drop are on record, and for each of their rows the date it goes to and its
    stamp. If all rows of such a date are found where they went, the write has happened and the date
    goes; otherwise, or without that record, the date stays. Only dates on record are read. ``moved`` names
    dates whose rows are known to have moved, as the write has just ended.
    """
    if moved is not None:
        writing.drop_partitions(spark, target_path, "process_date", moved)
        writing.remove_table(_pending_path(target_path))
        writing.remove_table(_moves_path(target_path))
        return
    pending = read_table(spark, _pending_path(target_path), PENDING)
    days = [] if pending is None else [r[0] for r in pending.distinct().collect()]
    if days:
        target = read_table(spark, target_path, schemas.ENRICHED)
        moves = read_table(spark, _moves_path(target_path), MOVES)
        if target is not None and moves is not None:
            stay = {r[0] for r in not_moved(target, moves, key).collect()}
            known = {r[0] for r in moves.select("left_date").distinct().collect()}
            writing.drop_partitions(spark, target_path, "process_date", [d for d in days if d in known - stay])
    if pending is not None:
        writing.remove_table(_pending_path(target_path))
        writing.remove_table(_moves_path(target_path))


def _fixed(spark: SparkSession, now: Column) -> Column:
    """The same time for all jobs of a run."""
    micros = spark.range(1).select(F.unix_micros(now.cast("timestamp"))).first()[0]
    return F.timestamp_micros(F.lit(micros))


def publish_across_days(
    spark: SparkSession,
    source: DataFrame,
    target_path: str,
    run_ts: Column | None = None,
    key: str = "order_id",
) -> None:
    """Upsert by key over all dates with whole-row replacement; a row may move between dates.

    Only dates that lose, gain or replace rows are rewritten, in one job that changes nothing
    unless it ends well. Dates left without rows are put on record before, with where each of their rows
    goes, and dropped after that; the next run, whatever it publishes, first drops what a failed one has
    left.
    """
    audit = quality.key_audit(source, key, F.collect_set("process_date").alias("arriving"))
    audited = audit.collect()  # one row: counts, and one value per date
    arriving = set(audited[0]["arriving"])
    gates = quality.premerge_gates(spark.createDataFrame(audited, audit.schema))
    quality.require(gates.where("gate <> 'staging_nonempty'"))  # nothing new is fine
    finish_drops(spark, target_path, key)
    now = _fixed(spark, F.current_timestamp() if run_ts is None else run_ts)
    target = read_table(spark, target_path, schemas.ENRICHED)
    if target is None:
        writing.write_enriched(stamped(source, now), target_path)
        return
    # One row per touched partition.
    replaced = {r["process_date"]: r["replaced"] for r in touched_dates(target, source, key).collect()}
    if not audited[0]["rows"]:
        return
    left_empty = emptied_dates(target, replaced, arriving, partition_index.read(target_path))
    if left_empty:
        writing.replace_table(planned_moves(target, source, left_empty, now, key), _moves_path(target_path))
        record = spark.createDataFrame([(d,) for d in left_empty], PENDING)
        writing.replace_table(record, _pending_path(target_path))
    affected = target.where(F.col("process_date").isin([*replaced.keys() | arriving]))
    writing.write_enriched(replace_rows(affected, source, [key], now), target_path)
    if left_empty:
        finish_drops(spark, target_path, key, left_empty)
