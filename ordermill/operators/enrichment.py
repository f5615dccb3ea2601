"""The daily enrichment: event aggregates and segments joined to the deduplicated orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import (
    counted_types_text,
    distinct_types_text,
    row_hash,
    types_text,
)
from ordermill.operators.cleaning import dedup_events, dedup_orders
from ordermill.schemas import ENRICHED_COLUMNS

_EVENT_COLUMNS = ("event_id", "user_id", "event_type", "timestamp", "ts")


def event_type_counts(events: DataFrame) -> DataFrame:
    """Per user: event_count and type_counts, array<struct<event_type,n>> in order of the type.

    Events are counted by user and type first. That combines in the map tasks, so a user with
    most of the events costs a few rows per task, and the list per user is as long as the
    vocabulary of types, not as the user's history. ``event_count`` skips NULL event ids and
    the list skips NULL types.
    """
    by_type = events.groupBy("user_id", "event_type").agg(
        F.count("event_id").alias("n_ids"), F.count(F.lit(1)).alias("n")
    )
    entry = F.when(F.col("event_type").isNotNull(), F.struct("event_type", "n"))
    return by_type.groupBy("user_id").agg(
        F.sum("n_ids").alias("event_count"),
        F.sort_array(F.collect_list(entry)).alias("type_counts"),
    )


def event_types_text(event_types: str = "list") -> Column:
    """Text of type_counts: ``list`` (one entry per event, with repeats), ``set`` (distinct) or
    ``counts`` (``type*count``, the same content in bounded space)."""
    counts = F.col("type_counts")
    if event_types == "set":
        return distinct_types_text(counts)
    if event_types == "counts":
        return counted_types_text(counts)
    if event_types != "list":
        raise ValueError(f"event_types is list, set or counts, not {event_types!r}")
    return types_text(counts)


def deduped_events(events: DataFrame) -> DataFrame:
    """Deduplicated events with only the columns the aggregates need."""
    return dedup_events(events.select(*[c for c in _EVENT_COLUMNS if c in events.columns]))


def events_per_user(events: DataFrame, event_types: str = "list") -> DataFrame:
    """user_id, event_count, event_types over deduplicated events (see :func:`event_types_text`)."""
    counts = event_type_counts(deduped_events(events))
    text = event_types_text(event_types)
    return counts.select("user_id", "event_count", text.alias("event_types"))


def segment_columns(segments: DataFrame) -> DataFrame:
    return segments.select("user_id", "segment", "lifetime_value", "country")


def join_segments(orders: DataFrame, segments: DataFrame) -> DataFrame:
    """Left join to the segment dimension.

    No hint: Spark broadcasts the dimension when its size is below
    ``spark.sql.autoBroadcastJoinThreshold``, as known from its files or measured by AQE, and
    otherwise shuffles both sides and splits hot users.
    """
    return orders.join(segment_columns(segments), "user_id", "left")


def join_event_counts(orders: DataFrame, counts: DataFrame) -> DataFrame:
    """Left join to per-user aggregates. Users without events keep NULLs.

    The right side has one row per user, so the join never multiplies orders. AQE splits the
    partition of a hot user only where both inputs come straight from a shuffle, and an
    aggregate by the join key does not; taking the key through an expression gives the small
    side a shuffle of its own.
    """
    user = F.col("user_id")
    return orders.join(counts.withColumn("user_id", F.when(user.isNotNull(), user)), "user_id", "left")


def user_profile(segments: DataFrame, counts: DataFrame) -> DataFrame:
    """Segment columns and event aggregates of every user known to either side.

    Joining orders to this once equals joining them to both in turn: a user's segment rows
    meet the one row of aggregates here instead of there. The many orders then move at most
    once, their hot users are split by AQE, and where the profile turns out small it is
    broadcast and the orders do not move at all.
    """
    known = F.col("user_id").isNotNull()
    return segment_columns(segments).where(known).join(counts.where(known), "user_id", "full_outer")


def _as_date(value: str | dt.date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def enrich(
    orders: DataFrame,
    events: DataFrame,
    segments: DataFrame,
    run_date: str | dt.date | Column | None = None,
    run_ts: Column | None = None,
    event_types: str = "list",
    exact_amount: bool = False,
) -> DataFrame:
    """Deduplicated orders with the user's segment and event aggregates, in 14 columns.

    ``run_date`` replaces the orders' own process_date; None keeps it. ``run_ts`` fills both
    audit columns and defaults to the time of the query. The event types travel through the
    join as counts and become text in the final projection.
    """
    rows = join_profiles(orders, events, segments, run_date)
    return finish(rows, run_ts, event_types, exact_amount)


def join_profiles(
    orders: DataFrame, events: DataFrame, segments: DataFrame, run_date: str | dt.date | Column | None = None
) -> DataFrame:
    """The rows of :func:`enrich` before the columns that follow from others: the event types as counts
    by type, no hash and no stamps. What still has to be moved or sorted is short so."""
    profile = user_profile(segments, event_type_counts(deduped_events(events)))
    joined = dedup_orders(orders).join(profile, "user_id", "left")
    process_date = F.col("process_date") if run_date is None else _as_date(run_date)
    return joined.select(
        "order_id",
        "user_id",
        "amount",
        "currency",
        "status",
        "event_count",
        "type_counts",
        F.col("segment").alias("user_segment"),
        "lifetime_value",
        "country",
        process_date.cast("date").alias("process_date"),
    )


def finish(
    rows: DataFrame, run_ts: Column | None = None, event_types: str = "list", exact_amount: bool = False
) -> DataFrame:
    """All 14 columns from rows of :func:`join_profiles`."""
    stamp = F.current_timestamp() if run_ts is None else run_ts
    return rows.select(
        "*",
        event_types_text(event_types).alias("event_types"),
        row_hash(exact_amount).alias("row_hash"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    ).select(*ENRICHED_COLUMNS)
