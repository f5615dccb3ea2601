"""Synthetic orders, events and segments with planted defects.

Every value is a function of (seed, row number), so rows are the same under any
partitioning and on any engine with MD5, and no task depends on another.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Vocabularies and defect rates of the sample data.
EVENT_TYPES = ["purchase", "cart_add", "page_view", "wishlist", "search"]
CURRENCIES = ["USD", "EUR", "GBP", "INR", "JPY"]
STATUSES = ["completed", "pending", "refunded"]
SEGMENT_NAMES = ["premium", "standard", "budget", "new", "churned"]
NULL_USER_RATE = 0.005
REPEATED_EVENT_RATE = 0.01
NEGATIVE_AMOUNT_ROWS = [42, 9999]

COUNTRIES = ["US", "DE", "GB", "IN", "JP", "FR", "BR", "CA", "AU", "ZA"]
PATHS = ["home", "search", "category", "product", "cart", "checkout", "account", "help"]

EVENT_BLOCK = 100_000
#: Blocks in one stretch of the prefix scan, and its levels.
SCAN_WIDTH, SCAN_LEVELS = 1_000, 3
_WEEK_SECONDS = 7 * 86_400


@dataclass(frozen=True)
class SynthPlan:
    """Who and when: number of users, run date (ISO), seed."""

    users: int = 10_000
    run_date: str = "2026-03-19"
    seed: int = 42


def _digest(plan: SynthPlan, label: str, row: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(plan.seed)), F.lit(label), row.cast("string")))


class _Draws:
    """Random values of a row, cut from the 32 hex digits of one digest. Spark computes the
    digest once for all columns that use it; each use names the digits it takes."""

    def __init__(self, plan: SynthPlan, label: str, row: Column):
        self._digits = _digest(plan, label, row)

    def code(self, start: int, length: int) -> Column:
        return F.substring(self._digits, start, length)

    def below(self, n: int, start: int, length: int = 8) -> Column:
        """Integer in [0, n)."""
        return F.conv(self.code(start, length), 16, 10).cast("bigint") % n

    def chance(self, rate: float, start: int) -> Column:
        return self.below(10_000, start) < round(rate * 10_000)

    def pick(self, values: Sequence[str], start: int, length: int = 4) -> Column:
        options = F.array(*[F.lit(v) for v in values])
        return F.element_at(options, (self.below(len(values), start, length) + 1).cast("int"))

    def cents(self, low: int, high: int, start: int) -> Column:
        """Amount with two digits between ``low`` and ``high`` cents."""
        return (self.below(high - low + 1, start) + low) / 100.0


def _user(number: Column) -> Column:
    return F.concat(F.lit("user_"), F.lpad(number.cast("string"), 6, "0"))


def _moment(plan: SynthPlan, seconds_back: Column) -> Column:
    """ISO time that many seconds, and one, before the run date."""
    start = F.unix_seconds(F.lit(f"{plan.run_date} 00:00:00").cast("timestamp"))
    return F.date_format(F.timestamp_seconds(start - 1 - seconds_back), "yyyy-MM-dd'T'HH:mm:ss")


def synth_orders(rows: DataFrame, plan: SynthPlan = SynthPlan(), row: str = "row") -> DataFrame:
    """One order per row number: 0.5 % without a user, two with a negative amount."""
    n = F.col(row)
    first, second = _Draws(plan, "order", n), _Draws(plan, "order more", n)
    amount = F.when(n.isin(NEGATIVE_AMOUNT_ROWS), -first.cents(100, 10_000, 21)).otherwise(
        first.cents(100, 50_000, 21)
    )
    known = ~second.chance(NULL_USER_RATE, 1)
    return rows.select(
        F.concat(F.lit("ORD-"), F.upper(first.code(1, 12))).alias("order_id"),
        F.when(known, _user(first.below(plan.users, 13))).alias("user_id"),
        amount.alias("amount"),
        second.pick(CURRENCIES, 17).alias("currency"),
        second.pick(STATUSES, 21).alias("status"),
        _moment(plan, second.below(_WEEK_SECONDS, 9)).alias("created_at"),
        F.lit(plan.run_date).alias("process_date"),
    )


def _largest_before(blocks: DataFrame, width: int = SCAN_WIDTH, levels: int = SCAN_LEVELS) -> DataFrame:
    """(_block, _before) for blocks (_block, _last): the largest value of all blocks before.

    A prefix scan in levels: within stretches of ``width`` blocks, then over the stretches in the same
    way. No task holds more than one stretch of a level, for up to ``width ** levels`` blocks.
    """
    stretch = F.floor(F.col("_block") / width)
    inside = Window.partitionBy("_stretch").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    near = blocks.withColumn("_stretch", stretch).withColumn("_near", F.max("_last").over(inside))
    if levels == 1:
        return near.select("_block", F.col("_near").alias("_before"))
    above = near.groupBy("_stretch").agg(F.max("_last").alias("_last")).withColumnRenamed("_stretch", "_block")
    far = _largest_before(above, width, levels - 1).select(F.col("_block").alias("_stretch"), F.col("_before").alias("_far"))
    return near.join(far, "_stretch", "left").select("_block", F.greatest("_near", "_far").alias("_before"))


def synth_events(
    rows: DataFrame, plan: SynthPlan = SynthPlan(), row: str = "row", block_rows: int = EVENT_BLOCK
) -> DataFrame:
    """One event per row number; 1 % repeat the event_id of the row before, so a repeat may
    repeat a repeat.

    Rows are numbered in blocks, each made on its own. The last fresh row of each block, one number
    per block, is carried to the blocks after it by a prefix scan in levels.
    """
    n = F.col(row)
    fresh = ~_Draws(plan, "event", n).chance(REPEATED_EVENT_RATE, 25) | (n == 0)
    marked = rows.select(
        n.alias("_n"), F.floor(n / block_rows).alias("_block"), F.when(fresh, n).alias("_fresh")
    )
    carried = _largest_before(marked.groupBy("_block").agg(F.max("_fresh").alias("_last")))
    inside = Window.partitionBy("_block").orderBy("_n")
    id_row = F.last("_fresh", ignorenulls=True).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = (
        marked.withColumn("_id", id_row)
        .join(carried, "_block", "left")
        .select("_n", F.coalesce("_id", "_before").alias("_id"))
    )
    n = F.col("_n")
    draws = _Draws(plan, "event", n)
    event_id = _Draws(plan, "event id", F.coalesce("_id", "_n")).code(1, 12)
    return numbered.select(
        F.concat(F.lit("EVT-"), F.upper(event_id)).alias("event_id"),
        _user(draws.below(plan.users, 1)).alias("user_id"),
        draws.pick(EVENT_TYPES, 9).alias("event_type"),
        F.concat_ws("/", draws.pick(PATHS, 13), draws.pick(PATHS, 15)).alias("page_url"),
        F.concat(F.lit("SES-"), _Draws(plan, "event id", n).code(13, 8)).alias("session_id"),
        _moment(plan, draws.below(_WEEK_SECONDS, 17)).alias("timestamp"),
        F.lit(plan.run_date).alias("process_date"),
    )


def _stride(population: int) -> int:
    """A step near the golden ratio of the population that shares no factor with it."""
    step = max(1, round(population * 0.6180339887))
    while math.gcd(step, population) != 1:
        step += 1
    return step


def synth_segments(
    users: DataFrame,
    population: int,
    sample: int,
    plan: SynthPlan = SynthPlan(),
    number: str = "row",
) -> DataFrame:
    """Segments of ``sample`` users out of ``population``, without replacement.

    ``users`` numbers the population from 0. Multiplying by a step coprime to the population
    permutes the numbers, and the users that land below ``sample`` are taken: exactly that
    many, with neither a sort nor a shuffle.
    """
    n = F.col(number)
    place = (n * _stride(population) + plan.seed) % population
    draws = _Draws(plan, "segment", n)
    signup = F.date_sub(F.lit(plan.run_date).cast("date"), draws.below(731, 9).cast("int"))
    return users.where(place < sample).select(
        _user(n).alias("user_id"),
        draws.pick(SEGMENT_NAMES, 17).alias("segment"),
        draws.cents(1_000, 1_000_000, 1).alias("lifetime_value"),
        signup.cast("string").alias("signup_date"),
        draws.pick(COUNTRIES, 21).alias("country"),
    )


def row_numbers(spark, n: int, tasks: int | None = None) -> DataFrame:
    """Row numbers 0 … n-1, spread over the cluster."""
    return spark.range(0, n, 1, tasks).withColumnRenamed("id", "row")
