"""Incremental selection: high watermarks and the newest date of the target."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sources import partition_index
from ordermill.sources.listing import partition_dates
from ordermill.sources.tables import read_table

WATERMARKS = "pipeline string, watermark timestamp, recorded_at timestamp"


def newer_than(
    df: DataFrame, watermark: str | dt.datetime | Column, column: str = "updated_at"
) -> DataFrame:
    """Rows changed strictly after the watermark; both sides compare as timestamps."""
    mark = watermark if isinstance(watermark, Column) else F.lit(str(watermark))
    return df.where(F.col(column).cast("timestamp") > mark.cast("timestamp"))


def watermark_of(df: DataFrame, column: str = "updated_at") -> DataFrame:
    """One row: the newest change time, the next run's watermark."""
    return df.agg(F.max(column).alias("watermark"))


def read_watermark(spark: SparkSession, path: str, pipeline: str, default: str) -> dt.datetime:
    """Last recorded watermark of a pipeline, else ``default``."""
    state = read_table(spark, path, WATERMARKS)
    if state is not None:
        last = state.where(F.col("pipeline") == pipeline).agg(F.max("watermark")).first()[0]
        if last is not None:
            return last
    return dt.datetime.fromisoformat(default)


def advance_watermark(df: DataFrame, path: str, pipeline: str, column: str = "updated_at") -> None:
    """Appends the newest change time of ``df`` to the state table; call after a good publish."""
    (
        watermark_of(df, column)
        .where(F.col("watermark").isNotNull())
        .select(
            F.lit(pipeline).alias("pipeline"),
            F.col("watermark").cast("timestamp").alias("watermark"),
            F.current_timestamp().alias("recorded_at"),
        )
        .write.mode("append")
        .parquet(path)
    )


#: Dates before this one do not count as the newest of a target (a documented setting of the jobs).
DATE_FLOOR = "2000-01-01"


def latest_date(target: DataFrame, column: str = "process_date", floor: str = DATE_FLOOR) -> DataFrame:
    """One row: the newest date of the target, dates before ``floor`` aside; NULL when there is none."""
    recent = target.where(F.col(column) >= F.lit(floor).cast("date"))
    return recent.agg(F.max(column).alias("latest"))


def since_latest_date(
    source: DataFrame, target: DataFrame, column: str = "process_date", floor: str = DATE_FLOOR
) -> DataFrame:
    """Source rows on or after the newest date of the target (dates before ``floor`` aside); all
    rows, those without a date included, when the target has no such date.
    """
    newest = latest_date(target, column, floor).scalar()
    return source.where(newest.isNull() | (F.col(column) >= newest))


def since_date(source: DataFrame, newest: dt.date | None, column: str = "process_date") -> DataFrame:
    """As :func:`since_latest_date`, for a newest date that is known already."""
    return source if newest is None else source.where(F.col(column) >= F.lit(newest))


def newest_partition(
    spark: SparkSession, path: str, column: str = "process_date", floor: str = DATE_FLOOR,
    before: str | None = None,
) -> dt.date | None:
    """Newest date of a table partitioned by it that holds a row; dates before ``floor``, and from
    ``before`` on, aside.

    The table's index answers without a job and without opening a file of the table. Where there is none
    to trust, the names of the folders do, and the newest are opened to see that they hold a row.
    """
    index = partition_index.read(path)
    if index is not None:
        days = [v for v, (rows, _) in index.items() if rows and floor <= v and (before is None or v < before)]
        days = [day for day in map(_date, days) if day is not None]
        return max(days, default=None)
    for day in partition_dates(spark, path, column):
        if before is not None and str(day) >= before:
            continue
        if str(day) < floor:
            return None
        if not spark.read.parquet(f"{path.rstrip('/')}/{column}={day}").isEmpty():
            return day
    return None


def _date(value: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(value)
    except ValueError:
        return None
