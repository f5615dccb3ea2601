"""Writers: partitioned and clustered tables, staging, dual-format files."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill import schemas
from ordermill.operators.retention import drop_folders
from ordermill.sources import partition_index
from ordermill.sources.listing import open_filesystem

CLUSTER_COLUMNS = ("user_id", "user_segment")
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: A task reads 128 MB in files that count as 4 MB at least.
_OPEN_FILES = 40


def enforce_not_null(df: DataFrame, schema: T.StructType = schemas.ENRICHED) -> DataFrame:
    """Fails the job on a NULL in a required column. Parquet itself would take it.

    The test is part of the projection, so it costs no pass of its own and a failed write
    commits nothing.
    """
    required = {f.name for f in schema.fields if not f.nullable}
    return df.select(
        *[
            F.coalesce(F.col(c), F.raise_error(F.lit(f"NOT NULL violated: {c}"))).alias(c)
            if c in required
            else F.col(c)
            for c in df.columns
        ]
    )


def spread_by_partition(
    df: DataFrame, partition: str = "process_date", cluster: Sequence[str] = CLUSTER_COLUMNS
) -> DataFrame:
    """Rows of a partition value together, in tasks of even size, sorted by the cluster columns.

    REBALANCE lets AQE split a partition value that holds most rows over many tasks and merge
    small ones; a plain repartition on a constant run date would leave one task with all rows.
    """
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)


def cluster_by_range(
    df: DataFrame,
    partition: str = "process_date",
    cluster: Sequence[str] = CLUSTER_COLUMNS,
    tie_break: Sequence[str] = ("order_id",),
    num_partitions: int | None = None,
) -> DataFrame:
    """Rows in disjoint ranges of (partition, cluster columns), sorted, for narrow file statistics.

    The tie-break columns belong to the range key, so that the rows of one hot user still
    spread over many ranges. Spark samples the rows for the ranges, which runs the last stage
    below once more; cluster a stored table rather than a long plan.
    """
    key = [partition, *cluster, *tie_break]
    ranged = (
        df.repartitionByRange(num_partitions, *key)
        if num_partitions
        else df.repartitionByRange(*key)
    )
    return ranged.sortWithinPartitions(*key)


def overwrite_partitions(
    df: DataFrame, path: str, partition: str = "process_date",
    layout: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replaces the partitions ``df`` has rows for and leaves the others alone.

    The new files become visible when the job commits, so ``df`` may read the same path. The partitions
    written are seen while the rows pass, before ``layout`` sorts them, and entered in the table's index.
    """
    spark = df.sparkSession
    before = partition_index.begin(path)
    seen = Observation()
    rows = df.observe(seen, F.collect_set(F.col(partition).cast("string")).alias("values"))
    (
        (layout(rows) if layout else rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    try:
        values = seen.get["values"]
    except Py4JJavaError:  # Spark drops the observation from a plan it finds empty: count all afresh
        before, values = None, []
    partition_index.commit(spark, path, partition, before, values)


def write_enriched(
    df: DataFrame, path: str, clustered: bool = False, finish: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Checked, laid out by date and cluster columns, replacing the dates in ``df`` only. ``finish`` adds
    columns that follow from others row by row, after the rows have been moved and sorted."""
    layout = cluster_by_range if clustered else spread_by_partition
    overwrite_partitions(
        enforce_not_null(df), path, layout=(lambda rows: finish(layout(rows))) if finish else layout
    )


def write_in_place(df: DataFrame, path: str) -> None:
    """As :func:`write_enriched`, for rows read from a table that is laid out already and changed one by
    one: they stay in their tasks and in their order, neither shuffled nor sorted. A task keeps a file
    open for each date it meets, up to ``_OPEN_FILES``; rows of further dates are sorted."""
    conf = df.sparkSession.conf
    before = conf.get(_WRITERS, "0")
    conf.set(_WRITERS, str(_OPEN_FILES))
    try:
        overwrite_partitions(enforce_not_null(df), path)
    finally:
        conf.set(_WRITERS, before)


def replace_table(df: DataFrame, path: str) -> None:
    """Replaces a table as a whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def remove_table(path: str) -> None:
    """Removes a small table; none there is no error."""
    filesystem, base = open_filesystem(path)
    with contextlib.suppress(FileNotFoundError):
        filesystem.delete_dir(base)


def load_staging(processed: DataFrame, path: str) -> None:
    """Truncate-and-load of staging. Staging is unpartitioned and checked for required columns."""
    replace_table(enforce_not_null(processed), path)


def write_csv_and_parquet(df: DataFrame, path: str) -> None:
    """The same rows as CSV with a header under ``csv`` and as snappy Parquet under ``parquet``."""
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    (
        df.write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "static")
        .parquet(f"{path}/parquet")
    )


def row_count(df: DataFrame, name: str = "staging_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def drop_partitions(spark: SparkSession, path: str, partition: str, values: Iterable) -> None:
    """Deletes the folders of the given partition values, spread over tasks; one that is gone already
    is no error."""
    values = [str(v) for v in values]
    if values:
        before = partition_index.begin(path)
        folders = spark.createDataFrame([("table", f"{partition}={v}") for v in values], "zone string, folder string")
        drop_folders(folders, {"table": path}).write.format("noop").mode("overwrite").save()
        partition_index.commit(spark, path, partition, before, values)
