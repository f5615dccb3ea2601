"""Intake of new landed files only, as a file stream that stops when it has caught up.

The stream's checkpoint plays the part of the file ledger: each file is read exactly once,
over any number of runs and failures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ordermill import schemas


def new_files(
    spark: SparkSession,
    root: str,
    source: str,
    schema: T.StructType | None = None,
    file_format: str = "parquet",
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Streaming rows of a landed source, with its ``dt`` partition column."""
    fields = (schema or schemas.LANDED[source]).fields
    reader = (
        spark.readStream.schema(T.StructType([*fields, T.StructField("dt", T.DateType())]))
        .option("pathGlobFilter", f"*.{file_format}")
        .option("basePath", f"{root.rstrip('/')}/source={source}")
    )
    if file_format == "csv":
        reader = reader.option("header", True)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.format(file_format).load(f"{root.rstrip('/')}/source={source}")


def append_new_files(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    partition: str = "dt",
) -> StreamingQuery:
    """Appends everything that has landed since the last run and then ends.

    ``transform`` must be row-wise, as the filters of the cleaning module are. Both paths must
    lie on storage all executors share.
    """
    return (
        transform(rows)
        .writeStream.format("parquet")
        .partitionBy(partition)
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
