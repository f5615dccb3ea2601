"""Streamed intake tied to validation and the ledger.

A file stream finds what has landed since the last run, each file once, and ends when it has caught up. New
files that the ledger does not know are judged as :mod:`ordermill.operators.landing` judges them; rows of
valid ones go to a folder of this run, and the verdicts to the ledger. A manifest makes the run's rows
visible and notes its verdicts in one step, so a run that fails leaves nothing half done: before that step
its files are taken by the next run, after it the next run only records the verdicts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import landing
from ordermill.sources import listing, tables, versions

_FOUND = "file_name string, length bigint"
_BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def _manifest_folder(state: str) -> str:
    return f"{state.rstrip('/')}/manifest"


def _manifest(state: str) -> dict:
    return versions.latest(_manifest_folder(state)) or {"runs": [], "unrecorded": []}


def find_new(
    spark: SparkSession, root: str, source: str, state: str, max_files_per_batch: int | None = None
) -> None:
    """Appends names and sizes of files that have landed since the last run to ``found`` in ``state``. The
    contents are not read. Spark's listing leaves out hidden files; empty files give no row."""
    reader = spark.readStream.schema(_BINARY).option("recursiveFileLookup", "true")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    files = reader.format("binaryFile").load(f"{root.rstrip('/')}/source={source}")
    name = F.concat(F.lit("source="), F.substring_index("path", "/source=", -1))
    (
        files.select(name.alias("file_name"), "length")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{state}/checkpoint")
        .option("path", f"{state}/found")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def take_in(
    spark: SparkSession, root: str, source: str, target: str, state: str, ledger: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df, max_files_per_batch: int | None = None,
) -> DataFrame:
    """Takes in a source's new files; returns them judged. ``transform`` must be row-wise. All paths must lie
    on storage all executors share; one run at a time."""
    find_new(spark, root, source, state, max_files_per_batch)
    done = _manifest(state)
    for run in done["unrecorded"]:
        _record(spark, state, run, ledger)
    found = spark.read.schema(_FOUND).parquet(f"{state}/found")
    new = landing.pending(found, landing.read_ledger(spark, ledger))
    run = uuid.uuid4().hex
    judged = landing.route(landing.judge(listing.inspect_files(new, root)))
    judged.write.parquet(f"{state}/judged-{run}")
    judged = spark.read.schema(judged.schema).parquet(f"{state}/judged-{run}")
    valid = judged.where(F.col("zone") == "validated").select("file_name").collect()  # paths the reader needs
    paths = [f"{root.rstrip('/')}/{r['file_name']}" for r in valid]
    parquet, csv = ([p for p in paths if p.endswith(e)] for e in (".parquet", ".csv"))
    runs = done["runs"]
    if parquet or csv:
        rows = tables.read_both(spark, parquet, csv, schemas.LANDED[source])
        transform(rows).write.parquet(f"{target.rstrip('/')}/run-{run}")
        runs = [*runs, run]
    versions.put(_manifest_folder(state), {"runs": runs, "unrecorded": [run]})
    _record(spark, state, run, ledger)
    versions.put(_manifest_folder(state), {"runs": runs, "unrecorded": []})
    return judged


def _record(spark: SparkSession, state: str, run: str, ledger: str) -> None:
    """Verdicts of a run go to the ledger; once more does no harm."""
    judged = spark.read.parquet(f"{state}/judged-{run}")
    landing.append_ledger(landing.ledger_entries(judged), ledger)


def taken(spark: SparkSession, target: str, state: str, like: DataFrame) -> DataFrame:
    """Rows of all runs the manifest has, with the columns of ``like``."""
    runs = _manifest(state)["runs"]
    if not runs:
        return like.where("false")
    return spark.read.schema(like.schema).parquet(*[f"{target.rstrip('/')}/run-{run}" for run in runs])
