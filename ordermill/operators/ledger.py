"""The ledger of handled files: entries in buckets by a hash of the file name, compacted as runs add up.

A run appends one folder of entries, a file a bucket. A manifest says which folders each bucket consists of
and changes at once, so a reader sees a run whole or not at all. A bucket of more than ``MAX_RUNS`` folders
is rewritten to one, with the newest entry of each file; what it replaces is removed by the next
compaction, when readers of the old manifest are done. So the number of folders to read has a bound,
whatever the number of runs.
"""

from __future__ import annotations

import contextlib
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.cleaning import one_per_key
from ordermill.schemas import LEDGER
from ordermill.sources import versions
from ordermill.sources.listing import open_filesystem
from ordermill.sources.tables import read_table

BUCKETS = 16
MAX_RUNS = 8


def _bucket() -> Column:
    return F.pmod(F.crc32("file_name"), F.lit(BUCKETS)).cast("int")


def _manifest_folder(path: str) -> str:
    return f"{path.rstrip('/')}_manifest"


def manifest(path: str) -> dict | None:
    """``buckets``: bucket → folders, oldest first; ``replaced``: folders no bucket needs any more."""
    return versions.latest(_manifest_folder(path))


def latest_entries(ledger: DataFrame) -> DataFrame:
    """The ledger as a table with one row per file: the newest entry replaces older ones."""
    return one_per_key(ledger, ["file_name"], ["processed_at", "status"])


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """All entries, None when there is no ledger yet. A folder of plain Parquet files, as older versions
    left it, is read as it is."""
    now = manifest(path)
    if now is None:
        return read_table(spark, path, LEDGER)
    folders = [folder for folders in now["buckets"].values() for folder in folders]
    if not folders:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(*[f"{path.rstrip('/')}/{folder}" for folder in folders])


def _write(entries: DataFrame, path: str, kind: str) -> dict[str, str]:
    """Writes entries by bucket to a new folder; returns the folder of each bucket that has any."""
    folder = f"{kind}-{uuid.uuid4().hex}"
    rows = entries.select(*LEDGER.fieldNames()).withColumn("bucket", _bucket())
    rows.repartition(BUCKETS, "bucket").write.partitionBy("bucket").parquet(f"{path.rstrip('/')}/{folder}")
    filesystem, base = open_filesystem(f"{path.rstrip('/')}/{folder}")
    infos = filesystem.get_file_info(fs.FileSelector(base, allow_not_found=True))
    names = [i.path.rpartition("/")[2] for i in infos if i.type == fs.FileType.Directory]
    return {n.removeprefix("bucket="): f"{folder}/{n}" for n in names if n.startswith("bucket=")}


def append(entries: DataFrame, path: str) -> None:
    """Adds the entries of a run; entries repeated by a re-run do no harm, since the newest one per file
    counts. One writer at a time."""
    spark = entries.sparkSession
    now = manifest(path)
    if now is None:
        plain = read_table(spark, path, LEDGER)
        if plain is not None:
            entries = latest_entries(plain.unionByName(entries.select(*LEDGER.fieldNames())))
        now = {"buckets": {}, "replaced": []}
    buckets = {bucket: list(folders) for bucket, folders in now["buckets"].items()}
    for bucket, folder in _write(entries, path, "run").items():
        buckets.setdefault(bucket, []).append(folder)
    versions.put(_manifest_folder(path), {"buckets": buckets, "replaced": now["replaced"]})
    if any(len(folders) > MAX_RUNS for folders in buckets.values()):
        compact(spark, path, MAX_RUNS)


def compact(spark: SparkSession, path: str, max_runs: int = MAX_RUNS) -> None:
    """Rewrites buckets of more than ``max_runs`` folders to one folder each."""
    now = manifest(path)
    full = {b: folders for b, folders in now["buckets"].items() if len(folders) > max_runs}
    if not full:
        return
    old = [folder for folders in full.values() for folder in folders]
    rows = spark.read.schema(LEDGER).parquet(*[f"{path.rstrip('/')}/{folder}" for folder in old])
    written = _write(latest_entries(rows), path, "compact")
    buckets = now["buckets"] | {b: [written[b]] for b in full}
    versions.put(_manifest_folder(path), {"buckets": buckets, "replaced": old})
    filesystem, base = open_filesystem(path)
    for folder in now["replaced"]:
        with contextlib.suppress(FileNotFoundError):
            filesystem.delete_dir(f"{base}/{folder}")
