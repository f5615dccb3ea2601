"""File listings and file heads, read by the executors.

A Spark scan leaves out zero-byte files and needs every path on the driver first, so the
folders are listed inside tasks instead and each file becomes a row.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

_ENTRY = "path string, is_folder boolean, length bigint, modified_at timestamp"
_HEAD = (
    "file_name string, length bigint, known boolean, "
    "columns array<string>, rows bigint, error string, types array<string>"
)
_THREADS = 8
_CHUNK = 1 << 16
_ROWS_A_CHUNK = 10_000
_LEVELS = 3
#: Bytes of a file that are one task's work when files are read whole.
PART_BYTES = 64 << 20

# Names of folders and files that writers use while they work or as markers.
IN_FLIGHT_FOLDERS = frozenset({"_temporary", "_spark_metadata", "_delta_log"})
MARKER_FILES = frozenset({"_SUCCESS", "_FAILURE"})
IN_FLIGHT_ENDINGS = (".inprogress", "._COPYING_", ".crc")
IN_FLIGHT_BEGINNINGS = (".spark-staging", "_started_", "_committed_")


def is_landed(path: str) -> bool:
    """False for what a writer has not finished or left as a marker, by any part of the path; every
    other name, with a leading underscore or dot or not, is a landed file."""
    *folders, name = path.split("/")
    return not (
        any(f in IN_FLIGHT_FOLDERS or f.startswith(IN_FLIGHT_BEGINNINGS) for f in [*folders, name])
        or name in MARKER_FILES
        or name.endswith(IN_FLIGHT_ENDINGS)
    )


def open_filesystem(root: str) -> tuple[fs.FileSystem, str]:
    """File system and plain base path of a root given as a path or URI."""
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    filesystem, base = fs.FileSystem.from_uri(root)
    return filesystem, base.rstrip("/")


def _names(filesystem: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """Path and kind of a folder's entries, in the order they come. A local or mounted folder is read entry
    by entry, so that no task holds all of it; other file systems answer whole."""
    if isinstance(filesystem, fs.LocalFileSystem):
        with contextlib.suppress(FileNotFoundError, NotADirectoryError), os.scandir(folder) as entries:
            for entry in entries:
                yield f"{folder}/{entry.name}", entry.is_dir()
        return
    for info in filesystem.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        yield info.path, info.type == fs.FileType.Directory


def _entries(paths: list[str], are_folders: list[bool]) -> pd.DataFrame:
    n = len(paths)
    return pd.DataFrame(
        {
            "path": paths,
            "is_folder": are_folders,
            "length": pd.array([None] * n, dtype="Int64"),
            "modified_at": pd.to_datetime([None] * n, utc=True),
        }
    )


def _lister(root: str, recursive: bool):
    """Names of what the given folders hold, without sizes, in chunks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = open_filesystem(root)
        for batch in batches:
            files = batch[~batch["is_folder"]]
            if len(files):
                yield files
            waiting = list(batch.loc[batch["is_folder"], "path"])
            while waiting:
                paths, are_folders = [], []
                for path, is_folder in _names(filesystem, waiting.pop()):
                    if not is_landed(path[len(base) + 1 :]):
                        continue
                    if recursive and is_folder:
                        waiting.append(path)
                        continue
                    paths.append(path)
                    are_folders.append(is_folder)
                    if len(paths) >= _ROWS_A_CHUNK:
                        yield _entries(paths, are_folders)
                        paths, are_folders = [], []
                if paths:
                    yield _entries(paths, are_folders)

    return run


def _sizer(root: str):
    """Sizes and times of the given files; one that has gone in the meantime is left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, _ = open_filesystem(root)
        for batch in batches:
            infos = [i for i in filesystem.get_file_info(list(batch["path"])) if i.type == fs.FileType.File]
            yield pd.DataFrame(
                {
                    "path": [i.path for i in infos],
                    "is_folder": [False] * len(infos),
                    "length": pd.array([i.size for i in infos], dtype="Int64"),
                    "modified_at": pd.to_datetime([i.mtime_ns // 1000 for i in infos], unit="us", utc=True),
                }
            )

    return run


def task_count(spark: SparkSession, tasks: int | None = None) -> int:
    """Tasks to spread file work over. File rows are few and small while the work behind each
    is not, so their number, unlike the rows' bytes, says nothing about it. The shuffle setting
    counts too, since a cluster that grows on demand reports few cores at first."""
    if tasks:
        return tasks
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, wanted)


def list_files(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """Every file below ``root``: file_name (relative), length, modified_at. Zero bytes included.

    The upper folder levels (source, day, and one more) are listed one after the other, each level's
    folders spread over ``tasks`` tasks; what lies deeper is walked folder by folder in its task.
    Listing gives names only, streamed in chunks. The names, also those of one flat folder, are then dealt
    over the tasks, which ask for sizes and times.
    Unfinished files and markers are left out (see :func:`is_landed`).
    """
    n = task_count(spark, tasks)
    _, base = open_filesystem(root)
    level = spark.range(1, numPartitions=1).select(
        F.lit(base).alias("path"),
        F.lit(True).alias("is_folder"),
        F.lit(None).cast("bigint").alias("length"),
        F.lit(None).cast("timestamp").alias("modified_at"),
    )
    for _ in range(_LEVELS):
        level = level.mapInPandas(_lister(root, False), _ENTRY).repartition(n, "path")
    names = level.mapInPandas(_lister(root, True), _ENTRY)
    files = names.repartition(n, "path").mapInPandas(_sizer(root), _ENTRY)
    return files.select(
        F.substring("path", len(base) + 2, 1 << 20).alias("file_name"), "length", "modified_at"
    )


def list_folders(spark: SparkSession, root: str, depth: int) -> DataFrame:
    """Folders ``depth`` levels below ``root``, relative; their files are not listed."""
    n = task_count(spark)
    _, base = open_filesystem(root)
    level = spark.range(1, numPartitions=1).select(
        F.lit(base).alias("path"), F.lit(True).alias("is_folder"),
        F.lit(None).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modified_at"),
    )
    for k in range(depth):
        level = level.mapInPandas(_lister(root, False), _ENTRY).where("is_folder")
        if k + 1 < depth:
            level = level.repartition(n, "path")
    return level.select(F.substring("path", len(base) + 2, 1 << 20).alias("folder"))


def partition_dates(spark: SparkSession, root: str, column: str = "process_date") -> list[dt.date]:
    """Dates in the folder names of a table partitioned by ``column``, newest first: one value per
    partition, and no file is opened."""
    day = F.regexp_extract("folder", f"^{column}=(.*)$", 1).try_cast("date")
    found = list_folders(spark, root, 1).select(day.alias("day")).where("day IS NOT NULL").collect()
    return sorted((r["day"] for r in found), reverse=True)


def _arrow_type(kind: pa.DataType) -> str:
    """Name Spark gives a column of this type."""
    if pa.types.is_large_string(kind):
        kind = pa.string()
    try:
        return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()
    except Exception:  # a type Spark has no name for still is a type to report
        return str(kind)


def _parquet_head(filesystem: fs.FileSystem, path: str) -> tuple:
    """Names, rows, error, types and the row groups' compressed sizes."""
    # A file that cannot be opened fails the task, which Spark runs again; only a file that
    # opens and does not decode is corrupt.
    with filesystem.open_input_file(path) as handle:
        try:
            file = pq.ParquetFile(handle)
            schema, meta = file.schema_arrow, file.metadata
            sizes = [
                sum(meta.row_group(g).column(c).total_compressed_size for c in range(meta.num_columns))
                for g in range(meta.num_row_groups)
            ]
            return schema.names, meta.num_rows, None, [_arrow_type(t) for t in schema.types], sizes
        except (pa.ArrowException, OSError) as e:
            return None, None, f"Corrupt Parquet: {e}", None, []


def _csv_head(filesystem: fs.FileSystem, path: str) -> list[str]:
    head = []
    with filesystem.open_input_stream(path) as handle:
        while chunk := handle.read(_CHUNK):
            line, cut, _ = chunk.partition(b"\n")
            head.append(line)
            if cut:
                break
    return b"".join(head).decode("utf-8", errors="replace").strip().split(",")


def _decode(filesystem: fs.FileSystem, path: str, groups: range) -> str | None:
    """The error that decoding the pages of these row groups meets."""
    with filesystem.open_input_file(path) as handle:
        try:
            for _ in pq.ParquetFile(handle).iter_batches(row_groups=list(groups)):
                pass
        except (pa.ArrowException, OSError) as e:
            return f"Corrupt Parquet: {e}"
    return None


def _line_ends(filesystem: fs.FileSystem, path: str, begin: int, end: int) -> int:
    n = 0
    with filesystem.open_input_file(path) as handle:
        handle.seek(begin)
        while begin < end and (chunk := handle.read(min(_CHUNK, end - begin))):
            n += chunk.count(b"\n")
            begin += len(chunk)
    return n


def _shares(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """Stretches of neighbouring row groups of about ``limit`` bytes, one group at least."""
    out, begin, total = [], 0, 0
    for k, size in enumerate(sizes):
        if total and total + size > limit:
            out.append((begin, k))
            begin, total = k, 0
        total += size
    return [*out, (begin, len(sizes))] if sizes else []


def inspect_files(
    files: DataFrame,
    root: str,
    read_pages: bool = True,
    count_csv_rows: bool = True,
    tasks: int | None = None,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Column names and types, row count and read error of each Parquet or CSV file.

    Files are read whole: all Parquet pages are decoded and the line ends of CSV files counted
    (the header's included). Footers and headers come first; they cut files of more than ``part_bytes`` bytes
    into parts of about so many (row groups, byte ranges of a CSV file), which are dealt over the tasks and
    joined per file: the first error of a file, the sum of its line ends. So a large file is not one
    task's work. Without ``read_pages`` only Parquet footers, without ``count_csv_rows`` only the first CSV
    line is read. CSV columns have no types. Files of other formats, empty files and files with a true
    ``known`` column give NULLs.
    """
    if "known" not in files.columns:
        files = files.withColumn("known", F.lit(False))

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = open_filesystem(root)

        def head(name: str, length: int, known: bool) -> tuple:
            """Columns, rows, error, types and the parts left to read."""
            if known or not length:
                return None, None, None, None, []
            path = f"{base}/{name}"
            if name.endswith(".parquet"):
                names, rows, error, types, sizes = _parquet_head(filesystem, path)
                shares = _shares(sizes, part_bytes) if read_pages else []
                if len(shares) == 1:  # a small file, read here and now
                    return names, rows, _decode(filesystem, path, range(*shares[0])), types, []
                return names, rows, error, types, shares
            if name.endswith(".csv"):
                names = _csv_head(filesystem, path)
                if not count_csv_rows:
                    return names, None, None, None, []
                if length <= part_bytes:
                    return names, _line_ends(filesystem, path, 0, length), None, None, []
                return names, None, None, None, [(a, min(a + part_bytes, length)) for a in range(0, length, part_bytes)]
            return None, None, None, None, []

        with ThreadPoolExecutor(_THREADS) as pool:
            for batch in batches:
                found = list(pool.map(head, batch["file_name"], batch["length"], batch["known"]))
                yield batch.reset_index(drop=True).assign(
                    columns=pd.Series([h[0] for h in found], dtype="object"),
                    rows=pd.array([h[1] for h in found], dtype="Int64"),
                    error=pd.Series([h[2] for h in found], dtype="object"),
                    types=pd.Series([h[3] for h in found], dtype="object"),
                    parts=pd.Series([[{"begin": a, "end": z} for a, z in h[4]] for h in found], dtype="object"),
                )

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = open_filesystem(root)

        def read(name: str, begin, end) -> tuple:
            if pd.isna(begin):
                return None, None
            if name.endswith(".csv"):
                return _line_ends(filesystem, f"{base}/{name}", int(begin), int(end)), None
            return None, _decode(filesystem, f"{base}/{name}", range(int(begin), int(end)))

        with ThreadPoolExecutor(_THREADS) as pool:
            for batch in batches:
                found = list(pool.map(read, batch["file_name"], batch["begin"], batch["end"]))
                yield batch.reset_index(drop=True).assign(
                    line_ends=pd.array([f[0] for f in found], dtype="Int64"),
                    damage=pd.Series([f[1] for f in found], dtype="object"),
                )

    n = task_count(files.sparkSession, tasks)
    found = files.select("file_name", "length", "known").repartition(n, "file_name").mapInPandas(
        heads, f"{_HEAD}, parts array<struct<begin bigint, end bigint>>"
    )
    if not read_pages and not count_csv_rows:
        return found.drop("parts")
    dealt = found.select("*", F.inline_outer("parts")).drop("parts").repartition(n, "file_name", "begin")
    read = dealt.mapInPandas(parts, f"{_HEAD}, begin bigint, end bigint, line_ends bigint, damage string")
    damage = F.min(F.when(F.col("damage").isNotNull(), F.struct("begin", "damage")))["damage"]
    return read.groupBy("file_name").agg(
        F.first("length").alias("length"),
        F.first("known").alias("known"),
        F.first("columns").alias("columns"),
        F.coalesce(F.first("rows", ignorenulls=True), F.sum("line_ends")).alias("_rows"),
        F.coalesce(F.first("error", ignorenulls=True), damage).alias("error"),
        F.first("types").alias("types"),
    ).select(
        "file_name", "length", "known",
        F.when(F.col("error").isNull(), F.col("columns")).alias("columns"),
        F.when(F.col("error").isNull(), F.col("_rows")).alias("rows"),
        "error",
        F.when(F.col("error").isNull(), F.col("types")).alias("types"),
    )
