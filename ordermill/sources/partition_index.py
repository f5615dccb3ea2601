"""An index of a partitioned table, kept beside it: each partition with its rows and files.

The index is a small JSON file of one entry a partition in ``<table>_partitions``, read on the driver without
a job. A writer marks it open before it touches the table and puts the next version under a new name when
the table is committed, so a reader sees a whole version or, after a run that failed in between, an open
one, which it does not trust. The next commit after such a run counts all partitions afresh.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ordermill.sources.listing import inspect_files, is_landed, open_filesystem

_THREADS = 16
#: Footers of at most so many files are read by the driver, more of them by tasks.
_FEW_FILES = 512

Partitions = dict[str, tuple[int, int]]


def index_folder(path: str) -> str:
    return f"{path.rstrip('/')}_partitions"


def _versions(path: str) -> tuple[fs.FileSystem, str, list[tuple[int, str]]]:
    """Number and file of each version, in order; an open one after the closed one of its number."""
    filesystem, base = open_filesystem(index_folder(path))
    infos = filesystem.get_file_info(fs.FileSelector(base, allow_not_found=True))
    names = [i.path for i in infos if i.path.rpartition(".")[2] in ("json", "open")]
    found = [(int(n.rpartition("/")[2].partition(".")[0]), n) for n in names]
    return filesystem, base, sorted(found, key=lambda v: (v[0], v[1].endswith(".open")))


def read(path: str) -> Partitions | None:
    """Partition value → (rows, files); None without an index or when a writer has not closed it."""
    filesystem, _, versions = _versions(path)
    if not versions or versions[-1][1].endswith(".open"):
        return None
    with filesystem.open_input_stream(versions[-1][1]) as file:
        return {value: tuple(counts) for value, counts in json.loads(file.read()).items()}


def begin(path: str) -> Partitions | None:
    """Marks the index open; returns what it held if that can be trusted."""
    before = read(path)
    filesystem, base, versions = _versions(path)
    number = versions[-1][0] if versions else 0
    filesystem.create_dir(base, recursive=True)
    with filesystem.open_output_stream(f"{base}/{number:012d}.open") as file:
        file.write(b"")
    return before


def commit(
    spark: SparkSession, path: str, column: str, before: Partitions | None, touched: Iterable[str]
) -> None:
    """Closes the index after a write to, or a removal of, the ``touched`` partitions."""
    prefix = f"{column}="
    filesystem, base = open_filesystem(path)
    if before is None:
        folders = filesystem.get_file_info(fs.FileSelector(base, allow_not_found=True))
        names = (i.path.rpartition("/")[2] for i in folders if i.type == fs.FileType.Directory)
        before, touched = {}, [n.removeprefix(prefix) for n in names if n.startswith(prefix)]
    counted = _counts(spark, path, prefix, list(touched))
    now = {v: c for v, c in before.items() if v not in counted} | {v: c for v, c in counted.items() if c[1]}
    filesystem, base, versions = _versions(path)
    number = versions[-1][0] + 1 if versions else 1
    with filesystem.open_output_stream(f"{base}/{number:012d}.part") as file:
        file.write(json.dumps(dict(sorted(now.items()))).encode())
    filesystem.move(f"{base}/{number:012d}.part", f"{base}/{number:012d}.json")
    for _, name in versions:
        with contextlib.suppress(FileNotFoundError):
            filesystem.delete_file(name)


def _counts(spark: SparkSession, path: str, prefix: str, values: list[str]) -> Partitions:
    """Rows and files of the given partitions, from the footers of their files."""
    filesystem, base = open_filesystem(path)

    def files_of(value: str) -> list[fs.FileInfo]:
        selector = fs.FileSelector(f"{base}/{prefix}{value}", allow_not_found=True)
        return [i for i in filesystem.get_file_info(selector) if i.size and is_landed(i.path[len(base) + 1 :])]

    def rows_of(info: fs.FileInfo) -> int:
        with filesystem.open_input_file(info.path) as handle:
            return pq.read_metadata(handle).num_rows

    with ThreadPoolExecutor(_THREADS) as pool:
        found = dict(zip(values, pool.map(files_of, values), strict=True))
        files = [(value, info) for value, infos in found.items() for info in infos]
        if len(files) <= _FEW_FILES:
            rows = dict.fromkeys(values, 0)
            for (value, _), n in zip(files, pool.map(rows_of, [i for _, i in files]), strict=True):
                rows[value] += n
            return {value: (rows[value], len(found[value])) for value in values}
    table = spark.createDataFrame([(i.path[len(base) + 1 :], i.size) for _, i in files], "file_name string, length long")
    value = F.substring_index(F.substring_index("file_name", "/", 1), "=", -1)
    heads = inspect_files(table, path, read_pages=False).groupBy(value.alias("value")).agg(F.sum("rows"), F.count("*"))
    return dict.fromkeys(values, (0, 0)) | {r[0]: (r[1] or 0, r[2]) for r in heads.collect()}
