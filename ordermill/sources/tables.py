"""Readers of landed data and warehouse tables. Schemas are always given, never inferred."""

from __future__ import annotations

import datetime as dt
import posixpath
from collections.abc import Iterable, Sequence
from urllib.parse import unquote, urlsplit

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill import schemas
from ordermill.functions.columns import safe_date
from ordermill.operators.cleaning import one_per_key
from ordermill.sources import versions
from ordermill.sources.guard import guarded_table
from ordermill.sources.listing import inspect_files, is_landed, list_files, open_filesystem


class PartitionFilterRequired(ValueError):
    """A partitioned table was to be read without bounds on its partition column."""


def read_landed(
    spark: SparkSession, root: str, source: str, day: str | dt.date, file_format: str = "parquet"
) -> DataFrame:
    """One day of a landed source. Only that day's folder is listed and read.

    A day may hold the same table as Parquet and as CSV; only files of the asked format are read.
    """
    base = root.rstrip("/")
    folder = landed_folder(root, source, day)
    reader = (
        spark.read.schema(schemas.LANDED[source])
        .option("basePath", f"{base}/source={source}")
        .option("pathGlobFilter", f"*.{file_format}")
    )
    if file_format == "csv":
        reader = reader.option("header", True)
    return reader.format(file_format).load(folder).drop("dt")


def landed_folder(root: str, source: str, day: str | dt.date) -> str:
    return f"{root.rstrip('/')}/source={source}/dt={day}"


def snapshot_record(root: str, source: str) -> str:
    """Folder of the record that says which files are the snapshot of a dimension."""
    return f"{root.rstrip('/')}_snapshots/source={source}"


def set_snapshot(root: str, source: str, files: list[str]) -> None:
    """Makes these files (paths below ``root``) the snapshot, at once for all readers."""
    versions.put(snapshot_record(root, source), sorted(files))


def snapshot_files(root: str, source: str) -> list[str]:
    """Paths of the files of a dimension's snapshot: those on record, if all are there, else all in its
    ``latest`` folder."""
    filesystem, base = open_filesystem(root)
    recorded = versions.latest(snapshot_record(root, source)) or []
    there = filesystem.get_file_info([f"{base}/{name}" for name in recorded])
    if not recorded or any(i.type != fs.FileType.File for i in there):
        folder = fs.FileSelector(f"{base}/source={source}/latest", recursive=True, allow_not_found=True)
        there = [i for i in filesystem.get_file_info(folder) if i.type == fs.FileType.File]
    names = [i.path[len(base) + 1 :] for i in there if i.size]
    return [f"{root.rstrip('/')}/{name}" for name in names if is_landed(name)]


def read_latest(spark: SparkSession, root: str, source: str = "user_segments") -> DataFrame:
    """The undated snapshot of a dimension, in whichever formats it came. A reader never sees two
    snapshots: the record of the snapshot's files changes at once (see :func:`set_snapshot`)."""
    schema = schemas.LANDED[source]
    files = snapshot_files(root, source)
    parquet = [f for f in files if f.endswith(".parquet")]
    csv = [f for f in files if f.endswith(".csv")]
    if not parquet and not csv:
        folder = f"{root.rstrip('/')}/source={source}/latest"
        return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(folder)
    return read_both(spark, parquet, csv, schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def _csv_rows(spark: SparkSession, header: Sequence[str], paths: list[str], schema: T.StructType) -> DataFrame:
    """Rows of CSV files of one header, columns taken by its names."""
    text = spark.read.schema(", ".join(f"`{c}` string" for c in header)).option("header", True).csv(paths)
    return text.select(*[
        (F.col(f"`{f.name}`") if f.name in header else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _fingerprints(rows: DataFrame) -> DataFrame:
    """Rows of each file and a checksum of their contents, whatever their order: file, rows, checksum."""
    content = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in rows.columns])
    file = F.col("_metadata.file_path")
    return rows.select(file.alias("file"), content.alias("h")).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(20,0)")).alias("checksum")
    )


def _name(path: str) -> str:
    """A path as file systems, URIs and readers all spell it."""
    return unquote(urlsplit(path).path if "://" in path or path.startswith("file:") else path)


def csv_without_twin(
    spark: SparkSession, parquet: list[str], csv: list[str], schema: T.StructType
) -> dict[tuple[str, ...], list[str]]:
    """CSV files whose rows no Parquet file holds, by their header.

    Twins are told by what is in the files: the same column names, number of rows and checksum of the
    contract's columns, file by file or all CSV files of a header against all Parquet files of those
    columns. Names say nothing. Files are read for it only where both formats are there.
    """
    root = posixpath.commonpath([_name(f) for f in parquet + csv]) if len(parquet + csv) > 1 else posixpath.dirname(_name(csv[0]))
    names = {posixpath.relpath(_name(f), root): f for f in parquet + csv}
    listed = spark.createDataFrame([(n, 1) for n in names], "file_name string, length long")
    heads = inspect_files(listed, root, read_pages=False, count_csv_rows=False)
    columns = {r["file_name"]: tuple(r["columns"] or ()) for r in heads.select("file_name", "columns").collect()}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for name, file in names.items():
        if name.endswith(".csv"):
            by_header.setdefault(columns[name], []).append(file)
    by_columns: dict[frozenset, list[str]] = {}
    for name, file in names.items():
        if name.endswith(".parquet"):
            by_columns.setdefault(frozenset(columns[name]), []).append(file)
    out = {}
    for header, files in by_header.items():
        others = by_columns.get(frozenset(header))
        if not others:
            out[header] = files
            continue
        # One row per file.
        there = [tuple(r)[1:] for r in _fingerprints(spark.read.schema(schema).parquet(*others)).collect()]
        mine = {_name(r["file"]): (r["rows"], r["checksum"]) for r in _fingerprints(_csv_rows(spark, header, files, schema)).collect()}
        if _total(mine.values()) == _total(there):
            continue
        left = [f for f in files if mine.get(_name(f), (0, None)) not in there and _name(f) in mine]
        if left:
            out[header] = left
    return out


def _total(parts: Iterable[tuple]) -> tuple:
    parts = list(parts)
    return sum(p[0] for p in parts), sum(p[1] for p in parts)


def read_both(spark: SparkSession, parquet: list[str], csv: list[str], schema: T.StructType) -> DataFrame:
    """Rows of the given files, without those of CSV files that have a Parquet twin."""
    rows = spark.read.schema(schema).parquet(*parquet) if parquet else None
    for header, paths in sorted(csv_without_twin(spark, parquet, csv, schema).items()) if csv else ():
        part = _csv_rows(spark, header, paths, schema)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def read_day(spark: SparkSession, root: str, source: str, day: str | dt.date) -> DataFrame:
    """One day of a landed source in whichever formats it came: its Parquet files, and the CSV files
    that have no Parquet twin. CSV columns are taken by the names in each file's header."""
    folder = landed_folder(root, source, day)
    files = list_files(spark, folder).where("length > 0 AND file_name LIKE '%.csv'").select("file_name")
    csv = [f"{folder}/{r['file_name']}" for r in files.collect()]  # paths Spark's reader needs anyway
    if not csv:
        return read_landed(spark, root, source, day)
    files = list_files(spark, folder).where("length > 0 AND file_name LIKE '%.parquet'").select("file_name")
    parquet = [f"{folder}/{r['file_name']}" for r in files.collect()]
    return read_both(spark, parquet, csv, schemas.LANDED[source])


def read_inputs(
    spark: SparkSession, root: str, day: str | dt.date
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders and events of one day, and the latest segments, one row per user."""
    segments = read_latest(spark, root)
    rest = [c for c in segments.columns if c != "user_id"]
    return (
        read_day(spark, root, "orders", day),
        read_day(spark, root, "events", day),
        one_per_key(segments, ["user_id"], rest),
    )


def read_files(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Bag union of files or folders in one scan; a column a file lacks reads as NULL."""
    return spark.read.schema(schema).parquet(*paths)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A Parquet table, or None when nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def between_dates(
    column: Column, date_from: str | dt.date | None, date_to: str | dt.date | None
) -> Column:
    """Closed date range; either end may be open, not both."""
    if date_from is None and date_to is None:
        raise PartitionFilterRequired("give date_from, date_to or both")
    condition = F.lit(True)
    if date_from is not None:
        condition = condition & (column >= F.lit(str(date_from)).cast("date"))
    if date_to is not None:
        condition = condition & (column <= F.lit(str(date_to)).cast("date"))
    return condition


def read_partitions(
    spark: SparkSession,
    path: str,
    date_from: str | dt.date | None = None,
    date_to: str | dt.date | None = None,
    schema: T.StructType = schemas.ENRICHED,
    column: str = "process_date",
) -> DataFrame:
    """A date-partitioned table, bounded. Refuses to scan it whole."""
    condition = between_dates(F.col(column), date_from, date_to)
    return spark.read.schema(schema).parquet(path).where(condition)


def last_days(df: DataFrame, as_of: Column, days: int = 90, column: str = "process_date") -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``."""
    return df.where(F.col(column) >= F.date_sub(as_of, days))


def register_views(
    spark: SparkSession, staging: str, production: str, as_of: Column | None = None
) -> list[str]:
    """Temporary views for SQL users over the stored tables; returns their names.

    ``enriched_orders`` refuses a scan without a filter on its date; the 90-day view for dashboards carries
    its own.
    """
    today = F.current_date() if as_of is None else as_of
    produced = spark.read.schema(schemas.ENRICHED).parquet(production)
    views = {
        "enriched_orders_staging": spark.read.schema(schemas.ENRICHED).parquet(staging),
        "enriched_orders": guarded_table(spark, produced, production),
        "enriched_orders_last_90d": last_days(produced, today),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def staging_view(staging: DataFrame) -> DataFrame:
    """Staging with explicit columns and a safe date; a text that is no date becomes NULL."""
    order = [
        "order_id", "user_id", "amount", "currency", "status", "event_count", "event_types",
        "user_segment", "lifetime_value", "country", "row_hash", "process_date",
        "created_at", "updated_at",
    ]
    return staging.withColumn("process_date", safe_date(F.col("process_date"))).select(*order)
