"""A table that refuses to be read without a filter on its partition column, for SQL users too.

Spark reads the table itself, with its own pruning. It is joined to a data source of its partition values,
one row each, to which Spark hands the filters on the partition column. That source refuses to be read
without one, so a query that bounds no date fails before a file of the table is opened.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    LessThan,
    LessThanOrEqual,
)

from ordermill.sources import partition_index
from ordermill.sources.listing import open_filesystem

FORMAT = "ordermill_partition_values"
REFUSED = "this table is partitioned by %s: filter it by =, <, <=, >, >= or IN"
_BOUNDS = (EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual)


class PartitionValues(DataSource):
    """The dates a table is partitioned by, from its index or, without one, its folders."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{self.options['column']} date"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["column"])


class _Reader(DataSourceReader):
    def __init__(self, path: str, column: str):
        self.path, self.column, self.bounded = path, column, False

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes note of a bound; Spark still applies all filters."""
        self.bounded = any(isinstance(f, _BOUNDS) and f.attribute == (self.column,) for f in filters)
        return filters

    def partitions(self):
        if not self.bounded:
            raise ValueError(REFUSED % self.column)
        return super().partitions()

    def read(self, partition) -> Iterator[tuple]:
        if not self.bounded:
            raise ValueError(REFUSED % self.column)
        for value in _values(self.path, self.column):
            try:
                yield (dt.date.fromisoformat(value),)
            except ValueError:  # no date, so no query asks for it
                continue


def _values(path: str, column: str) -> Iterable[str]:
    known = partition_index.read(path)
    if known is not None:
        return known
    filesystem, base = open_filesystem(path)
    folders = filesystem.get_file_info(fs.FileSelector(base, allow_not_found=True))
    names = (i.path.rpartition("/")[2] for i in folders if i.type == fs.FileType.Directory)
    return [n.partition("=")[2] for n in names if n.startswith(f"{column}=")]


def guarded_table(
    spark: SparkSession, table: DataFrame, path: str, column: str = "process_date"
) -> DataFrame:
    """The rows of ``table``, stored at ``path`` by dates in ``column``, if a query bounds that column.

    Equality joins hand such a bound to both sides: to the scan of the table as partition filters, and to
    the partition values.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PartitionValues)
    values = spark.read.format(FORMAT).option("path", path).option("column", column).load()
    joined = table.alias("t").join(values.alias("v"), F.col(f"t.{column}") == F.col(f"v.{column}"))
    return joined.select(*[F.col(f"v.{c}" if c == column else f"t.{c}").alias(c) for c in table.columns])
