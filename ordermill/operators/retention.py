"""Partition expiry: which zone partitions are past their retention, and their removal."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.settings import Retention
from ordermill.sources.listing import open_filesystem, task_count


def keep_days(zone: Column, rules: Retention = Retention()) -> Column:
    """Retention of a zone in days; NULL for a zone without a rule."""
    pairs = [F.lit(x) for rule in vars(rules).items() for x in rule]
    return F.try_element_at(F.create_map(*pairs), zone)


def expired_partitions(
    partitions: DataFrame, as_of: Column, rules: Retention = Retention()
) -> DataFrame:
    """Rows of (zone, dt, …) older than the zone keeps them. Undated rows never expire."""
    return partitions.where(F.col("dt") < F.date_sub(as_of, keep_days(F.col("zone"), rules)))


def drop_folders(expired: DataFrame, roots: dict[str, str]) -> DataFrame:
    """Deletes the folder (or file) of each expired row (zone, folder), inside tasks. One that is
    already gone is no error, so a task may run twice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = {zone: open_filesystem(root) for zone, root in roots.items()}
        for batch in batches:
            for zone, folder in zip(batch["zone"], batch["folder"]):
                filesystem, base = opened[zone]
                path = f"{base}/{folder}"
                kind = filesystem.get_file_info(path).type
                with contextlib.suppress(FileNotFoundError):
                    if kind == fs.FileType.Directory:
                        filesystem.delete_dir(path)
                    elif kind == fs.FileType.File:
                        filesystem.delete_file(path)
            yield batch

    folders = expired.select("zone", "folder").distinct()
    spread = folders.repartition(task_count(expired.sparkSession), "folder")
    return spread.mapInPandas(run, "zone string, folder string")
