"""Status labels and the searched CASE expressions that pick them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels the reports print.
COMPLETE = "✅ MATCH"
DATA_LOSS = "❌ DATA LOSS"
OVER_COUNT = "⚠️ OVER-COUNT"
UNIQUE = "✅ UNIQUE"
DUPLICATES = "❌ DUPLICATES FOUND"
MERGED = "✅ MERGE SUCCESSFUL"
MERGE_MISMATCH = "❌ ROW COUNT MISMATCH — INVESTIGATE"
LARGE_SCAN = "⚠️ LARGE SCAN — check partition filter"
SCAN_OK = "✅ OK"

# Fixed value: bytes billed above which a job counts as a large scan (10 GiB).
LARGE_SCAN_BYTES = 10737418240


@dataclass(frozen=True)
class Labels:
    """Override to print other texts. ``missing`` names dates production lacks; by default
    both comparisons are NULL there and the last branch applies."""

    complete: str = COMPLETE
    data_loss: str = DATA_LOSS
    over_count: str = OVER_COUNT
    unique: str = UNIQUE
    duplicates: str = DUPLICATES
    missing: str | None = None


def completeness(staged: Column, produced: Column, labels: Labels = Labels()) -> Column:
    rest = F.lit(labels.over_count)
    if labels.missing is not None:
        rest = F.when(produced.isNull(), labels.missing).otherwise(rest)
    return (
        F.when(staged == produced, labels.complete)
        .when(staged > produced, labels.data_loss)
        .otherwise(rest)
    )


def uniqueness(rows: Column, distinct_ids: Column, labels: Labels = Labels()) -> Column:
    return F.when(rows == distinct_ids, labels.unique).otherwise(labels.duplicates)


def merge_outcome(staged: Column, produced: Column) -> Column:
    return F.when(produced >= staged, MERGED).otherwise(MERGE_MISMATCH)


def scan_size(bytes_billed: Column) -> Column:
    return F.when(bytes_billed > F.lit(LARGE_SCAN_BYTES), LARGE_SCAN).otherwise(SCAN_OK)
