import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ordermill.sources import listing


def test_a_flat_folder_is_sized_in_several_tasks(spark, tmp_path):
    folder = tmp_path / "source=orders" / "dt=2026-03-19"
    folder.mkdir(parents=True)
    for k in range(5_000):
        (folder / f"{k}.csv").write_bytes(b"x" * (k % 7))
    (folder / "_SUCCESS").touch()
    files = listing.list_files(spark, str(tmp_path), tasks=8)
    got = files.withColumn("task", F.spark_partition_id()).groupBy("task").agg(
        F.count("*").alias("n"), F.sum("length").alias("size")
    ).collect()
    assert len(got) == 8 and max(r["n"] for r in got) < 1_250
    assert sum(r["n"] for r in got) == 5_000 and sum(r["size"] for r in got) == sum(k % 7 for k in range(5_000))


def test_names_come_in_chunks(tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "_ROWS_A_CHUNK", 10)
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    for k in range(35):
        (deep / f"{k}.csv").touch()
    top = pd.DataFrame({"path": [str(tmp_path)], "is_folder": [True], "length": pd.array([None], dtype="Int64"), "modified_at": pd.to_datetime([None], utc=True)})
    found = list(listing._lister(str(tmp_path), True)(iter([top])))
    assert max(len(f) for f in found) == 10 and sum(len(f) for f in found) == 35


@pytest.fixture
def large(tmp_path):
    """A Parquet file of twelve row groups, one with its last group damaged, and a CSV file."""
    rows = pa.table({"order_id": [str(k) for k in range(12_000)], "amount": np.random.default_rng(1).random(12_000)})
    for name in ("good", "bad"):
        pq.write_table(rows, tmp_path / f"{name}.parquet", row_group_size=1_000, use_dictionary=False, compression="zstd")
    meta = pq.ParquetFile(tmp_path / "bad.parquet").metadata
    column = meta.row_group(11).column(0)
    with open(tmp_path / "bad.parquet", "r+b") as f:
        f.seek(column.data_page_offset)
        f.write(b"\xff" * column.total_compressed_size)
    (tmp_path / "c.csv").write_bytes(b"order_id,amount\n" + b"".join(b"%d,1.0\n" % k for k in range(9_000)))
    (tmp_path / "no_end.csv").write_bytes(b"order_id")
    return str(tmp_path)


def heads(df):
    return {r["file_name"]: (r["columns"], r["rows"], r["error"] and r["error"][:16]) for r in df.collect()}


def test_parts_of_a_file_are_read_by_several_tasks_with_the_same_result(spark, large):
    files = listing.list_files(spark, large)
    whole = heads(listing.inspect_files(files, large))
    parts = heads(listing.inspect_files(files, large, part_bytes=5_000))
    assert whole == parts == {
        "good.parquet": (["order_id", "amount"], 12_000, None),
        "bad.parquet": (None, None, "Corrupt Parquet:"),
        "c.csv": (["order_id", "amount"], 9_001, None),
        "no_end.csv": (["order_id"], 0, None),
    }
    quick = heads(listing.inspect_files(files, large, read_pages=False, count_csv_rows=False))
    assert quick["bad.parquet"] == (["order_id", "amount"], 12_000, None) and quick["c.csv"][1] is None


def test_a_large_file_is_cut_at_row_groups(large):
    filesystem, base = listing.open_filesystem(large)
    sizes = listing._parquet_head(filesystem, f"{base}/good.parquet")[4]
    shares = listing._shares(sizes, 2 * max(sizes))
    assert len(sizes) == 12 and len(shares) >= 6
    assert shares[0][0] == 0 and shares[-1][1] == 12 and all(a[1] == b[0] for a, b in zip(shares, shares[1:]))
    assert listing._decode(filesystem, f"{base}/bad.parquet", range(0, 11)) is None
    assert listing._decode(filesystem, f"{base}/bad.parquet", range(11, 12)).startswith("Corrupt Parquet")
    size = os.path.getsize(f"{large}/c.csv")
    assert sum(listing._line_ends(filesystem, f"{base}/c.csv", a, min(a + 1_000, size)) for a in range(0, size, 1_000)) == 9_001
