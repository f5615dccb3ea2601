import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import incremental, merging, writing
from ordermill.sources import partition_index
from ordermill.sources.tables import read_files
from tests.test_merging import D1, D2, D3, brief, now, rows, table


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "production")
    writing.write_enriched(rows(spark, ("a", 1.0, D1), ("b", 2.0, D2), ("c", 3.0, D2)), path)
    return path


def counted(path):
    return {value: rows for value, (rows, _) in partition_index.read(path).items()}


def test_the_index_follows_writes_and_drops(spark, path):
    assert counted(path) == {str(D1): 1, str(D2): 2}
    writing.write_enriched(rows(spark, ("d", 1.0, D2), ("e", 2.0, D3), ("f", 3.0, D3)), path, clustered=True)
    assert counted(path) == {str(D1): 1, str(D2): 1, str(D3): 2}
    files = {value: n for value, (_, n) in partition_index.read(path).items()}
    assert all(n == len([f for f in os.listdir(f"{path}/process_date={v}") if f.endswith(".parquet")]) for v, n in files.items())
    writing.drop_partitions(spark, path, "process_date", [D1, dt.date(1999, 1, 1)])
    assert counted(path) == {str(D2): 1, str(D3): 2}
    writing.write_enriched(rows(spark), path)
    assert counted(path) == {str(D2): 1, str(D3): 2}
    assert len(os.listdir(partition_index.index_folder(path))) == 1


def test_the_newest_date_needs_no_job_and_no_file(spark, path):
    for folder, _, files in os.walk(path):
        for name in files:
            os.chmod(f"{folder}/{name}", 0)
    spark.sparkContext.setJobGroup("newest", "newest date")
    try:
        assert incremental.newest_partition(spark, path) == D2
        assert incremental.newest_partition(spark, path, before=str(D2)) == D1
        assert incremental.newest_partition(spark, path, floor="2030-01-01") is None
    finally:
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("newest")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_an_index_left_open_is_not_trusted_and_then_counted_afresh(spark, path):
    partition_index.begin(path)
    # A run that failed after its write: the rows are there, the index does not know.
    rows(spark, ("x", 1.0, D3)).write.mode("append").partitionBy("process_date").parquet(path)
    assert partition_index.read(path) is None
    assert incremental.newest_partition(spark, path) == D3
    writing.write_enriched(rows(spark, ("y", 1.0, D1)), path)
    assert counted(path) == {str(D1): 1, str(D2): 2, str(D3): 1}


def test_many_files_are_counted_by_tasks(spark, path, monkeypatch):
    monkeypatch.setattr(partition_index, "_FEW_FILES", 1)
    before = partition_index.begin(path)
    partition_index.commit(spark, path, "process_date", before, [str(D1), str(D2), "2000-01-01"])
    assert counted(path) == {str(D1): 1, str(D2): 2}


def test_a_row_without_a_date_is_refused_when_nothing_else_arrives(spark, path):
    with pytest.raises(Exception, match="NOT NULL violated"):
        merging.publish_across_days(spark, rows(spark, ("n", 1.0, None)), path, now())


# Planned moves


def crash(monkeypatch, name):
    def lost(*args, **kwargs):
        raise OSError("lost")

    monkeypatch.setattr(merging.writing, name, lost)


def test_a_failed_write_leaves_its_dates_and_the_next_run_clears_the_record(spark, path, monkeypatch):
    before = brief(table(spark, path))
    with monkeypatch.context() as m:
        crash(m, "write_enriched")
        with pytest.raises(OSError):
            merging.publish_across_days(spark, rows(spark, ("a", 10.0, D2)), path, now())
    assert os.path.exists(merging._moves_path(path)) and os.path.exists(merging._pending_path(path))
    merging.publish_across_days(spark, rows(spark), path, now())
    assert brief(table(spark, path)) == before
    assert not os.path.exists(merging._moves_path(path)) and not os.path.exists(merging._pending_path(path))


def test_a_key_that_was_under_both_dates_before_is_no_sign_of_a_write(spark, tmp_path, monkeypatch):
    """The record has the stamp of the run, so older copies of a key do not count as moved."""
    path = str(tmp_path / "copies")
    writing.write_enriched(rows(spark, ("a", 1.0, D1), ("a", 2.0, D2)), path)
    before = brief(table(spark, path))
    with monkeypatch.context() as m:
        crash(m, "write_enriched")
        with pytest.raises(OSError):
            merging.publish_across_days(spark, rows(spark, ("a", 10.0, D2)), path, now())
    merging.finish_drops(spark, path)
    assert brief(table(spark, path)) == before


def test_failed_drops_are_made_good_from_recorded_dates_alone(spark, path, monkeypatch, plan):
    writing.write_enriched(rows(spark, ("old", 1.0, dt.date(2020, 1, 1))), path)
    with monkeypatch.context() as m:
        crash(m, "drop_partitions")
        with pytest.raises(OSError):
            merging.publish_across_days(spark, rows(spark, ("a", 10.0, D2)), path, now())
    moves = spark.read.schema(merging.MOVES).parquet(merging._moves_path(path))
    assert [tuple(r)[:3] for r in moves.collect()] == [("a", D1, D2)]
    text = plan(merging.not_moved(table(spark, path), moves, "order_id"))
    target = next(line for line in text.splitlines() if "process_date" in line and "PartitionFilters" in line)
    assert str(D2) in target and "2020" not in target and str(D1) not in target
    merging.finish_drops(spark, path)
    assert sorted(counted(path)) == ["2020-01-01", str(D2)]
    assert table(spark, path).where(F.col("order_id") == "a").count() == 1


def test_without_a_clock_all_jobs_of_a_run_use_one_stamp(spark, path):
    merging.publish_across_days(spark, rows(spark, ("a", 10.0, D2), ("z", 1.0, D3)), path)
    stamps = table(spark, path).where("order_id IN ('a', 'z')").select("updated_at").distinct()
    assert stamps.count() == 1 and str(D1) not in counted(path)
    assert read_files(spark, [path], schemas.ENRICHED).count() == 4
