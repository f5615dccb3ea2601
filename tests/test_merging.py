import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import merging, quality, writing
from ordermill.sources.listing import partition_dates
from ordermill.sources.tables import read_files, read_partitions, read_table

D1, D2, D3 = dt.date(2026, 3, 18), dt.date(2026, 3, 19), dt.date(2026, 3, 20)
OLD, NOW = "2026-01-01 00:00:00", "2026-03-21 00:00:00"


def rows(spark, *entries, stamp=OLD):
    """Enriched rows from (order_id, amount, process_date)."""
    data = [(o, a, d) for o, a, d in entries]
    df = spark.createDataFrame(data, "order_id string, amount double, process_date date")
    at = F.lit(stamp).cast("timestamp")
    columns = []
    for f in schemas.ENRICHED.fields:
        if f.name in df.columns:
            columns.append(F.col(f.name))
        elif f.name in ("created_at", "updated_at"):
            columns.append(at.alias(f.name))
        elif f.name == "currency":
            columns.append(F.lit("USD").alias(f.name))
        else:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*columns)


def brief(df):
    return sorted(
        (r["order_id"], r["amount"], r["process_date"], str(r["created_at"])[:10], str(r["updated_at"])[:10])
        for r in df.collect()
    )


def now():
    return F.lit(NOW).cast("timestamp")


@pytest.fixture
def target_path(spark, tmp_path):
    path = str(tmp_path / "production")
    writing.write_enriched(rows(spark, ("a", 1.0, D1), ("b", 2.0, D2), ("c", 3.0, D2)), path)
    return path


def table(spark, path):
    return read_files(spark, [path], schemas.ENRICHED)


def test_matched_rows_update_and_others_insert(spark):
    target = rows(spark, ("a", 1.0, D2), ("b", 2.0, D2))
    source = rows(spark, ("b", 20.0, D2), ("c", 30.0, D2), stamp="2026-02-02 00:00:00")
    merged = merging.merge_rows(target, source, ["order_id"], now())
    assert brief(merged) == [
        ("a", 1.0, D2, "2026-01-01", "2026-01-01"),
        ("b", 20.0, D2, "2026-01-01", "2026-03-21"),
        ("c", 30.0, D2, "2026-03-21", "2026-03-21"),
    ]
    assert merged.columns == schemas.ENRICHED_COLUMNS


def test_copies_and_null_keys_in_the_target_stay(spark):
    target = rows(spark, ("a", 1.0, D2), ("a", 2.0, D2), (None, 3.0, D2), (None, 4.0, D2))
    source = rows(spark, ("a", 9.0, D2), (None, 5.0, D2))
    merged = merging.merge_rows(target, source, ["order_id"], now())
    assert sorted(r["amount"] for r in merged.collect()) == [3.0, 4.0, 5.0, 9.0, 9.0]


def test_hot_target_key_against_large_source(spark, conf, plan, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    n = F.col("id")
    path = str(tmp_path / "t")
    spark.range(0, 40_000, 1, 16).select(
        F.when(n % 10 > 0, "hot").otherwise(n.cast("string")).alias("order_id"),
        F.sha2(n.cast("string"), 256).alias("status"), n.cast("double").alias("amount"),
    ).write.parquet(path)
    target = spark.read.parquet(path)
    target.select("order_id").distinct().select(
        "order_id", F.lit("s").alias("status"), F.lit(0.0).alias("amount")
    ).write.parquet(f"{path}-source")
    source = spark.read.parquet(f"{path}-source")
    merged = merging.merge_rows(target, source, ["order_id"], now())
    assert "SortMergeJoin(skew=true)" in plan(merged)
    assert merged.where("status = 's' and amount = 0").count() == 40_000


def test_publish_writes_one_date_only(spark, target_path):
    staged = rows(spark, ("b", 20.0, D3), ("d", 4.0, D1))
    merging.publish_day(spark, staged, target_path, D2, now())
    assert brief(table(spark, target_path)) == [
        ("a", 1.0, D1, "2026-01-01", "2026-01-01"),
        ("b", 20.0, D2, "2026-01-01", "2026-03-21"),
        ("c", 3.0, D2, "2026-01-01", "2026-01-01"),
        ("d", 4.0, D2, "2026-03-21", "2026-03-21"),
    ]


def test_publish_twice_is_publish_once(spark, target_path):
    staged = rows(spark, ("b", 20.0, D2), ("d", 4.0, D2))
    merging.publish_day(spark, staged, target_path, D2, now())
    once = brief(table(spark, target_path))
    merging.publish_day(spark, staged, target_path, D2, now())
    assert brief(table(spark, target_path)) == once


def test_first_publish_creates_the_table(spark, tmp_path):
    path = str(tmp_path / "new")
    assert read_table(spark, path, schemas.ENRICHED) is None
    merging.publish_day(spark, rows(spark, ("a", 1.0, D2)), path, D2, now())
    assert brief(table(spark, path)) == [("a", 1.0, D2, "2026-03-21", "2026-03-21")]


@pytest.mark.parametrize(
    "entries, message",
    [
        ([], "ABORT: Staging table is empty!"),
        ([("a", 1.0, D2), (None, 2.0, D2)], "ABORT: Found 1 null order_ids in staging"),
        ([("a", 1.0, D2), ("a", 2.0, D2)], "ABORT: Found 1 rows beyond the first"),
    ],
)
def test_bad_staging_is_refused_and_the_target_left_alone(spark, target_path, entries, message):
    before = brief(table(spark, target_path))
    with pytest.raises(quality.GateFailed, match=message):
        merging.publish_day(spark, rows(spark, *entries), target_path, D2, now())
    assert brief(table(spark, target_path)) == before


def test_rows_move_between_dates_and_empty_dates_vanish(spark, target_path):
    source = rows(spark, ("a", 10.0, D2), ("e", 5.0, D3))
    merging.publish_across_days(spark, source, target_path, now())
    expected = [
        ("a", 10.0, D2, "2026-03-21", "2026-03-21"),
        ("b", 2.0, D2, "2026-01-01", "2026-01-01"),
        ("c", 3.0, D2, "2026-01-01", "2026-01-01"),
        ("e", 5.0, D3, "2026-03-21", "2026-03-21"),
    ]
    assert brief(table(spark, target_path)) == expected
    merging.publish_across_days(spark, source, target_path, now())
    assert brief(table(spark, target_path)) == expected
    assert partition_dates(spark, target_path) == [D3, D2]


def test_a_run_that_failed_before_its_drops_is_repaired(spark, target_path, monkeypatch):
    source = rows(spark, ("a", 10.0, D2))
    with monkeypatch.context() as m:
        calls = []
        real = merging.finish_drops

        def once(*args):
            calls.append(args)
            if len(calls) > 1:
                raise OSError("lost between write and drop")
            return real(*args)

        m.setattr(merging, "finish_drops", once)
        with pytest.raises(OSError):
            merging.publish_across_days(spark, source, target_path, now())
    assert [r[0] for r in brief(table(spark, target_path))].count("a") == 2
    merging.publish_across_days(spark, rows(spark), target_path, now())
    assert [r[0] for r in brief(table(spark, target_path))] == ["a", "b", "c"]
    assert partition_dates(spark, target_path) == [D2]


def test_a_run_that_failed_before_its_write_keeps_the_date(spark, target_path):
    record = spark.createDataFrame([(D1,)], merging.PENDING)
    record.write.parquet(f"{target_path}_pending_drops")
    before = brief(table(spark, target_path))
    merging.finish_drops(spark, target_path)
    assert brief(table(spark, target_path)) == before


def test_touched_dates_filter_the_target_by_a_semi_join(spark, target_path, plan):
    text = plan(merging.touched_dates(table(spark, target_path), rows(spark, ("a", 1.0, D2))))
    assert "LeftSemi" in text and "LeftOuter" not in text and "ReadSchema: struct<order_id:string>" in text


def test_nothing_new_changes_nothing(spark, target_path):
    before = brief(table(spark, target_path))
    merging.publish_across_days(spark, rows(spark), target_path, now())
    assert brief(table(spark, target_path)) == before


def test_change_classes_compare_nulls_safely(spark):
    schema = "order_id string, row_hash string"
    target = spark.createDataFrame([("a", "1"), ("b", None), ("c", None), ("x", "9")], schema)
    source = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3"), ("d", "4")], schema)
    classes = merging.change_classes(target, source).collect()
    assert dict(classes) == {"a": "same", "b": "same", "c": "changed", "d": "new"}


def test_verify_reports_both_counts(spark):
    staged, produced = rows(spark, ("a", 1.0, D2), ("b", 1.0, D2)), rows(spark, ("a", 1.0, D2))
    row = merging.verify_merge(staged, produced).first()
    assert (row["staging_rows"], row["production_rows"]) == (2, 1) and "MISMATCH" in row["status"]
    assert "SUCCESSFUL" in merging.verify_merge(produced, staged).first()["status"]
    assert tuple(merging.verify_merge(rows(spark), rows(spark)).first())[:2] == (0, 0)


def test_only_the_asked_date_is_read(spark, target_path, plan):
    text = plan(read_partitions(spark, target_path, D2, D2))
    assert "PartitionFilters: [isnotnull(process_date" in text
    assert table(spark, target_path).where(F.col("process_date") == D2).count() == 2
