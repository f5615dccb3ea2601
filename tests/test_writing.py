import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import writing
from ordermill.plans.inputs import Inputs
from ordermill.sources import tables
from ordermill.sources.listing import partition_dates
from test_merging import D1, D2, D3, rows


def test_overwrite_leaves_other_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    writing.write_enriched(rows(spark, ("a", 1.0, D1), ("b", 2.0, D2)), path)
    writing.write_enriched(rows(spark, ("c", 3.0, D2)), path)
    back = tables.read_files(spark, [path], schemas.ENRICHED)
    assert sorted((r["order_id"], r["process_date"]) for r in back.collect()) == [("a", D1), ("c", D2)]


def test_null_in_a_required_column_fails_and_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    writing.write_enriched(rows(spark, ("a", 1.0, D1)), path)
    for bad in ((None, 1.0, D1), ("b", None, D1), ("b", 1.0, None)):
        with pytest.raises(PySparkException, match="NOT NULL violated"):
            writing.write_enriched(rows(spark, bad), path)
    assert tables.read_files(spark, [path], schemas.ENRICHED).count() == 1


def one_day(spark, n=40_000):
    i = F.col("id")
    day = rows(spark, ("x", 1.0, D2)).drop("order_id", "user_id", "row_hash")
    ids = spark.range(0, n, 1, 8).select(
        F.sha2(i.cast("string"), 256).alias("order_id"),
        F.when(i % 3 > 0, "hot").otherwise((i % 900).cast("string")).alias("user_id"),
        F.sha2(i.cast("string"), 256).alias("row_hash"),
    )
    return ids.join(F.broadcast(day)).select(*schemas.ENRICHED_COLUMNS)


def test_one_date_is_written_by_many_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    path = str(tmp_path / "t")
    writing.write_enriched(one_day(spark), path)
    assert len(glob.glob(f"{path}/process_date=*/*.parquet")) > 4


def test_clustering_gives_disjoint_file_ranges_and_splits_a_hot_user(spark, tmp_path):
    path = str(tmp_path / "t")
    df = writing.cluster_by_range(writing.enforce_not_null(one_day(spark)), num_partitions=6)
    writing.overwrite_partitions(df, path)
    ranges = []
    for file in glob.glob(f"{path}/process_date=*/*.parquet"):
        t = pq.read_table(file, columns=["user_id", "order_id"]).to_pylist()
        keys = [(r["user_id"], r["order_id"]) for r in t]
        assert keys == sorted(keys)
        ranges.append((keys[0], keys[-1], len(keys)))
    ranges.sort()
    assert len(ranges) == 6 and max(n for _, _, n in ranges) < 20_000
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_scan_without_bounds_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    writing.write_enriched(rows(spark, ("a", 1.0, D1), ("b", 2.0, D2), ("c", 2.0, D3)), path)
    with pytest.raises(tables.PartitionFilterRequired):
        tables.read_partitions(spark, path)
    assert tables.read_partitions(spark, path, D2).count() == 2
    assert tables.read_partitions(spark, path, None, D1).count() == 1


def test_staging_is_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    writing.load_staging(rows(spark, ("a", 1.0, D1), ("b", 1.0, D1)), path)
    writing.load_staging(rows(spark, ("c", 1.0, D2)), path)
    assert writing.row_count(tables.read_files(spark, [path], schemas.ENRICHED)).first()[0] == 1


def test_csv_round_trip_and_snappy_twin(spark, tmp_path):
    path = str(tmp_path / "dual")
    schema = "order_id string, user_id string, amount double"
    df = spark.createDataFrame([("a", None, 1.5), ("b,c", "u", None)], schema)
    writing.write_csv_and_parquet(df, path)
    back = tables.read_csv(spark, f"{path}/csv", schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/parquet/*.parquet")]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert {g.column(0).compression for g in groups} == {"SNAPPY"}


def test_safe_date_and_column_order(spark):
    df = rows(spark, ("a", 1.0, D1)).withColumn("process_date", F.lit("not a date"))
    view = tables.staging_view(df)
    assert view.first()["process_date"] is None
    assert view.columns.index("row_hash") + 1 == view.columns.index("process_date")


def test_last_days(spark):
    df = rows(spark, ("a", 1.0, dt.date(2025, 12, 19)), ("b", 1.0, dt.date(2025, 12, 18)))
    kept = tables.last_days(df, F.lit("2026-03-19").cast("date"))
    assert [r["order_id"] for r in kept.collect()] == ["a"]


def test_dropping_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    writing.write_enriched(rows(spark, ("a", 1.0, D1), ("b", 2.0, D2)), path)
    for _ in range(2):
        writing.drop_partitions(spark, path, "process_date", [D1, D3])
    assert partition_dates(spark, path) == [D2]


def test_views_for_sql(spark, tmp_path):
    staging, production = str(tmp_path / "s"), str(tmp_path / "p")
    writing.load_staging(rows(spark, ("a", 1.0, D1)), staging)
    writing.write_enriched(rows(spark, ("a", 1.0, D1), ("b", 2.0, dt.date(2025, 1, 1))), production)
    names = tables.register_views(spark, staging, production, F.lit("2026-03-19").cast("date"))
    counts = [spark.sql(f"SELECT count(*) FROM {n}").first()[0] for n in names]
    assert counts == [1, 2, 1]


def test_stored_tables_are_moved_once_and_without_text(spark, tmp_path, monkeypatch):
    """Rows are laid out before the event types become text; production keeps the layout of staging."""
    moved = []

    def spread(df, *args, lay_out=writing.spread_by_partition):
        moved.append(df.columns)
        return lay_out(df, *args)

    monkeypatch.setattr(writing, "spread_by_partition", spread)
    day = "timestamp_ntz'1995-01-05 10:00:00' + make_interval(0, id % 4)"
    tables_of = {
        "orders": ["id o_orderkey", "id % 7 o_custkey", "elt(id % 3 + 1, 'F', 'O', 'P') o_orderstatus",
                   "id * 1.5D o_totalprice", f"{day} o_orderdate", "'1-URGENT' o_orderpriority"],
        "events": ["id event_id", f"{day} ts", "id % 5 user_id", "elt(id % 3 + 1, 'view', 'click', NULL) event_type",
                   "1D value", "'' props"],
        "customer": ["id c_custkey", "'' c_name", "cast(id % 2 AS int) c_nationkey", "id * 100D c_acctbal", "'s' c_mktsegment"],
        "nation": ["cast(id AS int) n_nationkey", "concat('n', id) n_name", "0 n_regionkey"],
    }
    for name, columns in tables_of.items():
        spark.range(1, 300).selectExpr(*columns).write.parquet(f"{tmp_path}/{name}.parquet")
    i = Inputs(spark, str(tmp_path))
    rows = sorted(map(str, i.production().collect()))
    assert len(moved) == 1 and not {"event_types", "row_hash"} & set(moved[0])
    assert rows == sorted(map(str, i._production().collect())) and len(rows) > 200
    staged = i.staging().select(*schemas.ENRICHED_COLUMNS)
    assert sorted(map(str, staged.collect())) == sorted(map(str, i.enriched().collect()))
    assert any("click,click" in r for r in rows)


@pytest.mark.parametrize("open_files", [1, 40])
def test_rows_written_in_place_stay_in_their_order(spark, tmp_path, monkeypatch, open_files):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    three = one_day(spark, 900).withColumn(
        "process_date", F.expr("date_add(process_date, cast(crc32(order_id) % 3 AS int))")
    )
    writing.write_enriched(three, first)
    table = tables.read_files(spark, [first], schemas.ENRICHED)
    monkeypatch.setattr(writing, "_OPEN_FILES", open_files)
    writing.write_in_place(table.coalesce(1), second)
    assert spark.conf.get(writing._WRITERS) == "0"
    assert len(glob.glob(f"{second}/process_date=*/*.parquet")) == 3
    back = tables.read_files(spark, [second], schemas.ENRICHED)
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))
    for file in glob.glob(f"{second}/process_date=*/*.parquet"):
        users = pq.read_table(file, columns=["user_id"], partitioning=None).column(0).to_pylist()
        assert users == sorted(users)
    with pytest.raises(PySparkException, match="NOT NULL violated"):
        writing.write_in_place(rows(spark, (None, 1.0, D1)), second)
