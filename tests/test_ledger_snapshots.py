import os

import pytest
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import landing, ledger, quality, writing
from ordermill.sources import listing, synthetic, tables, versions
from tests.test_landing import DAY, ORDER, put
from tests.test_merging import D1, D2, D3, rows


# Ledger


def entries(spark, run, n=40):
    df = spark.range(n).select(F.concat(F.lit("f"), F.col("id")).alias("file_name"))
    return df.select(
        "file_name", F.lit(f"2026-01-{run + 1:02d}").cast("timestamp").alias("processed_at"), F.lit(f"run {run}").alias("status")
    )


def folders(path):
    return [f for bucket in ledger.manifest(path)["buckets"].values() for f in bucket]


def test_reading_the_ledger_does_not_grow_with_the_number_of_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MAX_RUNS", 3)
    monkeypatch.setattr(ledger, "BUCKETS", 4)
    path, sizes = str(tmp_path / "ledger"), []
    for run in range(9):
        landing.append_ledger(entries(spark, run), path)
        sizes.append(len(folders(path)))
        newest = landing.latest_entries(landing.read_ledger(spark, path)).collect()
        assert len(newest) == 40 and {r["status"] for r in newest} == {f"run {run}"}
    assert max(sizes) <= 4 * 3 and landing.read_ledger(spark, path).count() <= 40 * 3
    # What two compactions ago was replaced is gone.
    kept = {f.partition("/")[0] for f in folders(path) + ledger.manifest(path)["replaced"]}
    assert {n for n in os.listdir(path) if os.listdir(f"{path}/{n}") != ["_SUCCESS"]} >= kept


def test_a_reader_of_the_old_manifest_is_not_disturbed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MAX_RUNS", 2)
    path = str(tmp_path / "ledger")
    for run in range(2):
        landing.append_ledger(entries(spark, run), path)
    before = landing.read_ledger(spark, path)
    landing.append_ledger(entries(spark, 2), path)
    assert len(folders(path)) <= ledger.BUCKETS
    assert before.count() == 80 and landing.read_ledger(spark, path).count() == 40


def test_a_ledger_of_plain_files_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "ledger")
    entries(spark, 0).write.parquet(path)
    assert landing.read_ledger(spark, path).count() == 40
    landing.append_ledger(entries(spark, 1, n=41), path)
    newest = {r["file_name"]: r["status"] for r in landing.read_ledger(spark, path).collect()}
    assert len(newest) == 41 and set(newest.values()) == {"run 1"}


def test_an_empty_run_leaves_a_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    landing.append_ledger(entries(spark, 0, n=0), path)
    assert landing.read_ledger(spark, path).count() == 0


def test_versions_keep_the_one_before(tmp_path):
    folder = str(tmp_path / "v")
    assert versions.latest(folder) is None
    for n in range(4):
        versions.put(folder, {"n": n})
        assert versions.latest(folder) == {"n": n}
    assert len(os.listdir(folder)) == 2


# Twins and snapshots


def test_twins_are_told_by_content_not_by_name(spark, tmp_path):
    """Part files of different writers are not each other's twins; renamed copies are."""
    root = str(tmp_path / "v")
    other = {**ORDER, "order_id": ["8", "9"]}
    put(root, f"source=orders/{DAY}/part-0-a.parquet", ORDER)
    put(root, f"source=orders/{DAY}/part-0-b.csv", other, "csv")
    put(root, f"source=orders/{DAY}/copy.csv", ORDER, "csv")
    got = tables.read_day(spark, root, "orders", "2026-03-19").collect()
    assert sorted(r["order_id"] for r in got) == ["1", "2", "8", "9"]


def test_a_changed_copy_is_no_twin(spark, tmp_path):
    root = str(tmp_path / "v")
    put(root, f"source=orders/{DAY}/orders.parquet", ORDER)
    put(root, f"source=orders/{DAY}/orders.csv", {**ORDER, "amount": [1.0, 3.0]}, "csv")
    got = tables.read_day(spark, root, "orders", "2026-03-19").collect()
    assert sorted(r["amount"] for r in got) == [1.0, 1.0, 2.0, 3.0]


def test_rows_dealt_otherwise_over_files_are_twins_too(spark, tmp_path):
    root = str(tmp_path / "v")
    folder = tables.landed_folder(root, "orders", "2026-03-19")
    frame = spark.range(100).select(
        F.col("id").cast("string").alias("order_id"), F.lit("u v").alias("user_id"), (F.col("id") / 8).alias("amount"),
        F.lit("USD").alias("currency"), F.lit("2026-03-19").alias("process_date"),
    )
    frame.repartition(2).write.parquet(folder)
    frame.repartition(5).write.mode("append").option("header", True).csv(folder)
    assert tables.read_day(spark, root, "orders", "2026-03-19").count() == 100


def test_a_snapshot_comes_in_any_format_and_changes_at_once(spark, tmp_path):
    root = str(tmp_path / "v")
    put(root, "source=user_segments/latest/a.parquet", {"user_id": ["u"], "segment": ["old"]})
    put(root, "source=user_segments/latest/b.csv", {"segment": ["new", "new"], "user_id": ["u", "v"]}, "csv")
    everything = tables.read_latest(spark, root)
    assert everything.schema == schemas.SEGMENTS and everything.count() == 3
    tables.set_snapshot(root, "user_segments", ["source=user_segments/latest/a.parquet"])
    assert [r["segment"] for r in tables.read_latest(spark, root).collect()] == ["old"]
    tables.set_snapshot(root, "user_segments", ["source=user_segments/latest/b.csv"])
    assert sorted(r["user_id"] for r in tables.read_latest(spark, root).collect()) == ["u", "v"]
    # A record of files that have gone is not followed.
    tables.set_snapshot(root, "user_segments", ["source=user_segments/latest/gone.parquet"])
    assert tables.read_latest(spark, root).count() == 3


def test_snapshots_of_validated_files(spark):
    judged = spark.createDataFrame(
        [("source=user_segments/latest/n.csv", "validated"), ("source=user_segments/latest/x.csv", "quarantine"),
         ("source=orders/dt=2026-03-19/o.parquet", "validated"), ("source=user_segments/latest/k.csv", None)],
        "file_name string, zone string")
    assert landing.new_snapshots(judged) == {"user_segments": ["source=user_segments/latest/n.csv"]}


# Drift


def test_drift_is_counted_per_day_and_file(spark, tmp_path):
    root = str(tmp_path / "raw")
    event = {"event_id": ["1"], "user_id": ["u"], "event_type": ["x"], "page_url": ["p"], "session_id": ["s"],
             "timestamp": ["t"], "process_date": ["d"]}
    lacking = {k: v for k, v in event.items() if k != "timestamp"}
    for n in range(3):
        put(root, f"source=events/dt=2026-01-01/{n}.parquet", event)
        put(root, f"source=events/dt=2026-01-02/{n}.parquet", lacking if n else event)
    put(root, "source=events/dt=2026-01-02/r.parquet", {**event, "user_id": [7], "more": [1]})
    put(root, "source=other/dt=2026-01-02/r.parquet", {"x": [7]})
    put(root, "source=events/dt=2026-01-02/bad.parquet", b"not parquet")
    files = listing.inspect_files(listing.list_files(spark, root), root, read_pages=False, count_csv_rows=False)
    drift = landing.drift_by_day(schemas.contract_frame(spark), landing.file_signatures(files)).collect()
    assert sorted((r["column_name"], r["change"], str(r["dt"]), r["files"], r["of_files"], r["is_breaking"]) for r in drift) == [
        ("more", "added", "2026-01-02", 1, 4, False),
        ("timestamp", "removed", "2026-01-02", 2, 4, True),
        ("user_id", "retyped", "2026-01-02", 1, 4, True),
    ]


# Checks apart


def kept(tmp_path):
    def keep(df):
        path = str(tmp_path / f"c{len(os.listdir(tmp_path))}")
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)

    return keep


def test_a_check_that_raises_or_lost_its_column_does_not_end_the_others(spark, tmp_path):
    df = rows(spark, ("a", 10.0, D1), ("b", 20.0, D2))
    checks = [
        quality.Check("rows", F.count(F.lit(1)), lambda v: v > 0),
        quality.Check("lost", F.sum("no_such_column"), lambda v: v > 0),
        quality.Check("raises", F.max(F.raise_error(F.lit("boom"))), lambda v: v > 0),
        quality.Check("sum", F.sum("amount"), lambda v: v > 15),
    ]
    got = {r["check"]: (r["value"], r["status"]) for r in quality.run_checks_apart(df, checks, kept(tmp_path)).collect()}
    assert got == {"rows": (2.0, "PASS"), "lost": (None, "ERROR"), "raises": (None, "ERROR"), "sum": (30.0, "PASS")}
    by_day = quality.run_checks_apart(df, checks, kept(tmp_path), ["process_date"]).collect()
    assert sorted((r["check"], str(r["process_date"]), r["status"]) for r in by_day if r["check"] in ("raises", "sum")) == [
        ("raises", str(D1), "ERROR"), ("raises", str(D2), "ERROR"), ("sum", str(D1), "FAIL"), ("sum", str(D2), "PASS"),
    ]


def test_all_checks_may_be_broken(spark):
    got = quality.run_checks(rows(spark, ("a", 1.0, D1)), [quality.Check("lost", F.sum("gone"), lambda v: v > 0)]).collect()
    assert [(r["check"], r["status"]) for r in got] == [("lost", "ERROR")]


# Guard


@pytest.fixture
def views(spark, tmp_path):
    path = str(tmp_path / "production")
    writing.write_enriched(rows(spark, ("a", 1.0, D1), ("b", 2.0, D2), ("c", 3.0, D3)), path)
    tables.register_views(spark, path, path)
    return path


@pytest.mark.parametrize("where", [
    "", "WHERE amount > 1", "WHERE year(process_date) = 2026", "WHERE process_date IS NOT NULL",
    "WHERE process_date <> DATE '2026-03-19'",
])
def test_sql_without_a_date_is_refused(spark, views, where):
    with pytest.raises(Exception, match="partitioned by process_date"):
        spark.sql(f"SELECT * FROM enriched_orders {where}").collect()
    with pytest.raises(Exception, match="partitioned by process_date"):
        spark.sql(f"SELECT count(*) FROM enriched_orders {where}").collect()


@pytest.mark.parametrize("where, found", [
    ("process_date = DATE '2026-03-19'", ["b"]), ("process_date >= DATE '2026-03-19' AND amount < 3", ["b"]),
    ("process_date IN (DATE '2026-03-18', DATE '2026-03-20')", ["a", "c"]), ("process_date < '2026-03-19'", ["a"]),
    ("process_date BETWEEN DATE '2026-03-18' AND DATE '2026-03-19'", ["a", "b"]), ("process_date = DATE '1999-01-01'", []),
])
def test_sql_with_a_date_is_pruned(spark, views, where, found, plan):
    df = spark.sql(f"SELECT order_id FROM enriched_orders WHERE {where}")
    assert sorted(r["order_id"] for r in df.collect()) == found
    scan = next(x for x in plan(df).splitlines() if "Scan parquet" in x or "FileScan" in x)
    filters = scan.partition("PartitionFilters: [")[2].partition("PushedFilters")[0]
    assert "process_date" in filters and ("2026-03-" in filters or "1999-01-01" in filters)
    assert "lifetime_value" not in scan


def test_the_guard_reads_folders_without_an_index(spark, tmp_path):
    path = str(tmp_path / "plain")
    rows(spark, ("a", 1.0, D1), ("b", 2.0, D2)).write.partitionBy("process_date").parquet(path)
    tables.register_views(spark, path, path)
    assert spark.sql(f"SELECT * FROM enriched_orders WHERE process_date = DATE '{D1}'").count() == 1
    columns = spark.sql(f"SELECT * FROM enriched_orders WHERE process_date = DATE '{D1}'").columns
    assert sorted(columns) == sorted(schemas.ENRICHED_COLUMNS)


# Prefix scan


def test_the_scan_carries_across_stretches_and_no_task_holds_all(spark, plan):
    r = [(b, None if b % 5 == 1 or 20 <= b < 60 else b * 10 + 3) for b in range(130)]
    blocks = spark.createDataFrame(r, "_block long, _last long")
    df = synthetic._largest_before(blocks, width=6, levels=3)
    want, seen = {}, None
    for b, last in r:
        want[b] = seen
        seen = last if last is not None else seen
    assert dict(map(tuple, df.collect())) == want
    assert "SinglePartition" not in plan(df)
    assert "SinglePartition" not in plan(synthetic.synth_events(synthetic.row_numbers(spark, 500), block_rows=50))
