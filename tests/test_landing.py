import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import landing, retention
from ordermill.sources import listing, tables
from ordermill.streaming import new_files

ORDER = {"order_id": ["1", "2"], "user_id": ["u", "v"], "amount": [1.0, 2.0], "currency": ["USD", "EUR"],
         "process_date": ["2026-03-19", "2026-03-19"]}
DAY = "dt=2026-03-19"


def put(root, name, data, kind="parquet"):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if isinstance(data, bytes):
        with open(path, "wb") as f:
            f.write(data)
    elif kind == "csv":
        pd.DataFrame(data).to_csv(path, index=False)
    else:
        pd.DataFrame(data).to_parquet(path)


@pytest.fixture
def raw(tmp_path):
    root = str(tmp_path / "raw")
    lacking = {k: v for k, v in ORDER.items() if k not in ("amount", "currency")}
    put(root, f"source=orders/{DAY}/good.parquet", ORDER)
    put(root, f"source=orders/{DAY}/good.csv", ORDER, "csv")
    put(root, f"source=orders/{DAY}/extra.parquet", {**ORDER, "coupon": ["x", "y"]})
    put(root, f"source=orders/{DAY}/lacking.parquet", lacking)
    put(root, f"source=orders/{DAY}/lacking.csv", lacking, "csv")
    put(root, f"source=orders/{DAY}/empty.parquet", b"")
    put(root, f"source=orders/{DAY}/corrupt.parquet", b"this is not parquet")
    put(root, f"source=orders/{DAY}/notes.txt", b"hello")
    put(root, f"source=returns/{DAY}/r.parquet", {"x": [1]})
    put(root, f"source=returns/{DAY}/r.csv", {"x": [1]}, "csv")
    put(root, "source=user_segments/latest/s.parquet", {"user_id": ["u"], "segment": ["new"]})
    put(root, "loose.csv", {"x": [1]}, "csv")
    put(root, f"source=orders/{DAY}/known.parquet", b"")
    put(root, f"source=orders/{DAY}/_SUCCESS", b"")
    return root


@pytest.fixture
def ledger(spark):
    rows = [(f"source=orders/{DAY}/known.parquet", "quarantined:empty")]
    df = spark.createDataFrame(rows, "file_name string, status string")
    return df.select("file_name", F.lit("2026-01-01").cast("timestamp").alias("processed_at"), "status")


def test_listing_finds_every_file_at_any_depth(spark, raw):
    files = {r["file_name"]: r["length"] for r in listing.list_files(spark, raw).collect()}
    assert len(files) == 13
    assert files["loose.csv"] > 0 and files[f"source=orders/{DAY}/empty.parquet"] == 0


def test_judgement_of_each_kind_of_file(spark, raw, ledger):
    judged = {
        r["file_name"].rsplit("/", 1)[-1]: r
        for r in landing.validate(spark, raw, ledger, count_csv_rows=True)
        .where("file_name not like 'source=returns%'").collect()
    }
    said = {k: r["message"] for k, r in judged.items()}
    assert said["good.parquet"] == "Schema OK (2 rows, 5 columns)"
    assert said["extra.parquet"] == "Schema OK (2 rows, 6 columns)"
    assert said["good.csv"] == "Header OK (3 rows)"
    assert said["lacking.parquet"] == said["lacking.csv"] == (
        "Missing required columns: {'amount', 'currency'}"
    )
    assert said["corrupt.parquet"].startswith("Corrupt Parquet: ")
    assert said["notes.txt"] == "Unknown format (passed)"
    assert said["loose.csv"] == "No schema registered"
    assert judged["loose.csv"]["source"] is None
    status = {k: r["status"] for k, r in judged.items()}
    assert status["empty.parquet"] == "quarantined:empty"
    assert status["known.parquet"] == "skipped" and judged["known.parquet"]["zone"] is None
    assert judged["s.parquet"]["zone"] == "validated"
    assert judged["corrupt.parquet"]["zone"] == "quarantine"


def test_unregistered_sources_pass(spark, raw, ledger):
    rows = landing.validate(spark, raw, ledger).where("source = 'returns'").collect()
    assert {r["message"] for r in rows} == {
        "No schema registered (passed by default)", "No schema registered"
    }
    assert all(r["is_valid"] for r in rows)


def test_damaged_pages_show_only_when_pages_are_read(spark, tmp_path):
    root = str(tmp_path / "raw")
    name = f"source=orders/{DAY}/bad.parquet"
    put(root, name, {k: v * 5000 for k, v in ORDER.items()})
    with open(os.path.join(root, name), "r+b") as f:
        f.seek(4)
        f.write(b"\xff" * 400)
    empty = spark.createDataFrame([], schemas.LEDGER)
    quick = landing.validate(spark, root, empty, read_pages=False).first()
    assert quick["is_valid"] and quick["message"].startswith("Footer OK")
    deep = landing.validate(spark, root, empty).first()
    assert deep["status"].startswith("quarantined:Corrupt Parquet")


def test_summary_and_rate(spark, raw, ledger):
    judged = landing.validate(spark, raw, ledger)
    assert dict(landing.summarize(judged).collect()) == {
        "validated": 8, "quarantined": 4, "skipped": 1
    }
    rates = {r["source"]: r for r in landing.quarantine_rate(judged).collect()}
    assert rates["orders"]["rate"] == 0.5 and rates["orders"]["alert"]
    assert rates["returns"]["rate"] == 0.0 and not rates["returns"]["alert"]


def test_moving_may_run_twice(spark, raw, ledger, tmp_path):
    zones = {"validated": str(tmp_path / "v"), "quarantine": str(tmp_path / "q")}
    path = str(tmp_path / "judged")
    landing.validate(spark, raw, ledger).write.parquet(path)
    judged = spark.read.parquet(path)
    landing.move_files(judged, raw, zones, keep_raw=True).collect()
    for _ in range(2):
        landing.move_files(judged, raw, zones).collect()
    left = {r["file_name"] for r in listing.list_files(spark, raw).collect()}
    assert left == {f"source=orders/{DAY}/known.parquet"}
    assert listing.list_files(spark, zones["validated"]).count() == 8
    assert listing.list_files(spark, zones["quarantine"]).count() == 4
    orders = tables.read_landed(spark, zones["validated"], "orders", "2026-03-19")
    assert orders.count() == 4
    by_csv = tables.read_landed(spark, zones["validated"], "orders", "2026-03-19", "csv")
    assert sorted(r["amount"] for r in by_csv.collect()) == [1.0, 2.0]


def test_ledger_keeps_the_newest_entry(spark, tmp_path, ledger):
    path = str(tmp_path / "ledger")
    assert landing.read_ledger(spark, path).count() == 0
    landing.append_ledger(ledger, path)
    again = ledger.withColumns(
        {"processed_at": F.lit("2026-02-01").cast("timestamp"), "status": F.lit("validated")}
    )
    landing.append_ledger(again, path)
    latest = landing.latest_entries(landing.read_ledger(spark, path)).collect()
    assert [r["status"] for r in latest] == ["validated"]
    files = ledger.select("file_name")
    assert landing.pending(files, ledger).count() == 0
    assert landing.pending(files, ledger, retry_quarantined=True).count() == 1
    assert landing.pending(files, landing.read_ledger(spark, path), retry_quarantined=True).count() == 0


def test_a_target_of_the_same_size_is_replaced(spark, tmp_path):
    raw, zone = tmp_path / "raw", tmp_path / "v"
    for folder, text in ((raw, "NEW,2"), (zone, "OLD,1")):
        folder.mkdir()
        (folder / "a.csv").write_text(text)
    routed = spark.createDataFrame([("a.csv", "v", 5)], "file_name string, zone string, length bigint")
    landing.move_files(routed, str(raw), {"v": str(zone)}).collect()
    assert (zone / "a.csv").read_text() == "NEW,2"
    assert not list(raw.iterdir()) and [p.name for p in zone.iterdir()] == ["a.csv"]


def test_only_unfinished_files_and_markers_are_left_out(spark, tmp_path):
    kept = ["_orders.csv", ".hidden.csv", "a/_b/c.txt", "a/b/c/d/e/f.txt"]
    out = ["_SUCCESS", "dt=1/_temporary/0/part-0.parquet", "x.csv.abc.inprogress", ".x.csv.crc", "_started_1"]
    for name in kept + out:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
    assert sorted(r["file_name"] for r in listing.list_files(spark, str(tmp_path)).collect()) == sorted(kept)


def test_days_landed_as_csv_are_read_and_twins_are_not_read_twice(spark, tmp_path):
    root = str(tmp_path / "v")
    put(root, "source=orders/dt=2026-03-18/orders.csv", ORDER, "csv")
    put(root, f"source=orders/{DAY}/orders.parquet", ORDER)
    put(root, f"source=orders/{DAY}/orders.csv", ORDER, "csv")
    put(root, f"source=orders/{DAY}/late.csv", {**ORDER, "extra": ["1", "2"]}, "csv")
    put(root, f"source=orders/{DAY}/empty.csv", b"")
    assert tables.read_day(spark, root, "orders", "2026-03-18").count() == 2
    both = tables.read_day(spark, root, "orders", "2026-03-19")
    assert both.schema == tables.read_landed(spark, root, "orders", "2026-03-19").schema
    assert sorted(r["amount"] for r in both.collect()) == sorted(2 * ORDER["amount"])


def test_a_new_snapshot_replaces_the_old_one(spark, tmp_path):
    files = spark.createDataFrame(
        [("source=user_segments/latest/old.parquet",), ("source=user_segments/latest/new.parquet",),
         ("source=other/latest/x.parquet",), ("source=orders/dt=2026-03-19/o.parquet",)], "file_name string")
    moved = spark.createDataFrame([("source=user_segments/latest/new.parquet", "validated")], "file_name string, zone string")
    found = landing.outdated_snapshots(files, moved).collect()
    assert [tuple(r) for r in found] == [("validated", "source=user_segments/latest/old.parquet")]


def test_drift_of_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    put(root, f"source=orders/{DAY}/o.parquet", {**ORDER, "amount": ["1", "2"], "tax": [0.1, 0.2]})
    put(root, f"source=events/{DAY}/e.csv", {"event_id": ["1"], "kind": ["x"]}, "csv")
    files = listing.inspect_files(listing.list_files(spark, root), root)
    drift = landing.schema_drift(schemas.contract_frame(spark), landing.file_columns(files))
    found = {(r["source"], r["column_name"]): r["change"] for r in drift.collect()}
    assert found[("orders", "amount")] == "retyped" and found[("orders", "tax")] == "added"
    assert found[("events", "kind")] == "added" and found[("events", "user_id")] == "removed"
    assert ("events", "event_id") not in found
    assert not any(source == "user_segments" for source, _ in found)


@pytest.mark.parametrize(
    "name, source",
    [
        ("source=orders/dt=2026-03-19/o.parquet", "orders"),
        ("raw/source=a/source=b/x", "a"),
        ("mysource=orders/x", None),
        ("source=/x", None),
        ("x.csv", None),
    ],
)
def test_source_of_a_path(spark, name, source):
    df = spark.createDataFrame([(name,)], "file_name string")
    assert landing.with_source(df).first()["source"] == source


def test_drift_classes(spark):
    contract = schemas.contract_frame(spark).where("source = 'user_segments'")
    actual = spark.createDataFrame(
        [("user_segments", "user_id", "bigint"), ("user_segments", "segment", "string"),
         ("user_segments", "lifetime_value", "double"), ("user_segments", "country", "string"),
         ("user_segments", "tier", "string")],
        "source string, column_name string, data_type string",
    )
    found = {r["column_name"]: (r["change"], r["is_breaking"]) for r in
             landing.schema_drift(contract, actual).collect()}
    assert found == {
        "user_id": ("retyped", True), "signup_date": ("removed", True), "tier": ("added", False)
    }


def test_expiry_drops_old_folders_only(spark, tmp_path):
    root = str(tmp_path / "raw")
    put(root, "source=orders/dt=2025-12-01/a.parquet", ORDER)
    put(root, "source=orders/dt=2026-03-01/a.parquet", ORDER)
    put(root, "source=user_segments/latest/s.parquet", ORDER)
    found = landing.with_day(listing.list_files(spark, root)).select(
        F.lit("raw").alias("zone"),
        F.regexp_extract("file_name", r"^(.*/dt=[^/]*)/", 1).alias("folder"), "dt",
    )
    expired = retention.expired_partitions(found, F.lit("2026-03-19").cast("date"))
    for _ in range(2):
        retention.drop_folders(expired, {"raw": root}).collect()
    left = {r["file_name"] for r in listing.list_files(spark, root).collect()}
    assert left == {"source=orders/dt=2026-03-01/a.parquet", "source=user_segments/latest/s.parquet"}


def test_stream_reads_each_file_once(spark, tmp_path):
    root, target, state = (str(tmp_path / n) for n in ("raw", "out", "state"))

    def run():
        rows = new_files.new_files(spark, root, "orders", max_files_per_batch=1)
        new_files.append_new_files(rows, target, state).awaitTermination()
        return spark.read.parquet(target).count()

    put(root, f"source=orders/{DAY}/a.parquet", ORDER)
    assert run() == 2
    assert run() == 2
    put(root, f"source=orders/{DAY}/b.parquet", ORDER)
    put(root, "source=orders/dt=2026-03-20/c.parquet", ORDER)
    assert run() == 6
