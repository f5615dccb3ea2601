import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ordermill.__main__ import _parser
from ordermill.operators import quality
from ordermill.plans import jobs
from ordermill.session import remove_work, work_folder
from ordermill.settings import Locations, Settings, Thresholds
from ordermill.sources import listing, synthetic, tables

DAY = "2026-03-19"
ROOT = Path(__file__).resolve().parents[1]


def test_orders_do_not_depend_on_partitioning(spark):
    one = synthetic.synth_orders(synthetic.row_numbers(spark, 20_000, 1))
    many = synthetic.synth_orders(synthetic.row_numbers(spark, 20_000, 13))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    stats = one.agg(
        F.count_if(F.col("user_id").isNull()).alias("nulls"),
        F.count_if(F.col("amount") < 0).alias("negative"),
        F.count_distinct("order_id").alias("ids"), F.max("amount").alias("high"),
        F.min("created_at").alias("early"), F.max("created_at").alias("late"),
    ).first()
    assert 50 < stats["nulls"] < 160 and stats["negative"] == 2 and stats["ids"] == 20_000
    assert stats["high"] <= 500.0
    assert "2026-03-12T00:00:00" <= stats["early"] and stats["late"] < "2026-03-19"
    other = synthetic.synth_orders(synthetic.row_numbers(spark, 5), synthetic.SynthPlan(seed=7))
    assert other.join(one, "order_id").count() == 0


def test_repeated_events_follow_the_row_before(spark, monkeypatch):
    monkeypatch.setattr(synthetic, "EVENT_BLOCK", 3_000)
    events = synthetic.synth_events(synthetic.row_numbers(spark, 20_000, 8))
    repeats = events.groupBy("event_id").count().where("count > 1")
    extra = repeats.agg(F.sum(F.col("count") - 1)).first()[0]
    assert 120 < extra < 290
    sample = events.join(repeats, "event_id").groupBy("event_id").agg(
        F.count_distinct("session_id").alias("sessions"), F.max("count").alias("n")
    )
    assert sample.where("sessions <> n").isEmpty()


@pytest.mark.parametrize("population, sample", [(10_000, 1_000), (997, 997), (12, 5), (1, 1)])
def test_sample_has_exactly_the_asked_size(spark, population, sample):
    users = synthetic.row_numbers(spark, population)
    taken = synthetic.synth_segments(users, population, sample)
    assert taken.count() == sample == taken.select("user_id").distinct().count()


def session_like(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else None),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_work_folder_follows_the_session():
    assert work_folder(session_like("hdfs:///shared/", "yarn"), "x").startswith(
        "hdfs:///shared/ordermill-app-1/x-"
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(session_like(None, "yarn"), "x")


@pytest.fixture
def at(spark, tmp_path):
    locations = Locations.under(str(tmp_path))
    jobs.make_samples(spark, locations, orders=12_000, events=8_000, segments=1_000)
    return locations


def test_a_whole_day_twice(spark, at):
    jobs.daily(spark, at, DAY)
    production = tables.read_partitions(spark, at.production, DAY, DAY)
    first = production.drop("created_at", "updated_at").collect()
    rows = len(first)
    assert 11_800 < rows < 12_000
    assert listing.list_files(spark, at.raw).count() == 0
    assert tables.read_table(spark, at.metrics, "completeness_status string").first()[0] == "✅ MATCH"
    checks = {r["check"]: r["status"] for r in jobs.check(spark, at, DAY).collect()}
    assert set(checks.values()) == {"PASS"}

    jobs.daily(spark, at, DAY)
    again = tables.read_partitions(spark, at.production, DAY, DAY)
    assert sorted(map(str, again.drop("created_at", "updated_at").collect())) == sorted(map(str, first))

    outcome = jobs.publish(spark, at, DAY).first()
    assert outcome["staging_rows"] == outcome["production_rows"] == rows

    assert jobs.publish_changes(spark, at, Settings(watermark_default="2020-01-01 00:00:00")) == rows
    assert jobs.publish_changes(spark, at, Settings()) == 0
    assert jobs.test_columns(spark, at, DAY, DAY).where("failures > 0").isEmpty()

    # Of the raw days only the emptied folders are left.
    assert {r["zone"] for r in jobs.expire(spark, at, "2026-07-01").collect()} == {"raw"}
    assert jobs.expire(spark, at, "2026-07-01").count() == 0


def test_failed_gate_stops_before_the_day_is_published(spark, at):
    jobs.validate(spark, at)
    with pytest.raises(quality.GateFailed, match="empty"):
        jobs.enrich(spark, at, DAY, Settings(thresholds=Thresholds(min_row_count=10**6)))
    for path in (at.staging, at.processed):
        assert tables.read_table(spark, path, "order_id string") is None


def test_a_day_of_invalid_orders_leaves_the_published_day_alone(spark, at):
    jobs.validate(spark, at)
    jobs.enrich(spark, at, DAY)
    before = tables.read_partitions(spark, at.processed, DAY, DAY).count()
    folder = f"{at.validated}/source=orders/dt={DAY}"
    bad = tables.read_landed(spark, at.validated, "orders", DAY).withColumn("amount", F.lit(-1.0))
    kept = work_folder(spark, "bad")
    bad.write.parquet(kept)
    spark.read.parquet(kept).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
    with pytest.raises(quality.GateFailed, match="empty"):
        jobs.enrich(spark, at, DAY)
    assert tables.read_partitions(spark, at.processed, DAY, DAY).count() == before > 0


def test_two_snapshots_leave_one(spark, at):
    jobs.validate(spark, at)
    users = tables.read_latest(spark, at.validated).count()
    jobs.make_samples(spark, at, orders=10, events=10, segments=1_000)
    jobs.validate(spark, at)
    latest = tables.read_latest(spark, at.validated)
    assert latest.count() == users == latest.select("user_id").distinct().count()


def test_repeats_reach_across_blocks(spark):
    rows = synthetic.row_numbers(spark, 400)
    whole = synthetic.synth_events(rows, block_rows=10**6).orderBy("session_id", "timestamp")
    cut = synthetic.synth_events(rows, block_rows=7).orderBy("session_id", "timestamp")
    assert whole.collect() == cut.collect()
    assert whole.select("event_id").distinct().count() < 400


def test_work_folders_are_removed(spark):
    folder = work_folder(spark, "x")
    spark.range(3).write.parquet(folder)
    remove_work(spark, folder)
    assert not os.path.exists(folder)
    with pytest.raises(ValueError):
        remove_work(spark, "/elsewhere")


def test_entry_and_tasks_work_from_another_folder(tmp_path):
    """The package reaches the Python of the tasks although only the driver can import it."""
    code = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('rows', e.queries()['file_inventory'](spark, '/root/testdata/sf0.001').count())\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]


def test_transfer_takes_new_files_only(spark, at, tmp_path):
    other = Locations.under(str(tmp_path / "other"))
    files = listing.list_files(spark, at.raw).count()
    assert jobs.transfer(spark, at.raw, other) == files
    assert jobs.transfer(spark, at.raw, other) == 0
    assert listing.list_files(spark, other.raw).count() == files
    assert listing.list_files(spark, at.raw).count() == files


def test_old_raw_days_expire(spark, at):
    dropped = jobs.expire(spark, at, "2026-07-01")
    assert sorted(r["folder"] for r in dropped.collect()) == [
        f"source=events/dt={DAY}", f"source=orders/dt={DAY}"
    ]
    assert listing.list_files(spark, at.raw).where("file_name like '%dt=%'").isEmpty()


def test_command_line_names_every_job():
    args = _parser().parse_args(["daily", "--root", "/x", "--date", DAY])
    assert args.job == "daily" and args.event_types == "list"
