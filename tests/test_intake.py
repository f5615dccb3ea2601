import pytest
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.operators import landing
from ordermill.streaming import intake
from tests.test_landing import DAY, ORDER, put


@pytest.fixture
def at(tmp_path):
    return {n: str(tmp_path / n) for n in ("raw", "target", "state", "ledger")}


def run(spark, at):
    intake.take_in(spark, at["raw"], "orders", at["target"], at["state"], at["ledger"], lambda df: df.where("amount > 0"))
    like = spark.createDataFrame([], schemas.ORDERS)
    return sorted(r["order_id"] for r in intake.taken(spark, at["target"], at["state"], like).collect())


def ledger(spark, at):
    entries = landing.latest_entries(landing.read_ledger(spark, at["ledger"])).collect()
    return {r["file_name"].rpartition("/")[2]: r["status"].partition(":")[0] for r in entries}


def order(*ids):
    return {**{k: v[:1] * len(ids) for k, v in ORDER.items()}, "order_id": list(ids)}


def test_new_files_are_judged_recorded_and_read_once(spark, at):
    put(at["raw"], f"source=orders/{DAY}/a.parquet", order("1", "2"))
    put(at["raw"], f"source=orders/{DAY}/bad.parquet", b"not parquet")
    put(at["raw"], f"source=orders/{DAY}/lacking.csv", {"order_id": ["9"]}, "csv")
    assert run(spark, at) == ["1", "2"]
    assert ledger(spark, at) == {"a.parquet": "validated", "bad.parquet": "quarantined", "lacking.csv": "quarantined"}
    assert run(spark, at) == ["1", "2"]
    put(at["raw"], "source=orders/dt=2026-03-20/b.csv", order("3"), "csv")
    put(at["raw"], "source=orders/dt=2026-03-20/c.parquet", {**order("4", "5"), "amount": [-1.0, 1.0]})
    assert run(spark, at) == ["1", "2", "3", "5"]
    assert len(ledger(spark, at)) == 5


def test_files_the_ledger_knows_are_left_alone(spark, at):
    put(at["raw"], f"source=orders/{DAY}/a.parquet", order("1"))
    put(at["raw"], f"source=orders/{DAY}/b.parquet", order("2"))
    known = spark.createDataFrame([(f"source=orders/{DAY}/a.parquet", "validated")], "file_name string, status string")
    landing.append_ledger(known.withColumn("processed_at", F.current_timestamp()), at["ledger"])
    assert run(spark, at) == ["2"]


@pytest.mark.parametrize("lost", ["put", "_record"])
def test_a_run_that_fails_is_made_good_by_the_next(spark, at, monkeypatch, lost):
    """Before the manifest changes nothing of a run counts; after it only its verdicts are missing."""
    put(at["raw"], f"source=orders/{DAY}/a.parquet", order("1", "2"))

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(intake.versions if lost == "put" else intake, lost, fail)
        with pytest.raises(OSError):
            run(spark, at)
    assert ledger(spark, at) == {}
    put(at["raw"], f"source=orders/{DAY}/b.parquet", order("3"))
    assert run(spark, at) == ["1", "2", "3"]
    assert run(spark, at) == ["1", "2", "3"] and set(ledger(spark, at)) == {"a.parquet", "b.parquet"}
