import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.functions import columns, labels
from ordermill.operators import incremental, quality, reports, writing
from ordermill.settings import Prices, Settings, Thresholds
from test_merging import D1, D2, D3, rows

def as_of():
    return F.lit("2026-03-19 12:30:00").cast("timestamp")


def results(df, **options):
    checks = quality.production_checks(as_of(), **options)
    return {r["check"]: (r["value"], r["status"]) for r in quality.run_checks(df, checks).collect()}


def test_checks_on_good_rows(spark):
    df = rows(spark, ("a", 10.0, D2), ("b", 20.0, D2), stamp="2026-03-19 00:00:00")
    found = results(df.withColumn("user_segment", F.lit("new")))
    assert {status for _, status in found.values()} == {"PASS"}
    assert found["Freshness < 24 Hours"][0] == 12


def test_checks_on_bad_rows(spark):
    df = rows(spark, ("a", -10.0, D2), ("a", 20.0, D2), (None, 5000.0, D2), stamp="2026-03-18 12:00:00")
    found = results(df)
    assert {k: s for k, (_, s) in found.items()} == {
        "Row Count > 0": "PASS", "No Null Primary Keys": "FAIL", "No Negative Amounts": "FAIL",
        "Duplicate Rate < 1%": "FAIL", "User Segment Coverage > 5%": "FAIL",
        "Amount Range Sanity (avg $1-$1000)": "FAIL", "Freshness < 24 Hours": "FAIL",
    }


def test_an_empty_date_gives_errors_not_passes(spark):
    found = results(rows(spark))
    assert found["Row Count > 0"] == (0.0, "FAIL")
    assert found["No Null Primary Keys"] == (0.0, "PASS")
    assert found["Duplicate Rate < 1%"] == (None, "ERROR")
    assert found["Freshness < 24 Hours"] == (None, "ERROR")
    table = quality.run_checks(rows(spark), quality.production_checks(as_of()))
    score = quality.quality_score(table).first()
    assert (score["passed"], score["checks"], score["alert"]) == (2, 7, True)


def test_all_checks_share_one_scan(spark, tmp_path, plan):
    rows(spark, ("a", 1.0, D2)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert plan(quality.run_checks(df, quality.production_checks(as_of()))).split("Initial Plan")[0].count("FileScan") == 1


def test_limits_come_from_configuration(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("quality_gate:\n  min_row_count: 7\n  max_duplicate_rate: 0.5\n  other: 1\nroot: /x/\n")
    settings = Settings.from_yaml(str(path))
    assert settings.thresholds == Thresholds(min_row_count=7, max_duplicate_rate=0.5)
    assert settings.locations.raw == "/x/raw"


def test_output_gates(spark):
    def failed(df):
        gates = quality.output_gates(quality.key_audit(df))
        try:
            quality.require(gates)
        except quality.GateFailed as e:
            return str(e)

    assert failed(rows(spark)) == quality.EMPTY_OUTPUT
    ten = [(str(k), 1.0, D2) for k in range(10)]
    assert failed(rows(spark, *ten)) is None
    assert failed(rows(spark, *ten, ("0", 1.0, D2))) is None
    assert failed(rows(spark, *ten, *ten[:2])) == quality.ROW_EXPLOSION % (10, 12)


def test_column_tests(spark):
    df = rows(spark, ("a", 1.0, D2), ("a", 1.0, D2), (None, 1.0, D2), (None, 1.0, D2), ("b", 1.0, D2))
    assert dict(quality.column_tests(df).collect()) == {"unique": 1, "not_null": 2}
    assert [tuple(r) for r in quality.not_unique(df, "order_id").collect()] == [("a", 2)]
    assert quality.is_null(df, "order_id").count() == 2
    assert dict(quality.column_tests(rows(spark)).collect()) == {"unique": 0, "not_null": 0}


def test_health_report(spark):
    staged = rows(spark, ("a", 1.1, D1), ("b", 2.2, D1), ("c", 1.0, D2), ("c", 1.0, D2), ("d", 1.0, D3))
    produced = rows(
        spark, ("a", 1.1, D1), ("c", 1.0, D2), ("c", 1.0, D2), stamp="2026-03-19 10:59:30"
    )
    report = reports.pipeline_metrics(staged, produced, as_of()).collect()
    assert [r["process_date"] for r in report] == [D3, D2, D1]
    by_day = {r["process_date"]: r for r in report}
    assert by_day[D1]["completeness_status"] == labels.DATA_LOSS
    assert by_day[D1]["revenue_variance"] == pytest.approx(2.2)
    assert by_day[D2]["completeness_status"] == labels.COMPLETE
    assert by_day[D2]["uniqueness_status"] == labels.DUPLICATES
    assert by_day[D2]["minutes_since_last_run"] == 90
    assert by_day[D3]["completeness_status"] == labels.OVER_COUNT
    assert by_day[D3]["minutes_since_last_run"] is None
    named = reports.pipeline_metrics(staged, produced, as_of(), labels.Labels(missing="MISSING"))
    assert named.first()["completeness_status"] == "MISSING"


def test_revenue_is_exact(spark):
    many = rows(spark, *[(str(k), 0.1, D2) for k in range(1000)])
    row = reports.revenue_variance(many, many).first()
    assert row["revenue_variance"] == 0.0 and row["is_balanced"]


def jobs(spark):
    schema = ("job_id string, creation_time timestamp, job_type string, state string, "
              "total_bytes_billed bigint, total_slot_ms bigint, "
              "referenced_tables array<struct<table_id:string>>")
    at = dt.datetime(2026, 3, 19, 10, 15)
    return spark.createDataFrame(
        [
            ("1", at, "QUERY", "DONE", 2**40, 3_600_000, [("a",), ("b",)]),
            ("2", at, "QUERY", "DONE", 2**30, 1_800_000, [("a",)]),
            ("3", at, "QUERY", "DONE", 2**62, 0, []),
            ("4", at, "QUERY", "DONE", 2**62, 0, None),
            ("5", at, "LOAD", "DONE", 1, 0, [("a",)]),
            ("6", at, "QUERY", "RUNNING", 1, 0, [("a",)]),
            ("7", dt.datetime(2026, 3, 18, 12, 30), "QUERY", "DONE", 1, 0, [("a",)]),
        ],
        schema,
    )


def test_cost_reports(spark):
    cost = [tuple(r) for r in reports.cost_by_table(jobs(spark), as_of()).collect()]
    assert cost == [("a", 2, 1025.0, 6.26), ("b", 1, 1024.0, 6.25)]
    doubled = reports.cost_by_table(jobs(spark), as_of(), prices=Prices(scan_per_tib=12.5))
    assert doubled.first()["estimated_cost_usd"] == 12.51
    hour = reports.slot_usage_hourly(jobs(spark), as_of()).first()
    assert (str(hour["hour"]), hour["jobs"], hour["slot_hours"]) == ("2026-03-19 10:00:00", 4, 1.5)
    top = reports.top_scans(jobs(spark), as_of(), limit=3).collect()
    assert [r["job_id"] for r in top] == ["3", "4", "1"]
    assert top[0]["cost_alert"] == labels.LARGE_SCAN
    assert reports.top_scans(jobs(spark), as_of()).collect()[-1]["cost_alert"] == labels.SCAN_OK


def test_byte_sums_do_not_overflow(spark):
    many = spark.range(20).select(F.lit("d").alias("table_schema"), F.lit(2**62).alias("total_logical_bytes"))
    assert reports.storage_cost(many).first()["total_gb"] == 20 * 2.0**32


def test_top_scans_never_sorts_everything(spark, plan):
    assert "TakeOrderedAndProject" in plan(reports.top_scans(jobs(spark), as_of()))


def test_defects_and_stages(spark):
    orders = spark.createDataFrame(
        [("1", None, 1.0), ("2", "u", -1.0), ("3", "u", 1.0), ("3", "u", 1.0)],
        "order_id string, user_id string, amount double",
    )
    events = spark.createDataFrame([("e",), ("e",), ("f",), (None,), (None,)], "event_id string")
    assert dict(reports.defect_profile(orders, events).collect()) == {
        "null user_id": 1, "negative amount": 1, "repeated event_id": 2
    }
    none = events.where("false")
    assert dict(reports.defect_profile(orders, none).collect())["repeated event_id"] == 0
    stages = reports.stage_counts(orders, rows(spark, ("3", 1.0, D2)), rows(spark)).orderBy("stage_no")
    assert [(r["stage"], r["rows"], r["lost"]) for r in stages.collect()] == [
        ("landed", 4, None), ("valid", 2, 2), ("deduplicated", 1, 1), ("staging", 1, 0),
        ("production", 0, 1),
    ]


@pytest.mark.parametrize(
    "start, end, hours, minutes",
    [
        ("2026-03-19 00:30:00", "2026-03-19 02:00:00", 1, 90),
        ("2026-03-19 02:00:00", "2026-03-19 00:30:00", -1, -90),
        ("2026-03-19 00:00:00", "2026-03-19 00:59:59", 0, 59),
    ],
)
def test_whole_units(spark, start, end, hours, minutes):
    a, b = (F.lit(x).cast("timestamp") for x in (start, end))
    row = spark.range(1).select(
        columns.whole_units_between("HOUR", a, b), columns.whole_units_between("MINUTE", a, b)
    ).first()
    assert tuple(row) == (hours, minutes)


def test_watermark_is_strict_and_compares_times(spark):
    schema = "id int, updated_at string"
    data = [(1, "2026-03-21T00:00:00"), (2, "2026-03-21T00:00:01"), (3, "2026-03-20T23:59:59"), (4, None)]
    df = spark.createDataFrame(data, schema)
    assert [r["id"] for r in incremental.newer_than(df, "2026-03-21 00:00:00").collect()] == [2]


def test_watermark_state(spark, tmp_path):
    path = str(tmp_path / "w")
    default = "2026-03-21 00:00:00"
    assert incremental.read_watermark(spark, path, "p", default) == dt.datetime(2026, 3, 21)
    df = rows(spark, ("a", 1.0, D2), stamp="2026-03-22 10:00:00")
    incremental.advance_watermark(df, path, "p")
    incremental.advance_watermark(df.where("false"), path, "p")
    assert incremental.read_watermark(spark, path, "p", default) == dt.datetime(2026, 3, 22, 10)
    assert incremental.read_watermark(spark, path, "other", default) == dt.datetime(2026, 3, 21)


def test_rows_since_the_newest_date_and_all_rows_without_one(spark, tmp_path):
    source = rows(spark, ("a", 1.0, D1), ("b", 1.0, D2), ("c", 1.0, D3))
    target = rows(spark, ("z", 1.0, D1), ("y", 1.0, D2))
    kept = incremental.since_latest_date(source, target).collect()
    assert [r["order_id"] for r in kept] == ["b", "c"]
    old = rows(spark, ("y", 1.0, dt.date(1995, 5, 1)))
    for empty in (rows(spark), old):
        assert incremental.since_latest_date(source, empty).count() == 3
    path = str(tmp_path / "t")
    writing.write_enriched(target, path)
    assert incremental.newest_partition(spark, path) == D2
    assert incremental.newest_partition(spark, path, before=str(D2)) == D1
    assert incremental.newest_partition(spark, path, floor="2030-01-01") is None
    assert incremental.newest_partition(spark, str(tmp_path / "none")) is None
    assert incremental.since_date(source, None).count() == 3
    assert incremental.since_date(source, D2).count() == 2


@pytest.mark.parametrize(
    "amounts, total, mean",
    [
        ([1.004, 1.004], 2.008, 1.004),
        ([0.1] * 10, 1.0, 0.1),
        ([1e17, 1.0], 1e17 + 1.0, (1e17 + 1.0) / 2),
        ([1e30, 1.0], 1e30, 5e29),
        ([None, 2.0], 2.0, 2.0),
    ],
)
def test_sums_and_means_of_amounts_are_exact(spark, amounts, total, mean):
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    row = df.agg(columns.sum_amount(F.col("amount")), columns.mean_amount(F.col("amount"))).first()
    assert tuple(row) == (total, mean)


def test_an_amount_that_is_no_number_shows_in_the_sum(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "amount double")
    row = df.agg(columns.sum_amount(F.col("amount")), columns.mean_amount(F.col("amount"))).first()
    assert all(v != v for v in row)
    none = df.where("false").agg(columns.sum_amount(F.col("amount")), columns.mean_amount(F.col("amount")))
    assert tuple(none.first()) == (None, None)
