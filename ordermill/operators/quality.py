"""Gates that stop a run, checks that grade a table, and column tests."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import mean_amount, whole_units_between
from ordermill.settings import Thresholds

log = logging.getLogger("ordermill")


class GateFailed(ValueError):
    """A gate stopped the run."""


# What a failed gate says.
EMPTY_OUTPUT = "QUALITY CHECK FAILED: Output is empty!"
ROW_EXPLOSION = "QUALITY CHECK FAILED: Row explosion detected! Input=%d, Output=%d"
EMPTY_STAGING = "ABORT: Staging table is empty!"
NULL_KEYS = "ABORT: Found %d null order_ids in staging"
AMBIGUOUS_KEYS = "ABORT: Found %d rows beyond the first of their order_id in staging"


def key_audit(df: DataFrame, key: str = "order_id", *more: Column) -> DataFrame:
    """One row: rows, null_keys, distinct_keys, and what ``more`` aggregates. Reads the key column (and
    those of ``more``) only, once."""
    k = F.col(key)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(k.isNull()).alias("null_keys"),
        F.count_distinct(k).alias("distinct_keys"),
        *more,
    )


def _gates(audit: DataFrame, *gates: tuple[str, Column, Column, Column]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(name).alias("gate"),
            value.cast("double").alias("value"),
            passed.alias("passed"),
            F.when(~passed, message).alias("message"),
        )
        for name, value, passed, message in gates
    ]
    return audit.select(F.inline(F.array(*entries)))


def _input_rows() -> Column:
    """Rows before the joins. The left joins lose none, so each distinct key (NULL counts as
    one) was one row."""
    return F.col("distinct_keys") + (F.col("null_keys") > 0).cast("bigint")


def _nonempty(limits: Thresholds) -> tuple:
    rows = F.col("rows")
    return "nonempty", rows, rows >= limits.min_row_count, F.lit(EMPTY_OUTPUT)


def _row_explosion(limits: Thresholds) -> tuple:
    rows, before = F.col("rows"), _input_rows()
    message = F.format_string(ROW_EXPLOSION, before, rows)
    ok = rows <= before * F.lit(limits.max_row_growth)
    return "row_explosion", F.try_divide(rows, before), ok, message


def nonempty_gate(audit: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    return _gates(audit, _nonempty(limits))


def row_explosion_gate(audit: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    return _gates(audit, _row_explosion(limits))


def output_gates(audit: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Gates on the enriched rows: not empty, not multiplied by a join."""
    return _gates(audit, _nonempty(limits), _row_explosion(limits))


def premerge_gates(audit: DataFrame) -> DataFrame:
    """Gates on staging before the upsert: rows exist, no NULL keys, each key once."""
    rows, nulls = F.col("rows"), F.col("null_keys")
    spare = rows - nulls - F.col("distinct_keys")
    return _gates(
        audit,
        ("staging_nonempty", rows, rows > 0, F.lit(EMPTY_STAGING)),
        ("staging_null_keys", nulls, nulls == 0, F.format_string(NULL_KEYS, nulls)),
        ("staging_ambiguous", spare, spare == 0, F.format_string(AMBIGUOUS_KEYS, spare)),
    )


def require(gates: DataFrame) -> None:
    """Raises with the messages of the failed gates. A gate table has a few rows."""
    failed = [r["message"] for r in gates.where(~F.col("passed")).collect()]
    if failed:
        raise GateFailed("; ".join(failed))


@dataclass(frozen=True)
class Check:
    """A named aggregate over a table and the condition its value must meet."""

    name: str
    value: Column
    passed: Callable[[Column], Column]


def production_checks(as_of: Column | None = None, limits: Thresholds = Thresholds()) -> list[Check]:
    """The standard checks. ``as_of`` is the clock of the freshness check."""
    now = F.current_timestamp() if as_of is None else as_of
    order_id, amount, rows = F.col("order_id"), F.col("amount"), F.count(F.lit(1))
    # The names of the checks.
    return [
        Check("Row Count > 0", rows, lambda v: v > 0),
        Check("No Null Primary Keys", F.count_if(order_id.isNull()), lambda v: v == 0),
        Check("No Negative Amounts", F.count_if(amount < 0), lambda v: v == 0),
        Check(
            "Duplicate Rate < 1%",
            1.0 - F.try_divide(F.count_distinct(order_id), rows),
            lambda v: v < limits.max_duplicate_rate,
        ),
        Check(
            "User Segment Coverage > 5%",
            F.try_divide(F.count_if(F.col("user_segment").isNotNull()), rows),
            lambda v: v > limits.min_segment_coverage,
        ),
        Check(
            "Amount Range Sanity (avg $1-$1000)",
            mean_amount(amount),
            lambda v: v.between(limits.min_mean_amount, limits.max_mean_amount),
        ),
        Check(
            "Freshness < 24 Hours",
            whole_units_between("HOUR", F.max("updated_at"), now),
            lambda v: v < limits.max_age_hours,
        ),
    ]


def run_checks(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """One row per check (and per ``by`` group): check, value, passed, status.

    All checks share one aggregation. A check without a value, as on an empty table, and one that names
    a column the table has not got are an ERROR and have not passed; the others run. A check that raises
    while it runs ends the job: see :func:`run_checks_apart`.
    """
    values = [c.value if _resolves(df, c) else F.lit(None) for c in checks]
    aggregates = [v.cast("double").alias(f"_v{i}") for i, v in enumerate(values)]
    # An aggregate of no column still gives a row (per group).
    aggregates.append(F.count(F.lit(1)).alias("_rows"))
    one = df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)
    entries = []
    for i, c in enumerate(checks):
        v = F.col(f"_v{i}")
        ok = F.coalesce(c.passed(v), F.lit(False))
        status = F.when(v.isNull(), "ERROR").when(ok, "PASS").otherwise("FAIL")
        entries.append(
            F.struct(
                F.lit(c.name).alias("check"),
                v.alias("value"),
                ok.alias("passed"),
                status.alias("status"),
            )
        )
    return one.select(*by, F.inline(F.array(*entries)))


def _resolves(df: DataFrame, check: Check) -> bool:
    try:
        df.agg(check.value)
    except AnalysisException as e:
        log.error("check %s: %s", check.name, _brief(e))
        return False
    return True


def _brief(error: Exception) -> str:
    return str(error).partition("\n")[0]


def _raised(check: Check) -> Check:
    """The check without a value: an ERROR in every group."""
    return Check(check.name, F.max(F.lit(None).cast("double")), check.passed)


def run_checks_apart(
    df: DataFrame, checks: Sequence[Check], keep: Callable[[DataFrame], DataFrame], by: Sequence[str] = ()
) -> DataFrame:
    """As :func:`run_checks`, run at once, where no check can end another: if the shared aggregation
    raises, each check runs alone, and one that raises then is an ERROR (of every group). ``keep`` runs a
    plan and returns its rows as a table."""
    try:
        return keep(run_checks(df, checks, by))
    except PySparkException as e:
        log.error("the checks raised together and run one by one: %s", _brief(e))
    rows = None
    for check in checks:
        try:
            part = keep(run_checks(df, [check], by))
        except PySparkException as e:
            log.error("check %s: %s", check.name, _brief(e))
            part = keep(run_checks(df, [_raised(check)], by))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def quality_score(
    results: DataFrame, by: Sequence[str] = (), limits: Thresholds = Thresholds()
) -> DataFrame:
    """Share of passed checks, and whether it is low enough to alert."""
    score = F.avg(F.col("passed").cast("double"))
    grouped = results.groupBy(*by) if by else results.groupBy()
    return grouped.agg(
        F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("checks"), score.alias("score")
    ).withColumn("alert", F.col("score") < limits.min_quality_score)


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count. Empty when the test holds."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
    )


def is_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value. Empty when the test holds."""
    return df.where(F.col(column).isNull())


def column_tests(df: DataFrame, column: str = "order_id") -> DataFrame:
    """Failures of both column tests in one pass: test, failures."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col(column).isNotNull() & (F.col("n") > 1)).alias("repeated"),
    )
    return counts.select(
        F.inline(
            F.array(
                F.struct(F.lit("unique").alias("test"), F.col("repeated").alias("failures")),
                F.struct(F.lit("not_null").alias("test"), F.col("nulls").alias("failures")),
            )
        )
    )
