"""Reports: staging against production, row counts per stage, compute and storage cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import labels as L
from ordermill.functions.columns import (
    BYTES_PER_GIB,
    BYTES_PER_TIB,
    is_positive,
    mean_amount,
    sum_amount,
    whole_units_between,
)
from ordermill.settings import Prices


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def _total(bytes_column: str) -> Column:
    """Sum of a byte count that cannot overflow."""
    return F.sum(F.col(bytes_column).cast("decimal(20,0)")).cast("double")


def global_counts(df: DataFrame, key: str = "order_id") -> DataFrame:
    """One row: all rows, and rows without a key."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(key).isNull()).alias("null_keys")
    )


def staging_stats(staging: DataFrame) -> DataFrame:
    """Per date: rows, distinct orders, revenue, mean amount, NULL keys."""
    return staging.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("staging_rows"),
        F.count_distinct("order_id").alias("unique_staging_orders"),
        sum_amount(F.col("amount")).alias("total_staging_revenue"),
        mean_amount(F.col("amount")).alias("avg_staging_amount"),
        F.count_if(F.col("order_id").isNull()).alias("null_order_ids"),
    )


def production_stats(production: DataFrame) -> DataFrame:
    """Per date: rows, revenue, last update."""
    return production.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("production_rows"),
        sum_amount(F.col("amount")).alias("total_production_revenue"),
        F.max("updated_at").alias("last_updated_at"),
    )


def reconcile(staging: DataFrame, production: DataFrame) -> DataFrame:
    """Per staging date, both sides' statistics; dates production lacks have NULLs there."""
    return staging_stats(staging).join(production_stats(production), "process_date", "left")


def pipeline_metrics(
    staging: DataFrame,
    production: DataFrame,
    as_of: Column | None = None,
    labels: L.Labels = L.Labels(),
) -> DataFrame:
    """Health report, newest date first: completeness, uniqueness, revenue variance, freshness.

    Give date-bounded inputs (``read_partitions``) to keep the report from scanning all dates.
    """
    staged, produced = F.col("staging_rows"), F.col("production_rows")
    return (
        reconcile(staging, production)
        .select(
            "process_date",
            "staging_rows",
            "production_rows",
            L.completeness(staged, produced, labels).alias("completeness_status"),
            L.uniqueness(staged, F.col("unique_staging_orders"), labels).alias("uniqueness_status"),
            "total_staging_revenue",
            "total_production_revenue",
            revenue_difference().alias("revenue_variance"),
            F.col("avg_staging_amount").alias("price_point_telemetry"),
            F.col("null_order_ids").alias("primary_key_violations"),
            "last_updated_at",
            whole_units_between("MINUTE", F.col("last_updated_at"), _now(as_of)).alias(
                "minutes_since_last_run"
            ),
        )
        .orderBy(F.desc("process_date"))
    )


def revenue_difference() -> Column:
    return F.col("total_staging_revenue") - F.col("total_production_revenue")


def revenue_variance(staging: DataFrame, production: DataFrame) -> DataFrame:
    """Per date: staging revenue minus production revenue, exact; balanced when zero."""
    difference = revenue_difference()
    return reconcile(staging, production).select(
        "process_date",
        difference.alias("revenue_variance"),
        (difference == 0).alias("is_balanced"),
    )


def stage_counts(landed: DataFrame, staging: DataFrame, production: DataFrame) -> DataFrame:
    """Rows per stage and rows lost against the stage before: stage_no, stage, rows, lost.

    The landed, valid and deduplicated counts come from one pass over the landed orders.
    """
    valid = is_positive(F.col("amount")) & F.col("user_id").isNotNull()
    first = landed.agg(
        F.count(F.lit(1)).alias("landed"),
        F.count_if(valid).alias("valid"),
        F.count_distinct(F.when(valid, F.col("order_id"))).alias("deduplicated"),
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("stage_no"), F.lit(n).alias("stage"), F.col(n).alias("rows"))
                    for i, n in enumerate(("landed", "valid", "deduplicated"), 1)
                ]
            )
        )
    )

    def counted(df: DataFrame, number: int, stage: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(number).alias("stage_no"), F.lit(stage).alias("stage"), "rows"
        )

    stages = first.unionByName(counted(staging, 4, "staging")).unionByName(
        counted(production, 5, "production")
    )
    # Five rows in all: gathered into one array, each entry is compared with the one before.
    gathered = stages.agg(F.array_sort(F.collect_list(F.struct("stage_no", "stage", "rows"))).alias("s"))
    return gathered.select(F.posexplode("s").alias("i", "e"), "s").select(
        "e.stage_no",
        "e.stage",
        "e.rows",
        F.when(F.col("i") > 0, F.try_element_at("s", F.col("i"))["rows"] - F.col("e.rows")).alias("lost"),
    )


def defect_profile(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Planted defects found in the sources: defect, rows. Each source is read once."""
    order_defects = orders.agg(
        F.count_if(F.col("user_id").isNull()).alias("u"), F.count_if(F.col("amount") < 0).alias("n")
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("null user_id").alias("defect"), F.col("u").alias("rows")),
                F.struct(F.lit("negative amount").alias("defect"), F.col("n").alias("rows")),
            )
        )
    )
    # NULL ids are copies of each other; the marker counts them as one value.
    event_id = F.col("event_id")
    ids = F.count_distinct(event_id) + F.max(event_id.isNull().cast("int"))
    event_defects = events.agg((F.count(F.lit(1)) - F.coalesce(ids, F.lit(0))).alias("rows")).select(
        F.lit("repeated event_id").alias("defect"), "rows"
    )
    return order_defects.unionByName(event_defects)


def recent_done_queries(jobs: DataFrame, as_of: Column | None = None, hours: int = 24) -> DataFrame:
    """Finished queries created in the last ``hours``; there is no upper bound on the time."""
    start = _now(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return jobs.where(
        (F.col("creation_time") > start) & (F.col("job_type") == "QUERY") & (F.col("state") == "DONE")
    )


def by_referenced_table(jobs: DataFrame) -> DataFrame:
    """One row per job and table it reads. Jobs that read none drop out."""
    others = [c for c in jobs.columns if c != "referenced_tables"]
    return jobs.select(*others, F.explode("referenced_tables").alias("t")).select(
        *others, F.col("t.table_id").alias("table_id")
    )


def cost_by_table(
    jobs: DataFrame, as_of: Column | None = None, hours: int = 24, prices: Prices = Prices()
) -> DataFrame:
    """Queries, GiB billed and estimated cost per table, largest first.

    A job's bytes count in full for every table it reads.
    """
    recent = recent_done_queries(jobs, as_of, hours).select("total_bytes_billed", "referenced_tables")
    billed = _total("total_bytes_billed")
    return (
        by_referenced_table(recent)
        .groupBy("table_id")
        .agg(
            F.count(F.lit(1)).alias("query_count"),
            F.round(billed / BYTES_PER_GIB, 2).alias("gb_billed"),
            F.round(billed / BYTES_PER_TIB * prices.scan_per_tib, 2).alias("estimated_cost_usd"),
        )
        .orderBy(F.desc("gb_billed"), "table_id")
    )


def slot_usage_hourly(jobs: DataFrame, as_of: Column | None = None, hours: int = 24) -> DataFrame:
    """Jobs, slot hours and mean GiB per query for each hour, in order of time."""
    slot_ms = F.sum(F.col("total_slot_ms").cast("decimal(20,0)")).cast("double")
    mean_bytes = F.try_divide(_total("total_bytes_billed"), F.count("total_bytes_billed"))
    return (
        recent_done_queries(jobs, as_of, hours)
        .groupBy(F.date_trunc("HOUR", "creation_time").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("jobs"),
            F.round(slot_ms / 1000 / 3600, 1).alias("slot_hours"),
            F.round(mean_bytes / BYTES_PER_GIB, 2).alias("avg_gb_per_query"),
        )
        .orderBy("hour")
    )


def storage_cost(table_storage: DataFrame, prices: Prices = Prices()) -> DataFrame:
    """Tables, GiB and monthly cost per dataset, largest first."""
    size = _total("total_logical_bytes")
    return (
        table_storage.groupBy(F.col("table_schema").alias("dataset"))
        .agg(
            F.count(F.lit(1)).alias("table_count"),
            F.round(size / BYTES_PER_GIB, 2).alias("total_gb"),
            F.round(size / BYTES_PER_TIB * prices.storage_per_tib_month, 4).alias(
                "storage_cost_usd_month"
            ),
        )
        .orderBy(F.desc("total_gb"), "dataset")
    )


def top_scans(
    jobs: DataFrame, as_of: Column | None = None, hours: int = 24, limit: int = 20
) -> DataFrame:
    """The ``limit`` finished queries that billed most, flagged when above the large-scan size."""
    billed = F.col("total_bytes_billed")
    shown = [c for c in ("job_id", "query") if c in jobs.columns]
    return (
        recent_done_queries(jobs, as_of, hours)
        .orderBy(billed.desc_nulls_last(), "job_id")
        .limit(limit)
        .select(
            *shown,
            "total_bytes_billed",
            F.round(billed / BYTES_PER_GIB, 2).alias("gb_billed"),
            L.scan_size(billed).alias("cost_alert"),
        )
    )
