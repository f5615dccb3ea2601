"""Table schemas and the landing contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()
_DATE, _TS = T.DateType(), T.TimestampType()


def _struct(*cols: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in cols])


# Landed files hold times and dates as ISO text.
ORDERS = _struct(
    ("order_id", _S, True),
    ("user_id", _S, True),
    ("amount", _D, True),
    ("currency", _S, True),
    ("status", _S, True),
    ("created_at", _S, True),
    ("process_date", _S, True),
)

EVENTS = _struct(
    ("event_id", _S, True),
    ("user_id", _S, True),
    ("event_type", _S, True),
    ("page_url", _S, True),
    ("session_id", _S, True),
    ("timestamp", _S, True),
    ("process_date", _S, True),
)

SEGMENTS = _struct(
    ("user_id", _S, True),
    ("segment", _S, True),
    ("lifetime_value", _D, True),
    ("signup_date", _S, True),
    ("country", _S, True),
)

# Staging and production share one layout.
ENRICHED = _struct(
    ("order_id", _S, False),
    ("user_id", _S, True),
    ("amount", _D, False),
    ("currency", _S, False),
    ("status", _S, True),
    ("event_count", _L, True),
    ("event_types", _S, True),
    ("user_segment", _S, True),
    ("lifetime_value", _D, True),
    ("country", _S, True),
    ("process_date", _DATE, False),
    ("row_hash", _S, True),
    ("created_at", _TS, True),
    ("updated_at", _TS, True),
)
ENRICHED_COLUMNS = ENRICHED.fieldNames()

JOBS = _struct(
    ("job_id", _S, True),
    ("query", _S, True),
    ("creation_time", _TS, True),
    ("job_type", _S, True),
    ("state", _S, True),
    ("total_bytes_billed", _L, True),
    ("total_slot_ms", _L, True),
    ("referenced_tables", T.ArrayType(_struct(("table_id", _S, True))), True),
)

TABLE_STORAGE = _struct(
    ("table_schema", _S, True),
    ("total_logical_bytes", _L, True),
)

LEDGER = _struct(
    ("file_name", _S, False),
    ("processed_at", _TS, False),
    ("status", _S, False),
)

LANDED = {"orders": ORDERS, "events": EVENTS, "user_segments": SEGMENTS}

# Columns a landed file must hold, by source.
REQUIRED = {
    "orders": ["order_id", "user_id", "amount", "currency", "process_date"],
    "events": ["event_id", "user_id", "event_type", "timestamp", "process_date"],
    "user_segments": ["user_id", "segment"],
}
# Columns a landed file may hold, by source.
OPTIONAL = {
    "orders": ["status", "created_at"],
    "events": ["page_url", "session_id"],
    "user_segments": ["lifetime_value", "signup_date", "country"],
}


def required_columns(source: Column) -> Column:
    """Required columns of a source as an array literal lookup; NULL for an unregistered source.

    The registry holds a handful of sources, so a map literal replaces a join.
    """
    entries = [
        part
        for name, cols in REQUIRED.items()
        for part in (F.lit(name), F.array(*[F.lit(c) for c in cols]))
    ]
    return F.try_element_at(F.create_map(*entries), source)


def contract_frame(spark: SparkSession) -> DataFrame:
    """The landing contract as rows: source, column_name, data_type, is_required."""
    rows = [
        (source, f.name, f.dataType.simpleString(), f.name in REQUIRED[source])
        for source, schema in LANDED.items()
        for f in schema.fields
    ]
    return spark.createDataFrame(
        rows, "source string, column_name string, data_type string, is_required boolean"
    )


def columns_frame(spark: SparkSession, schema: T.StructType, source: str) -> DataFrame:
    """A schema as rows: source, column_name, data_type."""
    rows = [(source, f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "source string, column_name string, data_type string")
