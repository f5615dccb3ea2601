"""Column expressions. All are built from Spark's own functions and stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SEPARATOR = "||"
_EXACT = "decimal(28,10)"
BYTES_PER_GIB = 1024.0**3
BYTES_PER_TIB = 1024.0**4


def is_positive(amount: Column) -> Column:
    """True above zero. NULL, zero and negatives fail, and so does NaN, which Spark ranks highest."""
    return (amount > 0) & ~F.isnan(amount)


def money(amount: Column) -> Column:
    """Exact two-digit amount, so that sums do not depend on the order of addition."""
    return amount.cast("decimal(18,2)")


def sum_amount(amount: Column) -> Column:
    """Sum of amounts as a double. Amounts are added as decimals with ten digits after the point, so
    the sum does not depend on the order of addition and equal inputs have equal sums; where one is
    too large for that, infinite or NaN, it is the plain sum of doubles."""
    exact = amount.try_cast(_EXACT)
    odd = amount.isNotNull() & exact.isNull()
    total = F.try_sum(exact).cast("double")
    return F.when(F.coalesce(F.max(odd), F.lit(False)), F.sum(amount)).otherwise(
        F.coalesce(total, F.sum(amount))
    )


def mean_amount(amount: Column) -> Column:
    """Mean by :func:`sum_amount`."""
    return F.try_divide(sum_amount(amount), F.count(amount))


def text_hash(*parts: Column) -> Column:
    """SHA-256 hex over the parts joined by the separator; NULL parts are skipped."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def row_hash(exact_amount: bool = False) -> Column:
    """Change-detection hash over order_id, amount and currency.

    The amount enters as Spark prints the double (``100.0``). ``exact_amount`` prints it with
    two digits (``100.00``), which does not vary with the runtime's number format.
    """
    amount = F.col("amount")
    shown = money(amount) if exact_amount else amount
    return text_hash(F.col("order_id"), shown.cast("string"), F.col("currency"))


def safe_date(value: Column) -> Column:
    """ISO text (or a date) as DATE; NULL when it is not a date."""
    return value.cast("string").try_cast("date")


def safe_timestamp(value: Column) -> Column:
    return value.try_cast("timestamp")


def whole_units_between(unit: str, start: Column, end: Column) -> Column:
    """Complete HOURs or MINUTEs from ``start`` to ``end``, cut towards zero."""
    start, end = start.cast("timestamp"), end.cast("timestamp")
    return F.timestamp_diff(unit.upper(), start, end)


def source_name(file_name: Column) -> Column:
    """Value of the first ``source=`` part of a path; NULL if the path has none."""
    return F.nullif(F.regexp_extract(file_name, r"(?:^|/)source=([^/]*)", 1), F.lit(""))


def partition_day(file_name: Column) -> Column:
    """Value of the ``dt=`` part of a path as DATE; NULL if there is none."""
    return safe_date(F.regexp_extract(file_name, r"(?:^|/)dt=([^/]*)", 1))


def types_text(type_counts: Column) -> Column:
    """Comma list of event types with one entry per event, in order of the type.

    ``type_counts`` is array<struct<event_type,n>>, sorted. Each type is repeated in one go, so the
    list itself never exists as an array.
    """

    def run(entry: Column) -> Column:
        repeats = (entry["n"] - 1).cast("int")
        return F.concat(
            F.call_function("repeat", F.concat(entry["event_type"], F.lit(",")), repeats),
            entry["event_type"],
        )

    return F.array_join(F.transform(type_counts, run), ",")


def counted_types_text(type_counts: Column) -> Column:
    """The list of :func:`types_text` in short: ``type*count`` per type."""
    return F.array_join(
        F.transform(type_counts, lambda e: F.concat_ws("*", e["event_type"], e["n"].cast("string"))), ","
    )


def distinct_types_text(type_counts: Column) -> Column:
    """Comma list of the distinct event types, in order."""
    return F.array_join(type_counts["event_type"], ",")
