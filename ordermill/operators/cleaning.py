"""Row filters, stable deduplication and the row-level contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.columns import is_positive

_UNORDERED = (T.MapType, T.VariantType)


def positive_amounts(orders: DataFrame) -> DataFrame:
    return orders.where(is_positive(F.col("amount")))


def known_users(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("user_id").isNotNull())


def valid_orders(orders: DataFrame) -> DataFrame:
    """Orders with a positive amount and a user. Runs before dedup, so that an invalid copy
    never hides a valid one."""
    return known_users(positive_amounts(orders))


def null_keys(df: DataFrame, key: str = "order_id") -> DataFrame:
    return df.where(F.col(key).isNull())


def one_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the largest ``newest`` columns, NULLs last.

    Columns named in ``newest`` that ``df`` lacks are skipped. All other columns break ties,
    so the survivor does not depend on partitioning. NULL keys form one group.

    A filter on ``row_number`` lets Spark keep one row per key in each map task before the
    shuffle (WindowGroupLimit), so a key that holds most rows reaches the reducer as a few.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    ranked = [c for c in newest if c in fields]
    rest = [
        c for c, kind in fields.items()
        if c not in ranked and c not in keys and not isinstance(kind, _UNORDERED)
    ]
    order = ", ".join(f"`{c}` DESC NULLS LAST" for c in ranked + sorted(rest))
    if not order:
        return df.dropDuplicates(list(keys))
    group = ", ".join(f"`{k}`" for k in keys)
    ranks = f"row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS _rank"
    return df.selectExpr("*", ranks).where("_rank = 1").drop("_rank")


def dedup_orders(orders: DataFrame, newest: Sequence[str] = ("created_at",)) -> DataFrame:
    """The latest valid row of each order."""
    return one_per_key(valid_orders(orders), ["order_id"], newest)


def dedup_events(events: DataFrame, newest: Sequence[str] = ("timestamp", "ts")) -> DataFrame:
    """The latest row of each event."""
    return one_per_key(events, ["event_id"], newest)


# The row-level contract: reason → condition that breaks it.
def contract_breaches() -> dict[str, Column]:
    amount = F.col("amount")
    return {
        "order_id is null": F.col("order_id").isNull(),
        "user_id is null": F.col("user_id").isNull(),
        "amount is null": amount.isNull(),
        "amount is not positive": amount.isNotNull() & ~is_positive(amount),
        "status is null": F.col("status").isNull(),
        "process_date is null": F.col("process_date").isNull(),
    }


def with_breaches(orders: DataFrame) -> DataFrame:
    """Adds ``reasons``: the broken contract terms of a row, empty when it keeps all of them."""
    flags = [F.when(broken, F.lit(reason)) for reason, broken in contract_breaches().items()]
    return orders.withColumn("reasons", F.array_compact(F.array(*flags)))


def split_by_contract(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their reasons). Together they are exactly the input."""
    judged = with_breaches(orders)
    good = judged.where(F.size("reasons") == 0).drop("reasons")
    return good, judged.where(F.size("reasons") > 0)
