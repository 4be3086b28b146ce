"""Nested order documents -> relational order rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.casts import strict_cast
from orderloom.schema import ORDER_COLUMNS, QUANTITY


def _field(document: str, name: str, as_type: str, outer: bool = False) -> Column:
    column = F.col(document).outer() if outer else F.col(document)
    return F.variant_get(column, f'$["{name}"]', as_type)


def _date(document: str, name: str) -> Column:
    # By way of text: a variant's own cast to date takes damaged dates.
    return strict_cast(_field(document, name, "string"), T.DateType(), name)


def top_level(raw: DataFrame) -> DataFrame:
    """Scalars of the document, its orders still nested. A missing field is NULL."""
    kept = [c for c in raw.columns if c != "customer_orders"]
    return raw.select(
        _field("customer_orders", "Customer", "string").alias("customer"),
        _date("customer_orders", "Order date").alias("order_date"),
        _field("customer_orders", "Orders", "variant").alias("orders"),
        *kept,
    )


def flatten_days(raw: DataFrame) -> DataFrame:
    """One row per delivery day of a document; documents without any vanish."""
    kept = [c for c in raw.columns if c != "customer_orders"]
    spark = raw.sparkSession
    days = top_level(raw).lateralJoin(spark.tvf.variant_explode(F.col("orders").outer()))
    return days.select(
        "customer",
        "order_date",
        _date("value", "Delivery date").alias("delivery_date"),
        _field("value", "Orders by day", "variant").alias("orders_by_day"),
        *kept,
    )


def flatten_orders(raw: DataFrame) -> DataFrame:
    """One row per ordered item: documents, their days, the items of a day.

    Both levels are narrow generators. Scalars are typed before each of them, so only the part still to be unnested
    travels on as variant, and none reaches a shuffle.
    """
    kept = [c for c in raw.columns if c != "customer_orders"]
    spark = raw.sparkSession
    items = flatten_days(raw).lateralJoin(spark.tvf.variant_explode(F.col("orders_by_day").outer()))
    return items.select(
        "customer",
        "order_date",
        "delivery_date",
        _field("value", "Baked good type", "string").alias("baked_good_type"),
        _field("value", "Quantity", QUANTITY.simpleString()).alias("quantity"),
        *kept,
    )


def flatten_typed(documents: DataFrame) -> DataFrame:
    """The same rows from documents that were read into the known struct."""
    kept = [c for c in documents.columns if c not in ("Customer", "Order date", "Orders")]
    days = documents.select("Customer", "Order date", F.explode("Orders").alias("day"), *kept)
    items = days.select(
        "Customer", "Order date", F.col("day")["Delivery date"].alias("delivery_date"),
        F.explode(F.col("day")["Orders by day"]).alias("item"), *kept,
    )
    return items.select(
        F.col("Customer").alias("customer"),
        F.col("Order date").alias("order_date"),
        "delivery_date",
        F.col("item")["Baked good type"].alias("baked_good_type"),
        F.col("item")["Quantity"].alias("quantity"),
        *kept,
    )


def flattened_view(raw: DataFrame) -> DataFrame:
    """The flattened documents in the shape of an order staging table."""
    return flatten_orders(raw).select(*ORDER_COLUMNS)
