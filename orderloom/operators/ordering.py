"""Newest-first output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import partitions_for


def newest_first(rows: DataFrame, by: str, *then: str) -> DataFrame:
    """Sort by a date or time, descending, NULL first.

    Ties may come in any order, which is used to keep the sort balanced: a range partition cannot be split within
    equal sort values, so further columns and at last a row number make the values of a crowded day differ. The ranges
    are as many as the input's size asks for.
    """
    numbered = rows.withColumn("_tie", F.monotonically_increasing_id())
    order = [F.col(by).desc_nulls_first(), *then, "_tie"]
    ranges = partitions_for(rows.sparkSession, rows)
    return numbered.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("_tie")


def orders_newest_first(orders: DataFrame) -> DataFrame:
    return newest_first(orders, "delivery_date", "customer", "baked_good_type")
