"""Quantities per delivery day and type."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom import storage, versions
from orderloom.operators.merge import INSERT, OLD_QUANTITY, OPERATION
from orderloom.schema import PERIOD, SUMMARY
from orderloom.session import scratch, shuffles_sized_for
from orderloom.storage import OrderTable, SummaryTable

GROUPS = ["delivery_date", "baked_good_type"]
_TOTAL = SUMMARY["total_quantity"].dataType


def summarise(orders: DataFrame) -> DataFrame:
    """Sum per day and type. NULL quantities are skipped and NULL groups kept; partial sums go into the shuffle, so a
    crowded group costs one row per task there."""
    return orders.groupBy(*GROUPS).agg(F.sum("quantity").cast(SUMMARY["total_quantity"].dataType).alias("total_quantity"))


def summarise_group_by_all(orders: DataFrame) -> DataFrame:
    """The same in SQL, grouping by all outputs that are not aggregates."""
    return orders.sparkSession.sql(
        "SELECT delivery_date, baked_good_type, sum(quantity) AS total_quantity FROM {orders} GROUP BY ALL",
        orders=orders,
    )


def _counted(orders: DataFrame) -> DataFrame:
    """The sums with the numbers of rows and quantities that they are of."""
    return orders.groupBy(*GROUPS).agg(
        F.sum("quantity").cast(_TOTAL).alias("total_quantity"),
        F.count(F.lit(1)).alias("order_rows"),
        F.count("quantity").alias("quantities"),
    )


def _write(
    summary: DataFrame, table: SummaryTable, *inputs: DataFrame, replace: bool = False, change_id: str | None = None
) -> int:
    """Publish the years of the frame, or with ``replace`` no others, and return its rows."""
    spark, written = summary.sparkSession, Observation()
    versions.clean(spark, table.path)
    period = F.col(PERIOD.name)
    rows = (
        summary.withColumn(PERIOD.name, storage.period_of(F.col("delivery_date"), "year"))
        .withColumn(versions.PART, F.lit(versions.KEPT))
        .hint("rebalance", period)
        .observe(written, F.count(F.lit(1)).alias("rows"))
    )
    with shuffles_sized_for(spark, *inputs):
        mark = versions.write(rows, table.path)
    versions.commit(spark, table.path, mark, replace, {"id": change_id, "rows": written.get["rows"]})
    if table.name:
        versions.show_named(spark, table.name, table.path, SUMMARY)
    return written.get["rows"]


def refresh_summary(spark: SparkSession, orders: DataFrame, table: SummaryTable) -> int:
    """Replace the summary by that of all orders; returns the rows written.

    Readers see the former summary until the new one is published, and keep it if the job fails.
    """
    table.create(spark)
    return _write(_counted(orders), table, orders, replace=True)


def refresh_touched(spark: SparkSession, target: OrderTable, table: SummaryTable, periods: list, has_null: bool) -> int:
    """Summarise anew only the given periods of the target; returns the rows of the years written.

    The delivery day is merge key and group key, so a merge changes no group outside the periods it touched. The other
    days of their years are taken over from the summary itself.
    """
    table.create(spark)
    if not periods and not has_null:
        return 0
    orders = target.read_partitioned(spark).filter(storage.in_periods(periods, has_null))
    anew = _counted(orders)
    years = sorted({period.replace(month=1, day=1) for period in periods})
    of_target = storage.period_of(F.col("delivery_date"), target.grain)
    untouched = (
        table.read_partitioned(spark).filter(storage.in_periods(years, False) & ~of_target.isin(periods)).drop(PERIOD.name)
    )
    return _write(anew.unionByName(untouched), table, orders)


def refresh_from_changes(
    spark: SparkSession, changed: DataFrame, table: SummaryTable, change_id: str | None = None
) -> int:
    """Bring the summary up to date with the rows that a merge has changed; returns the rows of the years written.

    A changed row adds its quantity and takes away what it had before, so that only these rows and the summary's own years are
    read. A group of which no row is left would go; a sum of no quantities is NULL, as in a full refresh. Changes of an id are
    applied once, however often this is repeated.
    """
    table.create(spark)
    done = versions.merge_done(spark, table.path, change_id) if change_id else None
    if done:
        return done["rows"]
    old = F.col(OLD_QUANTITY)
    is_new = F.col(OPERATION) == INSERT
    signed = F.coalesce("quantity", F.lit(0)) - F.coalesce(old, F.lit(0))
    moved = (
        changed.groupBy(*GROUPS)
        .agg(
            F.sum(signed).cast(_TOTAL).alias("total_quantity"),
            F.count_if(is_new).alias("order_rows"),
            (F.count("quantity") - F.count(old)).alias("quantities"),
        )
    )
    # A row or two a day and type: written once, as they are read for their years and again for the sums.
    path = scratch(spark, "summary-changes")
    try:
        with shuffles_sized_for(spark, changed):
            moved.write.parquet(path)
        moved = spark.read.schema(moved.schema).parquet(path)
        year = storage.period_of(F.col("delivery_date"), "year")
        years = [row["year"] for row in moved.select(year.alias("year")).distinct().collect()]
        if not years:
            return 0
        dated = sorted(y for y in years if y is not None)
        before = table.read_partitioned(spark).filter(storage.in_periods(dated, None in years)).drop(PERIOD.name)
        summed = before.unionByName(moved).groupBy(*GROUPS).agg(
            F.sum("total_quantity").cast(_TOTAL).alias("total_quantity"),
            F.sum("order_rows").alias("order_rows"),
            F.sum("quantities").alias("quantities"),
        )
        total = F.when(F.col("quantities") > 0, F.col("total_quantity"))
        return _write(summed.where("order_rows > 0").withColumn("total_quantity", total), table, before, change_id=change_id)
    finally:
        storage.delete(spark, path)
