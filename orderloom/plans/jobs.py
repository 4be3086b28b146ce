"""The two table-filling jobs. They report errors in their status instead of raising."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.functions.status import JobStatus, failed, rows_affected, rows_inserted
from orderloom.operators.merge import MergeResult, merge_orders
from orderloom.operators.summary import refresh_summary
from orderloom.plans.event_log import EventLog
from orderloom.storage import OrderTable, SummaryTable


def run_job(spark: SparkSession, name: str, work: Callable[[], JobStatus], log: EventLog | None = None) -> JobStatus:
    """Run and report. The caller sees a normal return either way."""
    if log:
        log.write(spark, "DEBUG", name, f"{name} begin")
    try:
        status = work()
    except Exception as error:  # noqa: BLE001 - any failure becomes a status
        status = failed(error)
        if log:
            log.write(spark, "ERROR", name, status.message)
    return status


def load_customer_orders(
    spark: SparkSession, source: Callable[[], DataFrame] | DataFrame, target: OrderTable, log: EventLog | None = None, **merge_options
) -> JobStatus:
    """Merge the combined feed; rows affected are updates and inserts."""

    def work() -> JobStatus:
        rows = source() if callable(source) else source
        result: MergeResult = merge_orders(spark, target, rows, **merge_options)
        return rows_affected(result.affected)

    return run_job(spark, "LOAD_CUSTOMER_ORDERS", work, log)


def load_customer_summary_orders(
    spark: SparkSession, orders: OrderTable, summary: SummaryTable, log: EventLog | None = None
) -> JobStatus:
    """Refill the summary from all orders."""
    return run_job(
        spark,
        "LOAD_CUSTOMER_SUMMARY_ORDERS",
        lambda: rows_inserted(refresh_summary(spark, orders.read(spark), summary)),
        log,
    )
