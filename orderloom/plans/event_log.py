"""Event log of the jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import storage
from orderloom.operators.ordering import newest_first
from orderloom.schema import EVENT_LOG

# Severities, least first.
SEVERITIES = ["TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL"]


@dataclass(frozen=True)
class EventLog:
    """Events below ``level`` are not written."""

    path: str
    level: str = "DEBUG"

    def write(self, spark: SparkSession, severity: str, procedure: str, message: str, at: Column | None = None) -> None:
        if SEVERITIES.index(severity) < SEVERITIES.index(self.level):
            return
        event = spark.range(1).select(
            (F.current_timestamp() if at is None else at).alias("timestamp"),
            F.lit(severity).alias("severity"),
            F.lit(procedure).alias("procedure_name"),
            F.lit(message).alias("message"),
        )
        event.write.mode("append").parquet(self.path)

    def read(self, spark: SparkSession, severity: str | None = None) -> DataFrame:
        """The log, newest first."""
        storage.make_folder(spark, self.path)
        return scan_events(storage.read_table(spark, self.path, EVENT_LOG), "timestamp", "severity", severity)


def scan_events(events: DataFrame, time: str, severity_column: str, severity: str | None = None) -> DataFrame:
    """Any event table, newest first, of one severity if one is given."""
    wanted = events if severity is None else events.filter(F.col(severity_column) == severity)
    return newest_first(wanted, time, severity_column)
