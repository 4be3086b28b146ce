"""Positional CSV scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderloom.sources.stage import Stage, empty_scan


@dataclass(frozen=True)
class CsvFormat:
    """Named file format, shared by scans, loads and external tables.

    Fields are not enclosed unless ``quote`` is given: a quote character is then part of the value, and files can
    be split anywhere at a line end.
    """

    delimiter: str = ","
    skip_header: bool = True
    quote: str = ""

    def options(self) -> dict[str, str]:
        return {
            "sep": self.delimiter,
            "header": str(self.skip_header).lower(),
            "enforceSchema": "true",  # columns go by position; header names are not looked at
            "quote": self.quote,
            "mode": "FAILFAST",  # short, long or broken rows abort
        }


def ordinals(width: int) -> list[str]:
    return [f"c{i}" for i in range(1, width + 1)]


def text_schema(width: int) -> str:
    return ", ".join(f"{name} string" for name in ordinals(width))


def scan_csv(
    spark: SparkSession,
    stage: Stage,
    fmt: CsvFormat = CsvFormat(),
    prefix: str | None = None,
    width: int = 5,
    streaming: bool = False,
    paths: list[str] | None = None,
    **extra: str,
) -> DataFrame:
    """Untyped text columns ``c1..cN`` by position, with the lineage of each row.

    FAILFAST checks a row only when all of its columns are read, so whoever relies on the abort must use them all,
    as the load does. ``paths``, file URIs, read only some of the stage's files.
    """
    location = stage.location(spark, prefix) if paths is None else stage.readable(paths)
    if not location:
        return empty_scan(spark, text_schema(width))
    reader = spark.readStream if streaming else spark.read
    rows = reader.schema(text_schema(width)).options(**stage.options(), **fmt.options(), **extra).csv(location)
    return rows.select(*ordinals(width), *stage.lineage(spark))
