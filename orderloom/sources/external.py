"""External tables over CSV stages, and stored snapshots of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import storage, versions
from orderloom.functions.casts import strict_sql, typed_order_columns
from orderloom.functions.lineage import relative_file_name_sql
from orderloom.schema import FILE_COLUMNS, ORDER_COLUMNS, ORDERS
from orderloom.sources.csv_files import CsvFormat, ordinals, scan_csv, text_schema
from orderloom.sources.listing import list_stage
from orderloom.sources.stage import Stage

EXTERNAL_COLUMNS = ORDER_COLUMNS[:6]
SNAPSHOT = T.StructType([ORDERS[name] for name in EXTERNAL_COLUMNS])


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _files_of(name: str) -> str:
    return f"{name}_files"


def create_external_table(spark: SparkSession, name: str, stage: Stage, fmt: CsvFormat = CsvFormat()) -> None:
    """Register the files of a stage under a SQL name, with typed columns; nothing is loaded.

    ``name`` is a view over a table of the files' text columns. The catalog remembers the file listing, so new files are seen after ``refresh_external_table`` only.
    """
    options = {**stage.options(), **fmt.options()}
    listed = ", ".join(f"{_literal(key)} {_literal(value)}" for key, value in options.items())
    spark.sql(
        f"CREATE TABLE {_files_of(name)} ({text_schema(len(FILE_COLUMNS))}) USING csv OPTIONS ({listed}) "
        f"LOCATION {_literal(stage.root)}"
    )
    typed = [
        f"{strict_sql(c, ORDERS[column].dataType, column)} AS {column}"
        for c, column in zip(ordinals(len(FILE_COLUMNS)), FILE_COLUMNS, strict=True)
    ]
    file_name = relative_file_name_sql("_metadata.file_path", storage.encoded_path(spark, stage.root), stage.delivery)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(typed)}, {file_name} AS source_file_name FROM {_files_of(name)}")


def read_external_table(spark: SparkSession, name: str) -> DataFrame:
    """The typed columns, cast only where they are used."""
    return spark.table(name)


def refresh_external_table(spark: SparkSession, name: str) -> None:
    spark.catalog.refreshTable(_files_of(name))
    spark.catalog.refreshTable(name)


def drop_external_table(spark: SparkSession, name: str) -> None:
    """Forget the names; the files stay."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {_files_of(name)}")


def register_snapshot(spark: SparkSession, name: str, path: str) -> None:
    """Give a stored snapshot a SQL name; called again after a refresh, it shows the new one."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in SNAPSHOT.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, snapshot string) USING parquet PARTITIONED BY (snapshot) "
        f"LOCATION {_literal(path)}"
    )
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def refresh_snapshot(frame: DataFrame, path: str) -> None:
    """Store a projection as parquet; the former snapshot is there until the new one is committed."""
    rows = frame.select(*EXTERNAL_COLUMNS, F.lit("current").alias("snapshot"))
    storage.overwrite_all_of(rows, path, snapshot="current")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return storage.read_table(spark, path, SNAPSHOT).select(*EXTERNAL_COLUMNS)


# A projection kept by source file: a file that was read is not read again while its path, size and time stay the same.

FILE_KEY = T.StructField("file_key", T.StringType())


@dataclass(frozen=True)
class ProjectionDelta:
    """``rows`` are those of the files to read, None if there are none; ``fresh`` and ``gone`` are keys of files."""

    rows: DataFrame | None
    fresh: list[str]
    gone: list[str]


def _file_key() -> Column:
    return F.md5(F.concat_ws("|", "file_path", F.col("file_size").cast("string"), F.unix_micros("file_modification_time").cast("string")))


def projection_delta(spark: SparkSession, stage: Stage, path: str, fmt: CsvFormat = CsvFormat()) -> ProjectionDelta:
    """What a refresh has to read and to drop. The driver compares names of files, which it lists anyway."""
    listed = {row["key"]: row["file_path"] for row in list_stage(spark, stage).select(_file_key().alias("key"), "file_path").collect()}
    known = versions.current(spark, path).periods
    fresh = sorted(key for key in listed if key not in known)
    gone = sorted(key for key in known if key not in listed)
    if not fresh:
        return ProjectionDelta(None, fresh, gone)
    scanned = scan_csv(spark, stage, fmt, paths=[listed[key] for key in fresh])
    typed = typed_order_columns([F.col(c) for c in ordinals(len(FILE_COLUMNS))])
    return ProjectionDelta(scanned.select(*typed, "source_file_name", _file_key().alias(FILE_KEY.name)), fresh, gone)


def refresh_projection(spark: SparkSession, stage: Stage, path: str, fmt: CsvFormat = CsvFormat()) -> ProjectionDelta:
    """Bring the stored projection up to date: new and changed files are read, rows of files that are gone are dropped.

    Readers see the former state until the new one holds, all of it at once. A bad row fails the refresh, which changes
    nothing then.
    """
    versions.clean(spark, path)
    delta = projection_delta(spark, stage, path, fmt)
    if not delta.fresh and not delta.gone:
        return delta
    mark = None
    if delta.rows is not None:
        rows = delta.rows.withColumn(versions.PART, F.lit(versions.KEPT)).hint("rebalance", F.col(FILE_KEY.name))
        mark = versions.write(rows, path, FILE_KEY)
    versions.commit(spark, path, mark, empty=delta.fresh, gone=delta.gone)
    return delta


def read_projection(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path, SNAPSHOT, FILE_KEY).select(*EXTERNAL_COLUMNS)
