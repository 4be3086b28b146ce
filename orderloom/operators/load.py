"""Bulk load of stage files into staging tables, with load history and purge.

A staging table is a folder with one ``load_id=..`` partition per load. A load writes its own partition only, as one
job: if any row is bad the job fails and nothing is published, and a load repeated under its id replaces
itself instead of adding its rows again. Files that another load has taken, by path, size and time, are left out unless
asked for with ``force``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import storage
from orderloom.functions.casts import typed_order_columns
from orderloom.operators.rejects import csv_rejects, write_rejects
from orderloom.schema import FILE_COLUMNS, FILE_FIELDS, LOAD_HISTORY, LOAD_ID, ORDERS, RAW_DOCUMENTS, with_fields
from orderloom.session import scans_spread
from orderloom.sources.csv_files import CsvFormat, ordinals, scan_csv
from orderloom.sources.json_files import DOCUMENT_PER_FILE, scan_json
from orderloom.sources.listing import list_stage
from orderloom.sources.stage import Stage


# States of a file in the history. Files that are staged only are not taken yet: their run may still fail.
LOADED, STAGED = "LOADED", "STAGED"
_STAGED_FILES = T.StructType([ORDERS["source_file_name"], *FILE_FIELDS, LOAD_ID])


@dataclass(frozen=True)
class StagingTable:
    """``schema_name`` and ``name`` identify the table in the load history kept under ``history_path``."""

    path: str
    schema_name: str
    name: str
    history_path: str


@dataclass(frozen=True)
class LoadResult:
    load_id: str
    rows: int
    files: int


def _file_columns() -> list[str]:
    return [field.name for field in FILE_FIELDS]


def order_rows(scanned: DataFrame, load_ts: Column) -> DataFrame:
    """Scanned text ordinals -> typed order rows with lineage and load time."""
    columns = [F.col(c) for c in ordinals(len(FILE_COLUMNS))]
    return scanned.select(
        *typed_order_columns(columns), "source_file_name", load_ts.alias("load_ts"), *_file_columns()
    )


def raw_documents(scanned: DataFrame, load_ts: Column) -> DataFrame:
    return scanned.select("customer_orders", "source_file_name", load_ts.alias("load_ts"), *_file_columns())


def read_staged_orders(spark: SparkSession, table: StagingTable, load_id: str | None = None) -> DataFrame:
    return _read_staged(spark, table, ORDERS, load_id)


def read_staged_documents(spark: SparkSession, table: StagingTable, load_id: str | None = None) -> DataFrame:
    return _read_staged(spark, table, RAW_DOCUMENTS, load_id)


def _read_staged(spark, table, schema, load_id) -> DataFrame:
    storage.make_folder(spark, table.path)
    rows = storage.read_table(spark, table.path, with_fields(schema, LOAD_ID))
    if load_id is not None:
        rows = rows.filter(F.col(LOAD_ID.name) == load_id)
    return rows.select(*schema.fieldNames())


def write_load(rows: DataFrame, table: StagingTable, load_id: str) -> int:
    """Materialise all columns of every row; this is what makes bad rows abort. The rows of a former load of this id are
    there until the new ones are committed."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load_id):
        raise ValueError(f"load id {load_id!r} cannot name a folder")
    tagged = rows.withColumn(LOAD_ID.name, F.lit(load_id))
    return storage.overwrite_all_of(tagged, table.path, **{LOAD_ID.name: load_id})


def load_csv(
    spark: SparkSession,
    stage: Stage,
    table: StagingTable,
    load_id: str,
    fmt: CsvFormat = CsvFormat(),
    prefix: str | None = None,
    load_ts: Column | None = None,
    force: bool = False,
    status: str = LOADED,
    rejects: str | None = None,
) -> LoadResult:
    """Append the stage's new files to a staging table, or fail as a whole. ``status`` is what the history says of them.

    With ``rejects``, the path of a table, a load that fails leaves all of its bad rows there before it raises.
    """
    load_ts = F.current_timestamp() if load_ts is None else load_ts
    listed, paths = _new_files(spark, stage, prefix, table, load_id, force)
    try:
        with scans_spread(spark):
            write_load(order_rows(scan_csv(spark, stage, fmt, prefix, paths=paths), load_ts), table, load_id)
    except Exception:
        if rejects:
            found = csv_rejects(spark, stage, fmt, prefix, paths)
            write_rejects(found, rejects, table.schema_name, table.name, load_id)
        raise
    return record_load(spark, table, load_id, listed, load_ts, status)


def load_json(
    spark: SparkSession,
    stage: Stage,
    table: StagingTable,
    load_id: str,
    layout: str = DOCUMENT_PER_FILE,
    prefix: str | None = None,
    load_ts: Column | None = None,
    force: bool = False,
) -> LoadResult:
    """Append the stage's new documents, unflattened, to a raw staging table, or fail as a whole."""
    load_ts = F.current_timestamp() if load_ts is None else load_ts
    listed, paths = _new_files(spark, stage, prefix, table, load_id, force)
    documents = raw_documents(scan_json(spark, stage, layout, prefix, paths=paths), load_ts)
    with scans_spread(spark):
        write_load(documents, table, load_id)
    return record_load(spark, table, load_id, listed, load_ts)


def _new_files(
    spark: SparkSession, stage: Stage, prefix: str | None, table: StagingTable, load_id: str, force: bool
) -> tuple[DataFrame, list[str] | None]:
    """The files to load, and their paths if they are not simply all that are there.

    A file scan lists its files when it is defined. Listing before the scan means that a file without rows is recorded,
    hence purged, only if it was there before. The paths that reach the driver are those of one delivery.
    """
    listed = list_stage(spark, stage, prefix)
    if force:
        return listed, None
    known = taken_files(spark, table, load_id)
    if known.isEmpty():
        return listed, None
    new = listed.join(known, _file_columns(), "left_anti")
    return new, [row["file_path"] for row in new.select("file_path").collect()]


def taken_files(spark: SparkSession, table: StagingTable, load_id: str) -> DataFrame:
    """Files that other loads than this one have taken, whether in batches or in a stream."""
    history = load_history(spark, table.history_path, table.schema_name, table.name)
    return history.where((F.col("load_id") != load_id) & (F.col("status") == LOADED)).select(*_file_columns())


def without_taken(spark: SparkSession, rows: DataFrame, table: StagingTable, load_id: str) -> DataFrame:
    """Scanned rows but for those of files that another load has taken."""
    known = taken_files(spark, table, load_id)
    return rows if known.isEmpty() else rows.join(known.distinct(), _file_columns(), "left_anti")


def record_load(
    spark: SparkSession,
    table: StagingTable,
    load_id: str,
    listed: DataFrame | None,
    load_ts: Column,
    status: str = LOADED,
) -> LoadResult:
    """Write the history of one load: a row per file, counted from what was written.

    A stream knows no listing, so files without rows are in the history of batch loads only.
    """
    columns = ["source_file_name", *_file_columns()]
    staged_rows = storage.read_table(spark, table.path, _STAGED_FILES).where(F.col(LOAD_ID.name) == load_id)
    counted = staged_rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("counted"))
    # A file has one name, size and time, so joining on all is joining on the path.
    files = counted if listed is None else listed.join(counted, columns, "full_outer")
    history = files.select(
        "file_path",
        "source_file_name",
        F.col("file_size").cast("long").alias("file_size"),
        F.col("file_modification_time").cast("timestamp").alias("file_modification_time"),
        F.coalesce("counted", F.lit(0)).alias("row_count"),
        F.lit(status).alias("status"),
        load_ts.alias("last_load_time"),
    )
    place = _place(table, load_id)
    written = Observation()
    observed = history.observe(written, F.sum("row_count").alias("rows"))
    files_written = storage.overwrite_all_of(
        observed.withColumns({name: F.lit(value) for name, value in place.items()}), table.history_path, **place
    )
    return LoadResult(load_id, written.get["rows"] or 0, files_written)


def _place(table: StagingTable, load_id: str) -> dict[str, str]:
    return {"schema_name": table.schema_name, "table_name": table.name, "load_id": load_id}


def _history_of(spark: SparkSession, table: StagingTable, load_id: str) -> DataFrame:
    history = load_history(spark, table.history_path, table.schema_name, table.name)
    return history.filter(F.col("load_id") == load_id)


def mark_loaded(spark: SparkSession, table: StagingTable, load_id: str) -> LoadResult:
    """Let the files of a load count as taken; returns what the history has of it."""
    rows, written = _history_of(spark, table, load_id).withColumn("status", F.lit(LOADED)), Observation()
    observed = rows.observe(written, F.sum("row_count").alias("rows"))
    files = storage.overwrite_all_of(observed, table.history_path, **_place(table, load_id))
    return LoadResult(load_id, written.get["rows"] or 0, files)


def forget_load(spark: SparkSession, table: StagingTable, load_id: str) -> None:
    """Drop the staged rows and the history of a load that came to nothing."""
    place = "/".join(f"{name}={value}" for name, value in _place(table, load_id).items())
    storage.delete(spark, f"{table.history_path}/{place}")
    storage.delete(spark, f"{table.path}/{LOAD_ID.name}={load_id}")


def load_history(spark: SparkSession, history_path: str, schema_name: str, table_name: str) -> DataFrame:
    """Files loaded into one table. Schema and table are partitions, so only their files are read."""
    storage.make_folder(spark, history_path)
    return storage.read_table(spark, history_path, LOAD_HISTORY).filter(
        (F.col("schema_name") == schema_name) & (F.col("table_name") == table_name)
    ).select(*LOAD_HISTORY.fieldNames())


def purge_loaded(spark: SparkSession, table: StagingTable, load_id: str) -> int:
    """Delete the files of one load from their stage; to be called once their rows have been merged.

    The names come from the history a partition at a time; files delivered since the load are not in it.
    """
    files = _history_of(spark, table, load_id)
    uris = (row["file_path"] for row in files.select("file_path").toLocalIterator())
    return storage.delete_file_uris(spark, uris)


def truncate_staging(spark: SparkSession, table: StagingTable) -> None:
    """Empty a staging table. Its load history stays."""
    storage.truncate(spark, table.path)
