"""Incremental runs: each takes the files that arrived since the last one, merges them and ends.

The stream's checkpoint remembers the files already taken, so stages need not be purged, though they can be. A run is
started by whatever scheduler there is and works through what is there (``availableNow``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.load import (
    StagingTable,
    load_history,
    order_rows,
    raw_documents,
    read_staged_documents,
    read_staged_orders,
    record_load,
    without_taken,
    write_load,
)
from orderloom.operators.flatten import flattened_view
from orderloom.operators.merge import merge_orders
from orderloom.operators.summary import refresh_touched
from orderloom.sources.csv_files import CsvFormat, scan_csv
from orderloom.sources.json_files import DOCUMENT_PER_FILE, scan_json
from orderloom.sources.stage import Stage
from orderloom.storage import OrderTable, SummaryTable

MERGED = "_merged"


def purge_options(archive: str | None = None) -> dict[str, str]:
    """Source options that remove taken files, or move them. Spark does so after a later batch has begun."""
    if archive is None:
        return {"cleanSource": "delete"}
    return {"cleanSource": "archive", "sourceArchiveDir": archive}


def batch_load_id(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


def _run(
    rows: DataFrame,
    checkpoint: str,
    table: StagingTable,
    to_staging,
    from_staging,
    target: OrderTable,
    summary: SummaryTable | None,
    load_ts: Column | None,
    merge_options: dict,
) -> int:
    """Drain the stream batch by batch: stage, merge, summarise, and only then record the load.

    A batch that is repeated after a failure finds its record and is skipped, or has none and replaces its own
    staged rows. Its merge is published with the batch's id, so that it is not done again if only the record is missing.
    Files that a batch load has taken, or another stream into the same table, are left out.
    """

    taken = 0

    def take(batch: DataFrame, batch_id: int) -> None:
        nonlocal taken
        spark, load_id = batch.sparkSession, batch_load_id(batch_id)
        known = load_history(spark, table.history_path, table.schema_name, table.name)
        if not known.filter(F.col("load_id") == load_id).isEmpty():
            return
        at = F.current_timestamp() if load_ts is None else load_ts
        write_load(to_staging(without_taken(spark, batch, table, load_id), at), table, load_id)
        merge_id = f"{table.schema_name}.{table.name}.{load_id}"
        merged = merge_orders(spark, target, from_staging(spark, table, load_id), merge_id=merge_id, **merge_options)
        if summary is not None:
            refresh_touched(spark, target, summary, merged.periods, merged.has_null_period)
        taken += record_load(spark, table, load_id, None, at).rows

    query = (
        rows.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return taken


def ingest_csv(
    spark: SparkSession,
    stage: Stage,
    table: StagingTable,
    target: OrderTable,
    checkpoint: str,
    summary: SummaryTable | None = None,
    fmt: CsvFormat = CsvFormat(),
    load_ts: Column | None = None,
    source_options: dict[str, str] | None = None,
    **merge_options,
) -> int:
    """Take the new CSV files of a stage; ``source_options`` are those of Spark's file stream, such as
    ``maxFilesPerTrigger`` or ``purge_options()``."""
    rows = scan_csv(spark, stage, fmt, streaming=True, **(source_options or {}))
    return _run(
        rows, checkpoint, table, order_rows, read_staged_orders, target, summary, load_ts, merge_options
    )


def ingest_json(
    spark: SparkSession,
    stage: Stage,
    table: StagingTable,
    target: OrderTable,
    checkpoint: str,
    summary: SummaryTable | None = None,
    layout: str = DOCUMENT_PER_FILE,
    load_ts: Column | None = None,
    source_options: dict[str, str] | None = None,
    **merge_options,
) -> int:
    """Take the new documents of a stage: staged raw, flattened on the way into the merge."""

    def flattened(session: SparkSession, staged: StagingTable, load_id: str) -> DataFrame:
        return flattened_view(read_staged_documents(session, staged, load_id))

    rows = scan_json(spark, stage, layout, streaming=True, **(source_options or {}))
    return _run(rows, checkpoint, table, raw_documents, flattened, target, summary, load_ts, merge_options)
