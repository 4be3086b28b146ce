"""The whole run: files -> staging -> merge -> summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.ledger import ABANDONED, DONE, MERGED, STAGED, STARTED, SUMMARISED, Run
from orderloom.operators.load import (
    LoadResult,
    forget_load,
    load_csv,
    load_json,
    mark_loaded,
    purge_loaded,
    read_staged_orders,
    truncate_staging,
)
from orderloom.operators.load import STAGED as STAGED_ONLY
from orderloom.operators.merge import MergeResult, changes, merge_orders
from orderloom.operators.summary import refresh_from_changes, refresh_summary, refresh_touched
from orderloom.plans.jobs import JobStatus, load_customer_orders, load_customer_summary_orders
from orderloom.plans.workspace import Workspace
from orderloom.sources.csv_files import CsvFormat
from orderloom.sources.json_files import DOCUMENT_PER_FILE
from orderloom.sources.stage import Stage


PROCESS = "PROCESS_ORDERS"


@dataclass(frozen=True)
class IngestResult:
    load: LoadResult
    merge: MergeResult
    summary_rows: int
    purged_files: int


def process_orders(
    spark: SparkSession,
    workspace: Workspace,
    stage: Stage,
    load_id: str,
    fmt: CsvFormat = CsvFormat(),
    purge: bool = True,
    load_ts: Column | None = None,
    summary: str = "full",
    force: bool = False,
    **merge_options,
) -> IngestResult:
    """One run over the internal stage; whatever scheduler there is calls it. Inserted rows are stamped with the day, unless
    ``insert_ts`` says otherwise.

    A run begins by finishing those that have failed before, whatever their load ids, with the options given now. One that had
    staged its files is merged from there; one that had not is given up, and its files are loaded with the new ones. A run that
    finishes an unfinished one of its own id ends with that; what was delivered since is left to the next. Files are purged last,
    when their rows are in the order table. ``summary`` is refilled (``full``), or brought up to date by the periods touched
    (``touched``) or by the rows changed (``changes``).
    """
    if summary not in ("full", "touched", "changes"):
        raise ValueError(f"unknown summary refresh {summary!r}")
    merge_options.setdefault("insert_ts", F.current_date().cast("timestamp"))
    table, ledger = workspace.internal_staging, workspace.run_ledger
    for run in ledger.unfinished(spark, PROCESS):
        if run.state == STARTED:
            forget_load(spark, table, run.load_id)
            ledger.write(spark, run, ABANDONED)
            continue
        result = _finish(spark, workspace, run, purge, summary, merge_options)
        if run.load_id == load_id:
            return result
    run = ledger.start(spark, PROCESS, load_id)
    truncate_staging(spark, table)
    load_csv(
        spark, stage, table, load_id, fmt, load_ts=load_ts, force=force, status=STAGED_ONLY,
        rejects=workspace.rejects_path,
    )
    run = ledger.write(spark, run, STAGED)
    return _finish(spark, workspace, run, purge, summary, merge_options)


def _finish(
    spark: SparkSession, workspace: Workspace, run: Run, purge: bool, summary: str, merge_options: dict
) -> IngestResult:
    """What is left of a run whose rows are staged. Each step can be repeated: the merge and the changes of the summary are
    published with the run's token, and known by it."""
    table, target, ledger = workspace.internal_staging, workspace.customer_orders, workspace.run_ledger
    merged = merge_orders(spark, target, read_staged_orders(spark, table, run.load_id), merge_id=run.token, **merge_options)
    loaded = mark_loaded(spark, table, run.load_id)
    if not run.reached(MERGED):
        run = ledger.write(spark, run, MERGED)
    rows = _summarised(spark, workspace, run, merged, summary)
    if not run.reached(SUMMARISED):
        run = ledger.write(spark, run, SUMMARISED)
    purged = purge_loaded(spark, table, run.load_id) if purge else 0
    ledger.write(spark, run, DONE)
    return IngestResult(loaded, merged, rows, purged)


def _summarised(spark: SparkSession, workspace: Workspace, run: Run, merged: MergeResult, summary: str) -> int:
    target, table = workspace.customer_orders, workspace.summary_orders
    if summary == "touched":
        return refresh_touched(spark, target, table, merged.periods, merged.has_null_period)
    if summary == "changes":
        try:
            return refresh_from_changes(spark, changes(spark, target, merged.version), table, run.token)
        except LookupError:  # other merges have been published since; their changes are in the table as well
            pass
    return refresh_summary(spark, target.read(spark), table)


def load_feeds(
    spark: SparkSession,
    workspace: Workspace,
    internal: Stage,
    external: Stage,
    documents: Stage,
    load_id: str,
    layout: str = DOCUMENT_PER_FILE,
    fmt: CsvFormat = CsvFormat(),
    load_ts: Column | None = None,
    force: bool = False,
) -> dict[str, LoadResult]:
    """Load the new files of all three feeds into their staging tables."""
    common = {"load_ts": load_ts, "force": force}
    return {
        "internal": load_csv(spark, internal, workspace.internal_staging, load_id, fmt, **common),
        "external": load_csv(spark, external, workspace.external_staging, load_id, fmt, **common),
        "documents": load_json(spark, documents, workspace.document_staging, load_id, layout, **common),
    }


def process_combined(spark: SparkSession, workspace: Workspace, **merge_options) -> tuple[JobStatus, JobStatus]:
    """Merge what the three staging tables hold, then refill the summary. Both jobs report a status."""
    log = workspace.event_log
    target = workspace.customer_orders_combined
    merged = load_customer_orders(spark, lambda: workspace.combined_staging(spark), target, log, **merge_options)
    return merged, load_customer_summary_orders(spark, target, workspace.summary_orders_combined, log)
