"""Summary, ordering, jobs, whole runs and streams."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import ABORTS, deliver, deliver_text, rows
from orderloom.operators.combine import combine_feeds
from orderloom.operators.load import load_csv, load_history, read_staged_orders
from orderloom.operators.merge import MergeCardinalityError, changes, merge_orders
from orderloom.operators.ordering import newest_first, orders_newest_first
from orderloom.operators.summary import (
    refresh_from_changes,
    refresh_summary,
    refresh_touched,
    summarise,
    summarise_group_by_all,
)
from orderloom.plans import ingest
from orderloom.plans.ingest import load_feeds, process_combined, process_orders
from orderloom.plans.jobs import load_customer_orders
from orderloom.sources.stage import Stage
from orderloom.storage import OrderTable, SummaryTable
from orderloom.streaming import ingest as streaming
from orderloom.streaming.ingest import ingest_csv, ingest_json, purge_options
from samples import DAYS, DOCUMENT, csv_lines, csv_name
from test_merge import FIRST, content, frame, order


def totals(spark, table):
    return {(str(r[0]), r[1]): None if r[2] is None else int(r[2]) for r in table.read(spark).collect()}


def names(stage):
    return sorted(p.name for p in Path(stage.root).rglob("Orders*"))


# Summary


def test_sums_skip_nulls_and_keep_null_groups(spark):
    big = 10**37
    orders = frame(spark, order(quantity=2), order("B", quantity=None), order(kind=None), order(kind=None, quantity=5),
                   order(delivery=None), order(kind="Bun", quantity=None), order("C", quantity=0))
    is_c = F.col("customer") == "C"
    orders = orders.withColumn("quantity", F.when(is_c, F.lit(str(big)).cast("decimal(38,0)")).otherwise(F.col("quantity")))
    got = summarise(orders)
    assert dict(got.dtypes)["total_quantity"] == "decimal(38,0)"
    assert rows(got) == rows(summarise_group_by_all(orders))
    assert {(str(r[0]), r[1]): None if r[2] is None else int(r[2]) for r in got.collect()} == {
        ("2023-08-08", "Rye"): big + 2,
        ("2023-08-08", None): 6,
        ("None", "Rye"): 1,
        ("2023-08-08", "Bun"): None,
    }


def test_full_refresh_leaves_nothing_of_the_former(spark, tmp_path):
    table = SummaryTable(str(tmp_path / "summary"))
    old = frame(spark, order(delivery="2021-01-01"), order(delivery=None), order(quantity=3))
    assert refresh_summary(spark, old, table) == 3
    assert refresh_summary(spark, frame(spark, order(quantity=4)), table) == 1
    assert totals(spark, table) == {("2023-08-08", "Rye"): 4}
    assert refresh_summary(spark, frame(spark), table) == 0
    assert totals(spark, table) == {}


def test_failing_refresh_keeps_the_former(spark, tmp_path):
    table = SummaryTable(str(tmp_path / "summary"))
    refresh_summary(spark, frame(spark, order(quantity=3)), table)
    broken = frame(spark, order()).withColumn("quantity", F.raise_error(F.lit("lost")).cast("decimal(38,0)"))
    with pytest.raises(ABORTS):
        refresh_summary(spark, broken, table)
    assert totals(spark, table) == {("2023-08-08", "Rye"): 3}


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_touched_refresh_equals_full_refresh(spark, tmp_path, grain):
    target = OrderTable(str(tmp_path / "orders"), grain).create(spark)
    part, full = SummaryTable(str(tmp_path / "part")), SummaryTable(str(tmp_path / "full"))
    days = ["2022-12-31", "2023-01-01", "2023-01-02", "2023-02-01", None]
    merge_orders(spark, target, frame(spark, *(order(c, d, quantity=i) for i, d in enumerate(days) for c in "AB")))
    refresh_summary(spark, target.read(spark), part)
    changes = frame(spark, order("A", "2023-01-02", quantity=50), order("C", None, quantity=60), order("A", "2024-01-01"))
    merged = merge_orders(spark, target, changes)
    refresh_touched(spark, target, part, merged.periods, merged.has_null_period)
    refresh_summary(spark, target.read(spark), full)
    assert totals(spark, part) == totals(spark, full)
    assert totals(spark, part)[("2023-01-02", "Rye")] == 52
    assert refresh_touched(spark, target, part, [], False) == 0


# Ordering and union


def test_newest_first(spark):
    days = ["2023-08-02", None, "2023-08-09", "2023-08-02", "2023-08-05"]
    got = orders_newest_first(frame(spark, *(order(str(i), d) for i, d in enumerate(days)))).collect()
    assert [str(r["delivery_date"]) for r in got] == ["None", "2023-08-09", "2023-08-05", "2023-08-02", "2023-08-02"]


def test_a_crowded_day_is_sorted_by_several_tasks(spark):
    crowded = spark.range(40000).select(F.lit("2023-08-02").cast("date").alias("day"), F.lit("x").alias("kind"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        by_task = newest_first(crowded, "day", "kind").withColumn("task", F.spark_partition_id()).groupBy("task").count()
        sizes = [r["count"] for r in by_task.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 40000
    assert max(sizes) < 20000


def test_union_keeps_duplicates_and_goes_by_name(spark):
    one = frame(spark, order())
    other = one.select(*reversed(one.columns))
    assert combine_feeds(one, other, one).count() == 3
    assert len(set(rows(combine_feeds(one, other)))) == 1


# Jobs and runs


@pytest.fixture
def feeds(spark, tmp_path):
    """The samples, split over three stages."""
    stages = [Stage(str(tmp_path / name)) for name in ("internal", "external", "documents")]
    deliver(stages[0], csv_name("2023-08-04"), *csv_lines("2023-08-04"))
    deliver(stages[1], csv_name("2023-08-07"), *csv_lines("2023-08-07"))
    deliver(stages[1], csv_name("2023-08-08"), *csv_lines("2023-08-08"))
    deliver_text(stages[2], "Orders_2023-08-11.json", json.dumps(DOCUMENT, indent="\t"))
    return stages


def test_literal_merge_of_the_union_double_counts_then_is_refused(spark, workspace, feeds):
    load_feeds(spark, workspace, *feeds, "l1")
    combined = workspace.combined_staging(spark)
    assert (combined.count(), combined.agg(F.sum("quantity")).first()[0]) == (33, 532)
    merged, refilled = process_combined(spark, workspace)
    assert (merged.ok, merged.message) == (True, "Load Completed. 33 rows affected.")
    assert (refilled.ok, refilled.message) == (True, "Load completed. 25 rows inserted.")
    summary = totals(spark, workspace.summary_orders_combined)
    assert sum(summary.values()) == 532 and summary[("2023-08-08", "Baguette")] == 24
    before = content(spark, workspace.customer_orders_combined)
    again, _ = process_combined(spark, workspace)
    assert not again.ok
    assert again.message.startswith("Load failed with error message: 8 keys")
    assert content(spark, workspace.customer_orders_combined) == before


def test_last_merge_of_the_union_counts_once(spark, workspace, feeds):
    load_feeds(spark, workspace, *feeds, "l1")
    for _ in range(2):
        merged, _ = process_combined(spark, workspace, on_duplicate="last")
        assert merged.message == "Load Completed. 25 rows affected."
        summary = totals(spark, workspace.summary_orders_combined)
        assert sum(summary.values()) == 427 and summary[("2023-08-08", "Baguette")] == 12
    log = rows(workspace.event_log.read(spark), "severity", "message")
    assert [m for _, m in log] == ["LOAD_CUSTOMER_ORDERS begin"] * 2 + ["LOAD_CUSTOMER_SUMMARY_ORDERS begin"] * 2


def test_errors_become_statuses_and_are_logged(spark, workspace):
    def broken():
        raise RuntimeError("no source")

    status = load_customer_orders(spark, broken, workspace.customer_orders_combined, workspace.event_log)
    assert (status.ok, status.message) == (False, "Load failed with error message: no source")
    assert [r[0] for r in rows(workspace.event_log.read(spark, "ERROR"), "message")] == [status.message]
    newest = [r["severity"] for r in workspace.event_log.read(spark).collect()]
    assert newest == ["ERROR", "DEBUG"]


def test_daily_runs_over_the_internal_stage(spark, workspace, stage):
    counts = []
    for number, day in enumerate(DAYS):
        deliver(stage, csv_name(day), *csv_lines(day))
        mode = "full" if number == 1 else "touched"
        result = process_orders(spark, workspace, stage, f"run{number}", summary=mode)
        counts.append((result.merge.inserted, result.merge.updated, result.purged_files, result.load.rows))
        assert names(stage) == []
    assert counts == [(8, 0, 1, 8), (4, 4, 1, 8), (4, 4, 1, 8)]
    documents = Stage(f"{workspace.root}/documents")
    deliver_text(documents, "Orders_2023-08-11.json", json.dumps(DOCUMENT))
    load_feeds(spark, workspace, stage, stage, documents, "l1")
    merged = merge_orders(spark, workspace.customer_orders, workspace.document_orders(spark))
    assert (merged.inserted, merged.updated) == (9, 0)
    refresh_touched(spark, workspace.customer_orders, workspace.summary_orders, merged.periods, merged.has_null_period)
    kept = workspace.customer_orders.read(spark).filter("delivery_date = '2023-08-08'")
    assert {(str(r[1]), r[5]) for r in kept.collect()} == {("2023-08-04", "Orders_2023-08-07.csv")}
    summary = totals(spark, workspace.summary_orders)
    assert (len(summary), sum(summary.values())) == (25, 427)


def test_failing_run_keeps_the_files_and_can_be_repeated(spark, workspace, stage, monkeypatch):
    deliver(stage, csv_name("2023-08-04"), *csv_lines("2023-08-04"))

    def lost(*_, **__):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "merge_orders", lost)
        with pytest.raises(RuntimeError):
            process_orders(spark, workspace, stage, "run")
    assert names(stage) == [csv_name("2023-08-04")]
    assert process_orders(spark, workspace, stage, "run").merge.inserted == 8
    assert names(stage) == []


class Lost(RuntimeError):
    pass


def lost(*_, **__):
    raise Lost("executor lost")


@pytest.mark.parametrize("step", ["load_csv", "merge_orders", "mark_loaded", "_summarised", "purge_loaded"])
@pytest.mark.parametrize("summary", ["full", "changes"])
def test_next_run_finishes_what_a_failed_one_has_left(spark, workspace, stage, monkeypatch, step, summary):
    deliver(stage, "a.csv", *csv_lines("2023-08-04"), ",,,,3")  # the last row lacks its keys: merged twice, it would be there twice
    with monkeypatch.context() as patched:
        patched.setattr(ingest, step, lost)
        with pytest.raises(Lost):
            process_orders(spark, workspace, stage, "2024-01-01", summary=summary, on_duplicate="last")
    assert names_of_files(stage) == ["a.csv"]
    deliver(stage, "b.csv", *csv_lines("2023-08-07"))
    second = process_orders(spark, workspace, stage, "2024-01-02", summary=summary, on_duplicate="last")
    assert second.merge.affected == (13 if step == "load_csv" else 8)
    assert names_of_files(stage) == []
    merged = workspace.customer_orders.read(spark)
    assert merged.count() == 13 and merged.where("customer IS NULL").count() == 1
    assert sum(totals(spark, workspace.summary_orders).values()) == merged.agg(F.sum("quantity")).first()[0]
    states = {row["load_id"]: row["state"] for row in workspace.run_ledger.runs(spark).collect()}
    assert states == {"2024-01-01": "ABANDONED" if step == "load_csv" else "DONE", "2024-01-02": "DONE"}
    assert workspace.run_ledger.unfinished(spark, ingest.PROCESS) == []
    history = load_history(spark, workspace.history_path, "orders", "orders_stg")
    assert {row["status"] for row in history.collect()} == {"LOADED"}


def names_of_files(stage):
    return sorted(p.name for p in Path(stage.root).rglob("*.csv"))


def test_a_refused_merge_is_finished_with_the_next_runs_options(spark, workspace, stage):
    deliver(stage, "a.csv", *csv_lines("2023-08-04"))
    process_orders(spark, workspace, stage, "1")
    deliver(stage, "b.csv", *csv_lines("2023-08-04"), *csv_lines("2023-08-04"))
    for load_id in ("2", "3"):
        with pytest.raises(MergeCardinalityError):
            process_orders(spark, workspace, stage, load_id)
    assert names_of_files(stage) == ["b.csv"]
    result = process_orders(spark, workspace, stage, "4", on_duplicate="last")
    assert (result.load.rows, names_of_files(stage)) == (0, [])
    assert workspace.customer_orders.read(spark).count() == 8


def test_merge_of_an_id_is_done_once(spark, workspace):
    target = workspace.customer_orders
    source = frame(spark, order(), order(None, quantity=7))
    first = merge_orders(spark, target, source, merge_id="run-1")
    again = merge_orders(spark, target, source, merge_id="run-1")
    assert (first.repeated, again.repeated) == (False, True)
    assert (again.inserted, again.updated, again.periods, again.version) == (2, 0, first.periods, first.version)
    for number in range(4):  # its version is dropped, not what is known of it
        merge_orders(spark, target, frame(spark, order(quantity=number)))
    assert merge_orders(spark, target, source, merge_id="run-1").inserted == 2
    assert merge_orders(spark, target, frame(spark), merge_id="empty").affected == 0
    assert merge_orders(spark, target, source, merge_id="empty").repeated
    assert target.read(spark).count() == 2
    with pytest.raises(ValueError):
        merge_orders(spark, target, source, merge_id="a/b")
    with pytest.raises(LookupError):
        changes(spark, target, first.version)


@pytest.mark.parametrize("grain", ["day", "year"])
def test_summary_from_changes_equals_full_refresh(spark, tmp_path, grain):
    target = OrderTable(str(tmp_path / "orders"), grain).create(spark)
    kept, full = SummaryTable(str(tmp_path / "kept")), SummaryTable(str(tmp_path / "full"))
    days = ["2022-12-31", "2023-01-01", "2023-01-02", None]
    batches = [
        [order(c, d, quantity=i) for i, d in enumerate(days) for c in "AB"] + [order("N", quantity=None)],
        [order("A", "2023-01-02", quantity=50), order("C", None, quantity=60), order("A", "2024-01-01"), order("N", quantity=4)],
        [order("N", quantity=None), order("A", "2023-01-01", quantity=None), order("B", "2023-01-01", quantity=None), order(None)],
        [],
    ]
    assert refresh_from_changes(spark, changes(spark, target), kept) == 0
    for number, batch in enumerate(batches):
        merged = merge_orders(spark, target, frame(spark, *batch))
        for _ in range(2):  # the second time nothing is added, as the id is known
            if merged.version:
                refresh_from_changes(spark, changes(spark, target, merged.version), kept, f"change-{number}")
        refresh_summary(spark, target.read(spark), full)
        assert totals(spark, kept) == totals(spark, full)
    assert rows(kept.read_partitioned(spark)) == rows(full.read_partitioned(spark))
    assert totals(spark, kept)[("2023-01-01", "Rye")] is None


def test_changes_are_read_without_the_other_rows(spark, tmp_path):
    target = OrderTable(str(tmp_path / "orders"), "year").create(spark)
    merge_orders(spark, target, frame(spark, *(order(str(i)) for i in range(50))))
    merged = merge_orders(spark, target, frame(spark, order("7", quantity=9), order("new")))
    changed = changes(spark, target, merged.version)
    assert rows(changed, "customer", "quantity", "merge_op", "old_quantity") == rows(
        spark.sql("SELECT '7', 9BD, 'update', 1BD UNION ALL SELECT 'new', 1BD, 'insert', NULL")
    )
    assert all("/part=changed/" in name for name in changed.inputFiles())
    assert target.read(spark).count() == 51


def test_tables_can_be_queried_by_name(spark, workspace, feeds):
    load_feeds(spark, workspace, *feeds, "l1")
    workspace.register(spark, "shop")
    assert spark.sql("SELECT sum(quantity) FROM shop.orders_combined_stg").first()[0] == 532
    process_combined(spark, workspace, on_duplicate="last")
    workspace.refresh(spark, "shop")
    assert spark.sql("SELECT sum(total_quantity) FROM shop.summary_orders_combined").first()[0] == 427
    assert spark.sql("SELECT * FROM shop.event_log ORDER BY timestamp DESC").count() == 2
    assert spark.sql("SELECT * FROM shop.load_history WHERE table_name = 'orders_external_stg'").count() == 2
    fresh = type(workspace)(workspace.root + "-new").create(spark)
    fresh.register(spark, "shop", replace=True)
    assert spark.table("shop.orders_combined_stg").count() == 0
    OrderTable(workspace.customer_orders_combined.path).create(spark, replace=True)
    assert workspace.customer_orders_combined.read(spark).count() == 0
    spark.sql("DROP DATABASE shop CASCADE")


# Streams


def run_stream(spark, workspace, stage, **options):
    return ingest_csv(
        spark, stage, workspace.external_staging, workspace.customer_orders, f"{workspace.root}/checkpoint",
        workspace.summary_orders, merge_ts=F.lit(FIRST), **options,
    )


def test_stream_takes_new_files_once(spark, workspace, stage):
    days = list(DAYS)
    deliver(stage, csv_name(days[0]), *csv_lines(days[0]))
    assert run_stream(spark, workspace, stage) == 8
    state = content(spark, workspace.customer_orders), totals(spark, workspace.summary_orders)
    assert run_stream(spark, workspace, stage) == 0
    assert state == (content(spark, workspace.customer_orders), totals(spark, workspace.summary_orders))
    deliver(stage, csv_name(days[1]), *csv_lines(days[1]))
    deliver(stage, csv_name(days[2]), *csv_lines(days[2]))
    assert run_stream(spark, workspace, stage, source_options={"maxFilesPerTrigger": "1"}) == 16
    summary = totals(spark, workspace.summary_orders)
    assert (len(summary), sum(summary.values())) == (16, 244)
    table = workspace.external_staging
    history = load_history(spark, workspace.history_path, table.schema_name, table.name)
    assert rows(history, "load_id", "row_count") == [(f"batch-{i:012d}", 8) for i in range(3)]


def test_all_rows_of_a_long_run_are_counted(spark, workspace, stage):
    """Spark keeps the progress of some batches only."""
    for day in DAYS:
        deliver(stage, csv_name(day), *csv_lines(day))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        assert run_stream(spark, workspace, stage, source_options={"maxFilesPerTrigger": "1"}) == 24
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    table = workspace.external_staging
    history = load_history(spark, workspace.history_path, table.schema_name, table.name)
    assert history.where("file_size > 0 and file_modification_time is not null").count() == 3


def test_repeated_batch_is_not_merged_again(spark, workspace, stage):
    deliver(stage, "a.csv", "A,2023-08-01,2023-08-02,,1")  # lacks a key: merging it again would add a row
    run_stream(spark, workspace, stage)
    commits = Path(workspace.root, "checkpoint", "commits")
    for name in ("0", ".0.crc"):
        (commits / name).rename(commits.parent / f"undone{name}")  # as if the run had ended before its commit
    run_stream(spark, workspace, stage)
    assert workspace.customer_orders.read(spark).count() == 1


def test_batch_that_fails_between_merge_and_record_is_merged_once(spark, workspace, stage, monkeypatch):
    deliver(stage, "a.csv", "A,2023-08-01,2023-08-02,,1", "B,2023-08-01,2023-08-02,Rye,2")
    with monkeypatch.context() as patched:
        patched.setattr(streaming, "record_load", lost)
        with pytest.raises(Exception, match="executor lost"):
            run_stream(spark, workspace, stage)
    assert workspace.customer_orders.read(spark).count() == 2
    run_stream(spark, workspace, stage)
    assert workspace.customer_orders.read(spark).count() == 2
    assert totals(spark, workspace.summary_orders) == {("2023-08-02", None): 1, ("2023-08-02", "Rye"): 2}


def test_batches_and_streams_share_a_history(spark, workspace, stage):
    table = workspace.external_staging
    deliver(stage, "a.csv", *csv_lines("2023-08-04"))
    load_csv(spark, stage, table, "batch")
    deliver(stage, "b.csv", *csv_lines("2023-08-07"))
    assert run_stream(spark, workspace, stage) == 8  # the new file only
    assert load_csv(spark, stage, table, "later").rows == 0
    assert read_staged_orders(spark, table).count() == 16


def test_bad_file_fails_the_stream_and_lands_nowhere(spark, workspace, stage):
    deliver(stage, "a.csv", *csv_lines("2023-08-04"))
    deliver(stage, "b.csv", "X,2023-08-01,soon,Rye,1")
    with pytest.raises(ABORTS):
        run_stream(spark, workspace, stage)
    assert read_staged_orders(spark, workspace.external_staging).count() == 0
    assert workspace.customer_orders.read(spark).count() == 0


def test_stream_of_documents(spark, workspace, stage):
    deliver_text(stage, "a.json", json.dumps(DOCUMENT, indent="\t"))
    taken = ingest_json(spark, stage, workspace.document_staging, workspace.customer_orders, f"{workspace.root}/checkpoint")
    assert taken == 1
    assert workspace.customer_orders.read(spark).agg(F.sum("quantity")).first()[0] == 183


def test_stream_archives_taken_files(spark, workspace, stage, tmp_path):
    options = {"source_options": {**purge_options(str(tmp_path / "archive")), "maxFilesPerTrigger": "1"}}
    for day in DAYS:
        deliver(stage, csv_name(day), *csv_lines(day))
    run_stream(spark, workspace, stage, **options)
    archived = {p.name for p in (tmp_path / "archive").rglob("Orders*")}
    assert archived and archived | set(names(stage)) == {csv_name(day) for day in DAYS}
    assert purge_options() == {"cleanSource": "delete"}
    assert sum(totals(spark, workspace.summary_orders).values()) == 244


def test_unknown_options_are_refused(spark, workspace, stage):
    with pytest.raises(ValueError):
        process_orders(spark, workspace, stage, "run", summary="partial")
    with pytest.raises(ValueError):
        merge_orders(spark, workspace.customer_orders, frame(spark), on_duplicate="first")
