from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import ABORTS, deliver, deliver_text, rows
from orderloom import session, storage
from orderloom.functions.lineage import relative_file_name
from orderloom.operators.load import (
    load_csv,
    load_history,
    load_json,
    purge_loaded,
    read_staged_documents,
    read_staged_orders,
    truncate_staging,
)
from orderloom.schema import ORDERS
from orderloom.sources.json_files import DOCUMENT_PER_FILE, DOCUMENT_PER_LINE, scan_json_typed
from orderloom.sources.stage import Stage
from samples import DOCUMENT, csv_lines, csv_name


@pytest.mark.parametrize(("day", "total"), [("2023-08-04", 121), ("2023-08-07", 105), ("2023-08-08", 123)])
def test_sample_totals(spark, workspace, stage, day, total):
    deliver(stage, csv_name(day), *csv_lines(day))
    result = load_csv(spark, stage, workspace.internal_staging, "l1", load_ts=F.expr("timestamp'2023-08-09 10:00:00'"))
    staged = read_staged_orders(spark, workspace.internal_staging)
    assert (result.rows, result.files) == (8, 1)
    assert staged.schema == ORDERS
    assert staged.agg(F.sum("quantity")).first()[0] == total
    assert rows(staged.select(F.date_format("load_ts", "yyyy-MM-dd HH")).distinct()) == [("2023-08-09 10",)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "bad",
    [
        "X,2023-13-01,2023-08-02,Rye,1",
        "X,2023-08-01,soon,Rye,1",
        "X,2023-08-01,2023-08-02,Rye,many",
        "X,2023-08-01,2023-08-02,Rye,1" + "0" * 38,
        "X,2023-08-01,2023-08-02,Rye",
        "X,2023-08-01,2023-08-02,Rye,1,1",
    ],
)
def test_any_bad_row_aborts_the_whole_load(spark, workspace, stage, bad, ansi):
    table = workspace.internal_staging
    deliver(stage, "good/a.csv", *csv_lines("2023-08-04"))
    load_csv(spark, stage, table, "good")
    deliver(stage, "good/b.csv", *csv_lines("2023-08-07"))
    deliver(stage, "bad.csv", "X,2023-08-01,2023-08-02,Rye,1", bad)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(ABORTS):
            load_csv(spark, stage, table, "bad")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert read_staged_orders(spark, table).count() == 8
    history = load_history(spark, table.history_path, table.schema_name, table.name)
    assert rows(history, "load_id") == [("good",)]


def test_null_empty_and_fractional_fields(spark, workspace, stage):
    deliver(stage, "a.csv", "X,2023-08-01,2023-08-02,Rye,12.5", ",,,,", "Y,2023-08-01,2023-08-02,Rye,-3")
    load_csv(spark, stage, workspace.internal_staging, "l1")
    got = rows(read_staged_orders(spark, workspace.internal_staging), "customer", "delivery_date", "quantity")
    assert [(c, None if q is None else int(q)) for c, _, q in got] == [("X", 13), ("Y", -3), (None, None)]


def test_load_under_the_same_id_replaces_itself(spark, workspace, stage):
    deliver(stage, "a.csv", *csv_lines("2023-08-04"))
    for _ in range(2):
        load_csv(spark, stage, workspace.internal_staging, "l1")
    assert read_staged_orders(spark, workspace.internal_staging).count() == 8
    with pytest.raises(ValueError):
        load_csv(spark, stage, workspace.internal_staging, "a/b")


def test_files_that_another_load_has_taken_are_left_out(spark, workspace, stage):
    table = workspace.internal_staging
    deliver(stage, "a [1].csv", *csv_lines("2023-08-04"))
    load_csv(spark, stage, table, "l1")
    assert load_csv(spark, stage, table, "l2").rows == 0
    deliver(stage, "b+é {x}*.csv", *csv_lines("2023-08-07"))
    result = load_csv(spark, stage, table, "l3")
    assert (result.rows, result.files) == (8, 1)
    assert read_staged_orders(spark, table).count() == 16
    assert load_csv(spark, stage, table, "l4", force=True).rows == 16
    deliver_text(stage, "docs/a.json", json.dumps(DOCUMENT))
    documents = Stage(f"{stage.root}/docs")
    assert load_json(spark, documents, workspace.document_staging, "l1").rows == 1
    assert load_json(spark, documents, workspace.document_staging, "l2").rows == 0


def test_a_failing_reload_keeps_the_rows_loaded_before(spark, workspace, stage):
    table = workspace.internal_staging
    deliver(stage, "a.csv", *csv_lines("2023-08-04"))
    load_csv(spark, stage, table, "l1")
    deliver(stage, "bad.csv", "X,2023-08,2023-08-02,Rye,1")
    with pytest.raises(ABORTS):
        load_csv(spark, stage, table, "l1")
    assert read_staged_orders(spark, table, "l1").count() == 8
    history = load_history(spark, table.history_path, table.schema_name, table.name)
    assert rows(history, "load_id", "row_count") == [("l1", 8)]


@pytest.mark.parametrize("date", ["2023", "2023-08", "2023-08-04 junk", "2023-08-04T00:00:00", "2023-13-01", " 2023-08-04"])
def test_damaged_dates_abort_by_every_route(spark, workspace, stage, date):
    deliver(stage, "a.csv", f"X,{date},2023-08-05,Rye,1")
    with pytest.raises(ABORTS):
        load_csv(spark, stage, workspace.internal_staging, "l1")
    body = json.dumps({**DOCUMENT, "Order date": date})
    deliver_text(stage, "docs/a.json", body)
    documents = Stage(f"{stage.root}/docs")
    load_json(spark, documents, workspace.document_staging, "l1")
    with pytest.raises(ABORTS):
        workspace.document_orders(spark).collect()
    with pytest.raises(ABORTS):
        scan_json_typed(spark, documents).collect()
    workspace.register(spark, "damaged", replace=True)
    with pytest.raises(ABORTS):
        spark.sql("SELECT * FROM damaged.orders_json_stg").collect()


@pytest.mark.parametrize(
    "text",
    ['{"a":1}],[{"b":2}', '{"a":1}] junk', '{"a":1}]', '{"a":1}} junk', '{"a":1},"end":1}', '{"a":1},"x":2', '{"a":1} {"b":2}', '{"a":'],
)
def test_text_after_a_document_aborts(spark, workspace, stage, text):
    deliver_text(stage, "a.json", text)
    for layout in (DOCUMENT_PER_FILE, DOCUMENT_PER_LINE):
        with pytest.raises(ABORTS):
            load_json(spark, stage, workspace.document_staging, "l1", layout)


@pytest.mark.parametrize("name", ["_Orders.csv", ".Orders.csv", "2023/08/_Orders.csv"])
def test_files_that_spark_passes_over_are_refused(spark, workspace, stage, name):
    deliver(stage, "a.csv", *csv_lines("2023-08-04"))
    deliver(stage, name, *csv_lines("2023-08-07"))
    with pytest.raises(ValueError, match="Orders.csv"):
        load_csv(spark, stage, workspace.internal_staging, "l1")


def test_history_is_per_table_and_lists_files_without_rows(spark, workspace, stage):
    deliver(stage, "a.csv", *csv_lines("2023-08-04"))
    deliver(stage, "empty.csv")
    first, second = workspace.internal_staging, workspace.external_staging
    result = load_csv(spark, stage, first, "l1")
    load_csv(spark, stage, second, "l1", prefix="a")
    assert (result.rows, result.files) == (8, 2)

    def history(table):
        frame = load_history(spark, workspace.history_path, table.schema_name, table.name)
        assert "PartitionFilters: [isnotnull(schema_name" in frame._jdf.queryExecution().executedPlan().toString()
        return rows(frame, "source_file_name", "row_count", "status")

    assert history(first) == [("a.csv", 8, "LOADED"), ("empty.csv", 0, "LOADED")]
    assert history(second) == [("a.csv", 8, "LOADED")]


def test_stage_without_files_loads_nothing(spark, workspace, stage):
    result = load_csv(spark, stage, workspace.internal_staging, "l1", prefix="none")
    assert (result.rows, result.files) == (0, 0)
    assert load_csv(spark, stage, workspace.internal_staging, "l2").rows == 0
    assert load_json(spark, stage, workspace.document_staging, "l1").rows == 0
    assert read_staged_orders(spark, workspace.internal_staging).count() == 0


def test_purge_takes_loaded_files_only(spark, workspace, stage):
    deliver(stage, "x y+z.csv", *csv_lines("2023-08-04"))
    deliver(stage, "empty.csv")
    load_csv(spark, stage, workspace.internal_staging, "l1")
    deliver(stage, "late.csv", *csv_lines("2023-08-07"))
    assert purge_loaded(spark, workspace.internal_staging, "l1") == 2
    assert [p.name for p in Path(stage.root).glob("*.csv")] == ["late.csv"]


def test_documents_are_staged_raw(spark, workspace, stage):
    deliver_text(stage, "a.json", json.dumps(DOCUMENT, indent="\t"))
    assert load_json(spark, stage, workspace.document_staging, "l1").rows == 1
    staged = read_staged_documents(spark, workspace.document_staging)
    assert dict(staged.dtypes)["customer_orders"] == "variant"
    flat = workspace.document_orders(spark)
    assert (flat.count(), flat.agg(F.sum("quantity")).first()[0]) == (9, 183)


def test_truncate_keeps_the_history(spark, workspace, stage):
    table = workspace.internal_staging
    deliver(stage, "a.csv", *csv_lines("2023-08-04"))
    load_csv(spark, stage, table, "l1")
    truncate_staging(spark, table)
    assert read_staged_orders(spark, table).count() == 0
    assert load_history(spark, table.history_path, table.schema_name, table.name).count() == 1


def test_loads_are_not_sorted_by_their_folder(spark, workspace, stage, monkeypatch):
    """All rows of a load go to one folder, for which a task needs to hold none of them."""
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], storage.overwrite_partitions
    before = spark.conf.get(name)

    def writing(*args):
        seen.append(int(spark.conf.get(name)))
        write(*args)

    deliver(stage, csv_name("2023-08-04"), *csv_lines("2023-08-04"))
    with monkeypatch.context() as patched:
        patched.setattr(storage, "overwrite_partitions", writing)
        assert load_csv(spark, stage, workspace.internal_staging, "l1").rows == 8
    assert seen and min(seen) > 0 and spark.conf.get(name) == before


def test_a_load_is_spread_over_tasks(spark, workspace, stage, monkeypatch):
    lines = [f"Park Inn,2023-08-01,2023-08-02,Rye,{number}" for number in range(5000)]
    deliver(stage, "large.csv", *lines)
    monkeypatch.setattr(session, "SCAN_BYTES", 20_000)
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(name) for name in names]
    load_csv(spark, stage, workspace.internal_staging, "l1")
    staged = read_staged_orders(spark, workspace.internal_staging)
    assert staged.agg(F.count("quantity"), F.sum("quantity")).first()[:] == (5000, sum(range(5000)))
    assert len(list(Path(workspace.internal_staging.path).rglob("*.parquet"))) > 5
    assert [spark.conf.get(name) for name in names] == before


@pytest.mark.parametrize("root", ["/in/box", "/in/box/", "/", "/a"])
@pytest.mark.parametrize("delivery", [None, "[ab]+"])
def test_usual_paths_are_named_as_all_others(spark, root, delivery):
    """With and without the spellings of scheme and host that are cut off by searching bytes."""
    folder = root.rstrip("/")
    names = ["b.csv", "a%20b+c%2B.csv", "x/file:" + folder + "/b.csv", "é/%C3%A9.csv", ""]
    heads = ["file:", "file://", "FILE:", "hdfs://a", "hdfs://a:1", "s3a://a%20b", ""]
    paths = spark.createDataFrame([(f"{head}{folder}/{name}",) for head in heads for name in names] + [(None,)], "path string")
    plain = relative_file_name(F.col("path"), root, delivery)
    for origins in (["file:", "file://"], ["hdfs://a"]):
        quick = relative_file_name(F.col("path"), root, delivery, origins)
        assert paths.where(~plain.eqNullSafe(quick)).count() == 0
        assert paths.select(quick).distinct().count() > 1
