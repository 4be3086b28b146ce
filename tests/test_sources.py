from __future__ import annotations

import json
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from conftest import ABORTS, deliver, deliver_text, rows
from orderloom.operators.flatten import flatten_orders, flatten_typed
from orderloom.operators.load import load_csv, read_staged_orders
from orderloom.operators.rejects import csv_rejects, read_rejects
from orderloom.plans.ingest import process_orders
from orderloom.sources.csv_files import CsvFormat, scan_csv
from orderloom.sources.external import (
    create_external_table,
    drop_external_table,
    read_external_table,
    read_projection,
    read_snapshot,
    refresh_external_table,
    refresh_projection,
    register_snapshot,
    refresh_snapshot,
)
from orderloom.sources.json_files import DOCUMENT_PER_LINE, scan_json, scan_json_typed
from orderloom.sources.listing import (
    directory_changes,
    list_stage,
    read_directory,
    read_directory_changes,
    refresh_directory,
    refresh_with_changes,
)
from orderloom.sources.stage import Stage
from samples import DAYS, DOCUMENT, csv_lines, csv_name


def test_csv_is_read_by_position_with_lineage(spark, stage):
    deliver(stage, csv_name("2023-08-04"), *csv_lines("2023-08-04"), header="a,b,c,d,e")
    deliver(stage, "202308/more +1 %41.csv", "X,2023-08-01,2023-08-02,Rye,1")
    got = rows(scan_csv(spark, stage), "c1", "c5", "source_file_name")
    assert len(got) == 9
    assert ("X", "1", "202308/more +1 %41.csv") in got
    assert sum(int(r[1]) for r in got) == 122


def test_prefix_is_a_prefix_of_the_path(spark, stage):
    for name in ("202307/a.csv", "202308/b.csv", "202308b.csv", "2024/c.csv"):
        deliver(stage, name, f"{name},2023-08-01,2023-08-02,Rye,1")

    def names(prefix):
        return [r[0] for r in rows(scan_csv(spark, stage, prefix=prefix), "source_file_name")]

    assert names("202308") == ["202308/b.csv", "202308b.csv"]
    assert names("202308/") == ["202308/b.csv"]
    assert names("2023") == ["202307/a.csv", "202308/b.csv", "202308b.csv"]
    assert names("1999") == []


def test_pattern_keeps_formats_in_one_folder_apart(spark, stage):
    deliver(stage, "a.csv", "X,2023-08-01,2023-08-02,Rye,1")
    deliver_text(stage, "a.json", json.dumps(DOCUMENT))
    assert scan_csv(spark, Stage(stage.root, "*.csv")).count() == 1
    assert scan_json(spark, Stage(stage.root, "*.json")).count() == 1


def test_quotes_are_part_of_the_value_unless_declared(spark, stage):
    deliver(stage, "a.csv", 'X,2023-08-01,2023-08-02,"Rye",1')
    assert rows(scan_csv(spark, stage), "c4") == [('"Rye"',)]
    assert rows(scan_csv(spark, stage, CsvFormat(quote='"')), "c4") == [("Rye",)]


def test_other_delimiter_and_no_header(spark, stage):
    deliver(stage, "a.csv", "X|2023-08-01|2023-08-02|Rye|", header=None)
    assert rows(scan_csv(spark, stage, CsvFormat("|", skip_header=False)), "c1", "c4", "c5") == [("X", "Rye", None)]


@pytest.mark.parametrize("line", ["X,2023-08-01,2023-08-02,Rye", "X,2023-08-01,2023-08-02,Rye,1,2"])
def test_rows_of_other_width_abort(spark, stage, line):
    deliver(stage, "a.csv", "X,2023-08-01,2023-08-02,Rye,1", line)
    with pytest.raises(ABORTS):
        scan_csv(spark, stage).collect()


def test_document_per_file(spark, stage):
    deliver_text(stage, "a.json", json.dumps(DOCUMENT, indent="\t"))
    deliver_text(stage, "list.json", "[1, 2]")
    deliver_text(stage, "blank.json", "\n")
    got = scan_json(spark, stage).select(F.to_json("customer_orders"), "source_file_name")
    found = {name: json.loads(text) for text, name in rows(got)}
    assert found == {"a.json": DOCUMENT, "list.json": [1, 2]}


@pytest.mark.parametrize("text", ['{"Customer": ', '{"a": 1}\n{"a": 2}', '{"a": 1}, {"a": 2}', "{} x"])
def test_malformed_or_further_documents_abort(spark, stage, text):
    deliver_text(stage, "a.json", text)
    with pytest.raises(ABORTS):
        scan_json(spark, stage).collect()


def test_document_per_line(spark, stage):
    deliver_text(stage, "a.json", "\n".join(json.dumps({"Customer": str(i)}) for i in range(50)) + "\n\n")
    got = scan_json(spark, stage, DOCUMENT_PER_LINE)
    assert got.select(F.variant_get("customer_orders", "$.Customer", "string")).distinct().count() == 50


def test_both_json_routes_agree(spark, stage):
    deliver_text(stage, "a.json", json.dumps(DOCUMENT, indent="\t"))
    by_variant = flatten_orders(scan_json(spark, stage))
    by_struct = flatten_typed(scan_json_typed(spark, stage))
    assert by_variant.dtypes == by_struct.dtypes
    assert rows(by_variant) == rows(by_struct)
    assert len(rows(by_struct)) == 9
    assert by_struct.agg(F.sum("quantity")).first()[0] == 183


def test_typed_route_aborts_on_other_shapes(spark, stage):
    deliver_text(stage, "a.json", json.dumps({**DOCUMENT, "Order date": "soon"}))
    with pytest.raises(ABORTS):
        scan_json_typed(spark, stage).collect()


def test_listing_reads_no_content(spark, stage):
    deliver(stage, "202308/a.csv", "X,2023-08-01,2023-08-02,Rye,1")
    deliver(stage, "empty.csv")
    listed = list_stage(spark, stage)
    assert "ReadSchema: struct<>" in listed._jdf.queryExecution().executedPlan().toString()
    sizes = {r["source_file_name"]: r["file_size"] for r in listed.collect()}
    assert set(sizes) == {"202308/a.csv", "empty.csv"}
    assert all(size > 0 for size in sizes.values())


def test_directory_table_shows_its_last_refresh(spark, stage, tmp_path):
    path = str(tmp_path / "directory")
    deliver(stage, "a.csv")
    refresh_directory(spark, stage, path, checksums=True)
    deliver(stage, "b.csv")
    assert rows(read_directory(spark, path), "relative_path") == [("a.csv",)]
    assert all(len(r[0]) == 32 for r in rows(read_directory(spark, path), "md5"))
    refresh_directory(spark, stage, path)
    assert rows(read_directory(spark, path), "relative_path") == [("a.csv",), ("b.csv",)]


def test_external_table_needs_a_refresh(spark, stage):
    deliver(stage, "202308/" + csv_name("2023-08-04"), *csv_lines("2023-08-04"))
    create_external_table(spark, "ext_orders", stage)
    table = read_external_table(spark, "ext_orders")
    assert [t for _, t in table.dtypes] == ["string", "date", "date", "string", "decimal(38,0)", "string"]
    assert table.count() == 8
    deliver(stage, "202308/" + csv_name("2023-08-07"), *csv_lines("2023-08-07"))
    assert read_external_table(spark, "ext_orders").count() == 8
    refresh_external_table(spark, "ext_orders")
    assert read_external_table(spark, "ext_orders").count() == 16
    assert {r[0] for r in rows(read_external_table(spark, "ext_orders"), "source_file_name")} == {
        "202308/Orders_2023-08-04.csv",
        "202308/Orders_2023-08-07.csv",
    }
    drop_external_table(spark, "ext_orders")


def test_snapshot_is_replaced_also_by_nothing(spark, stage, tmp_path):
    path = str(tmp_path / "snapshot")
    deliver(stage, csv_name("2023-08-04"), *csv_lines("2023-08-04"))
    create_external_table(spark, "ext_snapshot", stage)
    table = read_external_table(spark, "ext_snapshot")
    refresh_snapshot(table, path)
    refresh_snapshot(table, path)
    assert rows(read_snapshot(spark, path)) == rows(table)
    refresh_snapshot(table.filter("quantity < 0"), path)
    assert read_snapshot(spark, path).count() == 0
    refresh_snapshot(table, path)
    register_snapshot(spark, "ext_stored", path)
    assert spark.sql("SELECT quantity FROM ext_stored WHERE delivery_date IS NOT NULL").count() == 8
    spark.sql("DROP TABLE ext_stored")
    drop_external_table(spark, "ext_snapshot")


# Projections kept by file, changes of a directory, rejects


def read_files(delta):
    return sorted(Path(unquote(urlparse(name).path)).name for name in delta.rows.inputFiles()) if delta.rows is not None else []


def test_projection_reads_only_files_that_are_new_or_changed(spark, stage, tmp_path):
    path = str(tmp_path / "projection")
    assert read_projection(spark, path).count() == 0
    for day in DAYS:
        deliver(stage, csv_name(day), *csv_lines(day))
    deliver(stage, "none é.csv")  # a header only
    first = refresh_projection(spark, stage, path)
    assert (len(first.fresh), first.gone, read_projection(spark, path).count()) == (4, [], 24)
    again = refresh_projection(spark, stage, path)
    assert (again.fresh, again.gone, again.rows) == ([], [], None)
    deliver(stage, "new [1].csv", "X,2023-08-01,2023-08-02,Rye,1")
    deliver(stage, csv_name(DAYS[0]), "Y,2023-08-01,2023-08-02,Rye,2")  # other content
    (Path(stage.root) / csv_name(DAYS[1])).unlink()
    second = refresh_projection(spark, stage, path)
    assert read_files(second) == sorted(["new [1].csv", csv_name(DAYS[0])])
    assert (len(second.fresh), len(second.gone)) == (2, 2)
    assert read_projection(spark, path).count() == 10
    deliver(stage, "bad.csv", "X,2023-08-01,soon,Rye,1")
    with pytest.raises(ABORTS):
        refresh_projection(spark, stage, path)
    assert read_projection(spark, path).count() == 10
    for file in Path(stage.root).glob("*"):
        file.unlink()
    assert len(refresh_projection(spark, stage, path).gone) == 4
    assert read_projection(spark, path).count() == 0


def test_changes_of_a_directory(spark, stage, tmp_path):
    catalog, log = str(tmp_path / "catalog"), str(tmp_path / "log")
    for name in ("a.csv", "b.csv", "c.csv"):
        deliver(stage, name, *csv_lines("2023-08-04"))
    assert refresh_with_changes(spark, stage, catalog, log, "1") == 3
    assert refresh_with_changes(spark, stage, catalog, log, "2") == 0
    deliver(stage, "a.csv", *csv_lines("2023-08-07"), *csv_lines("2023-08-08"))
    (Path(stage.root) / "b.csv").unlink()
    deliver(stage, "d.csv", *csv_lines("2023-08-04"))
    assert refresh_with_changes(spark, stage, catalog, log, "3", checksums=True) == 3
    found = read_directory_changes(spark, log).where("refresh_id = '3'")
    assert rows(found, "relative_path", "change") == [("a.csv", "changed"), ("b.csv", "removed"), ("d.csv", "added")]
    assert found.where("change = 'changed' AND new_size > old_size AND old_modified <= new_modified").count() == 1
    assert rows(read_directory(spark, catalog), "relative_path") == [("a.csv",), ("c.csv",), ("d.csv",)]
    # Checksums tell of a change that size and time do not.
    before = read_directory(spark, catalog)
    after = before.withColumn("md5", F.when(F.col("relative_path") != "c.csv", F.col("md5")).otherwise("0"))
    assert rows(directory_changes(before, after), "relative_path", "change") == [("c.csv", "changed")]
    assert directory_changes(before, before.withColumn("md5", F.lit(None).cast("string"))).count() == 0


def test_rejects_have_places_and_reasons(spark, workspace, stage):
    sound = "X,2023-08-01,2023-08-02,Rye,1"
    deliver(stage, "a.csv", sound, "", "X,2023-08-01,soon,Rye,1", "X,2023-08,2023-08-02,Rye,many", "X,Y", sound + ",more", ",,,,")
    deliver(stage, "b.csv", sound)
    deliver(stage, "long.csv", *([sound] * 3000), "bad", *([sound] * 2000), "X,2023-08-01,2023-08-02,Rye,x")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # the long file in blocks
    try:
        with pytest.raises(ABORTS):
            load_csv(spark, stage, workspace.internal_staging, "l1", rejects=workspace.rejects_path)
        assert csv_rejects(spark, Stage(stage.root, "long*")).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = read_rejects(spark, workspace.rejects_path)
    assert rows(found, "source_file_name", "line", "column_name", "reason") == sorted(
        [
            ("a.csv", 4, "delivery_date", "not date"),
            ("a.csv", 5, "order_date", "not date"),
            ("a.csv", 5, "quantity", "not decimal(38,0)"),
            ("a.csv", 6, None, "number of columns"),
            ("a.csv", 7, None, "number of columns"),
            ("long.csv", 3002, None, "number of columns"),
            ("long.csv", 5003, "quantity", "not decimal(38,0)"),
        ],
        key=repr,
    )
    assert {(row["table_name"], row["load_id"]) for row in found.collect()} == {("orders_stg", "l1")}
    assert rows(found.where("line = 4"), "text") == [("X,2023-08-01,soon,Rye,1",)]
    assert read_staged_orders(spark, workspace.internal_staging).count() == 0
    assert csv_rejects(spark, Stage(stage.root, "b*")).count() == 0


def test_a_run_tells_of_all_bad_rows(spark, workspace, stage):
    deliver(stage, "a.csv", "X,2023-08-01,soon,Rye,1", "X,2023-08-01,2023-08-02,Rye,x")
    with pytest.raises(ABORTS):
        process_orders(spark, workspace, stage, "run")
    assert read_rejects(spark, workspace.rejects_path).count() == 2
    deliver(stage, "a.csv", "X,2023-08-01,2023-08-02,Rye,1")
    assert process_orders(spark, workspace, stage, "next").merge.inserted == 1
