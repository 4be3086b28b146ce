"""Documents cut at the elements of their array of days."""

from __future__ import annotations

import json
import random
import re
from datetime import date
from pathlib import Path

import pytest

from conftest import ABORTS, deliver_text, rows
from orderloom.operators.flatten import flatten_orders
from orderloom.operators.load import load_json
from orderloom.plans.feed import write_giant_documents
from orderloom.session import scratch
from orderloom.sources import json_cut
from orderloom.sources.json_files import DOCUMENT_CUT, DOCUMENT_PER_FILE, scan_json
from orderloom.sources.stage import Stage

COLUMNS = ["customer", "order_date", "delivery_date", "baked_good_type", "quantity", "source_file_name"]
NASTY = ['}', '{"', "a]}[{", '\\"}', "\\\\", "é}ü", '"', "x, {", "\n}\t", ""]


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def document(r: random.Random, days: int, tail: bool = False, **layout) -> str:
    def day(i):
        items = [{"Baked good type": r.choice(NASTY) + str(k), "Quantity": r.randint(1, 9)} for k in range(r.randint(0, 4))]
        return {"Delivery date": f"2024-03-{i % 28 + 1:02d}", "Orders by day": items, "note": r.choice(NASTY)}

    head = {"Customer": "C" + r.choice(NASTY), "Order date": "2024-02-01"}
    orders = {"Orders": [day(i) for i in range(days)]}
    return json.dumps({**orders, **head} if tail else {**head, **orders}, **layout)


def flat(spark, stage, layout):
    return rows(flatten_orders(scan_json(spark, stage, layout)), *COLUMNS)


def test_cut_documents_flatten_to_the_same_rows(spark, stage, small_blocks):
    r = random.Random(5)
    for i, days in enumerate([0, 1, 2, 3, 40, 7, 25, 1]):
        text = document(r, days, tail=i % 2 == 1, indent=2 if i % 3 == 1 else None, ensure_ascii=i % 2 == 0)
        deliver_text(stage, f"{i}.json", text + "\n" * (i % 4))
    deliver_text(stage, "blank.json", " \n")
    deliver_text(stage, "none.json", "")
    deliver_text(stage, "missing.json", '{"Customer":"x}"}')
    deliver_text(stage, "null.json", '{"Customer":null,"Orders":null}')
    wanted = flat(spark, stage, DOCUMENT_PER_FILE)
    assert len(wanted) > 100
    assert flat(spark, stage, DOCUMENT_CUT) == wanted
    cut = scan_json(spark, stage, DOCUMENT_CUT)
    assert cut.groupBy("source_file_name").count().agg({"count": "max"}).first()[0] == 40


GOOD = '{"Customer":"a","Orders":[{"Delivery date":"2024-01-01","Orders by day":[{"Quantity":1}]},{"Orders by day":[]}]}'


@pytest.mark.parametrize(
    "bad",
    [
        GOOD[:-1],
        GOOD[:-2] + "}",
        GOOD[:40],
        GOOD + "}",
        GOOD + "\n}",
        GOOD + " x",
        GOOD + GOOD,
        GOOD + ',{"k":[{"a":1}',
        GOOD.replace('},{"Orders by', '}{"Orders by'),
        GOOD.replace("]},", "}],"),
        GOOD.replace('"Quantity":1', '"Quantity":'),
        '{"Meta":{"b":1},' + GOOD[1:],
        '{"Others":[{"b":1}],' + GOOD[1:],
        '{"Orders":[1,{"b":1}]}',
        "[" + GOOD + "]",
    ],
)
def test_what_cannot_be_cut_aborts(spark, stage, bad):
    deliver_text(stage, "good.json", GOOD)
    assert scan_json(spark, stage, DOCUMENT_CUT).count() == 2
    deliver_text(stage, "bad.json", bad)
    with pytest.raises(ABORTS):
        scan_json(spark, stage, DOCUMENT_CUT).collect()


def test_cut_documents_are_loaded_and_streams_refuse(spark, stage, workspace):
    deliver_text(stage, "good.json", GOOD)
    load_json(spark, stage, workspace.document_staging, "day", DOCUMENT_CUT)
    assert workspace.document_orders(spark).count() == 1
    with pytest.raises(ValueError, match="stream"):
        scan_json(spark, stage, DOCUMENT_CUT, streaming=True)


def test_blocks_are_small_whatever_the_session_reads(spark, stage, monkeypatch):
    """A block's fragments are sorted by one task."""
    deliver_text(stage, "a.json", document(random.Random(7), 40))
    monkeypatch.setattr(json_cut, "BLOCK_BYTES", 300)
    made, stored = {}, json_cut.stored

    def recorded(frame, purpose):
        made[purpose] = stored(frame, purpose)
        return made[purpose]

    monkeypatch.setattr(json_cut, "stored", recorded)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = flat(spark, stage, DOCUMENT_CUT)
    assert got == flat(spark, stage, DOCUMENT_PER_FILE)
    assert made["blocks"].count() > 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_text_is_shuffled_once_by_block(spark, stage, small_blocks, monkeypatch):
    deliver_text(stage, "a.json", document(random.Random(3), 40))
    plans = {}

    def stored(frame, purpose):
        plans[purpose] = frame._jdf.queryExecution().executedPlan().toString()
        return keep(frame, purpose)

    keep = json_cut.stored
    monkeypatch.setattr(json_cut, "stored", stored)
    assert scan_json(spark, stage, DOCUMENT_CUT).count() == 40
    assert len(re.findall(r"Exchange hashpartitioning", plans["pieces"])) == 1
    assert "value#" not in plans["blocks"]  # numbers only
    assert not re.search(r"Exchange hashpartitioning.*block", plans["frames"])


def test_scratch_of_the_cut_is_dropped_as_it_is_used(spark, stage, tmp_path):
    before = set(scratch_folders(spark))
    deliver_text(stage, "a.json", document(random.Random(4), 5))
    cut = scan_json(spark, stage, DOCUMENT_CUT)
    made = {name.rpartition("-")[0] for name in set(scratch_folders(spark)) - before}
    assert "fragments" not in made and "pieces" in made
    assert cut.count() == 5
    feed = spark.sql(
        "SELECT 'PERU' AS customer, date'2024-01-02' AS order_date, date'2024-01-03' AS delivery_date, 'Rye' AS baked_good_type,"
        " CAST(2 AS DECIMAL(38,0)) AS quantity, id DIV 2 AS l_orderkey FROM range(6)"
    )
    spark.sql("SELECT 1 AS n_nationkey, 'PERU' AS n_name, 3 AS n_regionkey").write.parquet(str(tmp_path / "nation.parquet"))
    spark.sql("SELECT 3 AS r_regionkey, 'AMERICA' AS r_name").write.parquet(str(tmp_path / "region.parquet"))
    before = set(scratch_folders(spark))
    write_giant_documents(spark, str(tmp_path), feed, str(tmp_path / "giants"))
    assert not [name for name in set(scratch_folders(spark)) - before if name.startswith("days-")]
    flattened = flat(spark, Stage(str(tmp_path / "giants")), DOCUMENT_CUT)
    assert [row[:5] for row in flattened] == [("AMERICA", date(2024, 1, 2), date(2024, 1, 3), "Rye", 2)] * 6


def scratch_folders(spark) -> list[str]:
    return [path.name for path in Path(scratch(spark, "x")).parent.glob("*-*")]
