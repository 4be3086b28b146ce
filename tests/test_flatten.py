from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import ABORTS, rows
from orderloom.operators.flatten import flatten_days, flatten_orders, top_level
from samples import DOCUMENT


def raw(spark, *documents):
    frame = spark.createDataFrame([(json.dumps(d), f"f{i}") for i, d in enumerate(documents)], "t string, source_file_name string")
    return frame.select(F.parse_json("t").alias("customer_orders"), "source_file_name")


def test_levels_of_the_sample(spark):
    documents = raw(spark, DOCUMENT)
    assert rows(top_level(documents).select("customer", F.col("order_date").cast("string"))) == [("Park Inn", "2023-08-11")]
    days = flatten_days(documents)
    assert [str(r[0]) for r in rows(days, "delivery_date")] == ["2023-08-14", "2023-08-15"]
    totals = flatten_orders(documents).groupBy("delivery_date").agg(F.count("*"), F.sum("quantity"))
    assert [(n, int(q)) for _, n, q in rows(totals)] == [(5, 101), (4, 82)]


@pytest.mark.parametrize("orders", [None, [], {}, "text", 1, [{"Orders by day": None}], [{"Orders by day": []}], [{}], [None], [1]])
def test_documents_without_items_vanish(spark, orders):
    got = flatten_orders(raw(spark, {**DOCUMENT, "Orders": orders}, DOCUMENT, {"Customer": "no field"}))
    assert {r[0] for r in rows(got, "source_file_name")} == {"f1"}
    assert got.count() == 9


def test_an_object_is_flattened_into_its_values(spark):
    as_object = {**DOCUMENT, "Orders": {"first": DOCUMENT["Orders"][0], "second": DOCUMENT["Orders"][1]}}
    got = flatten_orders(raw(spark, as_object)).drop("source_file_name")
    assert rows(got) == rows(flatten_orders(raw(spark, DOCUMENT)).drop("source_file_name"))


def test_missing_fields_are_null(spark):
    got = flatten_orders(raw(spark, {"Orders": [{"Orders by day": [{"Quantity": "7"}, {}, 5]}]}))
    assert [(r[0], r[2], r[3], None if r[4] is None else int(r[4])) for r in rows(got)] == [
        (None, None, None, 7),
        (None, None, None, None),
        (None, None, None, None),
    ]


@pytest.mark.parametrize("change", [{"Order date": "soon"}, {"Orders": [{"Delivery date": "x", "Orders by day": [{}]}]}])
def test_bad_values_abort(spark, change):
    with pytest.raises(ABORTS):
        flatten_orders(raw(spark, {**DOCUMENT, **change})).collect()
