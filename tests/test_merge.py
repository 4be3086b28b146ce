from __future__ import annotations

import itertools
import random
import re
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom import storage, versions
from orderloom.operators.merge import MergeCardinalityError, merge_orders, plan_merge
from orderloom.schema import ORDERS
from orderloom.session import shared_folder
from orderloom.storage import OrderTable

LOADED, FIRST, SECOND = (datetime(2023, 8, day, 12) for day in (1, 2, 3))


def order(customer="A", delivery="2023-08-08", kind="Rye", quantity=1, ordered="2023-08-01", file="f1"):
    day = None if delivery is None else date.fromisoformat(delivery)
    placed = None if ordered is None else date.fromisoformat(ordered)
    return (customer, placed, day, kind, quantity, file, LOADED)


def frame(spark, *orders):
    decimal = [(*o[:4], o[4], *o[5:]) for o in orders]
    schema = ", ".join(f"{f.name} {'long' if f.name == 'quantity' else f.dataType.simpleString()}" for f in ORDERS)
    return spark.createDataFrame(decimal, schema).withColumn("quantity", F.col("quantity").cast("decimal(38,0)"))


def content(spark, target):
    return sorted(
        ((r[0], str(r[1]), str(r[2]), r[3], None if r[4] is None else int(r[4]), r[5], r[6]) for r in target.read(spark).collect()),
        key=repr,
    )


def expect(*changed):
    return sorted(((o[0], str(o[1]), str(o[2]), *o[3:6], at) for o, at in changed), key=repr)


@pytest.fixture
def target(spark, tmp_path):
    return OrderTable(str(tmp_path / "orders")).create(spark)


def fill(spark, target, *orders):
    result = merge_orders(spark, target, frame(spark, *orders), merge_ts=F.lit(FIRST))
    assert result.inserted == len(orders)


def counts(result):
    return result.updated, result.inserted, result.kept


def test_update_keeps_the_order_date(spark, target):
    fill(spark, target, order(quantity=5), order("B"))
    source = frame(spark, order(quantity=7, ordered="2023-08-05", file="f2"), order("C", file="f2"))
    result = merge_orders(spark, target, source, merge_ts=F.lit(SECOND))
    assert counts(result) == (1, 1, 1)
    assert content(spark, target) == expect(
        (order(quantity=7, file="f2"), SECOND), (order("B"), FIRST), (order("C", file="f2"), SECOND)
    )


def test_insert_time_can_differ(spark, target):
    fill(spark, target, order())
    midnight = datetime(2023, 8, 3)
    merge_orders(spark, target, frame(spark, order(), order("B")), merge_ts=F.lit(SECOND), insert_ts=F.lit(midnight))
    assert content(spark, target) == expect((order(), SECOND), (order("B"), midnight))


def test_null_quantity_is_taken_over(spark, target):
    fill(spark, target, order(quantity=5))
    merge_orders(spark, target, frame(spark, order(quantity=None, file=None)), merge_ts=F.lit(SECOND))
    assert content(spark, target) == expect((order(quantity=None, file=None), SECOND))


@pytest.mark.parametrize("rule", ["error", "last"])
@pytest.mark.parametrize("lacking", [{"customer": None}, {"delivery": None}, {"kind": None}])
def test_null_keys_are_inserted_every_time(spark, target, lacking, rule):
    source = frame(spark, order(**lacking), order(**lacking), order("B"))
    for _ in range(2):
        merge_orders(spark, target, source, merge_ts=F.lit(FIRST), on_duplicate=rule)
    assert content(spark, target) == expect(*[(order(**lacking), FIRST)] * 4, (order("B"), FIRST))


def test_literal_duplicates_are_all_inserted_then_refused(spark, target):
    source = frame(spark, order(quantity=1), order(quantity=2), order("B"))
    assert counts(merge_orders(spark, target, source, merge_ts=F.lit(FIRST))) == (0, 3, 0)
    before = content(spark, target)
    with pytest.raises(MergeCardinalityError, match="^1 keys"):
        merge_orders(spark, target, source)
    assert content(spark, target) == before
    # Several target rows may match one source row.
    assert counts(merge_orders(spark, target, frame(spark, order(quantity=9)), merge_ts=F.lit(SECOND))) == (2, 0, 1)
    assert content(spark, target) == expect(*[(order(quantity=9), SECOND)] * 2, (order("B"), FIRST))


def test_literal_duplicates_beside_matches(spark, target):
    fill(spark, target, order("A"))
    source = frame(spark, order("A", quantity=3), order("B"), order("B"))
    assert counts(merge_orders(spark, target, source)) == (1, 2, 0)


def test_last_takes_the_row_that_is_last_in_order(spark, target):
    source = frame(
        spark,
        order(quantity=1, ordered="2023-08-02", file="f1"),
        order(quantity=2, ordered="2023-08-03", file="f1"),
        order(quantity=3, ordered="2023-08-03", file="f2"),
        order(quantity=4, ordered="2023-08-03", file="f2"),
        order(quantity=5, ordered=None, file="f9"),
    )
    assert counts(merge_orders(spark, target, source, merge_ts=F.lit(FIRST), on_duplicate="last")) == (0, 1, 0)
    assert content(spark, target) == expect((order(quantity=4, ordered="2023-08-03", file="f2"), FIRST))
    by_quantity = {"on_duplicate": "last", "order_by": ["quantity"], "merge_ts": F.lit(SECOND)}
    assert counts(merge_orders(spark, target, source, **by_quantity)) == (1, 0, 0)
    assert content(spark, target) == expect((order(quantity=5, ordered="2023-08-03", file="f9"), SECOND))


def test_order_by_may_name_further_columns(spark, target):
    source = frame(spark, order(quantity=1), order(quantity=2)).withColumn("line", -F.col("quantity"))
    merge_orders(spark, target, source, on_duplicate="last", order_by=["line"])
    assert [r[4] for r in content(spark, target)] == [1]


def test_empty_sources_change_nothing(spark, target):
    assert counts(merge_orders(spark, target, frame(spark))) == (0, 0, 0)
    fill(spark, target, order())
    assert counts(merge_orders(spark, target, frame(spark))) == (0, 0, 0)
    assert content(spark, target) == expect((order(), FIRST))


def test_only_touched_periods_are_read_and_written(spark, target):
    fill(spark, target, order(delivery="2023-07-01"), order(delivery="2023-08-01"), order(delivery=None), order("B"))

    def files(folder):
        live = versions.current(spark, target.path).part_folders()
        own = [place for part, place in live.items() if part.endswith(f"delivery_period={folder}")]
        return sorted(p.name for place in own for p in (Path(target.path) / "data" / place).glob("*.parquet"))

    july, undated, august = files("2023-07-01"), files("__HIVE_DEFAULT_PARTITION__"), files("2023-08-01")
    assert july and undated and august
    source = frame(spark, order(delivery="2023-08-31"), order(delivery="2023-08-01", quantity=9))
    plan = plan_merge(spark, target, source)
    text = plan.rows._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^]]*\(delivery_period#\d+ = 2023-08-01\)\]", text)) == 2
    assert counts(merge_orders(spark, target, source)) == (1, 1, 1)
    assert files("2023-07-01") == july and files("__HIVE_DEFAULT_PARTITION__") == undated
    assert files("2023-08-01") != august
    # A source row without a day touches the partition of such rows, whose old rows must stay.
    merge_orders(spark, target, frame(spark, order(delivery=None, quantity=4)), merge_ts=F.lit(SECOND))
    assert [r[4] for r in content(spark, target) if r[2] == "None"] == [1, 4]


def test_merging_twice_is_merging_once(spark, target):
    source = frame(spark, *(order(c, quantity=i) for i, c in enumerate("ABCDE")))
    merge_orders(spark, target, source, merge_ts=F.lit(FIRST))
    once = content(spark, target)
    assert counts(merge_orders(spark, target, source, merge_ts=F.lit(FIRST))) == (5, 0, 0)
    assert content(spark, target) == once


def test_scratch_is_dropped(spark, target):
    def left():
        return set(Path(shared_folder(spark).removeprefix("file:")).rglob("merge-*"))

    before = left()
    source = frame(spark, order(), order(), order("B"))
    merge_orders(spark, target, source)
    with pytest.raises(MergeCardinalityError):
        merge_orders(spark, target, source)
    assert left() == before


def brute_force(target, source, rule):
    """The statement, row by row. Rows are (customer, ordered, delivery, kind, quantity, file, time)."""

    def key(o):
        return (o[0], o[2], o[3])

    def matchable(o):
        return None not in key(o)

    by_key = {}
    for o in source:
        if matchable(o):
            by_key.setdefault(key(o), []).append(o)
    if rule == "last":
        by_key = {k: [max(v, key=lambda o: (o[1], o[6], o[5], o[4]))] for k, v in by_key.items()}
    known = {key(o) for o in target if matchable(o)}
    if any(len(by_key.get(k, ())) > 1 for k in known):
        return None
    kept = [
        (*o[:4], by_key[key(o)][0][4], by_key[key(o)][0][5], SECOND) if matchable(o) and key(o) in by_key else o
        for o in target
    ]
    new = [o for k, group in by_key.items() if k not in known for o in group]
    return kept + [(*o[:6], SECOND) for o in new + [o for o in source if not matchable(o)]]


@pytest.mark.parametrize(("rule", "grain"), list(itertools.product(["error", "last"], ["day", "month", "year"])))
def test_against_brute_force(spark, tmp_path, rule, grain):
    pick = random.Random(f"{rule}{grain}")

    def some(n, customers):
        return [
            order(
                pick.choice(customers),
                pick.choice(["2022-12-31", "2023-01-01", "2023-01-31", "2023-02-01", None]),
                pick.choice(["Rye", "Roll", None, "Bun"]),
                pick.randint(1, 9),
                pick.choice(["2022-12-01", "2022-12-02"]),
                pick.choice(["f1", "f2"]),
            )
            for _ in range(n)
        ]

    old = some(40, ["A", "B", "C", None])
    # With the literal rule, repeated keys only where the target lacks them, or some clash.
    new = some(60, ["A", "B", "D"] if rule == "last" else ["D", "E"])
    if rule == "error":
        new += [next(o for o in old if None not in o[:4])]
    target = OrderTable(str(tmp_path / "orders"), grain).create(spark)
    merge_orders(spark, target, frame(spark, *old), merge_ts=F.lit(FIRST))
    start = [(*o[:6], FIRST) for o in old]
    merge_orders(spark, target, frame(spark, *new), merge_ts=F.lit(SECOND), on_duplicate=rule)
    wanted = brute_force(start, new, rule)
    assert content(spark, target) == sorted(((o[0], str(o[1]), str(o[2]), *o[3:]) for o in wanted), key=repr)


def test_periods_of_dates(spark):
    day = spark.sql("SELECT date'2023-08-15' AS d")
    got = {g: rows(day.select(storage.period_of(F.col("d"), g)))[0][0] for g in ("day", "month", "year")}
    assert got == {"day": date(2023, 8, 15), "month": date(2023, 8, 1), "year": date(2023, 1, 1)}
    with pytest.raises(ValueError):
        storage.period_of(F.col("d"), "week")
