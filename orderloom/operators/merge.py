"""Merge of order rows into an order table by customer, delivery date and type.

A matched row takes over quantity and source file and keeps its order date; a row not matched is inserted. Parquet has
no MERGE INTO, and one full outer join could not be split where a key is crowded, so the merge is made of
joins that can: the source is first reduced to one row per key, which partial aggregation does before the shuffle,

* ``target LEFT JOIN winners`` updates and keeps, with the target on the side that AQE may split or, for a source
  small enough to broadcast, not shuffled at all;
* ``source LEFT ANTI JOIN matched keys`` inserts.

Only the periods named by the source are read and rewritten.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import storage, versions
from orderloom.schema import MERGE_KEYS, ORDER_COLUMNS, ORDERS, PERIOD, QUANTITY
from orderloom.session import scratch, shuffles_sized_for
from orderloom.storage import OrderTable

UPDATE, INSERT, KEEP = "update", "insert", "keep"
OPERATION = "merge_op"
OLD_QUANTITY = "old_quantity"  # of updated rows, what they had before
DEFAULT_ORDER = ("order_date", "load_ts", "source_file_name")


class MergeCardinalityError(ValueError):
    """Several source rows match the same target row."""


@dataclass(frozen=True)
class MergePlan:
    """New content of the touched periods, each row tagged with what the merge does to it.

    The rows are read from ``scratch_paths``, to be dropped when they are no longer needed.
    """

    rows: DataFrame
    periods: list = field(default_factory=list)
    has_null_period: bool = False
    scratch_paths: tuple[str, ...] = ()
    inputs: tuple[DataFrame, ...] = ()

    @property
    def empty(self) -> bool:
        return not self.periods and not self.has_null_period


@dataclass(frozen=True)
class MergeResult:
    updated: int = 0
    inserted: int = 0
    kept: int = 0
    periods: list = field(default_factory=list)
    has_null_period: bool = False
    version: int | None = None  # of the table, from which its changes can be read; None if the merge published nothing
    repeated: bool = False  # the merge of this id was published before

    @property
    def affected(self) -> int:
        return self.updated + self.inserted


def _matchable() -> Column:
    # NULL equals nothing: a row lacking a key is inserted every time and never updated.
    return reduce(Column.__and__, (F.col(key).isNotNull() for key in MERGE_KEYS))


def reduce_to_winners(rows: DataFrame, order_by: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """One row per key, the last in the given order, with the number of rows that had the key. Keys lacking a column are
    grouped as well; they match nothing.

    Quantity and file end the order, so rows that tie on all of it are equal in what the merge takes from them.
    """
    taken = ["order_date", "quantity", "source_file_name"]
    rank = F.struct(*dict.fromkeys([*order_by, "quantity", "source_file_name", "order_date"]))
    return (
        rows.groupBy(*MERGE_KEYS)
        .agg(F.max(rank).alias("winner"), F.count(F.lit(1)).alias("copies"))
        .select(*MERGE_KEYS, *(f"winner.{name}" for name in taken), "copies")
    )


def matched_keys(target: DataFrame, source: DataFrame) -> DataFrame:
    """Distinct keys found on both sides; ``source`` must have each key once.

    For a source of broadcast size Catalyst moves the semi join below the distinct, and the target is not shuffled;
    otherwise the keys are made distinct per task before they are.
    """
    return target.select(*MERGE_KEYS).distinct().join(source.select(*MERGE_KEYS), MERGE_KEYS, "left_semi")


def plan_merge(
    spark: SparkSession,
    target: OrderTable,
    source: DataFrame,
    merge_ts: Column | None = None,
    insert_ts: Column | None = None,
    on_duplicate: str = "error",
    order_by: Sequence[str] = DEFAULT_ORDER,
) -> MergePlan:
    """Work out a merge without writing to the target.

    ``on_duplicate='error'`` takes the statement literally: of a key that several source rows have, all rows are
    inserted if the target lacks it, and the merge is refused if the target has it. With ``'last'`` only the
    last row of a key counts, whether it is matched or not. ``insert_ts`` is the load time of inserted rows where
    it is to differ from ``merge_ts``.
    """
    if on_duplicate not in ("error", "last"):
        raise ValueError(f"unknown duplicate rule {on_duplicate!r}")
    paths: list[str] = []
    try:
        return _planned(spark, target, source, merge_ts, insert_ts, on_duplicate, order_by, paths)
    except BaseException:
        drop_scratch(spark, paths)
        raise


def _planned(
    spark: SparkSession,
    target: OrderTable,
    source: DataFrame,
    merge_ts: Column | None,
    insert_ts: Column | None,
    on_duplicate: str,
    order_by: Sequence[str],
    paths: list[str],
) -> MergePlan:
    """``paths`` gets the scratch folders as they are made."""
    merge_ts = F.current_timestamp() if merge_ts is None else merge_ts
    insert_ts = merge_ts if insert_ts is None else insert_ts
    period = storage.period_of(F.col("delivery_date"), target.grain)
    columns = list(dict.fromkeys([*ORDER_COLUMNS, *order_by]))

    # The source is evaluated into one row per key in the shared folder, and again only if it has repeated or incomplete
    # keys, whose rows are all needed. The size of what is written there decides about broadcasts.
    winners_path = scratch(spark, "merge-winners")
    paths.append(winners_path)
    rows = source.select(*columns)
    with shuffles_sized_for(spark, rows):
        reduce_to_winners(rows, order_by).write.parquet(winners_path)
    reduced = spark.read.parquet(winners_path)
    found = (
        reduced.groupBy(period.alias("period"))
        .agg(F.max(F.when(_matchable(), F.col("copies"))).alias("copies"), F.max(~_matchable()).alias("incomplete"))
        .collect()
    )
    periods = sorted(row["period"] for row in found if row["period"] is not None)
    has_null = len(periods) < len(found)
    duplicates = on_duplicate == "error" and any((row["copies"] or 0) > 1 for row in found)
    incomplete = any(row["incomplete"] for row in found)
    winners = reduced.filter(_matchable())

    touched = target.read_partitioned(spark).filter(storage.in_periods(periods, has_null))
    hit = matched_keys(touched, winners)
    if duplicates:
        # All rows of a crowded key are inserted, so the anti join has them on its left. Reading the keys from a table
        # leaves AQE a plain shuffle on both sides, which it can split, or a broadcast if they are few. Without any keys
        # the rows need no join, hence no shuffle by key either.
        keys_path, common = scratch(spark, "merge-keys"), Observation()
        paths.append(keys_path)
        with shuffles_sized_for(spark, touched, winners):
            hit.observe(common, F.count(F.lit(1)).alias("keys")).write.parquet(keys_path)
        hit = spark.read.parquet(keys_path)
        clashes = hit.join(winners.filter("copies > 1"), MERGE_KEYS, "left_semi").count()
        if clashes:
            raise MergeCardinalityError(f"{clashes} keys of the target are matched by more than one source row")
        fresh = rows.filter(_matchable())
        if common.get["keys"]:
            fresh = fresh.join(hit, MERGE_KEYS, "left_anti")
    else:
        fresh = winners.join(hit, MERGE_KEYS, "left_anti")

    kept_columns = ["customer", "order_date", "delivery_date", "baked_good_type"]
    incoming = winners.select(
        *MERGE_KEYS, F.col("quantity").alias("_quantity"), F.col("source_file_name").alias("_file"), F.lit(True).alias("_hit")
    )
    was_hit = F.col("_hit").isNotNull()
    updates = touched.join(incoming, MERGE_KEYS, "left").select(
        *kept_columns,
        F.when(was_hit, F.col("_quantity")).otherwise(F.col("quantity")).alias("quantity"),
        F.when(was_hit, F.col("_file")).otherwise(F.col("source_file_name")).alias("source_file_name"),
        F.when(was_hit, merge_ts).otherwise(F.col("load_ts")).alias("load_ts"),
        PERIOD.name,
        F.when(was_hit, F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias(OPERATION),
        F.when(was_hit, F.col("quantity")).alias(OLD_QUANTITY),
    )

    def inserts(frame: DataFrame) -> DataFrame:
        return frame.select(
            *kept_columns, "quantity", "source_file_name", insert_ts.alias("load_ts"),
            period.alias(PERIOD.name), F.lit(INSERT).alias(OPERATION), F.lit(None).cast(QUANTITY).alias(OLD_QUANTITY),
        )

    merged = updates.unionByName(inserts(fresh))
    if incomplete:
        merged = merged.unionByName(inserts(rows.filter(~_matchable())))
    return MergePlan(merged, periods, has_null, tuple(paths), (touched, rows))


def merge_orders(
    spark: SparkSession, target: OrderTable, source: DataFrame, merge_id: str | None = None, **options
) -> MergeResult:
    """Merge the source into the target; options as for ``plan_merge``.

    The touched periods are replaced in one step, after all rows have been written. Rows are spread by period first, so that
    a period gets few large files; AQE splits a period that is too large for one task. A merge with an id is published
    together with it: repeated, it changes nothing and returns what it did the first time.
    """
    if merge_id is not None:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", merge_id):
            raise ValueError(f"merge id {merge_id!r} cannot name a file")
        done = versions.merge_done(spark, target.path, merge_id)
        if done:
            _show(spark, target)  # in case that the first one came no further than its publication
            return replace(_result(done), repeated=True)
    versions.clean(spark, target.path)
    plan = plan_merge(spark, target, source, **options)
    try:
        return _apply(spark, target, plan, merge_id)
    finally:
        drop_scratch(spark, plan.scratch_paths)


def _apply(spark: SparkSession, target: OrderTable, plan: MergePlan, merge_id: str | None) -> MergeResult:
    done = dict.fromkeys((UPDATE, INSERT, KEEP), 0)
    mark = None
    if not plan.empty:
        # Counted in the writing stage, where a repeated task is not counted again.
        counts = Observation()
        rows = plan.rows.hint("rebalance", F.col(PERIOD.name)).observe(
            counts, *(F.count_if(F.col(OPERATION) == op).alias(op) for op in (UPDATE, INSERT, KEEP))
        )
        part = F.when(F.col(OPERATION) == KEEP, F.lit(versions.KEPT)).otherwise(F.lit(versions.CHANGED))
        with shuffles_sized_for(spark, *plan.inputs):
            mark = versions.write(rows.withColumn(versions.PART, part), target.path)
        done = counts.get
    elif merge_id is None:
        return MergeResult()
    merge = {"id": merge_id, "done": done, "periods": [p.isoformat() for p in plan.periods], "undated": plan.has_null_period, "mark": mark}
    published = versions.commit(spark, target.path, mark, merge=merge)
    _show(spark, target)
    return _result(published.merge)


def _result(merge: dict) -> MergeResult:
    done = merge["done"]
    periods = [date.fromisoformat(p) for p in merge["periods"]]
    return MergeResult(done[UPDATE], done[INSERT], done[KEEP], periods, merge["undated"], merge["number"])


def _show(spark: SparkSession, target: OrderTable) -> None:
    if target.name:
        versions.show_named(spark, target.name, target.path, ORDERS)


def changes(spark: SparkSession, target: OrderTable, version: int | None = None) -> DataFrame:
    """Rows that a recent publication wrote, ``merge_op`` and what updated ones had before in ``old_quantity``.

    They have files of their own, so no other row of the order table is read.
    """
    known = {v.number: v for v in versions.recent(spark, target.path)}
    number = max(known, default=None) if version is None else version
    schema = T.StructType([*ORDERS.fields, T.StructField(OPERATION, T.StringType()), T.StructField(OLD_QUANTITY, QUANTITY)])
    if number is None:
        return spark.createDataFrame([], schema)
    if number not in known:
        raise LookupError(f"version {number} is no longer kept")
    mark = known[number].merge.get("mark")
    wrote = any(part.startswith(f"{versions.PART}={versions.CHANGED}/") for part in known[number].parts.get(mark, []))
    if not wrote:
        return spark.createDataFrame([], schema)
    folder = f"{target.path}/{versions.DATA}/{versions.VERSION}={mark}/{versions.PART}={versions.CHANGED}"
    return spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())


def drop_scratch(spark: SparkSession, paths: Sequence[str]) -> None:
    for path in paths:
        storage.delete(spark, path)
