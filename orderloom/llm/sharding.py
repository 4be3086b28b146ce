"""Put documents into shards of even counts by balanced label propagation. Built-in functions only.

Documents with equal texts are linked. Their links are never written out as pairs: all neighbours of a document are in its
group, so what a document sees of its neighbours is how many of the group each shard has. In each round documents ask to
move to the shard that has most of their neighbours, and moves are granted while that shard has room. In the end every
shard keeps at most its quota of documents that sit with their group. All others, groups first, fill the rooms that are
left from the first shard to the last, so that a group larger than a shard comes to lie in few of them.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import sized_for, stored

ROUNDS = 4
STEPS = 1024  # grades of priority among those who ask for one shard
ROWS_A_CELL = 20_000


def _numbered(frame: DataFrame, lane: str, cell: list[str], order: list[str]) -> DataFrame:
    """The frame with ``rank``, gapless from 0 in each lane, by cell and then by order.

    Only a cell's rows meet in one task; cells are made small. The cells themselves are few.
    """
    counts = frame.groupBy(lane, *cell).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(lane).orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(lane, *cell, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(lane, *cell).orderBy(*order))
    return (
        frame.withColumn("_inside", inside)
        .join(offsets, [lane, *cell])
        .withColumn("rank", F.col("_offset") + F.col("_inside") - 1)
        .drop("_inside", "_offset")
    )


def _looked_up(values: list[int], at: Column) -> Column:
    return F.get(F.array(*(F.lit(v).cast("long") for v in values)), at)


def _round(labels: DataFrame, quotas: list[int]) -> tuple[DataFrame, int]:
    """One round: the new labels and how many have moved."""
    tally = labels.groupBy("g1", "g2", "shard").agg(F.count(F.lit(1)).alias("here"))
    best = (
        tally.groupBy("g1", "g2")
        .agg(F.max(F.struct("here", F.xxhash64("g1", "shard").alias("tie"), "shard")).alias("best"))
        .select("g1", "g2", F.col("best.shard").alias("home"))
    )
    asked = labels.select("row", "g1", "g2", "shard").join(best, ["g1", "g2"])
    asked = stored(asked.withColumn("step", F.pmod(F.xxhash64("g1", "g2", F.lit(7)), F.lit(STEPS)).cast("int")), "asked")
    fill = {row["shard"]: row["n"] for row in asked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    demand = (
        asked.where("shard <> home").groupBy("home", "step").agg(F.count(F.lit(1)).alias("n")).collect()
    )  # STEPS rows a shard at most
    moving = sum(row["n"] for row in demand)
    if not moving:
        return asked, 0
    room = {s: max(0, quota - fill.get(s, 0)) for s, quota in enumerate(quotas)}
    last_step, share = [STEPS] * len(quotas), [STEPS] * len(quotas)  # all below last_step, of last_step a share
    for row in sorted(demand, key=lambda row: (row["home"], row["step"])):
        s = row["home"]
        if last_step[s] < STEPS:
            continue
        if row["n"] > room[s]:
            last_step[s], share[s] = row["step"], STEPS * room[s] // row["n"]
        room[s] -= row["n"]
    limit = _looked_up(last_step, F.col("home"))
    lot = F.pmod(F.xxhash64("row"), F.lit(STEPS))
    granted = (F.col("step") < limit) | ((F.col("step") == limit) & (lot < _looked_up(share, F.col("home"))))
    moved = asked.withColumn("shard", F.when(granted, F.col("home")).otherwise(F.col("shard")))
    return stored(moved, "labels"), moving


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` of every row.

    The law is ``rows``: counts of shards are at most one apart. Null texts count as empty ones, which are equal to each
    other. Rows without id and repeated rows are rows like others. An empty table gives no rows.
    """
    sized_for(docs)
    text = F.coalesce("text", F.lit(""))
    base = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("g1"),
            F.xxhash64(text, F.lit(1)).alias("g2"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    total = base.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    groups = base.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    linked = base.select("row", "g1", "g2").join(groups, ["g1", "g2"])
    first = F.pmod(F.xxhash64("row", F.lit(3)), F.lit(shards)).cast("int")
    labels = stored(linked.select("row", "g1", "g2", first.alias("shard")), "labels")
    for _ in range(ROUNDS):
        labels, moving = _round(labels, quotas)
        if not moving:
            break

    # Those that sit where most of their group does, up to the quota.
    cells = math.ceil(total / shards / ROWS_A_CELL) or 1
    if "home" not in labels.columns:
        labels = labels.withColumn("home", F.col("shard"))
    seated = labels.where("shard = home").withColumn("cell", F.pmod(F.xxhash64("g1", "row"), F.lit(cells)))
    quota = _looked_up(quotas, F.col("shard"))
    seated = stored(
        _numbered(seated, "shard", ["cell"], ["g1", "g2", "row"]).where(F.col("rank") < quota).select("row", "shard", "rank"),
        "seated",
    )
    taken = {row["shard"]: row["n"] for row in seated.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    rooms = [quota - taken.get(s, 0) for s, quota in enumerate(quotas)]

    # The others, by group; a large group is cut into cells of its own.
    others = base.select("row", "g1", "g2").join(seated.select("row"), "row", "left_anti").join(groups, ["g1", "g2"], "left")
    large = F.coalesce("members", F.lit(1)) > ROWS_A_CELL
    others = others.select(
        "row",
        "g1",
        "g2",
        F.lit(0).alias("lane"),
        F.when(F.col("members").isNull(), 1).otherwise(0).alias("alone"),
        F.pmod(F.xxhash64("g1", "g2"), F.lit(math.ceil(total / ROWS_A_CELL) or 1)).alias("part"),
        F.when(large, F.col("g1")).otherwise(0).alias("own"),
        F.when(large, F.pmod(F.xxhash64("row"), F.ceil(F.col("members") / ROWS_A_CELL))).otherwise(0).alias("salt"),
    )
    ranked = _numbered(others, "lane", ["alone", "part", "own", "salt"], ["g1", "g2", "row"])
    ends = list(accumulate(rooms))
    shard = F.size(F.filter(F.array(*(F.lit(e).cast("long") for e in ends)), lambda e: e <= F.col("rank")))
    filled = ranked.select("row", "rank", shard.cast("int").alias("shard"))
    start = _looked_up([e - r for e, r in zip(ends, rooms, strict=True)], F.col("shard"))
    kept = _looked_up([taken.get(s, 0) for s in range(shards)], F.col("shard"))
    filled = filled.select("row", "shard", (F.col("rank") - start + kept).alias("slot"))
    places = seated.select("row", "shard", F.col("rank").alias("slot")).unionByName(filled)
    return base.join(places, "row").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
