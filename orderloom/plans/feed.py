"""The order feed of the driver tables, and its delivery as files.

Order lines become ordered items: the nation a customer belongs to is the ordering customer, the part type the item,
the ship date the delivery day. The market segment decides which of three channels an order comes in by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schema import QUANTITY
from orderloom import storage
from orderloom.session import partitions_for, scratch, shuffles_dropped, stored, stored_at, unsorted_writes
from orderloom.sources.stage import Stage

INTERNAL, EXTERNAL, DOCUMENTS = "internal", "external", "documents"
CHANNELS = {
    "BUILDING": INTERNAL,
    "AUTOMOBILE": INTERNAL,
    "MACHINERY": EXTERNAL,
    "HOUSEHOLD": EXTERNAL,
}  # all other segments: documents

# Name of a delivered file, which Spark writes as a folder of part files.
DELIVERY = r"Orders_[0-9]{4}\.(csv|json)"
LINES_PER_DOCUMENT = 4  # a document has one such window of its order's line numbers
# Feed, as stored, whose documents one task puts together: a row takes some sixty times as much there, and must not spill.
DOCUMENT_TASK_BYTES = 2 << 20
TASKS_PER_FILE = 8  # of those that put documents together: a delivered file is dealt over an eighth of them

# Seven years of deliveries, all of which every channel touches.
GRAIN = "year"


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines as feed rows. Join strategies are left to Catalyst and AQE: the small tables are broadcast as
    long as they are small, and a crowded order is split."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    segment = F.col("c_mktsegment")
    channel = F.lit(DOCUMENTS)
    for name, assigned in CHANNELS.items():
        channel = F.when(segment == name, assigned).otherwise(channel)
    return (
        table("lineitem")
        .select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_linenumber")
        .join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("n_name").alias("customer"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_shipdate").cast("date").alias("delivery_date"),
            F.col("p_type").alias("baked_good_type"),
            F.col("l_quantity").cast(QUANTITY).alias("quantity"),
            channel.alias("channel"),
            "l_orderkey",
            "l_linenumber",
        )
    )


def _delivered(rows: DataFrame, suffix: str) -> DataFrame:
    return rows.withColumn("file", F.concat(F.lit("Orders_"), F.date_format("order_date", "yyyy"), F.lit(suffix)))


def write_feed(feed: DataFrame, path: str) -> None:
    """The feed as a table by channel, of which deliveries are made."""
    with unsorted_writes(feed.sparkSession), shuffles_dropped(feed.sparkSession):
        feed.write.partitionBy("channel").parquet(path)


def write_csv_delivery(feed: DataFrame, path: str) -> None:
    """Yearly CSV files per channel, added to what the folder has. A year too large for one task becomes several part files."""
    rows = _delivered(feed, ".csv").select(
        F.col("customer").alias("Customer"),
        F.col("order_date").alias("Order date"),
        F.col("delivery_date").alias("Delivery date"),
        F.col("baked_good_type").alias("Baked good type"),
        F.col("quantity").alias("Quantity"),
        "channel", "file",
    )
    spread = rows.hint("rebalance", F.col("channel"), F.col("file"))
    with unsorted_writes(feed.sparkSession), shuffles_dropped(feed.sparkSession):
        spread.write.mode("append").option("header", True).partitionBy("channel", "file").csv(path)


def documents(feed: DataFrame) -> DataFrame:
    """One nested document per order and window of LINES_PER_DOCUMENT line numbers, so that no document and no group grows
    with the data; with the name of its yearly file."""
    # One shuffle serves both groupings, as their keys contain those it goes by, and the writing: a file comes from some of
    # the tasks. Their number is given, as AQE would merge them by their compressed size, which says little about the lists
    # made of them.
    tasks = partitions_for(feed.sparkSession, feed, each=DOCUMENT_TASK_BYTES)
    dealt = ["channel", "file", "deal"]
    document = [*dealt, "l_orderkey", "part", "customer", "order_date"]
    item = F.struct(F.col("baked_good_type").alias("Baked good type"), F.col("quantity").alias("Quantity"))
    deal = F.pmod(F.xxhash64("l_orderkey", "part"), F.lit(tasks // TASKS_PER_FILE + 1))
    return (
        _delivered(feed, ".json")
        .withColumn("part", F.floor((F.col("l_linenumber") - 1) / LINES_PER_DOCUMENT))
        .withColumn("deal", deal)
        .repartition(tasks, *dealt)
        .groupBy(*document, "delivery_date")
        .agg(F.collect_list(item).alias("items"))
        .groupBy(*document)
        .agg(
            F.collect_list(
                F.struct(F.col("delivery_date").alias("Delivery date"), F.col("items").alias("Orders by day"))
            ).alias("days")
        )
    )


def write_json_delivery(feed: DataFrame, path: str) -> None:
    """Yearly files per channel, one document per line, added to what the folder has. Compressed, as the names of the fields
    are most of the text; a task writes little enough to a file that none need be split."""
    body = F.to_json(
        F.struct(
            F.col("customer").alias("Customer"),
            F.col("order_date").alias("Order date"),
            F.col("days").alias("Orders"),
        )
    )
    rows = documents(feed).select(body.alias("value"), "channel", "file")
    with unsorted_writes(feed.sparkSession), shuffles_dropped(feed.sparkSession):
        rows.write.mode("append").option("compression", "gzip").partitionBy("channel", "file").text(path)


def with_region(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Rows with the region of their customer. The few nations are what is broadcast: flattened documents are estimated far
    too small, so that Spark would take them all to the driver."""
    nations, regions = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("nation", "region"))
    customers = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("customer"), F.col("r_name").alias("region")
    )
    return rows.join(F.broadcast(customers), "customer")


def write_document_files(spark: SparkSession, sf_dir: str, orders: DataFrame, path: str) -> None:
    """One file, of one document, for each region and order date.

    A document is bounded by what a customer, here a region, orders in a day. Larger deliveries go one document per line.
    """
    item = F.struct(F.col("baked_good_type").alias("Baked good type"), F.col("quantity").alias("Quantity"))
    days = with_region(spark, sf_dir, orders).groupBy("region", "order_date", "delivery_date").agg(
        F.collect_list(item).alias("items")
    )
    day = F.struct(F.col("delivery_date").alias("Delivery date"), F.col("items").alias("Orders by day"))
    whole = days.groupBy("region", "order_date").agg(F.collect_list(day).alias("days"))
    body = F.struct(
        F.col("region").alias("Customer"), F.col("order_date").alias("Order date"), F.col("days").alias("Orders")
    )
    # A number of partitions that AQE leaves alone, as it is the files that take time, not the rows.
    spread = whole.repartition(partitions_for(spark, orders), "region", "order_date")
    rows = spread.select(F.to_json(body).alias("value"), "region")
    # Tasks move their files themselves; one by one in the driver they would take long.
    committed = rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    committed.option("maxRecordsPerFile", 1).partitionBy("region").text(path)


def stage_of(path: str, channel: str | None = None) -> Stage:
    """The delivery as a stage: of one channel, or whole."""
    root = path if channel is None else f"{path}/channel={channel}"
    return Stage(root, delivery=DELIVERY)


def write_giant_documents(spark: SparkSession, sf_dir: str, feed: DataFrame, path: str) -> None:
    """One file, of one document, for each region, with a day entry for each order and delivery day.

    The document grows with the data, but is never put together: its entries are sorted and written as lines.
    """
    item = F.struct(F.col("baked_good_type").alias("Baked good type"), F.col("quantity").alias("Quantity"))
    lines = with_region(spark, sf_dir, feed)
    # Stored, so that what it takes to group the lines is gone when the entries are sorted.
    kept = scratch(spark, "days")
    days = stored_at(lines.groupBy("region", "delivery_date", "l_orderkey").agg(F.collect_list(item).alias("items")), kept)
    first = F.min(F.struct("delivery_date", "l_orderkey")).alias("first")
    ends = stored(lines.groupBy("region").agg(F.min("order_date").alias("order_date"), first), "ends")  # a row for each region
    is_first = (F.col("delivery_date") == F.col("first.delivery_date")) & (F.col("l_orderkey") == F.col("first.l_orderkey"))
    entry = F.to_json(F.struct(F.col("delivery_date").alias("Delivery date"), F.col("items").alias("Orders by day")))
    order = ["region", "place", "delivery_date", "l_orderkey"]
    entries = days.join(ends, "region").select(
        "region",
        F.lit(1).alias("place"),
        "delivery_date",
        "l_orderkey",
        F.concat(F.when(is_first, F.lit("")).otherwise(F.lit(",")), entry).alias("value"),
    )

    def frame(place: int, value: Column) -> DataFrame:
        no_day, no_order = F.lit(None).cast("date"), F.lit(None).cast("long")
        return ends.select(
            "region", F.lit(place).alias("place"), no_day.alias("delivery_date"), no_order.alias("l_orderkey"), value.alias("value")
        )

    named = F.to_json(F.struct(F.col("region").alias("Customer"), F.col("order_date").alias("Order date")))
    head = frame(0, F.concat(F.regexp_replace(named, r"\}$", ""), F.lit(',"Orders":[')))
    texts = entries.unionByName(head).unionByName(frame(2, F.lit("]}")))
    # A file is written by one task, row by row. Dealt by a hash, as the parts of the union are dealt by region already, from
    # which Spark would conclude that no shuffle is needed, though AQE may have split them.
    ordered = texts.repartition(partitions_for(spark, feed), F.xxhash64("region")).sortWithinPartitions(*order)
    with shuffles_dropped(spark):
        ordered.select("value", "region").write.partitionBy("region").text(path)
    storage.delete(spark, kept)
