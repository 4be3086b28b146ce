"""Shapes of the physical plans: what is shuffled, split, broadcast and pruned."""

from __future__ import annotations

import contextlib
import json
import re
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import deliver_text, rows
from orderloom import queries, session, storage, versions
from orderloom.operators.flatten import flatten_orders
from orderloom.operators.load import load_json, read_staged_documents
from orderloom.operators.merge import MERGE_KEYS, matched_keys, merge_orders, plan_merge, reduce_to_winners
from orderloom.operators.summary import summarise
from orderloom.plans import feed as feeds
from orderloom.plans.feed import LINES_PER_DOCUMENT, documents, order_feed, write_csv_delivery
from orderloom.queries import QUERIES, csv_stage, json_stage, stored_feed
from orderloom.schema import ORDERS
from orderloom.storage import OrderTable
from samples import DOCUMENT


SF_DIR = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# Sizes at which a few thousand rows behave like a cluster's partitions.
SMALL = {
    "spark_sql_autoBroadcastJoinThreshold": "-1",
    "spark_sql_adaptive_autoBroadcastJoinThreshold": "-1",
    "spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes": "20000",
    "spark_sql_adaptive_skewJoin_skewedPartitionFactor": "2",
    "spark_sql_adaptive_advisoryPartitionSizeInBytes": "20000",
    "spark_sql_adaptive_coalescePartitions_minPartitionSize": "1",
    "spark_sql_shuffle_partitions": "20",
}


def many_orders(spark, n, crowded):
    """n order rows, a part of which have one and the same key."""
    shared = F.rand(1) < crowded
    return spark.range(0, n, 1, 8).select(
        F.when(shared, "crowd").otherwise(F.concat(F.lit("c"), "id")).alias("customer"),
        F.lit("2023-08-01").cast("date").alias("order_date"),
        F.when(shared, F.lit("2023-08-02").cast("date")).otherwise(F.date_add(F.lit("2023-08-02").cast("date"), (F.col("id") % 20).cast("int"))).alias("delivery_date"),
        F.lit("Rye").alias("baked_good_type"),
        F.lit(1).cast("decimal(38,0)").alias("quantity"),
        F.concat(F.lit("f"), F.col("id")).alias("source_file_name"),
        F.lit("2023-08-01").cast("timestamp").alias("load_ts"),
    )


def executed(frame) -> str:
    frame.write.format("noop").mode("overwrite").save()  # not this plan object, but warms the same inputs
    physical = frame._jdf.queryExecution().executedPlan()
    frame._jdf.queryExecution().toRdd().count()
    return physical.toString()


@pytest.fixture
def target(spark, tmp_path):
    return OrderTable(str(tmp_path / "orders")).create(spark)


def test_summary_is_summed_before_the_shuffle(spark):
    plan = summarise(many_orders(spark, 10, 0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "partial_sum" in plan and "Python" not in plan


def test_flatten_has_no_shuffle(spark):
    raw = spark.createDataFrame([("{}", "f")], "t string, source_file_name string")
    plan = flatten_orders(raw.select(F.parse_json("t").alias("customer_orders"), "source_file_name"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Generate variant_explode") == 2
    assert not re.search("Exchange|Join|Python", text)


def test_repeated_keys_are_reduced_before_the_shuffle(spark):
    plan = reduce_to_winners(many_orders(spark, 10, 0.3))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and plan.count("Exchange") == 1


def test_crowded_target_key_is_split(spark, target):
    with settings(spark, **SMALL):
        merge_orders(spark, target, many_orders(spark, 20000, 0.5))
        source = many_orders(spark, 3000, 0.5)
        plan = plan_merge(spark, target, source, on_duplicate="last")
        text = executed(plan.rows)
    assert "SortMergeJoin(skew=true)" in text
    assert "FullOuter" not in text and "Cartesian" not in text and "NestedLoop" not in text
    by_op = dict(plan.rows.groupBy("merge_op").count().collect())
    assert by_op["update"] > 10000 and sum(by_op.values()) >= 20000


def test_crowded_new_key_is_split(spark, target):
    """All rows of a repeated key that the target lacks are inserted."""
    with settings(spark, **SMALL):
        merge_orders(spark, target, many_orders(spark, 3000, 0))
        source = many_orders(spark, 20000, 0.5).withColumn("customer", F.concat(F.lit("new"), "customer"))
        known = many_orders(spark, 100, 0)
        plan = plan_merge(spark, target, source.unionByName(known))
        text = executed(plan.rows)
        assert "SortMergeJoin(skew=true)" in text
        assert dict(plan.rows.groupBy("merge_op").count().collect()) == {"update": 100, "keep": 2900, "insert": 20000}
        # With no key in common the rows are not shuffled by key at all.
        apart = plan_merge(spark, target, source).rows._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in apart


def test_crowded_period_becomes_several_files(spark, tmp_path):
    target = OrderTable(str(tmp_path / "orders"), "year").create(spark)
    with settings(spark, **SMALL):
        merge_orders(spark, target, many_orders(spark, 20000, 0.3))
    files = target.read_partitioned(spark).select("_metadata.file_name").distinct().count()
    assert files > 3
    assert target.read(spark).count() == 20000


def test_small_source_does_not_shuffle_the_target(spark, target):
    merge_orders(spark, target, many_orders(spark, 5000, 0))
    plan = plan_merge(spark, target, many_orders(spark, 50, 0), on_duplicate="last")
    text = plan.rows._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"BroadcastHashJoin \[[^]]*\], \[[^]]*\], (\w+), (\w+)", text)
    assert sorted(joins) == [("LeftAnti", "BuildRight"), ("LeftOuter", "BuildRight"), ("LeftSemi", "BuildRight")]
    # The only shuffle is that of the matched keys, after the join with the source.
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in text and "Python" not in text


def test_large_source_meets_distinct_keys(spark, target):
    merge_orders(spark, target, many_orders(spark, 500, 0.5))
    with settings(spark, **SMALL):
        keys = matched_keys(target.read(spark), reduce_to_winners(many_orders(spark, 500, 0)))
        text = keys._jdf.queryExecution().optimizedPlan().toString()
    assert re.match(r"Join LeftSemi[^\n]*\n:- Aggregate", text)
    assert keys.columns == MERGE_KEYS


def test_summary_of_a_period_reads_three_columns(spark, target):
    merge_orders(spark, target, many_orders(spark, 50, 0))
    text = summarise(target.read(spark))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<delivery_date:date,baked_good_type:string,quantity:decimal(38,0)>" in text


def order_lines(spark, crowded_lines):
    """Feed rows in the shape of the driver tables': 200 small orders and one with very many lines."""
    return spark.range(800 + crowded_lines).select(
        F.least(F.floor(F.col("id") / 4), F.lit(200)).alias("l_orderkey"),
        F.when(F.col("id") < 800, F.col("id") % 4 + 1).otherwise(F.col("id") - 799).alias("l_linenumber"),
        F.lit("c").alias("customer"),
        F.lit("2023-08-01").cast("date").alias("order_date"),
        F.date_add(F.lit("2023-08-02").cast("date"), (F.col("id") % 3).cast("int")).alias("delivery_date"),
        F.lit("Rye").alias("baked_good_type"),
        F.lit(1).cast("decimal(38,0)").alias("quantity"),
        F.lit("documents").alias("channel"),
    )


def test_documents_do_not_grow_with_an_order(spark):
    made = documents(order_lines(spark, 20 * LINES_PER_DOCUMENT))
    items = F.aggregate(F.transform("days", lambda d: F.size(d["Orders by day"])), F.lit(0), lambda a, b: a + b)
    sizes = [r[0] for r in rows(made.select(items))]
    assert sum(sizes) == 800 + 20 * LINES_PER_DOCUMENT
    assert max(sizes) == LINES_PER_DOCUMENT == 4
    assert len(sizes) == 200 + 20


def test_crowded_delivery_becomes_several_part_files(spark, tmp_path):
    path = str(tmp_path / "csv")
    with settings(spark, **SMALL):
        write_csv_delivery(order_lines(spark, 20000).repartition(8), path)
    parts = list((tmp_path / "csv").rglob("part-*.csv"))
    assert len(parts) > 1
    assert spark.read.csv(path, header=True).count() == 20800


def small_tables(spark, path) -> str:
    """The order feed's tables, with an order of each market segment."""
    segments = ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"]
    day = "timestamp_ntz'2001-02-03 00:00:00'"
    made = {
        "nation": spark.sql("SELECT 0 AS n_nationkey, 'PERU' AS n_name, 1 AS n_regionkey"),
        "part": spark.sql("SELECT 7L AS p_partkey, 'SMALL' AS p_type"),
        "customer": spark.createDataFrame(list(enumerate(segments)), "c_custkey long, c_mktsegment string").selectExpr("*", "0 AS c_nationkey"),
        "orders": spark.range(5).selectExpr("id AS o_orderkey", "id AS o_custkey", f"{day} AS o_orderdate"),
        "lineitem": spark.range(40).selectExpr(
            "id % 5 AS l_orderkey", "7L AS l_partkey", "2D AS l_quantity", f"{day} AS l_shipdate", "int(id DIV 5) + 1 AS l_linenumber"
        ),
    }
    for name, table in made.items():
        table.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_a_channel_is_delivered_when_it_is_first_read(spark, tmp_path):
    sf_dir = small_tables(spark, tmp_path)
    stage = json_stage(spark, sf_dir, feeds.DOCUMENTS)
    base = Path(stage.root).parents[1]

    def delivered():
        return sorted(str(p.relative_to(base)) for p in base.glob("*/channel=*") if p.parent.name != "feed")

    assert delivered() == ["json/channel=documents"]
    assert {p.suffix for p in Path(stage.root).rglob("part-*")} == {".gz"}
    first = [p.name for p in Path(stage.root).rglob("part-*")]
    assert spark.read.option("recursiveFileLookup", True).json(stage.root).count() == 2  # an order of eight lines
    assert csv_stage(spark, sf_dir, feeds.INTERNAL).root == f"{base}/csv/channel=internal"
    assert delivered() == ["csv/channel=internal", "json/channel=documents"]
    whole = csv_stage(spark, sf_dir)
    assert delivered() == [*(f"csv/channel={c}" for c in ("documents", "external", "internal")), "json/channel=documents"]
    assert spark.read.csv(whole.root, header=True).groupBy("channel").count().count() == 3
    assert spark.read.csv(whole.root, header=True).count() == stored_feed(spark, sf_dir).count() == 40
    json_stage(spark, sf_dir)
    assert len(delivered()) == 6
    assert [p.name for p in Path(stage.root).rglob("part-*")] == first  # a channel is delivered once


def test_bad_files_are_there_for_their_own_attempt_only(spark, tmp_path, monkeypatch):
    sf_dir, seen = small_tables(spark, tmp_path), []

    def run_job(spark, name, job):
        folder = Path(session.scratch(spark, "x")).parent
        seen.append(sorted(p.name for p in folder.glob("bad-*/*") if str(p.parent) not in old))
        return keep(spark, name, job)

    old, keep = {str(p) for p in Path(session.scratch(spark, "x")).parent.glob("bad-*")}, queries.run_job
    monkeypatch.setattr(queries, "run_job", run_job)
    got = rows(QUERIES["load_abort"](spark, sf_dir))
    assert seen == [["row"], ["date"], ["documents"]]
    assert got == [("date", False, "date", 40, 40), ("documents", False, "documents", 10, 10), ("row", False, "row", 40, 40)]


def shuffled(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_shuffled_files_go_when_a_write_ends(spark, target, tmp_path):
    def left_by(write) -> set[str]:
        before = shuffled(spark)
        write()
        for _ in range(50):  # they are deleted in the background
            left = shuffled(spark) - before
            if not left:
                break
            time.sleep(0.1)
        return left

    lines = order_lines(spark, 200).repartition(4)
    assert left_by(lambda: write_csv_delivery(lines, str(tmp_path / "csv"))) == set()
    assert left_by(lambda: feeds.write_json_delivery(lines, str(tmp_path / "json"))) == set()
    assert left_by(lambda: feeds.write_feed(lines, str(tmp_path / "feed"))) == set()
    assert left_by(lambda: session.stored(lines, "lines")) == set()
    orders = many_orders(spark, 500, 0.1).repartition(4)
    assert left_by(lambda: storage.overwrite_all_of(orders.withColumn("p", F.lit("x")), str(tmp_path / "p"), p="x")) == set()
    with session.shuffles_sized_for(spark, orders):
        assert left_by(lambda: orders.write.parquet(str(tmp_path / "sized"))) == set()


def test_shuffles_grow_with_the_inputs(spark, target, monkeypatch):
    merge_orders(spark, target, many_orders(spark, 5000, 0))
    number = "spark.sql.shuffle.partitions"
    before = spark.conf.get(number)
    with session.shuffles_sized_for(spark, target.read(spark)):
        assert spark.conf.get(number) == before  # a small table needs no more
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 1 << 10)
    with session.shuffles_sized_for(spark, target.read(spark)):
        assert int(spark.conf.get(number)) > int(before)
    assert spark.conf.get(number) == before
    assert merge_orders(spark, target, many_orders(spark, 5000, 0)).updated == 5000
    joined = target.read(spark).crossJoin(target.read(spark))  # estimated at the product of both
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 1 << 16)
    assert session.partitions_for(spark, joined) <= 2 * session.partitions_for(spark, target.read(spark))


def test_documents_are_made_by_more_tasks_as_the_feed_grows(spark, tmp_path, monkeypatch):
    order_feed(spark, SF_DIR).write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    monkeypatch.setattr(feeds, "DOCUMENT_TASK_BYTES", 1 << 10)
    assert documents(feed).rdd.getNumPartitions() > 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_scans_of_a_merge_take_little_per_task(spark, target):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with session.shuffles_sized_for(spark, target.read(spark)):
        assert int(spark.conf.get(name)) == session.SCAN_BYTES
    assert spark.conf.get(name) == before


def test_regions_are_broadcast_not_orders(spark):
    few = order_feed(spark, SF_DIR).limit(1).selectExpr("customer").distinct()  # estimated smaller than the nations
    plan = feeds.with_region(spark, SF_DIR, few)._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "HashJoin [customer" in line)
    assert "BuildRight" in join


def test_results_run_with_enough_partitions(spark, monkeypatch):
    """Sorts, merges, flattening and the feed join, in plans of queries that run after they were returned."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 1 << 12)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        names = ["orders_sorted", "merge_insert", "flatten_one_level"]
        session.size_session(spark, order_feed(spark, SF_DIR))
        wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert wanted > int(before)
        for frame in (order_feed(spark, SF_DIR), *(QUERIES[name](spark, SF_DIR) for name in names)):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            numbers = [int(n) for n in re.findall(r"(?:hash|range)partitioning\(.*, (\d+)\)", plan)]
            assert all(n > int(before) for n in numbers), numbers
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_publication_that_fails_leaves_every_old_row(spark, target, monkeypatch):
    merge_orders(spark, target, many_orders(spark, 500, 0))
    before = sorted(map(tuple, target.read(spark).collect()))

    def failing(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(versions, "_appear", failing)  # all rows are written, the version's file is not
        with pytest.raises(OSError):
            merge_orders(spark, target, many_orders(spark, 500, 1))
    assert sorted(map(tuple, target.read(spark).collect())) == before
    assert len(list(Path(target.path).glob("data/*"))) == 2
    assert versions.clean(spark, target.path) == 1  # what was written for nothing
    assert merge_orders(spark, target, many_orders(spark, 500, 1)).affected == 500
    assert target.read(spark).count() == 1000 and not list(Path(target.path).glob("*/_*"))


def test_readers_see_whole_versions_between_all_steps(spark, tmp_path, monkeypatch):
    """By path and by name, at each call that writes, renames, deletes or alters something."""
    spark.sql("CREATE DATABASE IF NOT EXISTS steps")
    target = OrderTable(str(tmp_path / "orders"), "day", "steps.orders").create(spark)

    def orders_of(number):
        return many_orders(spark, 300 + 10 * number, 0).withColumn("quantity", F.lit(number).cast("decimal(38,0)"))

    merge_orders(spark, target, orders_of(0))

    def seen():
        by_path = target.read(spark).groupBy("quantity").count().collect()
        by_name = spark.sql("SELECT quantity, count(*) AS count FROM steps.orders GROUP BY ALL").collect()
        return [{int(q): n for q, n in found} for found in (by_path, by_name)]

    old = seen()
    assert old[0] == old[1]
    looks = []

    def looking(function):
        def looked(*args, **options):
            looks.append(seen())
            result = function(*args, **options)
            looks.append(seen())
            return result

        return looked

    class Session:  # a session whose statements are looked at
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text, **options):
            alters = text.lstrip().startswith(("ALTER", "CREATE OR", "DROP"))
            return looking(spark.sql)(text, **options) if alters else spark.sql(text, **options)

    shown = versions.show_named
    with monkeypatch.context() as patched:
        for name in ("write", "commit", "clean", "_appear", "_delete"):
            patched.setattr(versions, name, looking(getattr(versions, name)))
        patched.setattr(versions, "show_named", lambda _, *rest: shown(Session(), *rest))
        for round_ in (1, 2, 3):
            looks.clear()
            merge_orders(spark, target, orders_of(round_))
            new = seen()
            assert new[0] == new[1] != old[0] and len(looks) > 10
            assert all(found in (old[0], new[0]) for look in looks for found in look)
            old = new
    assert spark.sql("SELECT * FROM steps.orders").columns == [*ORDERS.fieldNames(), "delivery_period"]
    versions.drop_named(spark, "steps.orders")
    spark.sql("DROP DATABASE steps CASCADE")


def test_staged_documents_are_shredded_and_read_by_field(spark, workspace, stage):
    """A query of two fields reads their own parquet columns of the raw staging table, not the documents."""
    for number in range(3):
        deliver_text(stage, f"{number}.json", json.dumps(DOCUMENT))
    load_json(spark, stage, workspace.document_staging, "l1")
    file = next(Path(workspace.document_staging.path).rglob("*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {column.path_in_schema: column for column in map(group.column, range(group.num_columns))}
    assert "customer_orders.typed_value.Customer.typed_value" in columns
    assert "customer_orders.typed_value.Orders.typed_value.list.element.typed_value.Delivery date.typed_value" in columns
    staged = read_staged_documents(spark, workspace.document_staging)
    fields = staged.selectExpr("variant_get(customer_orders, '$.Customer', 'string') AS customer")
    read = re.search(r"ReadSchema: struct<customer_orders:struct<0:string>>", fields._jdf.queryExecution().executedPlan().toString())
    assert read and {row["customer"] for row in fields.collect()} == {DOCUMENT["Customer"]}
    own = columns["customer_orders.typed_value.Customer.typed_value"].total_compressed_size
    assert own < sum(column.total_compressed_size for path, column in columns.items() if path.startswith("customer_orders")) / 4
