"""The registered queries: every operator over the driver tables.

The order feed of the driver tables is delivered as CSV files and as JSON documents once per session and data folder, a
channel of either when a query first reads it, and all three channels are loaded into staging once; each query then runs its
operator on files or tables from there. What a query writes goes to a new folder in the shared one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import storage
from orderloom.functions.casts import typed_order_columns
from orderloom.functions.status import rows_affected
from orderloom.operators import flatten
from orderloom.operators.load import (
    StagingTable,
    load_csv,
    load_history,
    load_json,
    read_staged_documents,
    read_staged_orders,
    truncate_staging,
    write_load,
)
from orderloom.operators.merge import (
    INSERT,
    OPERATION,
    UPDATE,
    changes,
    matched_keys,
    merge_orders,
    plan_merge,
    reduce_to_winners,
)
from orderloom.operators.ordering import newest_first, orders_newest_first
from orderloom.operators.rejects import read_rejects
from orderloom.operators.summary import (
    refresh_from_changes,
    refresh_summary,
    refresh_touched,
    summarise,
    summarise_group_by_all,
)
from orderloom.plans.event_log import scan_events
from orderloom.plans.feed import (
    DOCUMENTS,
    EXTERNAL,
    GRAIN,
    INTERNAL,
    order_feed,
    stage_of,
    write_csv_delivery,
    write_document_files,
    write_feed,
    write_giant_documents,
    write_json_delivery,
)
from orderloom.plans.ingest import load_feeds, process_combined, process_orders
from orderloom.plans.jobs import load_customer_orders, load_customer_summary_orders, run_job
from orderloom.plans.workspace import Workspace
from orderloom.schema import FILE_COLUMNS, FILE_FIELDS, ORDER_COLUMNS
from orderloom.session import scans_spread, scratch, shuffles_dropped, size_session, stored, unsorted_writes
from orderloom.sources.csv_files import ordinals, scan_csv
from orderloom.sources.external import (
    FILE_KEY,
    create_external_table,
    drop_external_table,
    read_external_table,
    read_projection,
    read_snapshot,
    refresh_external_table,
    refresh_projection,
    refresh_snapshot,
    register_snapshot,
)
from orderloom.sources.json_files import DOCUMENT_CUT, DOCUMENT_PER_LINE, scan_json, scan_json_typed
from orderloom.sources.listing import (
    list_stage,
    read_directory,
    read_directory_changes,
    refresh_directory,
    refresh_with_changes,
)
from orderloom.sources.stage import LINEAGE, Stage
from orderloom.storage import OrderTable, SummaryTable
from orderloom.streaming.ingest import ingest_csv, ingest_json

# Load times are given, never the clock's, so that results can be compared.
LOAD_TS = "2024-01-02 00:00:00"
FIRST_MERGE_TS = "2024-01-03 06:00:00"
SECOND_MERGE_TS = "2024-01-04 06:00:00"
SECOND_INSERT_TS = "2024-01-04 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def at(timestamp: str):
    return F.expr(f"timestamp'{timestamp}'")


def portable(rows: DataFrame) -> DataFrame:
    """Dates and times as ISO text and whole decimals as bigint, which every client shows alike."""

    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("bigint")
        return value.alias(field.name)

    return rows.select(*(column(field) for field in rows.schema.fields))


# Inputs shared by the queries of a session


@cache
def _feed(application: str, sf_dir: str) -> str:
    """The folder of the deliveries, with the feed that they are made of: it is joined once."""
    spark = SparkSession.active()
    path = scratch(spark, "delivery")
    feed = order_feed(spark, sf_dir)
    # Results run after their query has returned, so the session itself is sized, for the largest input of all.
    size_session(spark, feed)
    write_feed(feed, f"{path}/feed")
    return path


def stored_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_feed(spark.sparkContext.applicationId, sf_dir)}/feed")


@cache
def _deliver(application: str, sf_dir: str, layout: str, channel: str) -> None:
    write = {"csv": write_csv_delivery, "json": write_json_delivery}[layout]
    feed = stored_feed(SparkSession.active(), sf_dir)
    write(feed.where(F.col("channel") == channel), f"{_feed(application, sf_dir)}/{layout}")


def _delivered(spark: SparkSession, sf_dir: str, layout: str, channel: str | None) -> Stage:
    """Files of one channel, or of all, which are written when they are first asked for."""
    application = spark.sparkContext.applicationId
    for each in (INTERNAL, EXTERNAL, DOCUMENTS) if channel is None else (channel,):
        _deliver(application, sf_dir, layout, each)
    return stage_of(f"{_feed(application, sf_dir)}/{layout}", channel)


def csv_stage(spark: SparkSession, sf_dir: str, channel: str | None = None) -> Stage:
    return _delivered(spark, sf_dir, "csv", channel)


def json_stage(spark: SparkSession, sf_dir: str, channel: str | None = None) -> Stage:
    return _delivered(spark, sf_dir, "json", channel)


@cache
def _staged(application: str, sf_dir: str) -> Workspace:
    spark = SparkSession.active()
    workspace = new_workspace(spark)
    load_all(spark, sf_dir, workspace)
    return workspace


def staged(spark: SparkSession, sf_dir: str) -> Workspace:
    """All feeds as staged; to be read only."""
    return _staged(spark.sparkContext.applicationId, sf_dir)


def new_workspace(spark: SparkSession) -> Workspace:
    return Workspace(scratch(spark, "workspace"), GRAIN).create(spark)


def load_all(spark: SparkSession, sf_dir: str, workspace: Workspace):
    return load_feeds(
        spark,
        workspace,
        csv_stage(spark, sf_dir, INTERNAL),
        csv_stage(spark, sf_dir, EXTERNAL),
        json_stage(spark, sf_dir, DOCUMENTS),
        "initial",
        DOCUMENT_PER_LINE,
        load_ts=at(LOAD_TS),
    )


def feed_of(spark: SparkSession, sf_dir: str, channel: str) -> DataFrame:
    workspace = staged(spark, sf_dir)
    if channel == INTERNAL:
        return read_staged_orders(spark, workspace.internal_staging)
    if channel == EXTERNAL:
        return read_staged_orders(spark, workspace.external_staging)
    return workspace.document_orders(spark)


def deliver_copy(spark: SparkSession, sf_dir: str, channel: str, path: str) -> Stage:
    """A copy of a channel's CSV files of one's own, to purge or to add to."""
    rows = feed_of(spark, sf_dir, channel)
    spread = rows.select(*FILE_COLUMNS, F.col("source_file_name").alias("file")).hint("rebalance", F.col("file"))
    with unsorted_writes(spark), shuffles_dropped(spark):
        spread.write.mode("append").option("header", True).partitionBy("file").csv(path)
    return stage_of(path)


def deliver_all(spark: SparkSession, sf_dir: str, path: str) -> Stage:
    """A copy of all channels' rows as CSV files."""
    for channel in (INTERNAL, EXTERNAL, DOCUMENTS):
        stage = deliver_copy(spark, sf_dir, channel, path)
    return stage


def first_target(spark: SparkSession, sf_dir: str) -> OrderTable:
    """Both CSV feeds, merged into a new order table."""
    target = OrderTable(scratch(spark, "orders"), GRAIN).create(spark)
    source = feed_of(spark, sf_dir, INTERNAL).unionByName(feed_of(spark, sf_dir, EXTERNAL))
    merge_orders(spark, target, source, merge_ts=at(FIRST_MERGE_TS), on_duplicate="last")
    return target


@cache
def _first_target(application: str, sf_dir: str) -> OrderTable:
    return first_target(SparkSession.active(), sf_dir)


def shared_first_target(spark: SparkSession, sf_dir: str) -> OrderTable:
    """The same, to be read only."""
    return _first_target(spark.sparkContext.applicationId, sf_dir)


# Sources and loads


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_csv(spark, csv_stage(spark, sf_dir)).drop(*LINEAGE[1:])


@query
def prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries of the nineties: all paths that start so."""
    rows = scan_csv(spark, csv_stage(spark, sf_dir, EXTERNAL), prefix="file=Orders_199")
    return rows.drop(*LINEAGE[1:])


@query
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_json(spark, json_stage(spark, sf_dir), DOCUMENT_PER_LINE)
    days = F.expr("variant_get(customer_orders, '$.Orders', 'array<struct<`Orders by day`: array<variant>>>')")
    items = F.aggregate(days, F.lit(0), lambda sum_, day: sum_ + F.size(day["Orders by day"]))
    return rows.groupBy("source_file_name").agg(
        F.count("customer_orders").alias("documents"), F.sum(items).alias("items")
    )


@query
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_csv(spark, csv_stage(spark, sf_dir))
    return rows.groupBy("source_file_name").agg(F.count(F.lit(1)).alias("file_rows"))


@query
def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.col(c) for c in ordinals(len(FILE_COLUMNS))]
    return portable(scan_csv(spark, csv_stage(spark, sf_dir)).select(*typed_order_columns(columns)))


@query
def bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = new_workspace(spark)
    load_csv(spark, csv_stage(spark, sf_dir), workspace.internal_staging, "all", load_ts=at(LOAD_TS))
    return portable(read_staged_orders(spark, workspace.internal_staging))


def _kind(message: str) -> str:
    """What a failed load complains of."""
    signs = {"date": "as date in column", "documents": "more than one document", "row": "MALFORMED"}
    return next((kind for kind, sign in signs.items() if sign in message), "other")


@query
def load_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads with bad files, repeated under the id of a good one, fail whole; rows and history stay as they were."""
    workspace, path = new_workspace(spark), scratch(spark, "bad")
    orders, raw = workspace.external_staging, workspace.document_staging
    load_csv(spark, csv_stage(spark, sf_dir), orders, "load", load_ts=at(LOAD_TS))
    load_json(spark, json_stage(spark, sf_dir), raw, "load", DOCUMENT_PER_LINE, load_ts=at(LOAD_TS))
    rows = read_staged_orders(spark, orders)
    cut_off = rows.withColumn("order_date", F.date_format("order_date", "yyyy-MM"))
    lines = spark.read.options(**json_stage(spark, sf_dir).options()).text(json_stage(spark, sf_dir).root)
    twice = lines.select(F.concat("value", F.lit(',"more":'), "value"))

    def state(table: StagingTable) -> tuple[int, int]:
        rows = read_staged_orders(spark, table) if table is orders else read_staged_documents(spark, table)
        history = load_history(spark, table.history_path, table.schema_name, table.name)
        return rows.count(), history.agg(F.sum("row_count")).first()[0]

    def load_orders(stage: Stage):
        return load_csv(spark, stage, orders, "load")

    csv = {"header": True, "compression": "lz4"}
    attempts = {
        "row": (orders, lambda to: rows.select(*FILE_COLUMNS[:4]).write.options(**csv).csv(to), load_orders),
        "date": (orders, lambda to: cut_off.select(*FILE_COLUMNS).write.options(**csv).csv(to), load_orders),
        "documents": (
            raw,
            lambda to: twice.write.option("compression", "lz4").text(to),
            lambda stage: load_json(spark, stage, raw, "load", DOCUMENT_PER_LINE),
        ),
    }
    found = []
    for bad, (table, deliver, load) in attempts.items():
        # All rows once more: the files are there for their own attempt only, and compressed by what takes no time.
        with scans_spread(spark):
            deliver(f"{path}/{bad}")
        status = run_job(spark, "load", lambda load=load, bad=bad: rows_affected(load(Stage(f"{path}/{bad}")).rows))
        found.append((bad, status.ok, _kind(status.message), *state(table)))
        storage.delete(spark, f"{path}/{bad}")
    return spark.createDataFrame(found, "bad string, ok boolean, kind string, staged_rows long, history_rows long")


@query
def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of files in which several rows are bad in several ways leaves all of them in a table, and nothing staged."""
    workspace, path = new_workspace(spark), scratch(spark, "bad")
    rows = feed_of(spark, sf_dir, INTERNAL)
    texts = rows.select(*(F.col(name).cast("string").alias(name) for name in FILE_COLUMNS), F.col("source_file_name").alias("file"))
    spoilt = texts.withColumns(
        {
            "order_date": F.when(F.col("quantity") == "7", F.substring("order_date", 1, 7)).otherwise(F.col("order_date")),
            "quantity": F.when(F.col("quantity").isin("7", "8"), F.concat("quantity", F.lit("x"))).otherwise(F.col("quantity")),
        }
    )
    spoilt.hint("rebalance", F.col("file")).write.option("header", True).partitionBy("file").csv(path)
    table, stage = workspace.internal_staging, stage_of(path)
    status = run_job(spark, "load", lambda: rows_affected(load_csv(spark, stage, table, "bad", rejects=workspace.rejects_path).rows))
    faults = read_rejects(spark, workspace.rejects_path).groupBy("source_file_name", "column_name", "reason", "load_id")
    told = {"ok": F.lit(status.ok), "staged_rows": F.lit(read_staged_orders(spark, table).count())}
    return faults.agg(F.count(F.lit(1)).alias("faults"), F.countDistinct("file_path", "line").alias("bad_lines")).withColumns(told)


@query
def load_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load takes the files that came since the first; a third, forced, takes all."""
    workspace, path = new_workspace(spark), scratch(spark, "again")
    table = workspace.internal_staging
    stage = deliver_copy(spark, sf_dir, INTERNAL, path)
    load_csv(spark, stage, table, "first", load_ts=at(LOAD_TS))
    deliver_copy(spark, sf_dir, EXTERNAL, path)
    deliver_copy(spark, sf_dir, DOCUMENTS, path)
    load_csv(spark, stage, table, "second", load_ts=at(LOAD_TS))
    load_csv(spark, stage, table, "third", load_ts=at(LOAD_TS), force=True)
    files = load_history(spark, workspace.history_path, table.schema_name, table.name)
    return files.groupBy("load_id").agg(F.sum("row_count").alias("load_rows"))


@query
def stage_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are gone from the stage after the run; their rows are in the order table."""
    workspace = new_workspace(spark)
    stage = deliver_all(spark, sf_dir, scratch(spark, "purged"))
    process_orders(spark, workspace, stage, "run", on_duplicate="last")
    counted = {"files_left": list_stage(spark, stage), "order_rows": workspace.customer_orders.read(spark)}
    parts = [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("counted"), "n") for name, rows in counted.items()]
    return parts[0].union(parts[1])


def _content(files: DataFrame, name: str, size: str) -> DataFrame:
    """Bytes of a delivery's rows: what its files hold beyond a header each."""
    header = len("Customer,Order date,Delivery date,Baked good type,Quantity\n")
    return files.groupBy(name).agg((F.sum(size) - header * F.count(F.lit(1))).alias("row_bytes"))


@query
def stage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _content(list_stage(spark, csv_stage(spark, sf_dir)), "source_file_name", "file_size")


@query
def directory_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "directory")
    refresh_directory(spark, csv_stage(spark, sf_dir), path)
    return _content(read_directory(spark, path), "relative_path", "size")


@query
def load_history_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per delivered file, newest load first."""
    workspace = staged(spark, sf_dir)
    table = workspace.external_staging
    files = load_history(spark, workspace.history_path, table.schema_name, table.name)
    by_delivery = files.groupBy("schema_name", "table_name", "source_file_name", "status", "last_load_time").agg(
        F.sum("row_count").alias("row_count")
    )
    return portable(newest_first(by_delivery, "last_load_time", "source_file_name"))


@query
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "external_" + scratch(spark, "t")[-32:]
    create_external_table(spark, name, csv_stage(spark, sf_dir))
    return portable(read_external_table(spark, name))


@query
def external_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files added to the location count after a refresh."""
    name, path = "external_" + scratch(spark, "t")[-32:], scratch(spark, "external")
    create_external_table(spark, name, deliver_copy(spark, sf_dir, INTERNAL, path))
    counts = {"created": read_external_table(spark, name).count()}
    deliver_copy(spark, sf_dir, EXTERNAL, path)
    deliver_copy(spark, sf_dir, DOCUMENTS, path)
    counts["added"] = read_external_table(spark, name).count()
    refresh_external_table(spark, name)
    counts["refreshed"] = read_external_table(spark, name).count()
    drop_external_table(spark, name)
    return spark.createDataFrame(list(counts.items()), "state string, file_rows long")


@query
def external_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External table and stored snapshot in SQL, by name and typed, before and after files were added."""
    name, path = "external_" + scratch(spark, "t")[-32:], scratch(spark, "external")
    snapshot = scratch(spark, "snapshot")
    create_external_table(spark, name, deliver_copy(spark, sf_dir, INTERNAL, path))

    def totals(state: str) -> DataFrame:
        refresh_snapshot(spark.table(name), snapshot)
        register_snapshot(spark, f"{name}_stored", snapshot)
        columns = "year(delivery_date) AS delivery_year, source_file_name, sum(quantity) AS total_quantity, count(*) AS order_rows"
        rows = spark.sql(
            f"""SELECT '{state}' AS state, 'external' AS via, {columns} FROM {name} GROUP BY ALL
            UNION ALL SELECT '{state}', 'stored', {columns} FROM {name}_stored GROUP BY ALL"""
        )
        return stored(rows, "totals")

    before = totals("created")
    deliver_copy(spark, sf_dir, EXTERNAL, path)
    deliver_copy(spark, sf_dir, DOCUMENTS, path)
    refresh_external_table(spark, name)
    return portable(before.union(totals("refreshed")))


@query
def materialized_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored twice, to see the second snapshot replace the first."""
    name, path = "external_" + scratch(spark, "t")[-32:], scratch(spark, "snapshot")
    for stage in (csv_stage(spark, sf_dir, INTERNAL), csv_stage(spark, sf_dir)):
        create_external_table(spark, name, stage)
        refresh_snapshot(read_external_table(spark, name), path)
        drop_external_table(spark, name)
    return portable(read_snapshot(spark, path))


@query
def projection_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A projection kept by file: files are added and removed between two refreshes, the second of which reads only the new."""
    path, kept = scratch(spark, "deliveries"), scratch(spark, "projection")
    stage = deliver_copy(spark, sf_dir, INTERNAL, path)
    refresh_projection(spark, stage, kept)
    early = read_projection(spark, kept).agg(F.min("source_file_name")).first()[0]
    storage.delete(spark, f"{path}/file={early}")
    deliver_copy(spark, sf_dir, EXTERNAL, path)
    delta = refresh_projection(spark, stage, kept)
    read = delta.rows.select(FILE_KEY.name).distinct()
    if delta.rows is None or read.count() != len(delta.fresh) or not delta.gone:
        raise RuntimeError("the refresh did not read what is new")
    return portable(read_projection(spark, kept))


@query
def directory_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the log of a stage's changes has after each of three refreshes, by kind of change and delivered file."""
    path, catalog, log = scratch(spark, "deliveries"), scratch(spark, "directory"), scratch(spark, "changes")
    stage = deliver_copy(spark, sf_dir, INTERNAL, path)
    refresh_with_changes(spark, stage, catalog, log, "first")
    storage.delete(spark, path)
    deliver_copy(spark, sf_dir, EXTERNAL, path)
    refresh_with_changes(spark, stage, catalog, log, "second")
    refresh_with_changes(spark, stage, catalog, log, "third")
    found = read_directory_changes(spark, log)
    return found.select("refresh_id", "change", "relative_path").distinct()


# Documents


@query
def json_top_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten.top_level(scan_json(spark, json_stage(spark, sf_dir), DOCUMENT_PER_LINE))
    per_day = rows.groupBy("customer", "order_date").agg(F.count("orders").alias("documents"))
    return portable(per_day)


@query
def flatten_one_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten.flatten_days(scan_json(spark, json_stage(spark, sf_dir), DOCUMENT_PER_LINE))
    items = F.size(F.col("orders_by_day").cast("array<variant>"))
    return portable(rows.groupBy("customer", "order_date", "delivery_date").agg(F.sum(items).alias("items")))


@query
def flatten_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_json(spark, json_stage(spark, sf_dir), DOCUMENT_PER_LINE)
    return portable(flatten.flatten_orders(rows).drop(*LINEAGE[1:]))


@query
def flatten_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_json_typed(spark, json_stage(spark, sf_dir), DOCUMENT_PER_LINE)
    return portable(flatten.flatten_typed(rows).drop(*LINEAGE[1:]))


@query
def raw_documents_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that went through the variant staging table."""
    raw = read_staged_documents(spark, staged(spark, sf_dir).document_staging)
    return portable(flatten.flattened_view(raw))


@query
def json_document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are one document each, as the samples are: of a region's order day, loaded and flattened."""
    workspace, path = new_workspace(spark), scratch(spark, "documents")
    write_document_files(spark, sf_dir, feed_of(spark, sf_dir, DOCUMENTS), path)
    load_json(spark, Stage(path), workspace.document_staging, "files", load_ts=at(LOAD_TS))
    rows = workspace.document_orders(spark)
    per_day = rows.groupBy("customer", "order_date", "delivery_date").agg(
        F.count(F.lit(1)).alias("items"), F.sum("quantity").alias("total_quantity")
    )
    return portable(per_day)


@query
def json_giant_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region's orders as one document that grows with the tables, cut into its days, loaded and flattened."""
    workspace, path = new_workspace(spark), scratch(spark, "giants")
    write_giant_documents(spark, sf_dir, stored_feed(spark, sf_dir), path)
    load_json(spark, Stage(path), workspace.document_staging, "giants", DOCUMENT_CUT, load_ts=at(LOAD_TS))
    per_day = workspace.document_orders(spark).groupBy("customer", "order_date", "delivery_date").agg(
        F.count(F.lit(1)).alias("items"), F.sum("quantity").alias("total_quantity")
    )
    return portable(per_day)


# Union and merge


@query
def combined_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(staged(spark, sf_dir).combined_staging(spark))


@query
def registered_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined staging view, queried by name in SQL."""
    workspace = staged(spark, sf_dir)
    database = "orders_" + scratch(spark, "d")[-32:]
    workspace.register(spark, database)
    rows = spark.sql(
        f"""SELECT source_file_name, delivery_date, count(*) AS order_rows, sum(quantity) AS total_quantity
        FROM {database}.orders_combined_stg GROUP BY ALL"""
    )
    return portable(rows)


@query
def merge_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = shared_first_target(spark, sf_dir).read(spark)
    return portable(matched_keys(target, reduce_to_winners(feed_of(spark, sf_dir, DOCUMENTS))))


def _planned(spark: SparkSession, sf_dir: str, operation: str) -> DataFrame:
    plan = plan_merge(
        spark,
        shared_first_target(spark, sf_dir),
        feed_of(spark, sf_dir, DOCUMENTS),
        merge_ts=at(SECOND_MERGE_TS),
        on_duplicate="last",
    )
    return portable(plan.rows.filter(F.col(OPERATION) == operation).select(*ORDER_COLUMNS))


@query
def merge_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _planned(spark, sf_dir, UPDATE)


@query
def merge_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _planned(spark, sf_dir, INSERT)


@query
def merge_single_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed into an order table that holds the others; inserts are stamped with the day only."""
    target = first_target(spark, sf_dir)
    merge_orders(
        spark,
        target,
        feed_of(spark, sf_dir, DOCUMENTS),
        merge_ts=at(SECOND_MERGE_TS),
        insert_ts=at(SECOND_INSERT_TS),
        on_duplicate="last",
    )
    return portable(target.read(spark))


@query
def merge_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three feeds, from the view, into an order table that holds one of them."""
    target = OrderTable(scratch(spark, "orders"), GRAIN).create(spark)
    internal = feed_of(spark, sf_dir, INTERNAL)
    merge_orders(spark, target, internal, merge_ts=at(FIRST_MERGE_TS), on_duplicate="last")
    combined = staged(spark, sf_dir).combined_staging(spark)
    merge_orders(spark, target, combined, merge_ts=at(SECOND_MERGE_TS), on_duplicate="last")
    return portable(target.read(spark))


@query
def merge_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into an empty table, the statement taken literally inserts every row of a repeated key."""
    target = OrderTable(scratch(spark, "orders"), GRAIN).create(spark)
    merge_orders(spark, target, staged(spark, sf_dir).combined_staging(spark), merge_ts=at(FIRST_MERGE_TS))
    return portable(target.read(spark))


@query
def merge_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge again is refused, as keys are matched by several rows; the table stays as it was."""
    target = OrderTable(scratch(spark, "orders"), GRAIN).create(spark)
    combined = staged(spark, sf_dir).combined_staging(spark)
    merge_orders(spark, target, combined)
    status = run_job(spark, "merge", lambda: rows_affected(merge_orders(spark, target, combined).affected))
    rows = target.read(spark).agg(F.count(F.lit(1)).alias("order_rows"))
    return rows.select(F.lit(status.ok).alias("ok"), F.lit(status.message).alias("message"), "order_rows")


@query
def truncate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_workspace(spark).internal_staging
    rows = staged(spark, sf_dir).combined_staging(spark)
    write_load(rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in FILE_FIELDS}), table, "all")
    counts = {"filled": read_staged_orders(spark, table).count()}
    truncate_staging(spark, table)
    counts["truncated"] = read_staged_orders(spark, table).count()
    return spark.createDataFrame(list(counts.items()), "state string, staged_rows long")


# Summary, order, log


@query
def summary_by_day_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(summarise(staged(spark, sf_dir).combined_staging(spark)))


@query
def summary_group_by_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(summarise_group_by_all(staged(spark, sf_dir).combined_staging(spark)))


@query
def summary_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh replaces what an earlier one has left."""
    table = SummaryTable(scratch(spark, "summary"))
    refresh_summary(spark, shared_first_target(spark, sf_dir).read(spark), table)
    refresh_summary(spark, staged(spark, sf_dir).combined_staging(spark), table)
    return portable(table.read(spark))


@query
def summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a merge, only the periods it touched are summarised anew."""
    target, table = first_target(spark, sf_dir), SummaryTable(scratch(spark, "summary"))
    refresh_summary(spark, target.read(spark), table)
    merged = merge_orders(spark, target, feed_of(spark, sf_dir, DOCUMENTS), on_duplicate="last")
    refresh_touched(spark, target, table, merged.periods, merged.has_null_period)
    return portable(table.read(spark))


@query
def summary_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a merge, the summary takes over the rows that it changed; the order table is not read."""
    target, table = first_target(spark, sf_dir), SummaryTable(scratch(spark, "summary"))
    refresh_summary(spark, target.read(spark), table)
    merged = merge_orders(spark, target, feed_of(spark, sf_dir, DOCUMENTS), on_duplicate="last")
    refresh_from_changes(spark, changes(spark, target, merged.version), table)
    return portable(table.read(spark))


@query
def orders_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(orders_newest_first(staged(spark, sf_dir).combined_staging(spark)))


@query
def event_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    newest = scan_events(events.select("event_id", "ts", "user_id", "event_type", "value"), "ts", "event_type")
    return newest.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# Jobs and whole runs


@query
def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the jobs have logged: a merge, the same again, which is refused, and a summary."""
    workspace = new_workspace(spark)
    combined, log = staged(spark, sf_dir).combined_staging(spark), workspace.event_log
    target = workspace.customer_orders_combined
    load_customer_orders(spark, combined, target, log)
    load_customer_orders(spark, combined, target, log)
    load_customer_summary_orders(spark, target, workspace.summary_orders_combined, log)
    return log.read(spark).select("severity", "procedure_name", "message")


@query
def insert_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over the internal stage stamps the rows that it inserts with the day."""
    workspace = new_workspace(spark)
    day = spark.sql("SELECT current_date() AS day").first()["day"]
    process_orders(spark, workspace, deliver_all(spark, sf_dir, scratch(spark, "day")), "run", on_duplicate="last")
    later = spark.sql("SELECT current_date() AS day").first()["day"]
    stamp = F.col("load_ts")
    on_the_day = (stamp == F.date_trunc("day", stamp)) & stamp.cast("date").between(F.lit(day), F.lit(later))
    rows = workspace.customer_orders.read(spark)
    return rows.groupBy(on_the_day.alias("on_the_day")).agg(F.count(F.lit(1)).alias("order_rows"))


@query
def load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status texts of both jobs."""
    shared = staged(spark, sf_dir)
    workspace = new_workspace(spark)
    target, summary = workspace.customer_orders_combined, workspace.summary_orders_combined
    merged = load_customer_orders(spark, shared.combined_staging(spark), target, on_duplicate="last")
    refilled = load_customer_summary_orders(spark, target, summary)
    return spark.createDataFrame(
        [("merge", merged.message), ("summary", refilled.message)], "job string, message string"
    )


@query
def ingest_to_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over the internal stage, each with new files: load, merge, summary, purge.

    The first is literal and leaves repeated keys, all of which the later ones' updates reach.
    """
    workspace, path = new_workspace(spark), scratch(spark, "deliveries")
    process_orders(spark, workspace, deliver_copy(spark, sf_dir, INTERNAL, path), "first")
    for channel in (EXTERNAL, DOCUMENTS):
        stage = deliver_copy(spark, sf_dir, channel, path)
        process_orders(spark, workspace, stage, channel, on_duplicate="last", summary="touched")
    return portable(workspace.summary_orders.read(spark))


@query
def resume_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run fails in its merge; the next day's, under its own id, finishes it and takes the files delivered since."""
    workspace, path = new_workspace(spark), scratch(spark, "deliveries")
    stage = deliver_copy(spark, sf_dir, INTERNAL, path)
    lost = F.raise_error(F.lit("executor lost")).cast("timestamp")
    failed = run_job(spark, "first", lambda: process_orders(spark, workspace, stage, "first", insert_ts=lost, on_duplicate="last"))
    stage = deliver_copy(spark, sf_dir, EXTERNAL, path)
    process_orders(spark, workspace, stage, "second", on_duplicate="last", summary="changes")
    told = {"files_left": F.lit(list_stage(spark, stage).count()), "first_failed": F.lit(not failed.ok)}
    return portable(workspace.summary_orders.read(spark).withColumns(told))


@query
def feeds_to_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of all three channels -> staging -> combined view -> merge -> summary."""
    workspace = new_workspace(spark)
    load_all(spark, sf_dir, workspace)
    for status in process_combined(spark, workspace, on_duplicate="last"):
        if not status.ok:
            raise RuntimeError(status.message)
    return portable(workspace.summary_orders_combined.read(spark))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental runs over the files of all channels into one order table."""
    workspace, checkpoints = new_workspace(spark), scratch(spark, "streams")
    target, summary = workspace.customer_orders, workspace.summary_orders
    for channel, table in ((INTERNAL, workspace.internal_staging), (EXTERNAL, workspace.external_staging)):
        ingest_csv(
            spark,
            csv_stage(spark, sf_dir, channel),
            table,
            target,
            f"{checkpoints}/{channel}",
            summary,
            merge_ts=at(FIRST_MERGE_TS),
            on_duplicate="last",
        )
    ingest_json(
        spark,
        json_stage(spark, sf_dir, DOCUMENTS),
        workspace.document_staging,
        target,
        f"{checkpoints}/json",
        summary,
        DOCUMENT_PER_LINE,
        merge_ts=at(SECOND_MERGE_TS),
        on_duplicate="last",
    )
    return portable(target.read(spark))
