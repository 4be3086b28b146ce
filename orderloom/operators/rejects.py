"""All bad rows of a delivery, with their places and reasons.

A load aborts at the first bad row that any task meets. This pass reads the same files as lines, each of which is judged by
itself, so that whoever delivered them learns of all that is wrong at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderloom import storage
from orderloom.functions.casts import ISO_DATE
from orderloom.schema import FILE_COLUMNS, LOAD_ID, ORDERS, REJECTS, with_fields
from orderloom.sources.csv_files import CsvFormat, ordinals, text_schema
from orderloom.sources.stage import Stage, empty_scan

WRONG_WIDTH = "number of columns"


def csv_rejects(
    spark: SparkSession,
    stage: Stage,
    fmt: CsvFormat = CsvFormat(),
    prefix: str | None = None,
    paths: list[str] | None = None,
) -> DataFrame:
    """A row for each fault: ``source_file_name``, ``file_path``, ``line`` (from 1, header included), ``column_name``,
    ``reason`` and the line's ``text``. Blank lines are no rows, as in a load.

    A line's place in its file is its place in the block that a task reads, and the lines of the blocks before: only counts of
    blocks are put in order, so that a large file is read by many tasks.
    """
    location = stage.location(spark, prefix) if paths is None else stage.readable(paths)
    if not location:
        lines = empty_scan(spark, "value string, block long, id long")
    else:
        lines = spark.read.options(**stage.options()).text(location).select(
            "value", F.col("_metadata.file_block_start").alias("block"), *stage.lineage(spark),
            F.monotonically_increasing_id().alias("id"),
        )
    block = ["file_path", "block"]
    counted = lines.groupBy(*block).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("lines"))
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.select(*block, "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))

    options = {**fmt.options(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "header": "false"}
    width = len(FILE_COLUMNS)
    parsed = lines.withColumn("row", F.from_csv("value", f"{text_schema(width)}, bad string", options))
    wrong = F.col("row.bad").isNotNull()
    faults = [F.when(wrong, F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(WRONG_WIDTH).alias("reason")))]
    for ordinal, name in zip(ordinals(width), FILE_COLUMNS, strict=True):
        to = ORDERS[name].dataType
        if isinstance(to, T.StringType):
            continue
        text = F.col(f"row.{ordinal}")
        typed = F.when(text.rlike(ISO_DATE), text.try_cast(to)) if isinstance(to, T.DateType) else text.try_cast(to)
        fault = F.struct(F.lit(name).alias("column_name"), F.lit(f"not {to.simpleString()}").alias("reason"))
        faults.append(F.when(~wrong & text.isNotNull() & typed.isNull(), fault))
    found = F.filter(F.array(*faults), lambda fault: fault.isNotNull())
    # Of sound lines nothing goes further than this.
    bad = parsed.where(~F.col("value").rlike(r"^\s*$")).withColumn("faults", found).where(F.size("faults") > 0)
    placed = bad.join(blocks, block).withColumn("line", F.col("before") + F.col("id") - F.col("first") + 1)
    rows = placed.where(F.col("line") > int(fmt.skip_header))
    return rows.select(
        "source_file_name", "file_path", "line", F.explode("faults").alias("fault"), F.col("value").alias("text")
    ).select("source_file_name", "file_path", "line", "fault.column_name", "fault.reason", "text")


def write_rejects(rejects: DataFrame, path: str, schema_name: str, table_name: str, load_id: str) -> int:
    """Keep the faults found in a load, in place of those that it had before; returns their number."""
    place = {"schema_name": schema_name, "table_name": table_name, LOAD_ID.name: load_id}
    tagged = rejects.withColumns({name: F.lit(value) for name, value in place.items()})
    return storage.overwrite_all_of(tagged, path, **place)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    storage.make_folder(spark, path)
    places = [T.StructField(name, T.StringType()) for name in ("schema_name", "table_name")]
    return storage.read_table(spark, path, with_fields(REJECTS, *places, LOAD_ID))
