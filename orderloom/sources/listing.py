"""Stage listings and the directory table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import storage
from orderloom.session import stored
from orderloom.sources.stage import Stage, empty_scan

DIRECTORY = T.StructType(
    [
        T.StructField("relative_path", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("last_modified", T.TimestampType()),
        T.StructField("md5", T.StringType()),
    ]
)

DIRECTORY_CHANGES = T.StructType(
    [
        T.StructField("relative_path", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("change", T.StringType()),
        T.StructField("old_size", T.LongType()),
        T.StructField("new_size", T.LongType()),
        T.StructField("old_modified", T.TimestampType()),
        T.StructField("new_modified", T.TimestampType()),
        T.StructField("refreshed_at", T.TimestampType()),
        T.StructField("refresh_id", T.StringType()),
    ]
)


def list_stage(spark: SparkSession, stage: Stage, prefix: str | None = None) -> DataFrame:
    """One row per file, with size and time. Only file metadata is read, never the content."""
    location = stage.location(spark, prefix)
    if location is None:
        return empty_scan(spark, "listed boolean").drop("listed")
    return (
        spark.read.format("binaryFile")
        .options(**stage.options())
        .load(location)
        .select(*stage.lineage(spark))
    )


def _directory_rows(spark: SparkSession, stage: Stage, checksums: bool) -> DataFrame:
    location = stage.location(spark)
    files = spark.read.format("binaryFile").options(**stage.options()).load(location)
    md5 = F.md5("content") if checksums else F.lit(None).cast("string")
    return files.select(
        stage.source_file_name(spark).alias("relative_path"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        md5.alias("md5"),
    )


def refresh_directory(spark: SparkSession, stage: Stage, path: str, checksums: bool = False) -> None:
    """Rewrite the file catalog of a stage; the former one is there until the new one is committed.

    Checksums read every file, each as one row, so they are asked for and are for files of moderate size.
    """
    rows = _directory_rows(spark, stage, checksums)
    storage.overwrite_all_of(rows.withColumn("snapshot", F.lit("current")), path, snapshot="current")


def directory_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What differs between two catalogs: ``change`` is added, removed or changed.

    A file has changed if its size or time has, or its checksum where both catalogs have one.
    """
    kept = ["relative_path", "size", "last_modified", "md5"]
    old = before.select("file_path", F.struct(*kept).alias("old"))
    new = after.select("file_path", F.struct(*kept).alias("new"))
    both = old.join(new, "file_path", "full_outer")
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(
            ~F.equal_null("old.size", "new.size")
            | ~F.equal_null("old.last_modified", "new.last_modified")
            | (F.col("old.md5") != F.col("new.md5")),
            "changed",
        )
    )
    return both.select(
        F.coalesce("new.relative_path", "old.relative_path").alias("relative_path"),
        "file_path",
        change.alias("change"),
        F.col("old.size").alias("old_size"),
        F.col("new.size").alias("new_size"),
        F.col("old.last_modified").alias("old_modified"),
        F.col("new.last_modified").alias("new_modified"),
    ).where(F.col("change").isNotNull())


def refresh_with_changes(
    spark: SparkSession, stage: Stage, path: str, log_path: str, refresh_id: str, checksums: bool = False
) -> int:
    """Refresh the catalog and log what has changed since the last refresh; returns the number of changes.

    The log is written first. A refresh that failed in between is repeated under its id, and finds the same changes and those
    that came since.
    """
    now = stored(_directory_rows(spark, stage, checksums), "listing")  # one listing for both
    storage.make_folder(spark, path)
    found = directory_changes(read_directory(spark, path), now)
    tagged = found.withColumns({"refreshed_at": F.current_timestamp(), "refresh_id": F.lit(refresh_id)})
    changes = storage.overwrite_all_of(tagged, log_path, refresh_id=refresh_id)
    storage.overwrite_all_of(now.withColumn("snapshot", F.lit("current")), path, snapshot="current")
    return changes


def read_directory_changes(spark: SparkSession, log_path: str) -> DataFrame:
    """The log of all refreshes."""
    storage.make_folder(spark, log_path)
    return storage.read_table(spark, log_path, DIRECTORY_CHANGES)


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """The catalog as of its last refresh."""
    return storage.read_table(spark, path, DIRECTORY).select(*DIRECTORY.fieldNames())
