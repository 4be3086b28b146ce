"""Folders of parquet files used as tables, and the few file-system calls they need."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fnmatch import fnmatch
from itertools import islice

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import versions
from orderloom.schema import ORDER_COLUMNS, ORDERS, PERIOD, SUMMARY, SUMMARY_COUNTS, with_fields
from orderloom.session import shuffles_dropped, unsorted_writes


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def encoded_path(spark: SparkSession, path: str) -> str:
    """The path without scheme and host, encoded as in a URI."""
    fs, jvm_path = _file_system(spark, path)
    return fs.makeQualified(jvm_path).toUri().getRawPath()


def origins(spark: SparkSession, path: str) -> list[str]:
    """Scheme and host of a path, as ``_metadata.file_path`` mostly has them. Without a host there are two spellings."""
    fs, jvm_path = _file_system(spark, path)
    uri = fs.makeQualified(jvm_path).toUri()
    host = uri.getRawAuthority()
    return [f"{uri.getScheme()}://{host}"] if host else [f"{uri.getScheme()}:", f"{uri.getScheme()}://"]


def glob_matches(spark: SparkSession, pattern: str) -> bool:
    fs, jvm_path = _file_system(spark, pattern)
    found = fs.globStatus(jvm_path)
    return found is not None and len(found) > 0


def hidden_files(spark: SparkSession, root: str, pattern: str, levels: int) -> list[str]:
    """Files below the folder, to some levels, that match the pattern but begin with ``_`` or ``.``.

    Marks of Spark's own writers are none: ``_SUCCESS`` and checksums.
    """
    fs, _ = _file_system(spark, root)
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    found = []
    for level in range(levels + 1):
        path = root.rstrip("/") + "/*" * level
        if level and not len(fs.globStatus(as_path(path)) or []):
            break
        for status in fs.globStatus(as_path(path + "/[_.]*")) or []:
            name = status.getPath().getName()
            if status.isFile() and name != "_SUCCESS" and not name.endswith(".crc") and fnmatch(name[1:], pattern):
                found.append(name)
    return found


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _file_system(spark, path)
    fs.mkdirs(jvm_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _file_system(spark, path)
    fs.delete(jvm_path, True)


def delete_file_uri(spark: SparkSession, uri: str) -> bool:
    """Delete one file named by the encoded URI of ``_metadata.file_path``."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, False)


def delete_file_uris(spark: SparkSession, uris, at_once: int = 16) -> int:
    """Delete files, several at a time; the number that were there. Names are taken in portions, not all at once."""
    names, deleted = iter(uris), 0
    with ThreadPoolExecutor(at_once) as pool:
        while portion := list(islice(names, 1000)):
            deleted += sum(pool.map(lambda uri: delete_file_uri(spark, uri), portion))
    return deleted


def truncate(spark: SparkSession, path: str) -> None:
    """Empty a table; the table itself stays."""
    delete(spark, path)
    make_folder(spark, path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table folder. The schema is given, so an empty table reads as no rows."""
    return spark.read.schema(schema).parquet(path)


def period_of(date: Column, grain: str) -> Column:
    """First day of the delivery period a date belongs to."""
    if grain == "day":
        return date
    if grain in ("month", "year"):
        return F.trunc(date, grain)
    raise ValueError(f"unknown grain {grain!r}")


def in_periods(periods: list, has_null: bool, column: Column | None = None) -> Column:
    """Literal filter on the partition column, so that the scan lists only those partitions."""
    column = F.col(PERIOD.name) if column is None else column
    wanted = column.isin(periods) if periods else F.lit(False)
    return wanted | column.isNull() if has_null else wanted


@dataclass(frozen=True)
class OrderTable:
    """Merge target: versions of parquet partitioned by delivery period.

    The period is a function of a merge key, so a merge needs only the periods its source names. A month
    suits deliveries spread over many days; take ``grain='day'`` where a day alone fills large files, ``'year'`` where
    a month does not fill one. ``name`` is a SQL name that publications keep up to date.
    """

    path: str
    grain: str = "month"
    name: str | None = None

    def create(self, spark: SparkSession, replace: bool = False) -> OrderTable:
        if replace:
            truncate(spark, self.path)
        else:
            make_folder(spark, self.path)
        return self

    def read_partitioned(self, spark: SparkSession) -> DataFrame:
        return versions.read(spark, self.path, ORDERS)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.read_partitioned(spark).select(*ORDER_COLUMNS)


@dataclass(frozen=True)
class SummaryTable:
    """Quantities per delivery day and type, a few rows per day, hence partitioned by delivery year.

    Beside the sums it keeps how many rows and quantities they are of, so that it can be kept up to date from changes.
    """

    path: str
    name: str | None = None

    def create(self, spark: SparkSession) -> SummaryTable:
        make_folder(spark, self.path)
        return self

    def read_partitioned(self, spark: SparkSession) -> DataFrame:
        return versions.read(spark, self.path, with_fields(SUMMARY, *SUMMARY_COUNTS))

    def read(self, spark: SparkSession) -> DataFrame:
        return self.read_partitioned(spark).select(*SUMMARY.fieldNames())


def overwrite_partitions(frame: DataFrame, path: str, *by: str) -> None:
    """Replace only the partitions that occur in the frame, also when it was read from the same path.

    The writer option is honoured for path writes only. New files are published at commit, so a failing job
    leaves the old ones in place.
    """
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def overwrite_all_of(frame: DataFrame, path: str, **partition: str) -> int:
    """Replace one partition, whose columns the frame has with these values, and return its rows.

    The old files go when the new ones are committed. A frame without rows commits no partition, so that the old one is
    deleted then. All rows go to one folder, by which they need not be sorted.
    """
    written = Observation()
    with unsorted_writes(frame.sparkSession), shuffles_dropped(frame.sparkSession):
        overwrite_partitions(frame.observe(written, F.count(F.lit(1)).alias("rows")), path, *partition)
    rows = written.get["rows"]
    if not rows:
        delete(frame.sparkSession, "/".join([path, *(f"{name}={value}" for name, value in partition.items())]))
    return rows
