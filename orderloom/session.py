"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Only settings whose defaults would be wrong for this workload. AQE does the sizing: partitions
# start many and are coalesced, skewed join and rebalance partitions are split.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Input per shuffle partition. Files are compressed, so a partition holds a few times this much in memory.
SHUFFLE_BYTES = 64 << 20

# Table files per task where each row is sorted. Order rows take some thirty times as much there.
SCAN_BYTES = 16 << 20

# Files that a task keeps open at once where it writes folders by value; only with more of them it sorts what is left.
OPEN_FILES = 32

_DROPPED = {"classic_shuffleDependency_fileCleanup_enabled": "true"}

_TO_DROP: set[str] = set()


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster use the session it gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach: ``spark.checkpoint.dir`` of the session.

    A session within one process (``local[..]``) without that setting gets a temporary one. Any other session without it
    is refused, as a folder of the driver's machine would be lost on the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new path (not yet created) in the shared folder, unique to this call. It is gone when Python ends."""
    folder = f"{shared_folder(spark)}/orderloom/{spark.sparkContext.applicationId}"
    if folder not in _TO_DROP:
        _TO_DROP.add(folder)
        atexit.register(_drop, spark._jvm, folder)
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to and read back from the shared folder, which cuts its lineage."""
    return stored_at(frame, scratch(frame.sparkSession, purpose))


def stored_at(frame: DataFrame, path: str) -> DataFrame:
    """The same at a path of one's own, to be deleted when it has served."""
    with shuffles_dropped(frame.sparkSession):
        frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _drop(jvm, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)


def partitions_for(spark: SparkSession, *inputs: DataFrame, each: int | None = None) -> int:
    """Shuffle partitions for these inputs: the session's number, or more if the sizes of the tables read add up to more
    than ``each`` bytes a partition (SHUFFLE_BYTES).

    Only the leaves of the plans are counted, as Catalyst takes a join's size for the product of its inputs'. Rows that the
    driver itself has made have no estimate, and count nothing.
    """
    total, unknown = 0, 1 << 60
    for frame in inputs:
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        total += sum(size for size in sizes if size < unknown)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (each or SHUFFLE_BYTES))


def size_session(spark: SparkSession, *inputs: DataFrame) -> None:
    """Raise the session's number of shuffle partitions to what the inputs ask for, for results that run later."""
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions_for(spark, *inputs)))


@contextlib.contextmanager
def configured(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of ``spark.sql`` within this block, for what runs in it; ``_`` stands for a dot."""
    names = {f"spark.sql.{name.replace('_', '.')}": value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def at_most(spark: SparkSession, most: int) -> str:
    """A scan's bytes per task: the session's, but no more than this."""
    return str(min(most, int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())))


def shuffles_dropped(spark: SparkSession):
    """Within this block, what an action has shuffled is deleted when the action ends. Else it stays until the driver's memory
    is next cleaned, which a driver with little to do puts off for half an hour."""
    return configured(spark, **_DROPPED)


def unsorted_writes(spark: SparkSession):
    """Within this block, tasks that write to few folders do so without sorting their rows by folder first. Not for parquet
    files of many folders, each of which is put together in memory."""
    return configured(spark, maxConcurrentOutputFileWriters=str(OPEN_FILES))


def scans_spread(spark: SparkSession):
    """Within this block, a task of a scan takes SCAN_BYTES of files at most, so that tasks end together. Small files are
    packed as before: what opening one counts for goes down in proportion."""
    conf = spark._jsparkSession.sessionState().conf()
    before, opening = int(conf.filesMaxPartitionBytes()), int(conf.filesOpenCostInBytes())
    most = min(SCAN_BYTES, before)
    return configured(
        spark, files_maxPartitionBytes=str(most), files_openCostInBytes=str(max(1, opening * most // max(before, 1)))
    )


@contextlib.contextmanager
def shuffles_sized_for(spark: SparkSession, *inputs: DataFrame) -> Iterator[None]:
    """Within this block, shuffles have as many partitions as the inputs' size asks for and go when an action ends, and scans
    have no large tasks.

    AQE merges partitions that are too small and splits those that stand out, but it does not split partitions that are
    all too large. So the session's number is raised, never lowered. A task of a scan takes SCAN_BYTES at most, or less if
    the session says so.
    """
    shuffles = str(partitions_for(spark, *inputs))
    with configured(spark, shuffle_partitions=shuffles, files_maxPartitionBytes=at_most(spark, SCAN_BYTES), **_DROPPED):
        yield
