"""What the text operators share: tables, row keys, scratch tables and Arrow batches of bounded size."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom.session import scratch, shared_folder, size_session

NO_ID = 2**63 - 1  # stands for a null doc_id: ids sort with nulls last, and rows without id are one document
BATCH_BYTES = 4 << 20  # text handled at once inside a task; a longer document is handled alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to and read back from the shared scratch folder, which cuts its lineage."""
    path = scratch(frame.sparkSession, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def stored_with(frame: DataFrame, purpose: str, **measures: Column) -> tuple[DataFrame, dict]:
    """The same, and aggregates of its rows, taken while they are written."""
    seen = Observation()
    rows = stored(frame.observe(seen, *(measure.alias(name) for name, measure in measures.items())), purpose)
    return rows, seen.get


def with_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure that ``checkpoint()`` has a folder: the session's own, or for a local session one of its own."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def sized_for(rows: DataFrame) -> None:
    """Give the session shuffle partitions for the tables that the rows are read from, and small Arrow batches.

    Texts then go to Python a few megabytes at a time, also where rows are long. Both are settings of the session, as they
    count when the returned frame runs.
    """
    spark = rows.sparkSession
    size_session(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def row_key() -> list[Column]:
    """``doc_id`` (null: NO_ID) and a hash of the text.

    Together they tell rows apart that share an id; rows that share both are equal and get equal results.
    """
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.hash("text").alias("text_hash"),
    ]


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns of these names, which an operator needs for itself, renamed, and how to name them back."""
    taken, back = {name.lower() for name in docs.columns}, {}
    for name in docs.columns:
        if name.lower() in names:
            free = f"own{name}"
            while free.lower() in taken:
                free = f"own_{free}"
            taken.add(free.lower())
            back[free] = name
    return docs.withColumnsRenamed({name: free for free, name in back.items()}), back


def keyed(docs: DataFrame, *columns: Column) -> DataFrame:
    """The row's key, its text (null: empty) and more columns."""
    return docs.select(*row_key(), F.coalesce("text", F.lit("")).alias("text"), *columns)


def public_id(name: str = "doc_id") -> Column:
    """The id without the coding of ``row_key``."""
    return F.when(F.col(name) != NO_ID, F.col(name))


def text_batches(
    batches: Iterable[pa.RecordBatch], column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most BATCH_BYTES of text (or one row), and their texts; null is empty.

    Workers stay for later tasks, so what was used for the texts is given back to the system at the end.
    """
    try:
        for batch in batches:
            texts = batch.column(column).cast(pa.binary())
            sizes = pc.binary_length(texts).to_pylist()
            start, total = 0, 0
            for i, size in enumerate([*sizes, None]):
                if i == len(sizes) or (total and total + (size or 0) > BATCH_BYTES):
                    if i > start:
                        yield batch.slice(start, i - start), [text or b"" for text in texts.slice(start, i - start).to_pylist()]
                    start, total = i, 0
                total += size or 0
    finally:
        batch = texts = None
        give_back_memory()


def give_back_memory() -> None:
    """What Arrow and the C library hold of memory that is free."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems have no such call
        ctypes.CDLL(None).malloc_trim(0)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
