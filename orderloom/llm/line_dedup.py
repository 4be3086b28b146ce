"""Drop lines that an earlier document has.

Line keys go to range partitions by hash and are sorted there by document and position, so that one pass over a
partition sees the first document of each key before all others. What comes back to the documents is a compressed bitmap
each, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import keyed, row_key, sha256, sized_for, text_batches, with_checkpoint_dir

SPACE = b" \t\n\x0b\x0c\r"
_LINES = "doc_id long, text_hash int, position int, high long, low long"
_ENDS = "part int, first_high long, first_low long, first_doc long, last_high long, last_low long, last_doc long"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()  # of bytes: ASCII only


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def _line_hashes(least: int):
    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            rows, positions, digests = [], [], []
            for row, text in enumerate(texts):
                for position, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if long_enough(key, least):
                        rows.append(row)
                        positions.append(position)
                        digests.append(xxhash.xxh3_128_digest(key))
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("text_hash").take(at),
                    pa.array(positions, pa.int32()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                ],
                ["doc_id", "text_hash", "position", "high", "low"],
            )

    return hashed


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(batch.column(name).to_numpy() for name in ("high", "low", "doc_id"))


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each partition: its first key and document, and its last key with that key's first document here."""
    first = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low, doc = _columns(batch)
        first = first or (high[0], low[0], doc[0])
        start = np.flatnonzero((high == high[-1]) & (low == low[-1]))[0]
        if not last or start or (last[0], last[1]) != (high[-1], low[-1]):
            last = (high[-1], low[-1], doc[start])
    if first:
        row = [TaskContext.get().partitionId(), *map(int, first), *map(int, last)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[0]], pa.int32()), *(pa.array([v], pa.int64()) for v in row[1:])],
            ["part", "first_high", "first_low", "first_doc", "last_high", "last_low", "last_doc"],
        )


def _repeats(carried: dict[int, tuple[int, int, int]]):
    """Keep the lines of the first document of each key, and give out the others."""

    def streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = carried.get(TaskContext.get().partitionId())
        for batch in batches:
            if not batch.num_rows:
                continue
            high, low, doc = _columns(batch)
            new = np.ones(len(doc), bool)
            new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            owner = doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
            if before and before[:2] == (high[0], low[0]):
                run = int(np.flatnonzero(new)[1]) if new.sum() > 1 else len(doc)
                owner[:run] = before[2]
            before = (int(high[-1]), int(low[-1]), int(owner[-1]))
            yield batch.select(["doc_id", "text_hash", "position"]).filter(pa.array(doc != owner))

    return streamed


def _bitmaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bitmaps = []
        for positions in batch.column("positions"):
            dropped = positions.values.to_numpy()
            keep = np.ones((int(dropped.max()) // 8 + 1) * 8, np.uint8)
            keep[dropped] = 0
            bitmaps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(bitmaps, pa.binary())],
            ["doc_id", "text_hash", "keep_bitmap"],
        )


def line_keep_bitmaps(docs: DataFrame, least: int = 10) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``keep_bitmap`` of each document that loses a line.

    A bitmap is zlib over one bit a line, most significant first; lines beyond its end and whole documents without a row
    are kept. Keys of fewer than ``least`` code points take no part. Repeated rows of one id are one document, and a null
    id counts as the greatest.
    """
    spark = docs.sparkSession
    with_checkpoint_dir(spark)
    sized_for(docs)
    lines = keyed(docs).mapInArrow(_line_hashes(least), _LINES)
    # The document is part of the range, so a line that a third of all documents share is cut into many ranges.
    ordered = (
        lines.repartitionByRange("high", "low", "doc_id")
        .sortWithinPartitions("high", "low", "doc_id", "position")
        .checkpoint()
    )
    ends = sorted(ordered.mapInArrow(_ends, _ENDS).collect(), key=lambda row: row["part"])  # a row a partition
    carried, before = {}, None
    for row in ends:
        carried[row["part"]] = before
        same_as_before = before and before[:2] == (row["first_high"], row["first_low"])
        one_key = (row["first_high"], row["first_low"]) == (row["last_high"], row["last_low"])
        if not (same_as_before and one_key):
            before = (row["last_high"], row["last_low"], row["last_doc"])
    repeats = ordered.mapInArrow(_repeats(carried), "doc_id long, text_hash int, position int")
    return (
        repeats.groupBy("doc_id", "text_hash")
        .agg(F.collect_set("position").alias("positions"))
        .mapInArrow(_bitmaps, "doc_id long, text_hash int, keep_bitmap binary")
    )


def kept_lines(text: bytes, bitmap: bytes | None) -> tuple[int, list[bytes]]:
    """The number of lines and the lines that stay."""
    lines = text.split(b"\n")
    if bitmap is None:
        return len(lines), lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    return len(lines), [line for i, line in enumerate(lines) if i >= len(bits) or bits[i]]


def _applied(with_text: bool):
    def applied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            bitmaps = batch.column("keep_bitmap").to_pylist()
            kept = [kept_lines(text, bitmap) for text, bitmap in zip(texts, bitmaps, strict=True)]
            joined = [b"\n".join(lines) for _, lines in kept]
            if with_text:
                missing = batch.column("text").is_null().to_numpy(zero_copy_only=False)
                result = pa.array(joined, pa.binary(), mask=missing).cast(pa.string(), safe=False)
            else:
                result = pa.array([sha256(text) for text in joined], pa.string())
            arrays = [
                batch.column("row"),
                pa.array([n for n, _ in kept], pa.int64()),
                pa.array([n - len(lines) for n, lines in kept], pa.int64()),
                result,
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "n_lines", "n_dropped", "kept"])

    return applied


def deduplicate_lines(docs: DataFrame, least: int = 10, with_text: bool = True) -> DataFrame:
    """``row`` (the document's columns but the text, as a struct), ``n_lines``, ``n_dropped`` and ``kept``.

    ``kept`` is the text that stays (null stays null), or its SHA-256 if ``with_text`` is false. Null and empty texts are
    one empty line, which stays. An empty table gives no rows.
    """
    row = F.struct(*(name for name in docs.columns if name != "text"))
    rows = docs.select(*row_key(), "text", row.alias("row"))
    fields = [
        T.StructField("row", rows.schema["row"].dataType),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("kept", T.StringType()),
    ]
    joined = rows.join(line_keep_bitmaps(docs, least), ["doc_id", "text_hash"], "left")
    return joined.select("row", "text", "keep_bitmap").mapInArrow(_applied(with_text), T.StructType(fields))


def line_digest(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_lines``, ``n_dropped`` and ``kept_sha256``."""
    result = deduplicate_lines(docs.select("doc_id", "text"), with_text=False)
    return result.select(F.col("row")["doc_id"].alias("doc_id"), "n_lines", "n_dropped", F.col("kept").alias("kept_sha256"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents with ``text`` and ``n_chars`` of what stays; a document that loses all its text goes."""
    result = deduplicate_lines(docs)
    dropped = F.col("n_dropped") > 0
    new = {
        "text": F.col("kept"),
        "n_chars": F.when(dropped, F.char_length("kept").cast("long")).otherwise(F.col("row")["n_chars"]),
    }
    columns = [new.get(name, F.col("row")[name]).alias(name) for name in docs.columns]
    return result.where(~dropped | F.col("kept").rlike(r"[^\x20\x09-\x0D]")).select(*columns)
