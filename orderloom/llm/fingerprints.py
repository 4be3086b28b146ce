"""Threshold-scaled sketches of documents. Built-in functions only.

A sketch keeps every hash of a word shingle that lies below a fixed fraction of the hash range. Sketches of a fixed
fraction can be merged by union, compared whatever the sizes of their texts, and give containment as well as likeness. A
text that has words but no hash below the threshold keeps its least hash, which unions preserve too.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import set_aside, sized_for

ROWS_A_BLOCK = 5_000
MOST_BLOCKS = 4096  # with more rows, blocks are larger; about three times as many heads are sent to the driver at most
FAN = 64


def _hashes(text: Column) -> Column:
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(hashes: str, n: int) -> Column:
    """Hashes of n consecutive words; with fewer words, of the whole sequence. Null where no shingle starts."""
    last = F.greatest(F.size(hashes) - n, F.lit(0))
    return F.transform(
        hashes, lambda _, i: F.when(i <= last, F.xxhash64(*(F.get(F.col(hashes), i + j) for j in range(n))))
    )


def _below(fraction: int) -> Column:
    return F.lit(-(2**63) + 2**64 // fraction)


def with_sketch(frame: DataFrame, text: str, name: str, n: int = 5, fraction: int = 8) -> DataFrame:
    """The frame with a column of sorted hashes: those below 1/fraction of all hashes of n-word shingles of ``text``.

    A null or empty text has an empty sketch.
    """
    others = [c for c in frame.columns if c != name]
    hashed = frame.select(*others, _hashes(F.coalesce(text, F.lit(""))).alias("_hashes"))
    shingled = hashed.select(*others, _shingles("_hashes", n).alias("_shingles"))
    kept = shingled.select(
        *others,
        F.array_distinct(F.filter("_shingles", lambda v: v < _below(fraction))).alias("_kept"),
        F.array_min("_shingles").alias("_least"),
    )
    none = F.array().cast("array<bigint>")
    sketch = F.when(F.size("_kept") > 0, F.array_sort("_kept")).when(F.col("_least").isNull(), none).otherwise(F.array("_least"))
    return kept.select(*others, sketch.alias(name))


def merged(a: Column, b: Column, fraction: int = 8) -> Column:
    """The sketch of both texts' shingles together."""
    union = F.array_union(a, b)
    below = F.filter(union, lambda v: v < _below(fraction))
    return F.when(F.size(below) > 0, F.array_sort(below)).when(F.size(union) > 0, F.array(F.array_min(union))).otherwise(union)


def likeness(a: str, b: str) -> Column:
    """Common hashes by united hashes; two empty sketches are alike."""
    common = F.size(F.array_intersect(a, b))
    united = F.size(a) + F.size(b) - common
    return F.when(united == 0, F.lit(1.0)).otherwise(common.cast("double") / united.cast("double"))


def containment(a: str, b: str) -> Column:
    """The share of a's hashes that b has; an empty sketch is contained in any."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)).cast("double") / F.size(a).cast("double"))


def as_text(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda v: F.hex(v)), ",")


def _block(splits: list[int], order: Column) -> Column:
    """How many splits are at most ``order``: first among every FAN-th split, then between two of those."""
    if not splits:
        return F.lit(0)
    listed = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    coarse = F.size(F.filter(listed(splits[::FAN]), lambda s: s <= order))
    fine = F.slice(listed(splits), (coarse - 1) * FAN + 1, F.lit(FAN))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * FAN + F.size(F.filter(fine, lambda s: s <= order)))


def _placed(docs: DataFrame) -> DataFrame:
    """The rows with ``_order`` and ``_place`` (block, guest), and the first row of each block in the block before too.

    Blocks are ranges of (id, hash of the text). An id that holds several blocks' worth of rows is cut by hash into as many
    parts, so that only copies of one row stay together. (Ids beyond 2^53 are cut only if a double has them.)
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    ids = docs.select(order.alias("order"), F.hash("text").cast("long").alias("hash"))
    blocks = min(MOST_BLOCKS, math.ceil(ids.count() / ROWS_A_BLOCK))
    splits: Counter = Counter()
    if blocks > 1:
        steps = [i / blocks for i in range(1, blocks)]
        splits = Counter(ids.agg(F.percentile_approx("order", steps, 50 * MOST_BLOCKS)).first()[0])
    parts = {split: count + 1 for split, count in splits.items() if count > 1}

    def block(order: Column, text_hash: Column) -> Column:
        """Later rows have smaller numbers; rows of a crowded id come last in their block, and are its further parts."""
        whole = _block(sorted(splits), order) * F.lit(2 * MOST_BLOCKS)
        if not parts:
            return whole
        text = ",".join(f"{split}:{n}" for split, n in sorted(parts.items()))
        n = F.try_element_at(F.str_to_map(F.lit(text), F.lit(","), F.lit(":")), order.cast("string")).cast("long")
        part = F.floor((text_hash + F.lit(2**31)) * n / F.lit(2**32)).cast("int") + 1
        return whole - F.coalesce(part, F.lit(0))

    rows = docs.withColumn("_order", order).withColumn("_hash", F.hash("text").cast("long"))
    rows = rows.withColumn("_block", block(F.col("_order"), F.col("_hash")))
    first = F.max(F.struct("order", (-F.col("hash")).alias("minus"))).alias("head")
    heads = ids.withColumn("block", block(F.col("order"), F.col("hash"))).groupBy("block").agg(first)
    found = sorted(heads.collect(), key=lambda row: -row["block"])  # three times MOST_BLOCKS rows at most
    guests = [(*found[(i + 1) % len(found)]["head"], row["block"]) for i, row in enumerate(found)]
    guest_frame = spark.createDataFrame(guests, "_head long, _minus long, _to int")
    own = F.struct(F.col("_block").alias("block"), F.lit(False).alias("guest"))
    other = F.struct(F.col("_to").alias("block"), F.lit(True).alias("guest"))
    # The broadcast side has a row of three numbers for each block.
    same = (rows["_order"] == guest_frame["_head"]) & (-rows["_hash"] == guest_frame["_minus"])
    return rows.join(F.broadcast(guest_frame), same, "left").select(
        *docs.columns,
        "_order",
        F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, other))).alias("_place"),
    )


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The rows with ``next_..`` of the row after them by descending ``doc_id``; after the last comes the first.

    Rows without id come last, and rows of one id by their text's hash. Rows are ordered within blocks of ids and hashes;
    the first row of each block is copied into the block before, so that no task sees all rows.
    """
    docs, back = set_aside(docs, "_order", "_hash", "_block", "_place", "_head", "_minus", "_to")
    by_block = Window.partitionBy("_place.block").orderBy("_place.guest", F.desc("_order"), F.hash("text"))
    return _placed(docs).select(
        *docs.columns, "_place", *(F.lead(name).over(by_block).alias(f"next_{name}") for name in carried)
    ).where("not _place.guest").drop("_place").withColumnsRenamed(back)


def fingerprint_digest(docs: DataFrame, n: int = 5, fraction: int = 2) -> DataFrame:
    """Fingerprints of every text and of its edited text: its last third (``floor(n_chars / 3)`` code points) replaced
    by the first as many of the next document.

    ``near_edited`` and ``near_next`` are the likeness of the text's sketch to those of the edited and the next text. Half
    of all hashes are kept, as short texts would seldom have a common one among fewer.
    """
    sized_for(docs)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_sketch(texts, "text", "sketch", n, fraction), ["text", "sketch"])
    third = F.floor(F.char_length("text") / 3).cast("int")
    edited = rows.select(
        "doc_id",
        "sketch",
        "next_sketch",
        F.char_length("text").cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), F.char_length("text") - third), F.substring("next_text", F.lit(1), third)).alias("edited"),
    )
    both = with_sketch(edited, "edited", "edited_sketch", n, fraction)
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"),
        containment("edited_sketch", "sketch").alias("edited_contained"),
    )
