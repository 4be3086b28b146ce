"""Remove passages that occur more than once, by anchors and window counts in place of prefix-partitioned suffix trees.

A repeated passage is a node of string depth ``window`` or more in the tree of all suffixes. No tree is built, and maximal
repeats are not given, only the spans of repeated windows:

* Only suffixes whose window could share a prefix are looked at. Every window of 35 words has one anchor, its 12-word
  gram of least hash, so equal windows have equal anchors at equal places; about one word in twelve is an anchor. An
  anchor found once is a leaf at depth 12, and its windows are unique.
* The anchor's gram is the first prefix by which suffixes are grouped. Occurrences whose whole region (the words of all
  windows that have this anchor) is alike are counted by a hash of the region, without any text.
* Of the other regions the words are sent to their group, where the suffixes are ranked by doubling their depth; classes
  of two or more at full depth are the deep internal nodes. A group beyond ``group_limit`` regions is cut by a longer
  prefix, the whole window: then all leaves of a group are equal and are counted, in any number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import keyed, row_key, sha256, sized_for, stored, text_batches
from orderloom.llm.words import grams, mix, powers, split_words

_POSITION = np.uint64((1 << 24) - 1)
_REGION_BASE = 0xD6E8FEB86659FD93


def _anchors(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one document: each anchor's hash, position, first window and last window."""
    none = np.empty(0, np.int64)
    if len(hashes) < window:
        return np.empty(0, np.uint64), none, none, none
    by_gram = grams(hashes, gram)
    span = window - gram + 1
    # Least hash of ``span`` grams: by doubling; of equals the leftmost, as the position fills the low bits. Positions count
    # within strips, which overlap by a window, so that their number fits.
    found = []
    strip = int(_POSITION) // 2
    for offset in range(0, len(by_gram) - span + 1, strip):
        part = by_gram[offset : offset + strip + span - 1]
        least = (part & ~_POSITION) | np.arange(len(part), dtype=np.uint64)
        reach = 1
        while reach * 2 <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if span > reach:
            least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
        found.append((least & _POSITION).astype(np.int64) + offset)
    at = np.concatenate(found)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [len(at)])) - 1
    return by_gram[at[first]], at[first], first, last


def _anchor_rows(window: int, gram: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            words = split_words(texts)
            parts = []
            for document in range(len(texts)):
                hashes = words.hashes[words.of(document)]
                prefix, at, first, last = _anchors(hashes, window, gram)
                if not len(at):
                    continue
                up, down = powers(_REGION_BASE, len(hashes))
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1], dtype=np.uint64)))
                end = last + window
                region = mix(
                    mix((sums[end] - sums[first]) * down[first])
                    + (end - first).astype(np.uint64) * np.uint64(4099)
                    + (at - first).astype(np.uint64)
                )
                parts.append((np.full(len(at), document), prefix, region, first, last - first + 1))
            if not parts:
                continue
            document, prefix, region, first, count = (np.concatenate(p) for p in zip(*parts, strict=True))
            at = pa.array(document)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("text_hash").take(at),
                    pa.array(prefix.view(np.int64)),
                    pa.array(region.view(np.int64)),
                    pa.array(first.astype(np.int32)),
                    pa.array(count.astype(np.int16)),
                ],
                ["doc_id", "text_hash", "prefix", "region", "first", "windows"],
            )

    return rows


_ANCHORS = "doc_id long, text_hash int, prefix long, region long, first int, windows short"
_REGIONS = "doc_id long, text_hash int, prefix long, first int, open boolean, crowded boolean, words array<long>"


def _regions(window: int):
    """The words (as hashes) of the regions asked for."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            words = split_words(texts)
            wanted, lists = [], []
            for document, regions in enumerate(batch.column("regions").to_pylist()):
                own = words.hashes[words.of(document)]
                for region in regions:
                    wanted.append((document, region))
                    lists.append(own[region["first"] : region["first"] + region["windows"] + window - 1])
            at = pa.array([document for document, _ in wanted], pa.int64())
            offsets = np.cumsum([0] + [len(x) for x in lists])
            values = np.concatenate(lists) if lists else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("text_hash").take(at),
                    pa.array([r["prefix"] for _, r in wanted], pa.int64()),
                    pa.array([r["first"] for _, r in wanted], pa.int32()),
                    pa.array([r["open"] for _, r in wanted], pa.bool_()),
                    pa.array([r["crowded"] for _, r in wanted], pa.bool_()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64))),
                ],
                ["doc_id", "text_hash", "prefix", "first", "open", "crowded", "words"],
            )

    return rows


def _depth_classes(words: np.ndarray, depth: int) -> np.ndarray:
    """A number for each suffix, equal where the first ``depth`` words are equal (suffixes near the end: meaningless).

    Ranks of depth 1, 2, 4, ... as in the construction of a suffix array by doubling.
    """
    rank, reach = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    while reach < depth:
        step = min(reach, depth - reach)
        pair = rank[: len(rank) - step] << 32 | rank[step:]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        reach += step
    return rank


def _spans(batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of consecutive window starts as spans of words."""
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(row)])) - 1
    at = pa.array(row[first])
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(at),
            batch.column("text_hash").take(at),
            pa.array(start[first].astype(np.int32)),
            pa.array((start[last] + length).astype(np.int32)),
        ],
        ["doc_id", "text_hash", "start", "stop"],
    )


def _deep_nodes(window: int):
    """Spans under deep nodes of the trees of all groups in this partition, which is sorted by group."""

    def tree(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        lists = batch.column("words")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy()[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        counts = np.diff(offsets) - window + 1  # windows of each region
        if not len(counts) or counts.max(initial=0) <= 0:
            return None
        classes = _depth_classes(values, window)
        row = np.repeat(np.arange(len(counts)), counts)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        node = classes[offsets[:-1][row] + inner]
        group = np.cumsum(np.concatenate(([0], np.diff(batch.column("prefix").to_numpy()) != 0)))[row]
        key = group.astype(np.int64) << 32 | node
        _, inverse, leaves = np.unique(key, return_inverse=True, return_counts=True)
        open_ = batch.column("open").to_numpy(zero_copy_only=False)[row]
        hit = (leaves[inverse] > 1) & open_
        if not hit.any():
            return None
        first = batch.column("first").to_numpy()[row]
        return _spans(batch, row[hit], (first + inner)[hit], window)

    def streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            prefix = batch.column("prefix").to_numpy()
            cut = np.flatnonzero(prefix != prefix[-1])  # the last group may go on in the next batch
            if len(cut):
                whole = pa.concat_batches([*rest, batch.slice(0, int(cut[-1]) + 1)])
                rest = [batch.slice(int(cut[-1]) + 1)]
                if (result := tree(whole)) is not None:
                    yield result
            else:
                rest.append(batch)
        if rest and (result := tree(pa.concat_batches(rest))) is not None:
            yield result

    return streamed


def _window_rows(window: int):
    """Each window of a crowded group's region, by a hash of all its words."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            hashed = [np.asarray(words.values.to_numpy()).view(np.uint64) for words in batch.column("words")]
            high = [grams(words, window) for words in hashed]
            low = [grams(mix(words), window, 0x8CB92BA72F3D8DD7) for words in hashed]
            row = np.repeat(np.arange(len(high)), [len(x) for x in high])
            inner = np.concatenate([np.arange(len(x)) for x in high])
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).take(at) for name in ("doc_id", "text_hash", "open")),
                    pa.array((batch.column("first").to_numpy()[row] + inner).astype(np.int32)),
                    pa.array(np.concatenate(high).view(np.int64)),
                    pa.array(np.concatenate(low).view(np.int64)),
                ],
                ["doc_id", "text_hash", "open", "start", "high", "low"],
            )

    return rows


def repeated_spans(docs: DataFrame, window: int = 35, gram: int = 12, group_limit: int = 1000) -> DataFrame:
    """Spans of words (``doc_id``, ``text_hash``, ``start``, ``stop``) covered by windows that occur more than once.

    Spans of a document may touch and overlap. Null and short texts have none. ``doc_id`` is coded as by ``row_key``.
    """
    sized_for(docs)
    texts = keyed(docs)
    anchors = stored(texts.mapInArrow(_anchor_rows(window, gram), _ANCHORS), "anchors")
    found_again = anchors.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("prefix")
    shared = stored(anchors.join(found_again, "prefix", "left_semi"), "shared-anchors")

    place = F.struct("doc_id", "text_hash", "first", "windows")
    regions = shared.groupBy("prefix", "region").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place"))
    alike = regions.where("n > 1").select("prefix", "region")
    closed = shared.join(alike, ["prefix", "region"], "left_semi").select(
        "doc_id", "text_hash", F.col("first").alias("start"), (F.col("first") + F.col("windows") + (window - 1)).alias("stop")
    )

    # One occurrence of each different region makes up the trees; a group needs one whose region is not repeated.
    groups = (
        regions.groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("size"), F.max((F.col("n") == 1).cast("int")).alias("any_open"))
        .where("size > 1 and any_open = 1")
        .select("prefix", (F.col("size") > group_limit).alias("crowded"))
    )
    members = regions.join(groups, "prefix").select(
        "place.doc_id",
        "place.text_hash",
        F.struct("prefix", "place.first", "place.windows", (F.col("n") == 1).alias("open"), "crowded").alias("region"),
    )
    of_document = members.groupBy("doc_id", "text_hash").agg(F.collect_list("region").alias("regions"))
    # Equal rows: any one of them will do.
    with_words = stored(
        texts.join(of_document, ["doc_id", "text_hash"]).mapInArrow(_regions(window), _REGIONS), "regions"
    )
    span_type = "doc_id long, text_hash int, start int, stop int"
    deep = (
        with_words.where("not crowded")
        .dropDuplicates(["doc_id", "text_hash", "prefix", "first"])
        .repartition("prefix")
        .sortWithinPartitions("prefix")
        .mapInArrow(_deep_nodes(window), span_type)
    )
    leaves = with_words.where("crowded").mapInArrow(
        _window_rows(window), "doc_id long, text_hash int, open boolean, start int, high long, low long"
    ).dropDuplicates(["doc_id", "text_hash", "start", "high", "low"])
    full_depth = (
        leaves.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("high", "low")
    )
    crowded = leaves.where("open").join(full_depth, ["high", "low"], "left_semi").select(
        "doc_id", "text_hash", "start", (F.col("start") + window).alias("stop")
    )
    return closed.unionByName(deep).unionByName(crowded)


def _kept_words(with_text: bool):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            totals, removed, results = [], [], []
            for text, spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
                words = split_words([text])
                n = len(words.starts)
                change = np.zeros(n + 1, np.int32)
                for span in spans or ():
                    change[span["start"]] += 1
                    change[min(span["stop"], n)] -= 1
                keep = np.cumsum(change[:-1]) == 0
                pairs = zip(words.starts[keep].tolist(), words.ends[keep].tolist(), strict=True)
                kept = b" ".join([text[a:b] for a, b in pairs])
                totals.append(n)
                removed.append(n - int(keep.sum()))
                results.append(kept if with_text else sha256(kept))
            result = pa.array(results, pa.binary() if with_text else pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), result.cast(pa.string())],
                ["row", "n_words", "n_removed", "kept"],
            )

    return rows


def remove_repeated_passages(docs: DataFrame, window: int = 35, with_text: bool = True) -> DataFrame:
    """``row`` (the document's columns but the text), ``n_words``, ``n_removed`` and ``kept``: the words or their SHA-256.

    All occurrences of a repeated passage go, the first one too, and a passage repeated inside one document counts. Equal
    rows are occurrences of each other. Null, empty and short texts keep their words; an empty table gives no rows.
    """
    row = F.struct(*(name for name in docs.columns if name != "text"))
    rows = docs.select(*row_key(), "text", row.alias("row"))
    spans = (
        repeated_spans(docs, window)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    )
    fields = [
        T.StructField("row", rows.schema["row"].dataType),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()),
    ]
    joined = rows.join(spans, ["doc_id", "text_hash"], "left")
    return joined.select("row", "text", "spans").mapInArrow(_kept_words(with_text), T.StructType(fields))


def passage_digest(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256``."""
    result = remove_repeated_passages(docs.select("doc_id", "text"), with_text=False)
    return result.select(F.col("row")["doc_id"].alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))
