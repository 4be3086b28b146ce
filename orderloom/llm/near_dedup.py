"""Near-duplicate documents: MinHash signatures, bands, exact confirmation and connected components.

Documents with equal shingle sets are one node from the start. Nodes that share a band are candidates, but a bucket's
pairs are never all made:

1. of the least nodes of its buckets, every node is compared with the least that it may be like, and the links found are
   joined to components;
2. what then still shares a bucket across components is compared in blocks: small buckets at once, others as pairs of
   chunks of bounded size, each a task's work of its own.

Only pairs whose signatures allow it come out to be confirmed. The signature has, besides the bands, the parities of the
set's hashes in PARITIES places: two sets differ in as many elements at least as their parities differ, so no pair that
is alike is refused. A pair goes unconfirmed only if its ends are in one component already, or can't be alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import keyed, public_id, row_key, set_aside, sized_for, stored, text_batches
from orderloom.llm.components import components
from orderloom.llm.words import mix, shingle_set, split_words

MISS = 1e-6  # chance that a pair at the threshold shares no band
MOST_HASHES = 160
PARITIES = 2048
SMALL_BUCKET = 16
CHUNK = 512  # nodes of a bucket that a block has from each side, about


def bands_for(threshold: float) -> tuple[int, int]:
    """Bands and rows: the longest bands with which MISS is kept within MOST_HASHES hashes."""
    for rows in range(8, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log1p(-(threshold**rows)))
        if bands * rows <= MOST_HASHES:
            return bands, rows
    raise ValueError(f"threshold {threshold} is too low for {MOST_HASHES} hashes")


def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add hash functions modulo 2^32."""
    random = np.random.default_rng(1299709)
    return (
        random.integers(0, 2**31, (count, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1),
        random.integers(0, 2**32, (count, 1), dtype=np.uint32),
    )


def minima(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Each hash function's least value over the set."""
    a, b = family
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 2**32 - 1, np.uint32)
    for start in range(0, len(folded), 4096):
        least = np.minimum(least, (a * folded[start : start + 4096] + b).min(axis=1))
    return least


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of the set's elements falls on each place, as bits of longs."""
    counts = np.bincount((shingles % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _long_lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0] + [len(row) for row in rows])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(rows).astype(np.int64)))


def _signatures(words_each: int, bands: int, rows_each: int):
    none = np.empty(0, np.int64)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family(bands * rows_each)
        for batch, texts in text_batches(batches):
            words = split_words(texts, lower=True)
            sets = [shingle_set(words.hashes[words.of(i)], words_each) for i in range(len(texts))]
            sums = [(int(s.sum()), int((s * s | np.uint64(1)).sum())) if len(s) else (0, 0) for s in sets]
            digests = np.array(sums, np.uint64).reshape(-1, 2)
            least = np.array([minima(s, family) for s in sets], np.uint64).reshape(len(sets), bands, rows_each)
            keys = np.zeros((len(sets), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
            for i in range(rows_each):
                keys = mix(keys + least[:, :, i])
            keys = keys.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests[:, 0].view(np.int64)),
                    pa.array(digests[:, 1].view(np.int64)),
                    _long_lists([keys[i] if len(s) else none for i, s in enumerate(sets)]),
                    _long_lists([parities(s) if len(s) else none for s in sets]),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_high", "set_low", "bands", "parity"],
            )

    return rows


_SIGNED = (
    "doc_id long, text_hash int, n_shingles long, set_high long, set_low long, bands array<long>, parity array<long>"
)


def _confirmed(words_each: int, percent: int):
    """Pairs whose full sets are as alike as asked for."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(text: bytes | None) -> np.ndarray:
            return shingle_set(split_words([text or b""], lower=True).hashes, words_each)

        known_id, known_set = None, None
        for batch in batches:
            us, vs = batch.column("u").to_pylist(), batch.column("v").to_pylist()
            u_texts, v_texts = (batch.column(c).cast(pa.binary()) for c in ("u_text", "v_text"))
            keep = []
            for i, v in enumerate(vs):
                if known_id != v:  # rows come sorted by v from the join
                    known_id, known_set = v, of(v_texts[i].as_py())
                own = of(u_texts[i].as_py())
                common = len(np.intersect1d(own, known_set, assume_unique=True))
                keep.append(100 * common >= percent * (len(own) + len(known_set) - common) and common > 0)
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays(
                [pa.array([us[i] for i in at], pa.int64()), pa.array([vs[i] for i in at], pa.int64())], ["u", "v"]
            )

    return rows


def _could_be_alike(percent: int, prefix: str) -> Column:
    """For columns size and parity and those of another node with a prefix: whether the sets may be alike enough."""
    differing = F.aggregate(
        F.zip_with("parity", f"{prefix}parity", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n
    )
    return differing * (100 + percent) <= (100 - percent) * (F.col("size") + F.col(f"{prefix}size"))


def _close_in_blocks(percent: int):
    """Of each block (a bucket's chunks i and j): pairs across, or within if i = j, that may be alike enough."""

    def rows(group: pa.Table) -> pa.Table:
        node, comp, size = (group.column(name).to_numpy() for name in ("node", "comp", "size"))
        own = group.column("chunk").to_numpy()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        parity = np.array(group.column("parity").to_pylist(), np.int64)
        right = np.flatnonzero(own == high)
        us, vs = [], []
        for i in np.flatnonzero(own == low):
            other = right[(comp[right] != comp[i]) & ((node[right] > node[i]) | (low != high))]
            differing = np.bitwise_count(parity[other] ^ parity[i]).sum(axis=1, dtype=np.int64)
            close = other[differing * (100 + percent) <= (100 - percent) * (size[other] + size[i])]
            us.append(np.maximum(node[close], node[i]))
            vs.append(np.minimum(node[close], node[i]))
        empty = [np.empty(0, np.int64)]
        return pa.table({"u": np.concatenate(us or empty), "v": np.concatenate(vs or empty)})

    return rows


class _Candidates:
    """Nodes, their buckets and texts, and the rounds of comparison."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, percent: int, words_each: int):
        self.nodes, self.words_each, self.percent = nodes.drop("bands"), words_each, percent
        banded = nodes.select("node", F.explode("bands").alias("bucket"))
        shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
        # What is joined is written first, here and below: AQE splits crowded keys only in a join of plain tables.
        self.buckets = stored(banded.join(stored(shared, "shared-buckets"), "bucket", "left_semi"), "buckets")
        wanted = self.buckets.select(F.col("node").alias("doc_id")).distinct()
        texts = keyed(docs).select("doc_id", "text").join(wanted, "doc_id", "left_semi")
        self.texts = stored(texts.select(F.col("doc_id").alias("node"), "text"), "candidate-texts")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs u > v, those that are alike on their full sets."""
        u = self.texts.select(F.col("node").alias("u"), F.col("text").alias("u_text"))
        v = self.texts.select(F.col("node").alias("v"), F.col("text").alias("v_text"))
        texts = pairs.join(u, "u").join(v, "v")
        return stored(texts.mapInArrow(_confirmed(self.words_each, self.percent), "u long, v long"), "links")

    def with_components(self, found: DataFrame) -> DataFrame:
        """The nodes, with ``comp``, ``size`` and ``parity``, of buckets that hold several components."""
        comps = found.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        rows = self.buckets.join(comps, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
        several = (
            rows.groupBy("bucket")
            .agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count(F.lit(1)).alias("n"))
            .where("least < most")
            .select("bucket", "n")
        )
        return stored(rows.join(stored(several, "several"), "bucket").join(self.nodes, "node"), "open-buckets")

    def star_pairs(self) -> DataFrame:
        """Every node with the least of its buckets' least nodes that it may be like."""
        pivots = stored(self.buckets.groupBy("bucket").agg(F.min("node").alias("pivot")), "pivots")
        pairs = self.buckets.join(pivots, "bucket").where("node <> pivot").select("node", "pivot").distinct()
        other = self.nodes.select(*(F.col(name).alias(f"p_{name}") for name in self.nodes.columns))
        near = (F.col("pivot") == F.col("p_node")) & _could_be_alike(self.percent, "p_")
        return (
            pairs.join(self.nodes, "node").join(other, near).groupBy(F.col("node").alias("u")).agg(F.min("pivot").alias("v"))
        )

    def block_pairs(self, open_buckets: DataFrame) -> DataFrame:
        """The pairs of different components that are left in open buckets and may be alike."""
        small = open_buckets.where(F.col("n") <= SMALL_BUCKET).select("bucket", "node", "comp", "size", "parity")
        other = small.select(*(F.col(name).alias(f"o_{name}") for name in small.columns))
        across = (F.col("bucket") == F.col("o_bucket")) & (F.col("node") > F.col("o_node")) & (F.col("comp") != F.col("o_comp"))
        few = (
            small.join(other, across & _could_be_alike(self.percent, "o_"))
            .select(F.col("node").alias("u"), F.col("o_node").alias("v"))
            .distinct()
        )
        chunks = F.ceil(F.col("n") / CHUNK).cast("int")
        values = ["bucket", "node", "comp", "size", "parity", "chunk"]
        large = (
            open_buckets.where(F.col("n") > SMALL_BUCKET)
            .withColumn("chunks", chunks)
            .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
            .select(*values, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("with"))
            .select(*values, F.least("chunk", "with").alias("low"), F.greatest("chunk", "with").alias("high"))
        )
        many = large.groupBy("bucket", "low", "high").applyInArrow(_close_in_blocks(self.percent), "u long, v long")
        return few.union(many).distinct()

    def links(self) -> DataFrame:
        """Enough confirmed links to connect every component."""
        first = stored(self.star_pairs(), "pairs")
        links = self.confirm(first)
        found = components(links)
        second = self.block_pairs(self.with_components(found)).join(first, ["u", "v"], "left_anti")
        return links.union(self.confirm(stored(second, "pairs")))


def near_duplicates(docs: DataFrame, words_each: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles`` and ``component_id`` of every row; ids coded as by ``row_key``.

    Documents are linked if 100 * common >= percent * united on their sets of shingles of ``words_each`` words.
    ``component_id`` is the least id that links reach. Documents without words are alone. Rows of one id are one document,
    and so are all rows without id.
    """
    sized_for(docs)
    bands, rows = bands_for(percent / 100)
    signed = stored(keyed(docs).mapInArrow(_signatures(words_each, bands, rows), _SIGNED), "signatures")
    filled = signed.where("n_shingles > 0")
    classes = stored(filled.groupBy("set_high", "set_low").agg(F.min("doc_id").alias("node")), "classes")
    of_class = filled.join(classes, ["set_high", "set_low"])
    own = of_class.where("doc_id = node").select("node", F.col("n_shingles").alias("size"), "bands", "parity")
    nodes = stored(own.distinct(), "nodes")
    links = _Candidates(docs, nodes, percent, words_each).links()
    same_set = of_class.select(F.col("doc_id").alias("u"), F.col("node").alias("v")).where("u <> v")
    found = components(links.union(same_set)).select(F.col("u").alias("doc_id"), F.col("v").alias("component"))
    return signed.join(found, "doc_id", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``, for three words and 85 per cent."""
    found = near_duplicates(docs, words_each=3, percent=85)
    return found.select(
        public_id().alias("doc_id"),
        "n_shingles",
        public_id("component_id").alias("component_id"),
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )


def one_of_each(docs: DataFrame, words_each: int = 5, percent: int = 80) -> DataFrame:
    """The documents, without those that are not their component's least id. Rows without id all stay, and link nothing."""
    docs, back = set_aside(docs, "_gone_id")
    known = docs.where("doc_id is not null")
    found = near_duplicates(known, words_each, percent).where("doc_id <> component_id")
    gone = found.select(F.col("doc_id").alias("_gone_id")).distinct()
    return docs.join(gone, row_key()[0] == F.col("_gone_id"), "left_anti").withColumnsRenamed(back)
