"""Token ids in files, compressed by Re-Pair grammars that any place can be read from.

Documents go to range partitions in the order of their ids; a partition's ids, an end id behind each document, are cut into
shards of bounded size. In each shard frequent pairs of neighbouring ids are replaced by new symbols, again and again,
and the rules are stored with the number of ids that each symbol stands for. Their running sums say which symbol of the
sequence holds a wanted place, so that only the symbols around it are expanded.

Texts are encoded by the tokenizers library. Most of a text is pieces met before, so it is cut where the pattern of a
byte-level tokenizer always cuts, each distinct piece is encoded once, and the ids are put together.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import public_id, row_key, sized_for, text_batches
from orderloom.llm.words import mix
from orderloom.session import partitions_for, scratch

SHARD = 1 << 20  # ids of a shard
FILE_SHARDS = 16
CHUNK = 1 << 22  # bytes of a text encoded at once
SLOTS = 1 << 20  # short pieces that a worker remembers
SLOT_IDS = 8
LONG = 1 << 16  # longer ones
USES = 16  # a pair found less often is not worth a rule
FALL = 8  # a round replaces pairs down to this part of the count that the one before it went down to

_FILE = (
    "part int, shard int, first long, base int, first_place long, doc_ids array<long>, n_ids array<long>, "
    "rules binary, lengths binary, symbols binary"
)
_PIECES = "part int, place long, doc_id long, first long, n_ids long, crc long"


# Grammars.


@dataclass(frozen=True)
class Grammar:
    """Symbols below ``base`` are ids; symbol ``base + i`` stands for the pair ``rules[i]``, ``lengths[i]`` ids long."""

    base: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        size = np.ones(len(symbols), np.int64)
        composed = symbols >= self.base
        size[composed] = self.lengths[symbols[composed] - self.base]
        return size

    def expanded(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that the symbols stand for, copied from the rules' own."""
        sizes = self.sizes(symbols)
        met = np.zeros(len(self.rules), bool)
        met[symbols[symbols >= self.base] - self.base] = True
        used = np.flatnonzero(met).astype(np.uint32) + np.uint32(self.base)
        ids_of_used = self._unfolded(used)
        starts = np.zeros(len(self.rules), np.int64)
        starts[used - self.base] = np.cumsum(self.sizes(used)) - self.sizes(used)
        result = np.repeat(symbols, sizes)
        composed = np.flatnonzero(result >= self.base)
        first = np.cumsum(sizes) - sizes
        inside = composed - np.repeat(first, sizes)[composed]
        result[composed] = ids_of_used[starts[result[composed] - self.base] + inside]
        return result

    def _unfolded(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of symbols by their rules: a pass replaces every composed one by its pair."""
        while len(composed := np.flatnonzero(symbols >= self.base)):
            pairs = self.rules[symbols[composed] - self.base]
            width = np.ones(len(symbols), np.int64)
            width[composed] = 2
            wider = np.repeat(symbols, width)
            at = composed + np.arange(len(composed))
            wider[at], wider[at + 1] = pairs[:, 0], pairs[:, 1]
            symbols = wider
        return symbols

    def between(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to before ``stop``; only the symbols that reach into them are expanded."""
        ends = np.cumsum(self.sizes(self.symbols))
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
        before = int(ends[first - 1]) if first else 0
        return self.expanded(self.symbols[first : last + 1])[start - before : stop - before]


def _frequent_pairs(symbols: np.ndarray, least: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs found so often, sorted, with their counts; the places where they begin, and which pair is at each.

    Places are counted by buckets first, and only pairs of full buckets by themselves. Of two such pairs in a bucket one has to
    wait for another round, whose seed parts them.
    """
    pairs = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
    factor = np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % 2**64)

    def bucket(of: np.ndarray) -> np.ndarray:
        return ((of * factor) >> np.uint64(44)).astype(np.int64)

    buckets = bucket(pairs)
    places = np.flatnonzero((np.bincount(buckets, minlength=1 << 20) >= least)[buckets])
    ordered = np.sort(pairs[places])
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else places
    counts = np.diff(np.append(first, len(ordered)))
    often = counts >= least
    distinct, counts = ordered[first][often], counts[often]
    if not len(distinct):
        return distinct, counts, places[:0], places[:0]
    number = np.full(1 << 20, -1, np.int32)
    number[bucket(distinct)] = np.arange(len(distinct))
    which = number[buckets[places]]
    sure = (which >= 0) & (distinct[which] == pairs[places])
    return distinct, counts, places[sure], which[sure]


def _apart(places: np.ndarray, which: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the places whose pairs do not overlap: of two that do, the more frequent pair's; of equals in a row, every
    second."""
    weight = counts[which]
    touching = np.diff(places) == 1
    beaten = np.zeros(len(places), bool)
    beaten[:-1] |= touching & (weight[1:] > weight[:-1])
    beaten[1:] |= touching & (weight[:-1] > weight[1:])
    places, which = places[~beaten], which[~beaten]
    if not len(places):
        return places, which
    new_run = np.concatenate(([True], np.diff(places) != 1))
    at = np.arange(len(places))
    first = (at - np.maximum.accumulate(np.where(new_run, at, 0))) % 2 == 0
    return places[first], which[first]


def compress(ids: np.ndarray, base: int) -> Grammar:
    """Rounds of replacing pairs, the most frequent ones first, until those found USES times are hardly worth a round."""
    symbols = ids.astype(np.uint32)
    rules, lengths, n_rules = [np.zeros((0, 2), np.uint32)], [np.zeros(0, np.uint32)], 0
    least, turn = max(USES, len(symbols) >> 8), 0
    while len(symbols) > 1:
        before, turn = len(symbols), turn + 1
        distinct, counts, places, which = _frequent_pairs(symbols, least, turn)
        places, which = _apart(places, which, counts)
        made = np.bincount(which, minlength=len(distinct)) >= 2
        number = np.cumsum(made) - 1
        places, which = places[made[which]], which[made[which]]
        if len(places):
            new = np.stack([distinct[made] >> np.uint64(32), distinct[made] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
            known = np.concatenate(lengths)
            sizes = np.ones(new.shape, np.uint32)
            composed = new >= base
            sizes[composed] = known[new[composed] - base]
            rules.append(new)
            lengths.append(sizes.sum(axis=1).astype(np.uint32))
            symbols = symbols.copy()
            symbols[places] = (base + n_rules + number[which]).astype(np.uint32)
            n_rules += len(new)
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            symbols = symbols[keep]
        if least == USES and before - len(symbols) <= before // 16:
            break
        least = max(USES, least // FALL)
    return Grammar(base, np.concatenate(rules), np.concatenate(lengths), symbols)


# Encoding.

_LETTER = np.zeros(256, bool)
_LETTER[list(range(0x41, 0x5B)) + list(range(0x61, 0x7B))] = True
_SEEN = np.zeros(256, bool)  # ASCII that is neither blank nor a control
_SEEN[0x21:0x7F] = True


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places at which the pattern of byte-level tokenizers always begins a new match, whatever is around.

    A blank behind anything but white space; a character that is no letter behind a letter; a letter behind a single line
    end. Only ASCII, and the letters from U+00C0 to U+00FF, are judged. The pattern looks ahead at the end of white space only, and no
    piece ends in more than one character of it.
    """
    if len(data) < 2:
        return np.zeros(0, np.int64)
    ascii_letter = _LETTER[data]
    second = np.zeros(len(data), bool)  # second byte of U+00C0 to U+00FF
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    sign = second & ((data == 0x97) | (data == 0xB7))  # times and division
    letter = ascii_letter | (second & ~sign)
    solid = _SEEN[data] | second
    here = np.zeros(len(data), bool)
    here[1:] = (data[1:] == 0x20) & solid[:-1]
    here[1:] |= letter[:-1] & ~ascii_letter[1:] & (data[1:] < 0x80)
    here[2:] |= ascii_letter[2:] & (data[1:-1] == 0x0A) & solid[:-2]
    return np.flatnonzero(here)


class Encoder:
    """A tokenizers file, and the pieces that a worker has met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        self.by_pieces = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
            and not any(spec.get(part) for part in ("normalizer", "truncation", "padding"))
            and not any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in added)
        )
        self.added = [token["content"].encode() for token in added]
        self.base = self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = (self.tokenizer.id_to_token(i) or "" for i in range(self.base))
        self.sizes = np.array([len(name) for name in names], np.int64)  # a byte is a character in their spelling
        for token in added:
            self.sizes[token["id"]] = len(token["content"].encode())
        self.head, self.tail = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.width, self.n_ids = np.zeros(SLOTS, np.uint8), np.zeros(SLOTS, np.uint8)
        self.ids = np.zeros((SLOTS, SLOT_IDS), np.uint32)
        self.long: dict[bytes, np.ndarray] = {}

    def whole(self, texts: list[bytes]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in encoded]

    def encode(self, text: bytes) -> np.ndarray:
        return self.batch([text])[0]

    def batch(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_pieces:
            return self.whole(texts)
        if any(token in text for token in self.added for text in texts):  # the library looks for these first, across all cuts
            return self.whole(texts)
        if len(texts) == 1 and len(texts[0]) > 2 * CHUNK:
            return [np.concatenate([self._by_pieces([chunk])[0] for chunk in _chunks(texts[0])])]
        return self._by_pieces(texts)

    def _by_pieces(self, texts: list[bytes]) -> list[np.ndarray]:
        data = b"".join(texts) + bytes(8)
        ends_of_texts = np.cumsum([len(text) for text in texts])
        total = int(ends_of_texts[-1]) if len(texts) else 0
        raw = np.frombuffer(data, np.uint8)[:total]
        # A text's end is a cut as well. What a cut looks back at may be of the text before, but there the two coincide.
        marks = np.zeros(total + 1, bool)
        marks[0], marks[_cuts(raw)], marks[ends_of_texts] = True, True, True
        bounds = np.flatnonzero(marks)
        starts, ends = bounds[:-1], bounds[1:]
        which, (offsets, ids) = self._distinct(data, starts, ends)
        counts = np.diff(offsets)[which]
        out_ends = np.cumsum(counts)
        places = np.arange(out_ends[-1] if len(out_ends) else 0) + np.repeat(offsets[which] - (out_ends - counts), counts)
        joined = ids[places]
        upto = np.concatenate(([0], out_ends))[np.searchsorted(starts, ends_of_texts)] if len(starts) else np.zeros(len(texts), int)
        return np.split(joined, upto[:-1])

    def _distinct(self, data: bytes, starts: np.ndarray, ends: np.ndarray):
        """For each piece the number of a distinct one, and the offsets and ids of those."""
        eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        width = ends - starts
        short = width <= 16
        s, e, w = starts[short], ends[short], width[short]
        keep = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
        head = eights[s] & keep[np.minimum(w, 8)]
        tail, wide = np.zeros(len(s), np.uint64), np.flatnonzero(w > 8)
        tail[wide] = eights[e[wide] - 8]
        key = mix(mix(head) + tail * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64))
        order = np.argsort(key, kind="stable")

        def like_the_one_before() -> np.ndarray:
            return np.logical_and.reduce([np.diff(column[order]) == 0 for column in (head, tail, w)])

        equal = like_the_one_before()
        if (equal != (np.diff(key[order]) == 0)).any():  # two pieces of one key: put them in order by themselves
            order = np.lexsort((w, tail, head))
            equal = like_the_one_before()
        new = np.concatenate(([True], ~equal)) if len(order) else np.zeros(0, bool)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        one = order[new]
        head, tail, w, slot = head[one], tail[one], w[one].astype(np.uint8), (key[one] & np.uint64(SLOTS - 1)).astype(np.int64)
        hit = (self.head[slot] == head) & (self.tail[slot] == tail) & (self.width[slot] == w)
        counts, flat = self.n_ids[slot].astype(np.int64), self.ids[slot]
        missing = np.flatnonzero(~hit)
        at = one[missing]
        own_counts, own_ids = self._pieces(data, s[at], e[at])
        counts[missing] = own_counts
        own_starts = np.cumsum(own_counts) - own_counts
        fits = own_counts <= SLOT_IDS
        small = missing[fits]
        inside = np.arange(SLOT_IDS) < own_counts[fits, None]
        filled = np.zeros((len(small), SLOT_IDS), np.uint32)
        filled[inside] = own_ids[(own_starts[fits, None] + np.arange(SLOT_IDS))[inside]]
        flat[small] = filled
        rows = [(i, own_ids[a : a + n]) for i, a, n in zip(missing[~fits], own_starts[~fits], own_counts[~fits], strict=True)]
        # Where two pieces want a slot, all columns take the last one.
        slots = slot[small]
        self.head[slots], self.tail[slots], self.width[slots] = head[small], tail[small], w[small]
        self.n_ids[slots], self.ids[slots] = counts[small], filled
        # Longer pieces, told apart by themselves.
        number: dict[bytes, int] = {}
        places: list[tuple[int, int]] = []
        which = np.empty(len(starts), np.int64)
        which[short] = group
        n = len(one)
        for i, a, b in zip(np.flatnonzero(~short).tolist(), starts[~short].tolist(), ends[~short].tolist(), strict=True):
            j = number.setdefault(data[a:b], len(number))
            which[i] = n + j
            if j == len(places):
                places.append((a, b))
        if len(self.long) + len(number) > LONG:
            self.long.clear()
        unknown = [piece for piece in number if piece not in self.long]
        at = np.array([places[number[piece]] for piece in unknown], np.int64).reshape(-1, 2)
        own_counts, own_ids = self._pieces(data, at[:, 0], at[:, 1])
        found = dict(zip(unknown, np.split(own_ids, np.cumsum(own_counts)[:-1]), strict=True)) if unknown else {}
        of_long = [found[p] if p in found else self.long[p] for p in number]
        self.long.update((p, ids) for p, ids in found.items() if len(p) <= 64 and len(self.long) < LONG)
        offsets = np.concatenate(([0], np.cumsum(np.concatenate((counts, [len(ids) for ids in of_long])).astype(np.int64))))
        ids = np.zeros(int(offsets[-1]), np.uint32)
        fits = np.flatnonzero(counts <= SLOT_IDS)
        inside = np.arange(SLOT_IDS) < counts[fits, None]
        ids[(offsets[fits, None] + np.arange(SLOT_IDS))[inside]] = flat[fits][inside]
        for i, own in [*rows, *((n + j, own) for j, own in enumerate(of_long))]:
            ids[offsets[i] : offsets[i + 1]] = own
        return which, (offsets, ids)

    def _pieces(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of the pieces, and all the ids.

        Pieces that begin with a blank are encoded many in a row, as a cut goes before each, and told apart by their bytes.
        """
        raw = np.frombuffer(data, np.uint8)
        solid = _SEEN[raw[ends - 1]] | ((raw[ends - 2] == 0xC3) & (raw[ends - 1] >= 0x80))
        lined = np.flatnonzero((raw[starts] == 0x20) & solid)
        width = (ends - starts)[lined]
        upto = np.cumsum(width)
        row = raw[np.arange(width.sum()) + np.repeat(starts[lined] - (upto - width), width)].tobytes()
        bounds = [0, *upto[255:-1:256].tolist(), len(row)]
        together = self.whole([row[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]) if row else []
        encoded = np.concatenate(together) if together else np.zeros(0, np.uint32)
        to = np.cumsum(self.sizes[encoded])
        last = np.searchsorted(to, upto)
        if len(lined) and (to[-1] != upto[-1] or (to[last] != upto).any()):
            lined, last, encoded = lined[:0], last[:0], encoded[:0]
        rest = np.setdiff1d(np.arange(len(starts)), lined, assume_unique=True)
        alone = self.whole([data[a:b] for a, b in zip(starts[rest].tolist(), ends[rest].tolist(), strict=True)])
        counts = np.zeros(len(starts), np.int64)
        counts[lined] = np.diff(last, prepend=-1)
        counts[rest] = [len(ids) for ids in alone]
        order = np.concatenate((lined, rest))
        encoded = np.concatenate([encoded, *alone])
        first = np.empty(len(starts), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        own = np.cumsum(counts) - counts
        return counts, encoded[np.arange(len(encoded)) + np.repeat(first - own, counts)]


def _chunks(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end at cuts."""
    start = 0
    while len(text) - start > 2 * CHUNK:
        cuts = _cuts(np.frombuffer(text, np.uint8, CHUNK, start))
        stop, width = start + (int(cuts[-1]) if len(cuts) else 0), CHUNK
        while stop == start and width < len(text) - start:
            width = min(2 * width, len(text) - start)
            cuts = _cuts(np.frombuffer(text, np.uint8, width, start))
            stop = start + (int(cuts[-1]) if len(cuts) else 0)
        if stop == start:
            break
        yield text[start:stop]
        start = stop
    yield text[start:]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# Files.


def _packed(path: str, end_id: int, most: int):
    """The shards of a partition, whose rows are in order."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(path), TaskContext.get().partitionId()
        base = max(own.base, end_id + 1)
        held: list[np.ndarray] = []
        docs: list[tuple[int | None, int]] = []  # of the shard in hand: id of the document, its ids in the shard
        size = shard = first = place = first_place = 0

        def given() -> pa.RecordBatch:
            grammar = compress(np.concatenate(held), base)
            values = [
                part, shard, first, base, first_place, [d for d, _ in docs], [n for _, n in docs],
                grammar.rules.astype("<u4").tobytes(), grammar.lengths.astype("<u4").tobytes(), grammar.symbols.astype("<u4").tobytes(),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _FILE_TYPES, strict=True)], _FILE_NAMES)

        for batch, texts in text_batches(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.batch(texts), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                done = 0
                while done < len(ids):
                    taken = ids[done : done + most - size]
                    held.append(taken)
                    docs.append((doc_id, len(taken)))
                    done, size = done + len(taken), size + len(taken)
                    if size == most:
                        yield given()
                        first, shard, size, held, docs = first + size, shard + 1, 0, [], []
                        first_place = place + (done == len(ids))
                place += 1
        if size:
            yield given()

    return packed


_FILE_NAMES = [field.split()[0] for field in _FILE.split(", ")]
_FILE_TYPES = [
    {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}[field.split()[1]]
    for field in _FILE.split(", ")
]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, shard: int = SHARD) -> None:
    """Encode all texts, with ``end_id`` behind each, and write them in ascending order of ``doc_id``.

    Rows of one id go by a hash of their text; a null id comes last. Null and empty texts are the end id alone. An empty table
    writes no shards.
    """
    sized_for(docs)
    rows = docs.select(*row_key(), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "text_hash", "row"]  # the row's number parts even rows that are equal
    ordered = rows.repartitionByRange(partitions_for(docs.sparkSession, docs), *order).sortWithinPartitions(*order)
    shards = ordered.select(public_id().alias("doc_id"), "text").mapInArrow(_packed(tokenizer, end_id, shard), _FILE)
    shards.write.option("compression", "zstd").option("maxRecordsPerFile", FILE_SHARDS).parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_FILE).parquet(folder)


def _grammars(batch: pa.RecordBatch) -> Iterator[tuple[dict, Grammar]]:
    for row in batch.to_pylist():
        rules, lengths, symbols = (np.frombuffer(row.pop(name), "<u4") for name in ("rules", "lengths", "symbols"))
        yield row, Grammar(row["base"], rules.reshape(-1, 2), lengths, symbols)


def _checked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and CRC-32 of each document's ids in each shard."""
    for batch in batches:
        for row, grammar in _grammars(batch):
            ids = grammar.expanded(grammar.symbols).astype("<u4")
            ends = np.cumsum(row["n_ids"])
            starts = ends - row["n_ids"]
            data = memoryview(ids).cast("B")
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(crcs)
            arrays = [
                pa.array(np.full(n, row["part"], np.int32)),
                pa.array(row["first_place"] + np.arange(n)),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["first"] + starts),
                pa.array(row["n_ids"], pa.int64()),
                pa.array(crcs, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "place", "doc_id", "first", "n_ids", "crc"])


def _shift(rows: list[int], vector: int) -> int:
    total = 0
    for row in rows:
        if vector & 1:
            total ^= row
        vector >>= 1
    return total


def crc32_of_both(first: int, second: int, size: int) -> int:
    """The CRC-32 of two strings in a row, from theirs and the size of the second: zeros of that size are appended to the
    first by squaring the step of a single zero bit."""
    step = [0xEDB88320, *(1 << i for i in range(31))]
    bits = 8 * size
    while bits:
        if bits & 1:
            first = _shift(step, first)
        step = [_shift(step, row) for row in step]
        bits >>= 1
    return first ^ second


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = []
        for parts in batch.column("parts").to_pylist():
            crc = parts[0]["crc"]
            for part in parts[1:]:
                crc = crc32_of_both(crc, part["crc"], 4 * part["n_ids"])
            crcs.append(crc)
        names = ["doc_id", "start", "n_tokens"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(crcs, pa.int64())], [*names, "ids_crc32"])


def _starts(shards: DataFrame) -> DataFrame:
    """How many ids are in the partitions before each; a row for each partition."""
    n_ids = F.aggregate("n_ids", F.lit(0).cast("long"), lambda total, n: total + n)
    totals = shards.groupBy("part").agg(F.sum(n_ids).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).cast("long").alias("before"))


def token_digest(shards: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of each document, from what the shards decode to."""
    pieces = shards.mapInArrow(_checked, _PIECES)
    # A document of several shards has a row of each, a few hundred at most.
    parts = F.sort_array(F.collect_list(F.struct("first", "n_ids", "crc")))
    documents = pieces.groupBy("part", "place").agg(
        F.max("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sum("n_ids").alias("n_tokens"), parts.alias("parts")
    )
    placed = documents.join(_starts(shards), "part").withColumn("start", F.col("first") + F.col("before"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.select("doc_id", "start", "n_tokens", "parts").mapInArrow(_joined, schema)


def read_ids(shards: DataFrame, start: int, stop: int) -> DataFrame:
    """Ids from place ``start`` to before ``stop`` of the whole: ``start`` and ``ids`` of each shard that has some.

    Shards outside are not decoded, nor are the symbols of a shard that lie outside.
    """
    names = ["first", "before", "base", "rules", "lengths", "symbols"]
    size = F.aggregate("n_ids", F.lit(0).cast("long"), lambda total, n: total + n)
    placed = shards.join(_starts(shards), "part").withColumn("at", F.col("first") + F.col("before"))
    wanted = placed.where((F.col("at") < stop) & (F.col("at") + size > start))

    def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, grammar in _grammars(batch):
                at = row["first"] + row["before"]
                end = int(grammar.sizes(grammar.symbols).sum())
                ids = grammar.between(max(0, start - at), min(end, stop - at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([max(start, at)], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], ["start", "ids"]
                )

    return wanted.select(*names).mapInArrow(sliced, "start long, ids array<int>")


def packed_digest(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` (with the end id) and ``ids_crc32``.

    The ids are written to files in the shared folder, from which the result is read back. A null id comes last; repeated
    rows each have their place; null and empty texts are the end id alone; an empty table gives no rows; other columns take
    no part.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "token-files")
    write_token_files(docs, folder, tokenizer or public_tokenizer(), end_id)
    return token_digest(read_shards(spark, folder))


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
