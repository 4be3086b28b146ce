"""SentencePiece encoding and decoding: the best path through a vocabulary's lattice.

A text's encoding is the sequence of vocabulary pieces with the greatest sum of scores that spells it (the unigram rule).
A text gets a blank in front, blanks stand for the vocabulary's mark U+2581, and characters without a piece (a mark of the
text's own, too) are spelt in byte pieces.
Of equal sums the path with the least sum of squared ids is taken, so that the result doesn't hang on the order of work.

No piece of such vocabularies goes on past a word's end into the next blank, so paths of words are found one by one. A
giant text is cut into chunks wherever it happens, and its path is found as a max-plus parallel scan: a chunk's transfer
matrix has the best score from each state at its start to each state at its end, a state being how many characters of a
chunk belong to a piece from the one before. Matrices of neighbours are combined, which is associative, first in blocks
of chunks and then over blocks; from the states on the best path each chunk is traced back independently of the others.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import row_key, sized_for, stored, text_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = " "
CHUNK = 65_536  # characters; longer texts are cut
BLOCK = 64  # chunks whose matrices are combined in one task
CACHED = 400_000  # words whose paths a worker keeps
KEPT = 64  # characters of a word that is kept
TIE = 50  # bits of a weight below the score, for squared ids
UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
NEVER = -(1 << 400)  # below any sum


class Vocabulary:
    """Pieces with ids and weights. A weight is the score, and far below it the squared id against ties."""

    def __init__(self, pieces: list[tuple[str, int, float]], byte_ids: list[int], unknown: float):
        self.arcs = {piece: (id_, (round(score * 1024) << TIE) - id_ * id_) for piece, id_, score in pieces}
        self.byte_ids = byte_ids
        self.unknown = round(unknown * 1024) << TIE
        self.longest = max((len(piece) for piece in self.arcs), default=1)
        self.words: dict[str, tuple[int, tuple[int, ...]]] = {}  # of giant texts, with weights
        self.seen: dict[str, tuple[int, ...]] = {}
        self._derive()
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.arcs):
            raise ValueError("a piece of this vocabulary spans two words")
        raw: list[bytes] = [b""] * (max([*(id_ for _, id_, _ in pieces), *byte_ids]) + 1)
        for piece, id_, _ in pieces:
            raw[id_] = piece.encode()
        for value, id_ in enumerate(byte_ids):
            raw[id_] = bytes([value])
        self.raw = raw

    def _derive(self) -> None:
        self.trie = _trie(self.arcs)
        self.backwards = _trie({piece[::-1]: arc for piece, arc in self.arcs.items()})
        self.singles = {piece for piece in self.arcs if len(piece) == 1}

    def __reduce__(self):
        return _rebuilt, (self.arcs, self.byte_ids, self.unknown, self.longest, self.raw)

    def spelt(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))

    def arcs_from(self, text: str, i: int, end: int) -> Iterator[tuple[int, int, int | None]]:
        """End, weight and id (None: spelt in bytes) of each piece of the text that starts at i."""
        if text[i] not in self.arcs:
            yield i + 1, self.unknown, None
        level = self.trie
        for j in range(i, end):
            if text[j] not in level:
                return
            level, arc = level[text[j]]
            if arc:
                yield j + 1, arc[1], arc[0]

    def path(self, text: str, limit: int | None = None) -> tuple[int, tuple[int, ...]]:
        """The best path over the text; its last piece starts before ``limit`` and no node lies between that and the end."""
        n = len(text)
        best, back = [NEVER] * (n + 1), [(0, None)] * (n + 1)
        best[0] = 0
        # As ``arcs_from``, but without its calls: most of the time goes here.
        root, arcs, unknown, longest = self.trie, self.arcs, self.unknown, self.longest
        for i in range(n if limit is None else limit):
            so_far = best[i]
            if so_far is NEVER:
                continue
            if text[i] not in arcs and so_far + unknown > best[i + 1]:
                best[i + 1], back[i + 1] = so_far + unknown, (i, None)
            level, j = root, i
            for char in text[i : i + longest]:
                node = level.get(char)
                if node is None:
                    break
                level, arc = node
                j += 1
                if arc is not None:
                    total = so_far + arc[1]
                    if total > best[j]:
                        best[j], back[j] = total, (i, arc[0])
        ids: list[tuple[int, ...]] = []
        j = n
        while j > 0 and best[n] != NEVER:
            i, id_ = back[j]
            ids.append((id_,) if id_ is not None else self.spelt(text[i]))
            j = i
        return best[n], tuple(chain.from_iterable(reversed(ids)))

    def word(self, text: str) -> tuple[int, tuple[int, ...]]:
        found = self.words.get(text)
        if found is None:
            if len(self.words) >= CACHED:
                self.words.clear()
            found = self.path(text)
            if len(text) <= KEPT:
                self.words[text] = found
        return found

    def learn(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """The ids of words, found in their order by letters: what two neighbours begin with is searched once."""
        backwards, singles, unknown = self.backwards, self.singles, self.unknown
        found, before = {}, ""
        best: list[int] = [0]
        back: list[tuple[int, int | None]] = [(0, None)]
        for word in sorted(words):
            n = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                n += 1
            del best[n + 1 :], back[n + 1 :]
            for j in range(n, len(word)):
                if word[j] in singles:
                    most, at = NEVER, (j, None)
                else:
                    most, at = best[j] + unknown, (j, None)
                level, i = backwards, j
                while i >= 0:
                    node = level.get(word[i])
                    if node is None:
                        break
                    level, arc = node
                    if arc is not None:
                        total = best[i] + arc[1]
                        if total >= most:
                            most, at = total, (i, arc[0])
                    i -= 1
                best.append(most)
                back.append(at)
            before, j, ids = word, len(word), []
            while j > 0:
                i, id_ = back[j]
                if id_ is None:
                    ids.extend(reversed(self.spelt(word[i])))
                else:
                    ids.append(id_)
                j = i
            found[word] = tuple(reversed(ids))
        return found

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of prepared texts. What their words are made of is remembered for the next call, within bounds."""
        cut = [UNIT.findall(text) for text in texts]
        new = set(chain.from_iterable(cut)).difference(self.seen)
        if len(self.seen) + len(new) > CACHED:
            self.seen.clear()
            new = set(chain.from_iterable(cut))
        self.seen.update(self.learn(new))
        known = self.seen.__getitem__
        found = [np.fromiter(chain.from_iterable(map(known, units)), np.int32) for units in cut]
        for word in new:
            if len(word) > KEPT:
                del self.seen[word]
        return found

    def text(self, ids: Iterable[int]) -> bytes:
        return spelt_by(ids, self.raw)


def spelt_by(ids: Iterable[int], raw: list[bytes]) -> bytes:
    """The text of ids, without the blank in front."""
    return b"".join([raw[i] for i in ids])[1:]


def _rebuilt(arcs, byte_ids, unknown, longest, raw) -> Vocabulary:
    made = Vocabulary.__new__(Vocabulary)
    made.arcs, made.byte_ids, made.unknown, made.longest, made.raw, made.words = arcs, byte_ids, unknown, longest, raw, {}
    made.seen = {}
    made._derive()
    return made


def _trie(arcs: dict[str, tuple[int, int]]) -> dict:
    """By character, the next level and the arc (or None) of the piece that ends there."""
    root: dict = {}
    for length in range(1, max(map(len, arcs), default=0) + 1):
        for piece, arc in arcs.items():
            if len(piece) >= length:
                level = root
                for char in piece[: length - 1]:
                    level = level[char][0]
                found = arc if len(piece) == length else None
                if found or piece[length - 1] not in level:
                    below = level[piece[length - 1]][0] if piece[length - 1] in level else {}
                    level[piece[length - 1]] = (below, found)
    return root


def load_vocabulary(model: str = MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece model file. It must have byte pieces, so that every text can be spelt."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    usual, byte_ids = [], [0] * 256
    for id_ in range(processor.get_piece_size()):
        if processor.is_byte(id_):
            byte_ids[int(processor.id_to_piece(id_)[3:-1], 16)] = id_
        elif not (processor.is_control(id_) or processor.is_unknown(id_) or processor.is_unused(id_)):
            usual.append((processor.id_to_piece(id_).replace("▁", MARK), id_, processor.get_score(id_)))
    if not any(byte_ids):
        raise ValueError(f"{model} has no byte pieces")
    return Vocabulary(usual, byte_ids, min(score for _, _, score in usual) - 10)


def prepared(text: bytes) -> str:
    """The text as the lattice has it; empty stays empty."""
    plain = text.decode("utf-8", "replace")
    return MARK + plain if plain else ""


# Transfer matrices. A row for each state at the start, a column for each at the end.


def word_starts(text: str) -> list[int]:
    return [m.start() for m in UNIT.finditer(text) if m.start() > 0 and text[m.start()] == MARK]


def transfer(vocabulary: Vocabulary, before: str, body: str, after: str) -> list[list[int]]:
    """The matrix of a chunk, given the character before it and ``longest - 1`` characters after it."""
    states, m = vocabulary.longest, len(body)
    text = body + after
    starts = _inner_starts(before, body, text)

    def forward(origin: int) -> list[int]:
        best = [NEVER] * (len(text) + states + 1)
        best[origin] = 0
        for i in range(origin, m):
            if best[i] != NEVER:
                for j, weight, _ in vocabulary.arcs_from(text, i, len(text)):
                    best[j] = max(best[j], best[i] + weight)
        return best[m : m + states]

    if not starts:
        return [forward(s) if s < m else [NEVER] * states for s in range(states)]
    to_first = [vocabulary.path(body[s : starts[0]])[0] if s <= starts[0] else NEVER for s in range(states)]
    middle = sum(vocabulary.word(body[a:b])[0] for a, b in zip(starts, starts[1:], strict=False))
    return [
        [a + middle + z if a != NEVER and z != NEVER else NEVER for z in from_last]
        for from_last in [forward(starts[-1])]
        for a in to_first
    ]


def combined(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    """The matrix of two neighbours: the max-plus product."""
    return [
        [max((x + y for x, y in zip(row, column, strict=True) if x != NEVER and y != NEVER), default=NEVER) for column in zip(*b, strict=True)]
        for row in a
    ]


def vectors_along(matrices: list[list[list[int]]], vector: list[int]) -> list[list[int]]:
    """The best sums from the text's start to each state, at the boundaries of the chunks."""
    vectors = [vector]
    for matrix in matrices:
        vectors.append(combined([vectors[-1]], matrix)[0])
    return vectors


def _from_entry(vocabulary: Vocabulary, text: str, vector: list[int], limit: int) -> tuple[list[int], list]:
    """Best sums and ways back of the nodes of a text, given those of the states at its start; pieces start before the limit.

    Of equal ways to a node the one whose piece starts first counts, as everywhere: one that starts before the text comes first.
    """
    best = [NEVER] * (len(text) + 1)
    back: list[tuple[int, int | None] | None] = [None] * (len(text) + 1)
    best[: len(vector)] = vector[: len(text) + 1]
    for i in range(limit):
        if best[i] == NEVER:
            continue
        for j, weight, id_ in vocabulary.arcs_from(text, i, len(text)):
            if best[i] + weight > best[j]:
                best[j], back[j] = best[i] + weight, (i, id_)
    return best, back


def _way_back(vocabulary: Vocabulary, text: str, back: list, node: int) -> tuple[int, list[int]]:
    """The state at the start of the best path to a node, and its ids."""
    ids: list[tuple[int, ...]] = []
    while back[node] is not None:
        i, id_ = back[node]
        ids.append((id_,) if id_ is not None else vocabulary.spelt(text[i]))
        node = i
    return node, list(chain.from_iterable(reversed(ids)))


def _inner_starts(before: str, body: str, text: str) -> list[int]:
    """Word starts within a chunk; its own start is one if a word begins there."""
    return [0] * (before not in ("", MARK) and body[:1] == MARK) + [s for s in word_starts(text) if s < len(body)]


def entries(vocabulary: Vocabulary, before: str, body: str, after: str, vector: list[int]) -> list[int]:
    """For each state at a chunk's end the state at its start on the best path there, -1 if there is none.

    All paths meet at the first word start, so that there the end does not matter.
    """
    text, states = body + after, vocabulary.longest
    starts = _inner_starts(before, body, text)
    if starts:
        head = text[: starts[0]]
        _, back = _from_entry(vocabulary, head, vector, len(head))
        return [_way_back(vocabulary, head, back, len(head))[0]] * states
    best, back = _from_entry(vocabulary, text, vector, len(body))
    ends = [len(body) + s for s in range(states)]
    return [_way_back(vocabulary, text, back, e)[0] if e < len(best) and best[e] != NEVER else -1 for e in ends]


def traced(vocabulary: Vocabulary, before: str, body: str, after: str, vector: list[int], leave: int) -> list[int]:
    """A chunk's ids on the best path, given the sums at its start and the state at its end."""
    text, m = body + after, len(body)
    starts = _inner_starts(before, body, text)
    if not starts:
        _, back = _from_entry(vocabulary, text, vector, m)
        return _way_back(vocabulary, text, back, m + leave)[1]
    head = text[: starts[0]]
    _, back = _from_entry(vocabulary, head, vector, len(head))
    ids = [_way_back(vocabulary, head, back, len(head))[1]]
    ids += [vocabulary.word(text[a:b])[1] for a, b in zip(starts, starts[1:], strict=False)]
    ids.append(vocabulary.path(text[starts[-1] : m + leave], m - starts[-1])[1])
    return list(chain.from_iterable(ids))


def leaves(maps: list[list[int]], leave: int = 0) -> list[int]:
    """The states at the ends of the chunks, from the maps of end states to start states, the last chunk's end first."""
    result = []
    for of_end in reversed(maps):
        result.append(leave)
        leave = of_end[leave]
    return result[::-1]


def _written(matrix: list[list[int]]) -> list[str]:
    return [str(x) for row in matrix for x in row]


def _read(values: Any) -> list[list[int]]:
    numbers = [int(x) for x in values]
    n = round(len(numbers) ** 0.5)
    return [numbers[i : i + n] for i in range(0, len(numbers), n)]


def _whole(shared: Any):
    """Texts of at most a chunk."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch, texts in text_batches(batches):
            found = vocabulary.ids([prepared(text) for text in texts])
            offsets = np.cumsum([0] + [len(x) for x in found])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), ids], ["row", "text", "ids"])

    return rows


_CHUNKS = "doc_id long, text_hash int, chunk int, before string, body string, after string"


def _cut(chunk: int, longest: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            for i, text in enumerate(texts):
                whole = prepared(text)
                edges = [*range(0, len(whole) - longest, chunk), len(whole)]
                columns: list[list] = [[], [], [], []]
                for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    for column, value in zip(columns, (n, whole[a - 1 : a] if a else "", whole[a:b], whole[b : b + longest - 1]), strict=True):
                        column.append(value)
                size = len(columns[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("doc_id")[i].as_py()] * size, pa.int64()),
                        pa.array([batch.column("text_hash")[i].as_py()] * size, pa.int32()),
                        pa.array(columns[0], pa.int32()),
                        *(pa.array(column, pa.string()) for column in columns[1:]),
                    ],
                    ["doc_id", "text_hash", "chunk", "before", "body", "after"],
                )

    return rows


def _giant(texts: DataFrame, vocabulary: Vocabulary, shared: Any, chunk: int) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``ids`` of texts longer than a chunk."""
    key = ["doc_id", "text_hash"]
    chunks = stored(
        texts.mapInArrow(_cut(chunk, vocabulary.longest), _CHUNKS)
        .dropDuplicates([*key, "chunk"])  # equal rows
        .withColumn("block", F.floor(F.col("chunk") / BLOCK).cast("int")),
        "chunks",
    )

    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [
                _written(transfer(shared.value, *row))
                for row in zip(frame["before"], frame["body"], frame["after"], strict=True)
            ]
            yield frame[[*key, "chunk", "block"]].assign(matrix=found)

    def product(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = [_read(m) for m in frame.sort_values("chunk")["matrix"]]
        total = ordered[0]
        for matrix in ordered[1:]:
            total = combined(total, matrix)
        return frame[[*key, "block"]].head(1).assign(matrix=[_written(total)])

    def block_vectors(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        first = [0] + [NEVER] * (vocabulary_states - 1)
        vectors = vectors_along([_read(m) for m in frame["matrix"]], first)[:-1]
        return frame[[*key, "block"]].assign(vector=[list(map(str, v)) for v in vectors])

    def chunk_vectors(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        vectors = vectors_along([_read(m) for m in frame["matrix"]], list(map(int, frame["vector"].iloc[0])))[:-1]
        return frame[[*key, "chunk"]].assign(vector=[list(map(str, v)) for v in vectors])

    def chunk_entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            columns = (frame[name] for name in ("before", "body", "after", "vector"))
            found = [entries(shared.value, b, t, a, list(map(int, v))) for b, t, a, v in zip(*columns, strict=True)]
            yield frame[[*key, "chunk"]].assign(of_end=found)

    def chunk_leaves(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        return frame[[*key, "chunk"]].assign(leave=leaves(frame["of_end"].tolist()))

    def back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            columns = (frame[name] for name in ("before", "body", "after", "vector", "leave"))
            found = [traced(shared.value, b, t, a, list(map(int, v)), e) for b, t, a, v, e in zip(*columns, strict=True)]
            yield frame[[*key, "chunk"]].assign(ids=found)

    keys, vocabulary_states = "doc_id long, text_hash int", vocabulary.longest
    by_chunk = stored(
        chunks.repartition(*key, "chunk").mapInPandas(matrices, f"{keys}, chunk int, block int, matrix array<string>"), "matrices"
    )
    by_block = by_chunk.groupBy(*key, "block").applyInPandas(product, f"{keys}, block int, matrix array<string>")
    of_blocks = by_block.groupBy(*key).applyInPandas(block_vectors, f"{keys}, block int, vector array<string>")
    vectors = (
        by_chunk.join(of_blocks, [*key, "block"])
        .groupBy(*key, "block")
        .applyInPandas(chunk_vectors, f"{keys}, chunk int, vector array<string>")
    )
    entered = stored(chunks.join(vectors, [*key, "chunk"]), "entered")
    of_ends = entered.repartition(*key, "chunk").mapInPandas(chunk_entries, f"{keys}, chunk int, of_end array<int>")
    # A few numbers for each chunk of a text.
    ends = of_ends.groupBy(*key).applyInPandas(chunk_leaves, f"{keys}, chunk int, leave int")
    ids = entered.join(ends, [*key, "chunk"]).mapInPandas(back, f"{keys}, chunk int, ids array<int>")
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "ids")))
    return ids.groupBy(*key).agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))


def _parts(docs: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of texts up to a chunk, and of longer ones if there are any: ``row`` (the other columns) and ``text``."""
    row = F.struct(*(c for c in docs.columns if c != "text")).alias("row")
    long = F.char_length(F.coalesce("text", F.lit(""))) >= chunk
    giant = docs.where(long)
    return docs.where(~long).select(row, "text"), None if giant.isEmpty() else giant.select(*row_key(), row, "text")


def _giant_rows(rows: DataFrame, vocabulary: Vocabulary, shared: Any, chunk: int) -> DataFrame:
    ids = _giant(rows.select("doc_id", "text_hash", "text"), vocabulary, shared, chunk)
    return rows.join(ids, ["doc_id", "text_hash"]).select("row", "text", "ids")


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, chunk: int = CHUNK) -> DataFrame:
    """``row`` (the document's columns but the text, as a struct), ``text`` and ``ids``.

    Null and empty texts have no ids. The vocabulary, of a fixed size, goes to every worker once. Where a text is cut makes no
    difference to its ids.
    """
    sized_for(docs)
    vocabulary = vocabulary or load_vocabulary()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    short, giant = _parts(docs, chunk)
    fields = [
        T.StructField("row", short.schema["row"].dataType),
        T.StructField("text", T.StringType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
    encoded = short.mapInArrow(_whole(shared), T.StructType(fields))
    return encoded if giant is None else encoded.unionByName(_giant_rows(giant, vocabulary, shared, chunk))


def _checked(shared: Any, encoded: bool):
    """``row``, ``ids`` and whether they spell the text; the ids are there already, or are found here."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch, texts in text_batches(batches):
            if encoded:
                ids = batch.column("ids")
                found = [x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32) for x in ids]
            else:
                found = vocabulary.ids([prepared(text) for text in texts])
                offsets = np.cumsum([0] + [len(x) for x in found])
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
            same = [spelt_by(x.tolist(), vocabulary.raw) == text for x, text in zip(found, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), ids, pa.array(same, pa.bool_())], ["row", "ids", "round_trip"])

    return rows


def encode_and_check(docs: DataFrame, vocabulary: Vocabulary | None = None, chunk: int = CHUNK) -> DataFrame:
    """``row``, ``ids`` and ``round_trip``: whether the ids decode to the text. One worker does all, and no text goes back."""
    sized_for(docs)
    vocabulary = vocabulary or load_vocabulary()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    short, giant = _parts(docs, chunk)
    fields = [
        T.StructField("row", short.schema["row"].dataType),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("round_trip", T.BooleanType()),
    ]
    checked = short.mapInArrow(_checked(shared, False), T.StructType(fields))
    if giant is None:
        return checked
    found = _giant_rows(giant, vocabulary, shared, chunk)
    return checked.unionByName(found.mapInArrow(_checked(shared, True), T.StructType(fields)))


def decode(encoded: DataFrame, vocabulary: Vocabulary | None = None, ids: str = "ids") -> DataFrame:
    """The frame with ``decoded``, the text that the ids spell."""
    sized_for(encoded)
    # Only the pieces' bytes: workers that decode need no tries and remember no words.
    shared = encoded.sparkSession.sparkContext.broadcast((vocabulary or load_vocabulary()).raw)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            texts = [spelt_by(x.values.to_numpy().tolist(), shared.value) if x.is_valid else b"" for x in column]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string(), safe=False)], [*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(rows, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def piece_digest(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: ``doc_id``, ``n_tokens``, ``ids_sha256`` (ids joined by commas) and ``round_trip``."""
    rows = encode_and_check(docs.select("doc_id", "text"), load_vocabulary(model))
    return rows.select(
        F.col("row")["doc_id"].alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "round_trip",
    )


def as_tokens(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: its columns but the text, and ``ids``, ``n_tokens`` and ``round_trip`` (decoding gives the text).

    These take the place of columns of their names.
    """
    rows = encode_and_check(docs, load_vocabulary(model))
    new = {"ids": F.col("ids"), "n_tokens": F.size("ids").cast("long"), "round_trip": F.col("round_trip")}
    own = [name for name in docs.columns if name not in ("text", *new)]
    return rows.select(*(F.col("row")[name].alias(name) for name in own), *(column.alias(name) for name, column in new.items()))
