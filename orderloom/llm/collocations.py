"""Phrases whose words keep together more than their numbers would have it.

A phrase scores by its weakest cut, 2000000 a / (l + r) with a its own count and l and r those of the two parts. A
longer phrase is never more frequent than its prefix p, and its first cut alone keeps it to 2000000 f(p) / (f(first
word) + f(p)): counts of prefixes bound the scores of all that grows from them. So the search goes best first. Words and word
pairs are counted whole; then a score is supposed for each language, only prefixes whose bound reaches it are grown (a pass
over the texts for each further word), and the supposed score is settled if as many phrases as asked for reach it and
survive. Where they do not, the next lower share of the frontier is grown.

Whether a phrase survives, that is, no longer one around it is nearly as frequent, needs its extensions by a single word
only, on either side, as longer ones are no more frequent than those in between.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import sized_for, stored, text_batches
from orderloom.llm.words import _hashes, grams, mix

LONGEST = 4
PORTION = 1 << 20  # prefixes that one pass over the texts grows; more of them take more passes
TALLY = 1 << 20  # distinct grams that a task holds before it hands them on
SHARE = 4  # the frontier supposed first, in multiples of the phrases asked for, and its growth

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK

_WORDS = "lang string, word string, w1 long, f long"
_RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


@dataclass
class Words:
    """The words of a batch: places in its bytes, hashes that tell languages apart, and the number of the piece of each."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    pieces: np.ndarray
    rows: np.ndarray

    def within(self, k: int) -> np.ndarray:
        """Whether the k words from each place on are of one piece."""
        last = len(self.pieces) - k + 1
        return self.pieces[:last] == self.pieces[k - 1 :] if last > 0 else np.zeros(0, bool)


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def batch_words(texts: list[bytes], langs: list[str]) -> Words:
    """A-Z lower-cased; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words at blanks and tabs as well."""
    data = b"\n".join(texts).lower()  # of bytes: ASCII only
    kind = _KIND[np.frombuffer(data, np.uint8)]
    gap = np.concatenate(([True], kind != _WORD, [True]))
    starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    pieces = np.cumsum(kind == _BREAK, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    offsets = np.cumsum([0] + [len(text) + 1 for text in texts])
    rows = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
    seeds = np.array([_seed(lang) for lang in langs], np.uint64)
    hashes = mix(_hashes(data, starts, ends) + seeds[rows]) if len(starts) else np.zeros(0, np.uint64)
    return Words(data, starts, ends, hashes, pieces, rows)


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    for batch, texts in text_batches(batches):
        langs = batch.column("lang").to_pylist()
        yield batch_words(texts, langs), langs


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct code, and the sum of its counts."""
    order = np.argsort(codes, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(codes[order]) != 0))) if len(codes) else np.zeros(0, int)
    return order[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _slices(words: Words, chosen: np.ndarray) -> pa.Array:
    """The chosen words as text."""
    sizes = words.ends[chosen] - words.starts[chosen]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    places = np.arange(offsets[-1]) + np.repeat(words.starts[chosen] - offsets[:-1], sizes)
    data = np.frombuffer(words.data, np.uint8)[places]
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(chosen), buffers)


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of a task with their counts, a portion at a time; the empty word stands for all words of a language."""
    held: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []
    total: dict[str, int] = {}

    def merged():
        codes = np.concatenate([h[0] for h in held])
        chosen, counts = _summed(codes, np.concatenate([h[1] for h in held]))
        at = pa.array(chosen)
        return codes[chosen], counts, *(pa.concat_arrays([h[i] for h in held]).take(at) for i in (2, 3))

    def given(codes, counts, texts, langs):
        arrays = [langs, texts.cast(pa.string()), pa.array(codes.view(np.int64)), pa.array(counts)]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "word", "w1", "f"])

    for words, langs in _batches(batches):
        for row, n in zip(*np.unique(words.rows, return_counts=True), strict=True):
            total[langs[row]] = total.get(langs[row], 0) + int(n)
        if not len(words.hashes):
            continue
        chosen, counts = _summed(words.hashes, np.ones(len(words.hashes), np.int64))
        of = pa.array(langs).take(pa.array(words.rows[chosen]))
        held.append((words.hashes[chosen], counts, _slices(words, chosen), of))
        if sum(len(h[0]) for h in held) > TALLY:
            held = [merged()]
            if len(held[0][0]) > TALLY // 2:
                yield given(*held.pop())
    if held:
        yield given(*merged())
    if total:
        zeros = np.zeros(len(total), np.uint64)
        yield given(zeros, np.array(list(total.values())), pa.array([b""] * len(total)), pa.array(list(total)))


class Filter:
    """A set of codes that may take others for its own (one in eight), but misses none."""

    def __init__(self, codes: np.ndarray):
        self.shift = np.uint64(64 - max(10, (8 * max(1, len(codes)) - 1).bit_length()))
        self.marks = np.zeros(1 << (64 - int(self.shift)), bool)
        self.marks[codes >> self.shift] = True

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        return self.marks[codes >> self.shift]


def _gram_columns(k: int) -> list[str]:
    return [f"w{i + 1}" for i in range(k)]


def _gram_counts(k: int, chooser: Callable[[], Callable[[Words], np.ndarray]]):
    """Counts of the k-grams at the places that the chooser names; it must name all places of a gram or none."""
    names = [*_gram_columns(k), "f"]

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choose, held = chooser(), []

        def merged():
            codes, counts, *columns = (np.concatenate(parts) for parts in zip(*held, strict=True))
            chosen, counts = _summed(codes, counts)
            return codes[chosen], counts, *(column[chosen] for column in columns)

        def given(_, counts, *columns):
            arrays = [*(pa.array(column.view(np.int64)) for column in columns), pa.array(counts)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for words, _ in _batches(batches):
            if len(words.hashes) < k:
                continue
            places = np.flatnonzero(words.within(k) & choose(words))
            codes = grams(words.hashes, k)[places]
            chosen, counts = _summed(codes, np.ones(len(codes), np.int64))
            held.append((codes[chosen], counts, *(words.hashes[places[chosen] + i] for i in range(k))))
            if sum(len(h[0]) for h in held) > TALLY:
                held = [merged()]
                if len(held[0][0]) > TALLY // 2:
                    yield given(*held.pop())
        if held:
            yield given(*merged())

    return counted


def _codes(rows: pa.Table, k: int) -> np.ndarray:
    """Codes of the k-grams in the first k columns, as ``grams`` has them."""
    columns = [rows.column(i).to_numpy().view(np.uint64) for i in range(k)]
    return grams(np.stack(columns, axis=1).ravel(), k)[::k] if rows.num_rows else np.zeros(0, np.uint64)


def _portions(grams_: DataFrame, k: int, *more: str) -> Iterator[tuple[int, int, pa.Table]]:
    """The k-grams in portions that a driver and every task can hold, whatever their number."""
    total = grams_.count()
    n = max(1, -(-total // (PORTION * 3 // 4)))
    part = F.pmod(F.col("w1") if k == 1 else F.xxhash64(*_gram_columns(k)), F.lit(n))
    for p in range(n if total else 0):
        yield n, p, grams_.where(part == p).select(*_gram_columns(k), *more).toArrow()


def _counted(docs: DataFrame, k: int, chooser, least: int, purpose: str) -> DataFrame:
    """Frequent k-grams among those that one pass counts."""
    columns = _gram_columns(k)
    schema = ", ".join(f"{name} long" for name in [*columns, "f"])
    rows = docs.mapInArrow(_gram_counts(k, chooser), schema)
    return stored(rows.groupBy(*columns).agg(F.sum("f").alias("f")).where(F.col("f") >= least), purpose)


def _union(frames: list[DataFrame]) -> DataFrame | None:
    """Passes count a gram whole or not at all, so what several of them have counted is the same."""
    if not frames:
        return None
    return stored(reduce(DataFrame.unionByName, frames).distinct(), "passes") if len(frames) > 1 else frames[0]


def _count_pairs(docs: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """All frequent pairs. Both words are frequent then; the second is only looked up if it is of the portion in hand."""
    passes = []
    for n, p, rows in _portions(words, 1):
        known = docs.sparkSession.sparkContext.broadcast(rows.column(0).to_numpy().view(np.uint64))

        def chooser(known=known, n=n, p=p):
            frequent = Filter(known.value)

            def choose(words: Words) -> np.ndarray:
                own = frequent(words.hashes)
                elsewhere = words.hashes.view(np.int64) % n != p
                return own[:-1] & (own | elsewhere)[1:]

            return choose

        passes.append(_counted(docs, 2, chooser, least, "pairs"))
    return _union(passes)


def _grown(docs: DataFrame, k: int, frontier: DataFrame, least: int) -> DataFrame | None:
    """Frequent k-grams that begin with a gram of the frontier, or end with one that is ``held``."""
    passes = []
    for _, _, rows in _portions(frontier, k - 1, "held"):
        codes = _codes(rows, k - 1)
        held = rows.column("held").to_numpy()
        sent = docs.sparkSession.sparkContext.broadcast((codes, codes[held]))

        def chooser(sent=sent):
            first, last = map(Filter, sent.value)

            def choose(words: Words) -> np.ndarray:
                shorter = grams(words.hashes, k - 1)
                return first(shorter[:-1]) | last(shorter[1:])

            return choose

        passes.append(_counted(docs, k, chooser, least, "grown"))
    return _union(passes)


def _counts_of(docs: DataFrame, k: int, wanted: DataFrame) -> DataFrame | None:
    """Counts of the wanted k-grams (and some others)."""
    passes = []
    for _, _, rows in _portions(wanted, k):
        sent = docs.sparkSession.sparkContext.broadcast(_codes(rows, k))

        def chooser(sent=sent):
            among = Filter(sent.value)
            return lambda words: among(grams(words.hashes, k))

        passes.append(_counted(docs, k, chooser, 1, "rest"))
    return _union(passes)


# Scores. All arithmetic is on whole numbers of up to 38 digits.


def _wide(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _cut(k: int, left: str = "l", right: str = "r") -> Column:
    """The score of a cut after k words, with what it is made of; the least of several is the phrase's."""
    score = F.call_function("div", _wide(F.col("a")) * F.lit(2_000_000).cast("decimal(7,0)"), _wide(F.col(left)) + _wide(F.col(right)))
    return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))


def _with_count(phrases: DataFrame, counts: DataFrame, first: int, last: int, name: str) -> DataFrame:
    """With the count of the words from ``first`` to ``last`` (from 1), or null."""
    part = [f"w{i}" for i in range(first, last + 1)]
    renamed = counts.select(*(F.col(f"w{i + 1}").alias(p) for i, p in enumerate(part)), F.col("f").alias(name))
    return phrases.join(renamed, part, "left")


def _scored(k: int, grams_: DataFrame, shorter: dict[int, DataFrame]) -> DataFrame:
    """Frequent k-grams with the count of every part; parts that were not counted are null."""
    phrases = grams_.withColumnRenamed("f", "a")
    for cut in range(1, k):
        phrases = _with_count(phrases, shorter[cut], 1, cut, f"l{cut}")
        phrases = _with_count(phrases, shorter[k - cut], cut + 1, k, f"r{cut}")
    return phrases


def _weakest(k: int) -> Column:
    return F.array_min(F.array(*(_cut(cut, f"l{cut}", f"r{cut}") for cut in range(1, k))))


def _bound() -> Column:
    """No phrase that grows from this one scores more."""
    return F.call_function("div", _wide(F.col("a")) * F.lit(2_000_000).cast("decimal(7,0)"), _wide(F.col("l1")) + _wide(F.col("a")))


def _finished(k: int, scored: DataFrame, langs: DataFrame) -> DataFrame:
    """Scored phrases of length k with language, score and bound, stored."""
    rows = scored.withColumns({"weakest": _weakest(k), "bound": _bound()})
    rows = rows.join(langs, "w1")
    columns = [*_gram_columns(k), "lang", "a", "weakest.l", "weakest.r", "weakest.score", "bound"]
    return stored(rows.select(*columns), f"scored-{k}")


def _survivors(k: int, phrases: DataFrame, longer: DataFrame | None, percent: int) -> DataFrame:
    """Those around which no phrase of one word more is nearly as frequent."""
    if longer is None:
        return phrases
    columns = _gram_columns(k)
    around = longer.select(*columns, "f").unionByName(
        longer.select(*(F.col(f"w{i + 2}").alias(name) for i, name in enumerate(columns)), "f")
    )
    most = around.groupBy(*columns).agg(F.max("f").alias("around"))
    kept = F.col("around").isNull() | (_wide(F.col("around")) * 100 < _wide(F.col("a")) * percent)
    return phrases.join(most, columns, "left").where(kept).drop("around")


def _supposed(two: DataFrame, rank: int) -> DataFrame:
    """For each language the score that so many pairs reach, ties included, or 0 if there are fewer."""
    best_first = Window.partitionBy("lang").orderBy(F.desc("score"))
    top = two.select("lang", "score", F.row_number().over(best_first).alias("place")).where(F.col("place") <= rank)
    reached = top.groupBy("lang").agg(F.max("place").alias("places"), F.min("score").alias("lowest"))
    return stored(reached.select("lang", F.when(F.col("places") < rank, 0).otherwise(F.col("lowest")).alias("supposed")), "supposed")


def _frontier(k: int, phrases: DataFrame, supposed: DataFrame) -> DataFrame:
    """Phrases from which others may grow that reach the supposed score; ``held`` are those that reach it themselves."""
    reaching = phrases.join(supposed, "lang").where(F.col("bound") >= F.col("supposed"))
    return stored(reaching.select(*_gram_columns(k), (F.col("score") >= F.col("supposed")).alias("held")), f"frontier-{k}")


def _scored_fours(texts: DataFrame, four: DataFrame, shorter: dict[int, DataFrame], langs: DataFrame, supposed: DataFrame) -> DataFrame:
    """Four-word phrases that may reach the supposed score.

    If their first three words were not grown, they do not. Their last three may not have been; they are counted where the
    other two cuts reach the score.
    """
    rows = _scored(4, four, shorter).join(langs, "w1").join(supposed, "lang").where(F.col("l3").isNotNull())
    others = F.least(*(_cut(cut, f"l{cut}", f"r{cut}")["score"] for cut in (2, 3)))
    rows = stored(rows.where(others >= F.col("supposed")).drop("lang", "supposed"), "fours")
    ends = rows.where("r1 IS NULL").select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("w4").alias("w3")).distinct()
    counts = _counts_of(texts, 3, stored(ends, "ends"))
    if counts is not None:
        rows = _with_count(rows, counts, 2, 4, "late").withColumn("r1", F.coalesce("r1", "late")).drop("late")
    return _finished(4, rows, langs)


def _settled(texts: DataFrame, two: DataFrame, shorter: dict[int, DataFrame], langs: DataFrame, supposed: DataFrame, least: int, percent: int) -> DataFrame:
    """All surviving phrases that reach the score supposed for their language."""
    three = _grown(texts, 3, _frontier(2, two, supposed), least)
    four, found = None, []
    if three is not None:
        of_three = _finished(3, _scored(3, three, shorter), langs)
        four = _grown(texts, 4, _frontier(3, of_three, supposed), least)
        found.append(_survivors(3, of_three, four, percent))
    if four is not None:
        found.append(_scored_fours(texts, four, {**shorter, 3: three}, langs, supposed))
    found.append(_survivors(2, two, three, percent))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    reaching = every.join(supposed, "lang").where(F.col("score") >= F.col("supposed"))
    for column in set(_gram_columns(LONGEST)) - set(reaching.columns):
        reaching = reaching.withColumn(column, F.lit(None).cast("long"))
    return stored(reaching.select(*_gram_columns(LONGEST), "lang", "a", "l", "r", "score", "supposed"), "reaching")


def mine(docs: DataFrame, keep: int = 2000, least: int = 30, percent: int = 80) -> DataFrame:
    """The best phrases of two to four words of each language.

    ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n`` (words of the language) and ``score``, for phrases
    found ``least`` times or more and not within a longer one that has ``percent`` of their count. A null language is
    ``und``; null and empty texts have no words, repeated rows count each, other columns take no part, and an empty table
    or one without a frequent phrase gives no rows. Ties of score go by count and then by the phrase's bytes. Words are told
    apart by hashes of 64 bits in passes over the texts, and by themselves where they are counted and given out.
    """
    sized_for(docs)
    texts = docs.select(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang")
    )
    counted = texts.mapInArrow(_word_counts, _WORDS).groupBy("lang", "word", "w1").agg(F.sum("f").alias("f"))
    frequent = stored(counted.where((F.col("f") >= least) | (F.col("word") == "")), "words")
    n_words = frequent.where("word = ''").select("lang", F.col("f").alias("n"))
    words = frequent.where((F.col("word") != "") & (F.col("f") >= least))
    ones, langs = words.select("w1", "f"), words.select("w1", "lang")

    pairs = _count_pairs(texts, ones, least)
    if pairs is None:
        return docs.sparkSession.createDataFrame([], _RESULT)
    two = _finished(2, _scored(2, pairs, {1: ones}), langs)

    done, share = [], SHARE
    while True:
        supposed = _supposed(two, keep * share)
        reaching = _settled(texts, two, {1: ones, 2: pairs}, langs, supposed, least, percent)
        many = reaching.groupBy("lang").agg(F.count(F.lit(1)).alias("many"))
        state = supposed.join(many, "lang", "left")
        enough = (F.col("supposed") == 0) | (F.coalesce("many", F.lit(0)) >= keep)
        done.append(reaching.join(state.where(enough).select("lang"), "lang", "left_semi"))
        unsettled = stored(state.where(~enough).select("lang"), "unsettled")
        if unsettled.isEmpty():
            break
        two = stored(two.join(unsettled, "lang", "left_semi"), "pairs")
        share *= SHARE
    return _ranked(reduce(DataFrame.unionByName, done), words, n_words, keep)


def _ranked(best: DataFrame, words: DataFrame, n_words: DataFrame, keep: int) -> DataFrame:
    for i in range(1, LONGEST + 1):
        named = words.select(F.col("w1").alias(f"w{i}"), F.col("word").alias(f"word{i}"))
        best = best.join(named, f"w{i}", "left")
    phrases = best.withColumn("phrase", F.concat_ws(" ", *(f"word{i}" for i in range(1, LONGEST + 1))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    top = phrases.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= keep)
    return top.join(n_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
