"""Language by rank-order profiles: out-of-place distance between a text's most frequent n-grams and each language's.

N-grams are of one to three characters of the lower-cased text, in which every run of other characters than letters is
one blank. A profile is the list of the most frequent n-grams, most frequent first. The distance adds up how far each of
the text's n-grams is from its place in the language's profile, and the full length for those that the profile lacks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import sized_for, text_batches

LENGTHS = (1, 2, 3)
PROFILE = 300
SPREAD = 64  # parts in which a language's n-grams are ranked before its profile is put together
COUNTED = 500_000  # characters whose n-grams are counted at once
UNKNOWN = "und"
_BITS = 21  # of a code point


@cache
def _letters() -> np.ndarray:
    """Of every code point whether it is a letter; made once in each worker."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: bytes) -> np.ndarray:
    """The normalised text: letters, lower-cased, with one blank around and between them; empty without letters."""
    lowered = text.decode("utf-8", "replace").lower()
    codes = np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.uint64)
    codes = np.concatenate(([32], np.where(letter, codes, 32), [32])).astype(np.uint64)
    blank = codes == 32
    return codes[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of a normalised text as numbers, and their counts; blanks alone are none."""
    parts, packed = [], np.zeros(len(codes), np.uint64)
    for n in LENGTHS:
        if len(codes) < n:
            break
        packed = (packed[: len(codes) - n + 1] << np.uint64(_BITS)) | codes[n - 1 :]
        parts.append(packed)
    grams = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    grams, counts = np.unique(grams, return_counts=True)
    return grams[grams != 32], counts[grams != 32]


def ranked(grams: np.ndarray, counts: np.ndarray, length: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first; of equals the smaller number first."""
    if len(grams) > length:
        least = np.partition(counts, len(counts) - length)[len(counts) - length]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))[:length]]


def _by_language(langs: list[str], texts: list[bytes]) -> Iterator[tuple[str, list[np.ndarray]]]:
    """The normalised texts of each language, COUNTED characters or one text at a time."""
    waiting: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(langs, texts, strict=True):
        codes = code_points(text)
        waiting.setdefault(lang, []).append(codes)
        sizes[lang] = sizes.get(lang, 0) + len(codes)
        if sizes[lang] >= COUNTED:
            yield lang, waiting.pop(lang)
            sizes[lang] = 0
    yield from waiting.items()


def _training_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of each language's n-grams, for every slice of the input."""
    for batch, texts in text_batches(batches):
        for lang, codes in _by_language(batch.column("lang").to_pylist(), texts):
            # One blank between texts, so that no n-gram spans the letters of two.
            grams, counts = gram_counts(np.concatenate([*(c[:-1] for c in codes), np.full(1, 32, np.uint64)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts)],
                ["lang", "gram", "n"],
            )


def profiles(training: DataFrame, length: int = PROFILE) -> dict[str, np.ndarray]:
    """The profile of each ``lang`` of the rows, from all of them; rows without language or text are left out.

    What reaches the driver is ``length`` numbers a language.
    """
    sized_for(training)
    rows = training.where("lang is not null and text is not null").select("lang", "text")
    counts = rows.mapInArrow(_training_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Within parts first, so that no task ranks all n-grams of a language.
    part = F.pmod(F.xxhash64("gram"), F.lit(SPREAD))
    order = [F.desc("n"), "gram"]
    top = (
        counts.withColumn("part", part)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
        .where(F.col("rank") <= length)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= length)
    )
    found: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "rank", "gram").collect():
        found.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return {lang: np.array([g for _, g in sorted(places)], np.int64).view(np.uint64) for lang, places in sorted(found.items())}


def distances(own: np.ndarray, known: np.ndarray, places: np.ndarray, length: int = PROFILE) -> np.ndarray:
    """The out-of-place distance of a text's ranked n-grams to each language.

    ``known`` are the n-grams of all profiles, sorted, and ``places`` their rank in each (n-grams by languages).
    """
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    place = np.where((known[at] == own)[:, None], places[at], length)
    rank = np.arange(len(own))[:, None]
    return np.where(place == length, length, np.abs(place - rank)).sum(axis=0)


def _predicted(found: dict[str, np.ndarray], length: int, columns: list[str]):
    langs = list(found)
    known = np.unique(np.concatenate(list(found.values()))) if found else np.empty(0, np.uint64)
    places = np.full((len(known), len(langs)), length, np.int64)
    for i, profile in enumerate(found.values()):
        places[np.searchsorted(known, profile), i] = np.arange(len(profile))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            names, scores = [], []
            for text in texts:
                codes = code_points(text)
                if not len(codes) or not len(known):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                own = ranked(*gram_counts(codes), length)
                distance = distances(own, known, places, length)
                best = int(np.argmin(distance))  # of equals the first by name
                names.append(langs[best])
                scores.append(1.0 - float(distance[best]) / (length * len(own)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*columns, "lang_pred", "score"],
            )

    return rows


def identify(docs: DataFrame, found: dict[str, np.ndarray], length: int = PROFILE) -> DataFrame:
    """``row`` (the document's columns as a struct), ``lang_pred`` and ``score``.

    The score is 1 for n-grams all in their places and 0 for none known. A null text, one without letters and, if no
    language is known, any text is ``und`` with score 0. Of equally near languages the first by name is taken.
    """
    sized_for(docs)
    rows = docs.select("text", F.struct(*(c for c in docs.columns if c != "text")).alias("row"))
    fields = [
        T.StructField("row", rows.schema["row"].dataType),
        T.StructField("text", T.StringType()),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
    return rows.mapInArrow(_predicted(found, length, ["row", "text"]), T.StructType(fields))


def held_out(fold: int, of: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == fold


def language_digest(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``lang_pred`` and ``score``; learned from rows that are not held out.

    A row without id is held out.
    """
    out = F.coalesce(held_out(1, 3), F.lit(True))
    found = profiles(docs.select("doc_id", "text", "lang").where(~out))
    result = identify(docs.select("doc_id", "text"), found)
    doc_id = F.col("row")["doc_id"].alias("doc_id")
    return result.select(doc_id, "lang_pred", "score").select("doc_id", out.alias("held_out"), "lang_pred", "score")


def _lettered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose text has a letter."""
    for batch, texts in text_batches(batches):
        yield batch.filter(pa.array([len(code_points(text)) > 0 for text in texts], pa.bool_()))


def with_known_language(docs: DataFrame, least: float = 0.2) -> DataFrame:
    """The documents whose language is recognised: not ``und``, and with a score of ``least`` or more.

    Profiles are learned from the documents themselves and their ``lang``. If no row names a language, all documents with
    a letter stay.
    """
    found = profiles(docs.select("text", "lang"))
    if not found:
        return docs.mapInArrow(_lettered, docs.schema)
    result = identify(docs, found).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return result.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
