"""Toxicity by a weighted finite-state pattern grammar.

Words of a clause become symbols: insults, threats, targets, negations, reporting words, others. The symbols run through
a cascade of transducers, which were composed into one: negation marks the insults and threats in its scope, reported
speech those of its clause, and the target transducer those that are aimed at somebody. What comes out of a clause are
matched patterns. Insults are learned: words, and beginnings of words, that toxic training texts have much more often
than others; how much each pattern counts is learned too, each half of the texts being read with the words of the other.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import sized_for, stored, text_batches
from orderloom.llm.language import held_out

SAMPLE = 20_000  # labelled rows that the grammar is fitted to at most, about
LEXICON = 20_000  # learned words and beginnings at most, which go to the driver
STEMS = (4, 5, 6, 7)
LEAST_WEIGHT = 1.0
CAUTION = 1.5  # standard errors that a word's log odds are lowered by
SCOPE = 3  # words that a negation reaches
CACHED = 200_000

# Closed word classes of the grammar, in the languages of the texts.
THREATS = frozenset("kill hurt punch shoot stab burn destroy die töten schlagen tuer frapper matar golpear".split())
TARGETS = frozenset(
    "you your yours yourself he him she her they them people du dich dir ihr sie euch tu te toi vous il elle ils tú usted ustedes ella ellos".split()
)
NEGATIONS = frozenset("not never no neither nor nicht kein keine nie pas jamais ni nunca jamás tampoco".split())
REPORTS = frozenset(
    "said says told claimed claims wrote quoted reported allegedly sagte sagt schrieb dit disait écrit dijo dice escribió".split()
)

CLAUSES = re.compile(r"[.!?;:\n]+")
LETTERS = re.compile(r"[^\W\d_]+")
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END = "ITGNRoE"


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer: a start state, and a step from state and symbol to state and output symbol."""

    start: object
    step: Callable[[object, str], tuple[object, str]]


def composed(first: Transducer, second: Transducer) -> Transducer:
    """What the first puts out is what the second reads. Steps are found once for each pair of states."""
    known: dict[tuple[object, str], tuple[object, str]] = {}

    def step(state, symbol):
        found = known.get((state, symbol))
        if found is None:
            a, middle = first.step(state[0], symbol)
            b, out = second.step(state[1], middle)
            known[state, symbol] = found = ((a, b), out)
        return found

    return Transducer((first.start, second.start), step)


def _negate(left: int, symbol: str) -> tuple[int, str]:
    """State: words that the negation still reaches."""
    if symbol[0] == NEGATION:
        return SCOPE, symbol
    if left and symbol[0] in (INSULT, THREAT):
        return left - 1, symbol + "n"
    return max(0, left - 1), symbol


def _report(reported: bool, symbol: str) -> tuple[bool, str]:
    """State: whether the clause has had a reporting word."""
    if symbol[0] == REPORT:
        return True, symbol
    return reported, symbol + "r" if reported and symbol[0] in (INSULT, THREAT) else symbol


def _aim(aimed: bool, symbol: str) -> tuple[bool, str]:
    """State: whether the clause has had a target."""
    if symbol[0] == TARGET:
        return True, symbol
    return aimed, symbol + "g" if aimed and symbol[0] in (INSULT, THREAT) else symbol


GRAMMAR = composed(composed(Transducer(0, _negate), Transducer(False, _report)), Transducer(False, _aim))
PATTERNS = [kind + n + r + g for kind in (INSULT, THREAT) for n in ("", "n") for r in ("", "r") for g in ("", "g")]
_PLACE = {pattern: i for i, pattern in enumerate(PATTERNS)}
FEATURES = 2 * len(PATTERNS) + 2  # clauses and weight of each pattern, the greatest weight of an arc, the text's length


def forms(word: str) -> list[str]:
    """A word as the lexicon may have it: whole, and its beginnings."""
    return [word + "$", *(word[:n] for n in STEMS if len(word) > n)]


class Lexicon:
    """Symbol and weight of words, with a bounded memory of words seen."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.known = weights, {}

    def __reduce__(self):
        return Lexicon, (self.weights,)

    def of(self, word: str) -> tuple[str, float]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            self.known[word] = found = self._look_up(word)
        return found

    def _look_up(self, word: str) -> tuple[str, float]:
        weight = max((self.weights.get(form, 0.0) for form in forms(word)), default=0.0)
        if weight > 0:
            return INSULT, weight
        for symbol, words in ((THREAT, THREATS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (TARGET, TARGETS)):
            if word in words:
                return symbol, 1.0
        return OTHER, 0.0


def matched(clause: list[str], lexicon: Lexicon) -> list[tuple[str, float]]:
    """The patterns that a clause's words match, with the weights of their arcs."""
    state, found = GRAMMAR.start, []
    for word in clause:
        symbol, weight = lexicon.of(word)
        state, out = GRAMMAR.step(state, symbol)
        if out[0] in (INSULT, THREAT):
            found.append((out, weight))
    return found


def features(text: bytes, lexicon: Lexicon) -> np.ndarray:
    values = np.zeros(FEATURES)
    lowered = text.decode("utf-8", "replace").lower()
    words = LETTERS.findall(lowered)
    values[-1] = math.log1p(len(words))
    if not any(lexicon.of(word)[0] in (INSULT, THREAT) for word in set(words)):
        return values
    greatest = 0.0
    for clause in CLAUSES.split(lowered):
        patterns = matched(LETTERS.findall(clause), lexicon)
        for pattern in {pattern for pattern, _ in patterns}:
            values[2 * _PLACE[pattern]] += 1
        for pattern, weight in patterns:
            values[2 * _PLACE[pattern] + 1] += weight
            greatest = max(greatest, weight if pattern[0] == INSULT else 0.0)
    values[: 2 * len(PATTERNS)] = np.log1p(values[: 2 * len(PATTERNS)])
    values[-2] = greatest
    return values


def _form_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_batches(batches):
        toxic, clean = Counter(), Counter()
        for label, text in zip(batch.column("toxic").to_pylist(), texts, strict=True):
            words = set(LETTERS.findall(text.decode("utf-8", "replace").lower()))
            (toxic if label else clean).update({form for word in words for form in forms(word)})
        names = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([toxic[name] for name in names], pa.int64()),
                pa.array([clean[name] for name in names], pa.int64()),
            ],
            ["form", "n_toxic", "n_clean"],
        )


def learn_lexicon(training: DataFrame) -> Lexicon:
    """From ``text`` and ``toxic`` (0 or 1): the forms whose cautious log odds reach LEAST_WEIGHT."""
    totals = training.agg(
        F.sum(F.col("toxic")).alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    ).first()
    odds = math.log(((totals["clean"] or 0) + 1) / ((totals["toxic"] or 0) + 1))
    t, c = F.col("n_toxic") + 0.5, F.col("n_clean") + 0.5
    weight = F.log(t / c) + odds - CAUTION * F.sqrt(1 / t + 1 / c)
    rows = (
        training.select("text", "toxic")
        .mapInArrow(_form_counts, "form string, n_toxic long, n_clean long")
        .groupBy("form")
        .agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
        .select("form", weight.alias("weight"))
        .where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc("weight"), "form")
        .limit(LEXICON)
        .collect()
    )
    return Lexicon({row["form"]: row["weight"] for row in rows})


def _feature_rows(lexicon: Lexicon):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            values = [features(text, lexicon) for text in texts]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([v.tolist() for v in values])], ["toxic", "x"])

    return rows


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # of the features, and the constant

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x = np.array([features(text, self.lexicon) for text in texts]).reshape(-1, FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fitted_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method, with a ridge on all but the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        change = np.linalg.solve(curve, slope)
        weights -= change
        if np.abs(change).max() < 1e-8:
            break
    return weights


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit the grammar to ``toxic`` (0 or 1) of the labelled documents, or to a sample of about ``sample`` of them.

    Labels without id or without ``toxic`` are left out. Without any label every score is 0.5.
    """
    sized_for(docs)
    known = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("long").alias("toxic"))
    total = known.count()
    lot = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    chosen = known.where(lot < int((1 << 30) * min(1.0, sample / max(total, 1))))
    # The broadcast side has about ``sample`` rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.distinct()), "doc_id").where("text is not null")
    # A text with many copies counts once.
    fold = F.pmod(F.xxhash64("text", F.lit(13)), F.lit(2)).alias("fold")
    rows = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = stored(rows.select("text", "toxic", fold), "training")
    # What the patterns count for is learned from texts that their words weren't learned from.
    found = []
    for own in (0, 1):
        other = learn_lexicon(rows.where(F.col("fold") != own))
        found += rows.where(F.col("fold") == own).mapInArrow(_feature_rows(other), "toxic long, x array<double>").collect()
    lexicon = learn_lexicon(rows)
    if not found:
        return Model(lexicon, np.zeros(FEATURES + 1))
    x, y = np.array([row["x"] for row in found]), np.array([row["toxic"] for row in found], float)
    return Model(lexicon, fitted_weights(x, y))


def _scored(model: Model):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            scores = model.scores(texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return rows


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row; null and empty texts match nothing."""
    sized_for(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scored(model), "doc_id long, score double")


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``score`` and ``predicted``; rows without id are held out."""
    out = F.coalesce(held_out(0, 5), F.lit(True))
    model = learn(docs, labels.select("doc_id", "toxic").where(~out))
    return score(docs, model).select(
        "doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
