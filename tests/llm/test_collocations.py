from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import brute
from tables import documents  # noqa: F401
from orderloom.llm import collocations


def best_phrases(rows, keep, least, percent=80):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.ascii_lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    result = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = set()
        for longer, b in candidates.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    if 100 * b >= percent * candidates[longer[i : i + k]]:
                        gone.add(longer[i : i + k])
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:keep], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def mined(docs, *options):
    return sorted(tuple(row) for row in collocations.mine(docs, *options).collect())


def prose(r, n_words):
    """Words of uneven frequency, some of which like to follow each other."""
    words, after = [], {f"w{i}": f"w{(i * 7) % 40}" for i in range(40)}
    for _ in range(n_words):
        if words and r.random() < 0.5:
            words.append(after[words[-1].lower()])
        else:
            words.append(f"w{min(int(r.expovariate(0.15)), 39)}")
        if r.random() < 0.1:
            words[-1] = words[-1].upper()
    return "".join(w + r.choice([" "] * 12 + ["\t", "  ", ", ", ".", "\n", " ; "]) for w in words)


def test_against_brute_force(spark, documents):
    r = random.Random(5)
    rows = [(d, prose(r, r.randint(0, 400)), r.choice(["en", "fr", None, "und"]), "s", 0) for d in range(60)]
    for keep, least in ((2000, 3), (20, 3), (5, 10), (1, 2)):
        wanted = best_phrases([(row[2], row[1]) for row in rows], keep, least)
        assert wanted and mined(documents(*rows), keep, least) == wanted


def crowded(n_texts):
    """Runs of one phrase: all pairs in it score best and none survives, so a small first frontier does not settle."""
    r = random.Random(6)
    runs = [" ".join(f"p{i}x{j}" for j in range(4)) for i in range(15)]
    return [(d, prose(r, 60) + ". " + ". ".join(runs), "en", "s", 0) for d in range(n_texts)]


def test_frontier_grows_until_settled(spark, documents, monkeypatch):
    rows = crowded(8)
    monkeypatch.setattr(collocations, "SHARE", 2)
    first = collocations._supposed
    ranks = []
    monkeypatch.setattr(collocations, "_supposed", lambda two, rank: ranks.append(rank) or first(two, rank))
    assert mined(documents(*rows), 18, 5) == best_phrases([(row[2], row[1]) for row in rows], 18, 5)
    assert ranks == [36, 72]


def test_passes_in_portions(spark, documents, monkeypatch):
    rows = crowded(6)
    monkeypatch.setattr(collocations, "PORTION", 60)
    monkeypatch.setattr(collocations, "TALLY", 50)
    assert mined(documents(*rows), 2000, 5) == best_phrases([(row[2], row[1]) for row in rows], 2000, 5)


def test_ties_repeats_and_odd_rows(spark, documents):
    same = (7, "Alpha beta, gamma delta alpha beta", "en", "s", 0)
    rows = [same, same, same, (None, None, None, None, None), (8, "", "en", "s", 0), (9, " . ,\n\t", "fr", "s", 0)]
    got = mined(documents(*rows).withColumnsRenamed({"source": "phrase", "n_chars": "w1"}), 10, 2)
    assert got == best_phrases([(row[2], row[1]) for row in rows], 10, 2)
    assert [row[2] for row in got] == ["alpha beta", "gamma delta alpha beta"]
    assert mined(documents(), 10, 2) == [] and mined(documents((1, "one two")), 10, 30) == []
    long = "x" * 5_000_000 + " " + "a b c " * 400_000
    assert mined(documents((1, long)), 3, 30) == best_phrases([("en", long)], 3, 30)


def test_exact_beyond_64_bits(spark):
    rows = spark.range(1).selectExpr("9000000000000000000 AS a", "9100000000000000000 AS l", "9000000000000000001 AS r")
    assert rows.select(collocations._cut(1)["score"]).first()[0] == 2_000_000 * 9 * 10**18 // (18_100_000_000_000_000_001)


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_filter_misses_nothing(n):
    codes = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64)
    others = np.random.default_rng(n + 1).integers(0, 2**64, 100_000, dtype=np.uint64)
    among = collocations.Filter(codes)
    assert among(codes).all() and among(others).mean() < 0.2
