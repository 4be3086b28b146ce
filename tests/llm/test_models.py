from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom.llm import language, pieces, toxicity
from tables import documents  # noqa: F401

SAMPLES = Path("/root/testdata/sf0.01")


def simple_vocabulary():
    """Pieces over a and b, some of which overlap in every way, and bytes for all else."""
    mark = pieces.MARK
    names = ["a", "b", "ab", "ba", "aab", "bba", "abab", mark, mark + "a", mark + "ab", mark * 2]
    scores = [-3.0, -3.0, -4.0, -3.5, -4.5, -4.0, -6.0, -2.0, -3.2, -4.2, -2.5]
    usual = [(name, 300 + i, score) for i, (name, score) in enumerate(zip(names, scores, strict=True))]
    return pieces.Vocabulary(usual, list(range(256)), -20.0)


def best_score(vocabulary, text):
    """Over all ways to cut a short text."""
    if not text:
        return 0
    best = None
    for j in range(1, min(len(text), vocabulary.longest) + 1):
        arc = vocabulary.arcs.get(text[:j])
        weight = arc[1] if arc else vocabulary.unknown if j == 1 else None
        if weight is not None:
            rest = weight + best_score(vocabulary, text[j:])
            best = rest if best is None else max(best, rest)
    return best


def test_paths_are_best():
    vocabulary, r = simple_vocabulary(), random.Random(1)
    for _ in range(60):
        text = "".join(r.choice("aabbé" + pieces.MARK) for _ in range(r.randint(0, 9)))
        assert vocabulary.path(text)[0] == best_score(vocabulary, text)
        assert vocabulary.ids([text])[0].tolist() == list(vocabulary.path(text)[1])


@pytest.mark.parametrize("chunk", [7, 12, 40])
def test_chunks_give_the_path_of_the_whole(chunk):
    vocabulary, r = simple_vocabulary(), random.Random(chunk)
    for alphabet in ("ab", "ab ", "abé  \n"):
        for _ in range(25):
            text = pieces.prepared("".join(r.choice(alphabet) for _ in range(r.randint(20, 200))).encode())
            edges = [*range(0, len(text) - vocabulary.longest, chunk), len(text)]
            parts = [
                (text[a - 1 : a] if a else "", text[a:b], text[b : b + vocabulary.longest - 1])
                for a, b in zip(edges, edges[1:], strict=False)
            ]
            matrices = [pieces.transfer(vocabulary, *part) for part in parts]
            left = matrices[0]
            for matrix in matrices[1:]:
                left = pieces.combined(left, matrix)
            right = matrices[-1]
            for matrix in reversed(matrices[:-1]):
                right = pieces.combined(matrix, right)
            assert left[0][0] == right[0][0] == vocabulary.path(text)[0]
            vectors = pieces.vectors_along(matrices, [0] + [pieces.NEVER] * (vocabulary.longest - 1))[:-1]
            maps = [pieces.entries(vocabulary, *part, vector) for part, vector in zip(parts, vectors, strict=True)]
            ends = pieces.leaves(maps)
            ids = [
                i
                for part, vector, leave in zip(parts, vectors, ends, strict=True)
                for i in pieces.traced(vocabulary, *part, vector, leave)
            ]
            assert ids == list(vocabulary.path(text)[1])
            assert vocabulary.text(ids) == text.encode()[1:]
            weights = {id_: weight for id_, weight in vocabulary.arcs.values()}
            # Bytes come in runs of one unknown character each.
            unknown = sum(c not in vocabulary.arcs for c in text)
            assert sum(weights.get(i, 0) for i in ids) + unknown * vocabulary.unknown == left[0][0]


needs_model = pytest.mark.skipif(not Path(pieces.MODEL).exists(), reason="no vocabulary here")


@needs_model
def test_round_trip_of_short_and_giant_texts(spark, documents):
    r = random.Random(2)
    texts = {
        1: "Hello  world,\n\tschön ▁ 你好 🙂 ",
        2: "",
        3: None,
        4: " ",
        5: "".join(r.choice("abcdefgh é\n") for _ in range(5000)),
        6: "x" * 3000,
        7: " ".join("word" for _ in range(1500)),
    }
    docs = documents(*texts.items(), (7, texts[7]))
    vocabulary = pieces.load_vocabulary()
    rows = {}
    for chunk in (500, 1_000_000):
        result = pieces.decode(pieces.encode(docs, vocabulary, chunk), vocabulary).select("row.doc_id", "text", "ids", "decoded")
        found = result.collect()
        assert len(found) == 8
        assert all(row["decoded"] == (row["text"] or "") for row in found)
        rows[chunk] = {row["doc_id"]: row["ids"] for row in found}
    assert rows[500] == rows[1_000_000]
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert processor.decode(rows[500][5]) == texts[5]
    assert pieces.piece_digest(documents()).count() == 0


def chunked_ids(vocabulary, text, chunk):
    """The steps of giant texts one after the other."""
    edges = [*range(0, len(text) - vocabulary.longest, chunk), len(text)]
    parts = [
        (text[a - 1 : a] if a else "", text[a:b], text[b : b + vocabulary.longest - 1]) for a, b in zip(edges, edges[1:], strict=False)
    ]
    matrices = [pieces.transfer(vocabulary, *part) for part in parts]
    vectors = pieces.vectors_along(matrices, [0] + [pieces.NEVER] * (vocabulary.longest - 1))[:-1]
    maps = [pieces.entries(vocabulary, *part, vector) for part, vector in zip(parts, vectors, strict=True)]
    ends = pieces.leaves(maps)
    return [i for part, v, e in zip(parts, vectors, ends, strict=True) for i in pieces.traced(vocabulary, *part, v, e)]


@needs_model
@pytest.mark.parametrize("run", ["-", "x", "a", ".", "=", "ab"])
def test_runs_of_one_character_are_cut_without_a_difference(run):
    """Such runs have many paths of one score, which only the order of pieces tells apart."""
    vocabulary = pieces.load_vocabulary()
    for length in (1999, 2000, 2003):
        text = pieces.prepared((run * length)[:length].encode())
        wanted = vocabulary.ids([text])[0].tolist()
        for chunk in (500, 501, 502, 503, 504):
            assert chunked_ids(vocabulary, text, chunk) == wanted


@needs_model
def test_ids_do_not_hang_on_the_chunk(spark, documents):
    texts = {i: (run * 65_700)[:length] for i, (run, length) in enumerate(zip("-xa.", (65_530, 65_600, 65_645, 65_700), strict=True))}
    texts |= {9: None, 10: "", 11: "short"}
    docs = documents(*texts.items()).withColumnsRenamed({"lang": "ids", "source": "n_tokens"}).withColumn("round_trip", F.lit(7))
    vocabulary = pieces.load_vocabulary()
    found = pieces.as_tokens(docs)
    assert found.columns == ["doc_id", "n_chars", "ids", "n_tokens", "round_trip"]
    for row in found.collect():
        assert row["ids"] == vocabulary.ids([pieces.prepared((texts[row["doc_id"]] or "").encode())])[0].tolist()
        assert row["round_trip"] and row["n_tokens"] == len(row["ids"])
    assert all(len(word) <= pieces.KEPT for word in vocabulary.seen)


@needs_model
def test_units_are_parts_that_no_piece_joins():
    vocabulary, r = pieces.load_vocabulary(), random.Random(4)
    texts = [pieces.prepared("".join(r.choice("ab .,|$-'\n()1é%") for _ in range(120)).encode()) for _ in range(60)]
    for text, ids in zip(texts, vocabulary.ids(texts), strict=True):
        assert "".join(pieces.UNIT.findall(text)) == text
        assert ids.tolist() == list(vocabulary.path(text)[1])


def test_a_vocabulary_across_words_is_refused():
    with pytest.raises(ValueError):
        pieces.Vocabulary([("a" + pieces.MARK + "b", 300, -1.0)], list(range(256)), -20.0)


def test_language_profiles(documents):
    texts = [(i, "the cat and the dog sat with them") for i in range(6)]
    texts += [(i, "der hund und die katze sind nicht hier") for i in range(6, 12)]
    docs = documents(*((i, t, "en" if i < 6 else "de", "s", 0) for i, t in texts), (20, "x", None, "s", 1), (21, None, "fr", "s", 0))
    found = language.profiles(docs)
    assert set(found) == {"en", "de"}
    new = documents((1, "THE dog and cat"), (2, "die Katze und der Hund"), (3, "123 !?"), (4, None), (5, ""))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(new, found).select("row.doc_id", "lang_pred", "score").collect()}
    assert [got[i][0] for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= score <= 1 for _, score in got.values())
    assert language.with_known_language(docs).count() == 13 - (21 in [r["doc_id"] for r in docs.where("text is null").collect()])
    assert language.language_digest(documents()).count() == 0
    assert {r["lang_pred"] for r in language.identify(new, {}).collect()} == {"und"}


def test_distance_is_out_of_place():
    import numpy as np

    known = np.array([1, 2, 3, 4], np.uint64)
    places = np.array([[0, 3], [1, 2], [2, 1], [3, 300]])
    own = np.array([2, 1, 9], np.uint64)
    assert language.distances(own, known, places).tolist() == [1 + 1 + 300, 2 + 2 + 300]


def test_counts_of_grams():
    codes = language.code_points("A b1b".encode())
    assert "".join(map(chr, codes.tolist())) == " a b b "
    grams, counts = language.gram_counts(codes)
    assert dict(zip(grams.tolist(), counts.tolist(), strict=True))[ord("b")] == 2
    assert 32 not in grams.tolist()


@pytest.mark.skipif(not SAMPLES.exists(), reason="driver tables are not here")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SAMPLES}/{name}.parquet") for name in ("documents", "labels"))
    found = language.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95
    scored = toxicity.toxicity_digest(docs, labels).join(labels, "doc_id").groupBy("toxic").agg(F.avg("score").alias("s"))
    means = {r["toxic"]: r["s"] for r in scored.collect()}
    assert means[1] > means[0] + 0.3


def test_grammar_marks_negation_report_and_target():
    lexicon = toxicity.Lexicon({"idiot$": 3.0, "trash": 2.0})
    found = lambda text: [pattern for pattern, _ in toxicity.matched(text.split(), lexicon)]
    assert found("what an idiot") == ["I"]
    assert found("you idiot") == ["Ig"]
    assert found("he is not an idiot") == ["Ing"]
    assert found("not one of many many idiot") == ["I"]
    assert found("she said he was trashy") == ["Irg"]
    assert found("kill it") == ["T"]
    assert found("idiots there") == []
    assert toxicity.features(b"", lexicon).tolist() == [0.0] * toxicity.FEATURES


def test_toxicity_without_labels_and_with_odd_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents((1, "some text"), (2, None), (2, ""), (None, "x"))
    rows = toxicity.toxicity_digest(docs, none).collect()
    assert [r["score"] for r in rows] == [0.5] * 4
    assert toxicity.toxicity_digest(documents(), none).count() == 0
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_digest(docs, labels).count() == 4


def test_letterless_documents_go_without_any_language(documents):
    rows = [(1, "some words", None, "s", 10), (2, None, None, "s", 0), (3, "", None, "s", 0), (4, "12 + 3!", None, "s", 7), (5, "é1", None, "s", 2)]
    kept = language.with_known_language(documents(*rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 5]
    assert kept.columns == documents().columns
