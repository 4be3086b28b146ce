from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import brute
from orderloom.llm import components, line_dedup, near_dedup, substring_dedup
from tables import documents  # noqa: F401


def generated(seed, n, length=120):
    """Texts over few words, with copies, near copies, shared passages and odd cases."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(2, 5)))
    passage = " ".join(word() for _ in range(50))
    texts = []
    for i in range(n):
        text = " ".join(word() + r.choice(["", "", "", "\n"]) for _ in range(r.randint(1, length)))
        kind = i % 6
        if kind == 1:
            text = texts[r.randrange(len(texts))]
        elif kind == 2:
            own = texts[r.randrange(len(texts))].split(" ")
            own[r.randrange(len(own))] = word()
            text = " ".join(own)
        elif kind == 3:
            text = text + " " + passage + "\t" + text[:40]
        texts.append(text)
    return texts + ["", " \n ", "la " * 90, "ab\n" * 3 + "A line that is Long enough\n a line that is long enough "]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_brute_force(documents, seed):
    texts = generated(seed, 40)
    got = line_dedup.line_digest(documents(*enumerate(texts), (100, None)))
    wanted = brute.kept_lines(dict(enumerate(texts)) | {100: None})
    assert sorted(map(tuple, got.collect())) == sorted((d, n, gone, brute.sha(kept)) for d, (n, gone, kept) in wanted.items())


def test_lines_in_many_ranges(spark, documents):
    """One line in every document: its range is cut, and the first document is still found."""
    docs = documents(*((i, f"the line that all of them have\nown line number {i}") for i in range(300)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = line_dedup.line_digest(docs).agg(F.sum("n_dropped"), F.min_by("n_dropped", "doc_id")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tuple(got) == (299, 0)


def test_lines_of_repeated_rows_null_ids_and_extra_columns(spark):
    rows = [
        (3, "what a long line", 1, "x"),
        (3, "what a long line", 1, "x"),
        (None, "what a long line", 1, None),
        (None, "of no id at all\nshort", 2, "y"),
        (None, "of no id at all", 2, "y"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, position int, keep_bitmap string")
    result = line_dedup.deduplicate_lines(docs).select("row.doc_id", "row.keep_bitmap", "n_dropped", "kept")
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(
        [
            (3, "x", 0, "what a long line"),
            (3, "x", 0, "what a long line"),
            (None, None, 1, ""),
            (None, "y", 0, "of no id at all\nshort"),
            (None, "y", 0, "of no id at all"),
        ],
        key=repr,
    )


def test_stage_drops_emptied_documents_and_counts_characters(documents):
    docs = documents((1, "a line of éé words\nanother line here"), (2, "a line of éé words"), (3, "x\nANOTHER line here"), (4, None), (5, ""))
    got = line_dedup.without_repeated_lines(docs)
    assert got.columns == docs.columns
    assert [tuple(r) for r in got.select("doc_id", "text", "n_chars").orderBy("doc_id").collect()] == [
        (1, "a line of éé words\nanother line here", 36),
        (3, "x", 1),
        (4, None, 0),
        (5, "", 0),
    ]


@pytest.mark.parametrize("limit", [1000, 1])
@pytest.mark.parametrize("seed", [3, 4])
def test_passages_against_brute_force(documents, seed, limit, monkeypatch):
    plain = substring_dedup.repeated_spans
    monkeypatch.setattr(substring_dedup, "repeated_spans", lambda docs, window: plain(docs, window, group_limit=limit))
    texts = [*enumerate(generated(seed, 40)), (100, None)]
    got = substring_dedup.passage_digest(documents(*texts))
    wanted = [(d, n, gone, brute.sha(kept)) for d, n, gone, kept in brute.kept_words(texts)]
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
    assert sum(x[2] for x in wanted) > 500


def test_passages_of_repeated_rows_and_one_document(documents):
    long = " ".join(f"w{i}" for i in range(60))
    docs = documents((7, long), (7, long), (8, " ".join(f"v{i}" for i in range(40)) * 2), (None, "x " + long))
    got = substring_dedup.passage_digest(docs)
    assert sorted(map(tuple, got.drop("kept_sha256").collect()), key=repr) == sorted(
        [(7, 60, 60), (7, 60, 60), (8, 79, 76), (None, 61, 60)], key=repr
    )


@pytest.mark.parametrize(("seed", "n", "percent"), [(5, 3, 85), (6, 5, 80)])
def test_near_duplicates_against_brute_force(documents, seed, n, percent):
    texts = dict(enumerate(generated(seed, 60)))
    found = near_dedup.near_duplicates(documents(*texts.items(), (1000, None)), n, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    wanted = brute.components(texts | {1000: None}, n, percent)
    assert got == {d: (len(brute.shingles(texts.get(d), n)), c) for d, c in wanted.items()}
    assert sum(d != c for d, c in wanted.items()) > 10


def test_a_crowded_bucket_is_compared_in_blocks(documents, monkeypatch):
    """Texts of one family, of which only some are alike enough."""
    r = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for d in range(60):
        own = list(base)
        for _ in range(r.choice([1, 2, 3])):
            own[r.randrange(60)] = f"x{r.randrange(1000)}"
        texts[d] = " ".join(own)
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 2)
    monkeypatch.setattr(near_dedup, "CHUNK", 8)
    found = near_dedup.near_duplicates(documents(*texts.items()), 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == brute.components(texts, 3, 85)


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text, 1), (2, text + " more", 2), (9, "other words here", 3), (9, "other words here", 3), (None, text, 4), (None, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["component_id"] for r in kept.collect()) == [2, 3, 3, 4, 5]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "u long, v long"))
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(1, 41)] + [(101, 100)]


def test_empty_table(documents, spark):
    docs = documents()
    assert line_dedup.line_digest(docs).count() == 0
    assert substring_dedup.passage_digest(docs).count() == 0
    assert near_dedup.near_duplicate_digest(docs).count() == 0
    assert line_dedup.without_repeated_lines(docs).count() == near_dedup.one_of_each(docs).count() == 0
