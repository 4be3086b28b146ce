from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import brute
from tables import documents  # noqa: F401
from orderloom.llm import decontamination, fingerprints, licences, oracles, sharding


@pytest.mark.parametrize("sent", [decontamination.MOST_SENT, 0])
def test_contamination_against_brute_force(spark, documents, monkeypatch, sent):
    monkeypatch.setattr(decontamination, "MOST_SENT", sent)
    r = random.Random(1)
    word = lambda: r.choice(["the", "of", "Éa", "éa", "x1", "KEY"]) + r.choice(["", "n", "É"])
    items = [(i, " ".join(word() for _ in range(r.randint(1, 30)))) for i in range(12)]
    items += [(20, "the"), (21, ""), (22, None), (None, items[0][1]), (23, items[1][1].lower())]
    texts = {}
    for d in range(40):
        own = [word() for _ in range(r.randint(0, 60))]
        if d % 2:
            own[5:5] = items[d % 12][1].upper().split()[: r.randint(10, 30)]
        texts[d] = r.choice([" ", ", ", "\n"]).join(own)
    texts[99] = None
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {
        row["doc_id"]: (row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"], row["contaminated"])
        for row in decontamination.contamination_digest(documents(*texts.items()), table).collect()
    }
    wanted = brute.contaminated(texts, items)
    assert got == {d: (n, hit, len(ids), brute.sha(",".join(ids)), bad) for d, (n, hit, ids, bad) in wanted.items()}
    kept = decontamination.without_contaminated(documents(*texts.items()), table)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, x in wanted.items() if not x[3])


def test_only_positions_of_the_benchmark_are_kept(spark, documents):
    """A benchmark of many foreign items costs no position of the documents."""
    r = random.Random(3)
    item = lambda: " ".join(f"f{r.randrange(10**6)}" for _ in range(60))
    items = spark.createDataFrame([(i, item()) for i in range(2000)] + [(9999, "known words of one")], "item_id long, text string")
    docs = documents(*((d, " ".join(f"w{r.randrange(1000)}" for _ in range(200))) for d in range(100)), (100, "a known words of one b"))
    shingled = decontamination._shingled(decontamination._windows(items))
    spots = decontamination._spots(docs, shingled).select("doc_id", "position", "n_words").collect()
    assert [tuple(row) for row in spots] == [(100, 1, 6)]


@pytest.mark.parametrize("sent", [decontamination.MOST_SENT, 0])
def test_contamination_of_repeated_rows_and_empty_tables(spark, documents, monkeypatch, sent):
    monkeypatch.setattr(decontamination, "MOST_SENT", sent)
    passage = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, passage), (1, passage)], "item_id long, text string")
    docs = documents((4, passage), (4, passage), (None, "a " + passage), (4, "clean"))
    got = decontamination.contamination_digest(docs, items).select("doc_id", "n_words", "n_hit", "n_items")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(4, 20, 20, 1), (4, 20, 20, 1), (None, 21, 20, 1), (4, 1, 0, 0)], key=repr)
    assert decontamination.contamination_digest(documents(), items).count() == 0
    assert decontamination.contamination_digest(docs, items.limit(0)).where("contaminated").count() == 0


def test_fingerprints(documents):
    long = " ".join(f"w{i}" for i in range(2000))
    texts = {1: long, 2: long, 5: "éé ü", 7: None, 9: "", 11: " ".join(f"v{i}" for i in range(900)), 12: "one two three four five six"}
    got = {row["doc_id"]: row for row in fingerprints.fingerprint_digest(documents(*texts.items())).collect()}
    ordered = sorted(texts, reverse=True)
    for i, d in enumerate(ordered):
        text, following = texts[d] or "", texts[ordered[(i + 1) % len(ordered)]] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert got[d]["n_chars"] == len(text)
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[2]["near_next"] == 1.0
    assert abs(got[2]["near_edited"] - 2 / 3) < 0.1  # its next text is the same: a third of the shingles go, none come
    assert abs(got[11]["near_edited"] - 2 / 3) < 0.12  # the next text is empty
    assert got[7]["fingerprint"] == got[9]["fingerprint"] == "" and got[5]["fingerprint"]


def test_next_rows_across_blocks(documents, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_A_BLOCK", 7)
    docs = documents(*((i * i, f"text {i}") for i in range(100)), (None, "last"))
    got = {row["text"]: row["next_text"] for row in fingerprints.with_next(docs, ["text"]).collect()}
    order = [f"text {i}" for i in reversed(range(100))] + ["last"]
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_sketches_merge_and_contain(spark):
    a, b = " ".join(f"a{i}" for i in range(400)), " ".join(f"b{i}" for i in range(40))
    frame = spark.createDataFrame([(a, b)], "a string, b string")
    frame = fingerprints.with_sketch(fingerprints.with_sketch(frame, "a", "sa"), "b", "sb")
    row = frame.withColumn("m", fingerprints.merged(F.col("sa"), F.col("sb"))).select(
        fingerprints.containment("sa", "m"), fingerprints.containment("m", "sb"), fingerprints.likeness("sa", "sb"), F.size("sa")
    ).first()
    assert row[0] == 1.0 and row[1] < 0.5 and row[2] == 0.0 and 20 < row[3] < 90
    assert fingerprints.fingerprint_digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shards(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_A_CELL", 16)
    texts = [f"text {i}" for i in range(300)] + ["copy"] * 130 + [f"pair {i // 2}" for i in range(100)] + [None, ""]
    docs = documents(*enumerate(texts), (5, "text 5"), (None, "x"))
    rows = sharding.shard_documents(docs, 8).collect()
    assert len(rows) == len(texts) + 2
    counts, slots, shards_of = {}, {}, {}
    for row in rows:
        counts[row["shard"]] = counts.get(row["shard"], 0) + 1
        slots.setdefault(row["shard"], []).append(row["slot"])
        if row["doc_id"] is not None:
            shards_of.setdefault(texts[row["doc_id"]], set()).add(row["shard"])
            assert row["size"] == len((texts[row["doc_id"]] or "").encode()) + 16
    assert len(counts) == 8 and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(shards_of["copy"]) <= 4  # 130 rows need two shards of 67
    assert sum(len(s) - 1 for t, s in shards_of.items() if (t or "").startswith("pair")) <= 5
    assert sharding.shard_documents(documents(), 8).count() == 0
    assert sorted(r["shard"] for r in sharding.shard_documents(documents((1, "a"), (2, "a"), (3, "a")), 2).collect()) in ([0, 0, 1], [0, 1, 1])


def test_native_plans_have_no_python(spark, documents):
    docs = documents((1, "a b c d e f"), (2, "a b c d e f"))
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    for frame in (
        fingerprints.fingerprint_digest(docs),
        sharding.shard_documents(docs, 4),
        decontamination.contamination_digest(docs, items),
    ):
        plan = frame._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_licences(documents):
    docs = documents(
        (1, "Hello there, some words come first.\nLicensed under the Apache License, Version 2.0.\nand some more words of text"),
        (2, "RELEASED under the mit license"),
        (3, "no licence at all in this text"),
        (4, None),
        (5, ""),
        (6, "word"),
        (7, "this work is licensed under the gnu general public license version 2"),
    )
    got = {r["doc_id"]: (r["n_matched"], r["licence"], r["unit"]) for r in licences.licence_digest(docs).collect()}
    assert got[1][:2] == (1, "Apache-2.0") and got[1][2] == 2
    assert got[2] == (1, "MIT", 0)
    assert got[7][1] == "GPL-2.0"
    assert all(got[d] == (0, None, None) for d in (3, 4, 5, 6))
    assert licences.licence_digest(documents()).count() == 0
    assert "templates" in oracles.LICENCES


def test_size_bounds_lose_no_match():
    templates = licences.Templates(licences.TEMPLATES)
    r = random.Random(3)
    for _ in range(300):
        own = r.choice(list(licences.TEMPLATES.values())).split()
        for _ in range(r.randint(0, 8)):
            own.insert(r.randrange(len(own) + 1), "word")
        found = licences.bigrams(" ".join(own).encode())
        best = max(2 * len(found & licences.bigrams(t.encode())) / (len(found) + len(licences.bigrams(t.encode()))) for t in licences.TEMPLATES.values())
        got = templates.best(" ".join(own).encode(), 0.6)
        assert (got[0] if got else None) == (best if best >= 0.6 else None)


MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""


def test_licences_inside_documents(spark, documents):
    prose = " ".join(f"word{i}" for i in range(200))
    docs = documents(
        (1, f"{prose}\n{MIT_BODY}\n{prose}\nend"),
        (2, f"{prose} Released under the MIT License. {prose}"),
        (3, f"{prose}\n{prose}"),
        (4, f"Released under the MIT License.\n{prose} licensed under CC BY 4.0 {prose}"),
    )
    rows = {r["row"]["doc_id"]: r for r in licences.scan(docs, {"own": MIT_BODY, "other": "nothing of the kind here"}).collect()}
    assert rows[1]["matches"] == [] and rows[2]["spans"] == rows[3]["spans"] == []
    n = len(MIT_BODY.replace("/", " ").split())
    assert [tuple(s) for s in rows[1]["spans"]] == [(2, "own", 1.0, 200, n, True)]
    got = {r["doc_id"]: tuple(r)[1:] for r in licences.licence_digest(docs).collect()}
    assert got[2] == (1, "MIT", 1.0, 0) and got[3] == (0, None, None, None)
    assert got[4] == (2, "MIT", 1.0, 1)


def test_best_spans_against_all_windows():
    r = random.Random(4)
    for _ in range(300):
        template = " ".join(r.choice("abcdefgh") for _ in range(r.randint(3, 12)))
        words = [r.choice("abcdefghij") for _ in range(r.randint(2, 60))]
        if r.random() < 0.5:
            words[10:10] = template.split()
        size = len(licences.bigrams(template.encode()))
        best = None
        for i in range(len(words)):
            for j in range(i + 2, min(len(words), i + 1 + int((2 - 0.6) / 0.6 * size + 1e-9)) + 1):
                found = licences.bigrams(" ".join(words[i:j]).encode())
                dice = 2 * len(found & licences.bigrams(template.encode())) / (len(found) + size)
                if dice >= 0.6 and (best is None or dice > best[0]):
                    best = (dice, "t", i, j)
        got = licences.Templates({"t": template}).spans(" ".join(words).encode(), 0.6)
        assert got == ([best] if best else [])


def test_licence_texts_headers_and_tags(documents):
    alike, _ = licences.known()
    prose = "\n".join(f"some words of line {i}" for i in range(20))
    said = {
        "MIT": ["// SPDX-License-Identifier: MIT", "This project is licensed under the MIT License.", MIT_BODY + " " + alike["MIT"][-1][450:]],
        "GPL-3.0": ["Distributed under the terms of the GNU General Public License v3.", "SPDX-License-Identifier: GPL-3.0-or-later"],
        "GPL-2.0": [licences.HEADERS["GPL-2.0"]],
        "Apache-1.1": ["Licensed under the Apache License, Version 1.1."],
    }
    rows = [(name, text) for name, texts in said.items() for text in texts]
    rows += [(name, text) for name, texts in alike.items() for text in texts]
    rows += [(None, "SPDX-License-Identifier: MIT-0"), (None, "This project is licensed under the ISC License."), (None, prose)]
    docs = documents(*((i, text if i % 2 else f"{prose}\n{text}\n{prose}") for i, (_, text) in enumerate(rows)))
    got = {r["doc_id"]: r["licence"] for r in licences.licence_digest(docs).collect()}
    assert got == {i: name for i, (name, _) in enumerate(rows)}


def test_short_texts_are_like_their_edited_texts(documents):
    docs = documents(*((d, " ".join(f"d{d}w{i:02}" for i in range(30))) for d in range(100, 300)))
    found = [r["near_edited"] for r in fingerprints.fingerprint_digest(docs).collect()]
    assert min(found) > 0  # 15 or 16 of 26 shingles stay, and as many others come
    assert abs(sum(found) / len(found) - 0.44) < 0.05


def test_rows_of_one_id_are_cut_into_blocks(documents, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_A_BLOCK", 10)
    docs = documents(*((7, f"seven {i}") for i in range(150)), *((None, f"none {i}") for i in range(150)), *((i, f"text {i}") for i in range(100)))
    rows = docs.select("doc_id", "text", F.hash("text").alias("h")).collect()
    order = [r["text"] for r in sorted(rows, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))]
    got = {r["text"]: r["next_text"] for r in fingerprints.with_next(docs, ["text"]).collect()}
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))
    assert fingerprints._placed(docs).groupBy("_place.block").count().agg(F.max("count")).first()[0] < 40


def test_capital_sigma_before_separators(spark, documents):
    passage = "Α.Σ Β γ δ.Σ ε " + " ".join(f"w{i}.Σ" for i in range(20))
    items = spark.createDataFrame([(1, passage), (2, "Α.Σ Β")], "item_id long, text string")
    docs = documents((1, passage), (2, "one Α.Σ Β two"), (3, "α.σ β"))
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in decontamination.contamination_digest(docs, items).collect()}
    assert got == {1: (47, 2), 2: (3, 1), 3: (0, 0)}
