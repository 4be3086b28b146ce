"""Columns of a caller's that have the names of an operator's own, and files that come with the package."""

from __future__ import annotations

import os
import subprocess
import sys
import zipfile
from pathlib import Path

from tables import documents  # noqa: F401
from orderloom.llm import decontamination, fingerprints, licences, near_dedup


def with_columns(docs, *names):
    return docs.selectExpr("*", *(f"doc_id + {100 * (i + 1)} AS `{name}`" for i, name in enumerate(names)))


def test_near_duplicates_and_contamination_keep_such_columns(spark, documents):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = documents((1, passage), (2, passage), (3, "clean words here"), (4, ""))
    names = ("_gone_id", "_GONE_HASH", "own_gone_id")
    kept = near_dedup.one_of_each(with_columns(docs, *names))
    assert kept.columns == [*docs.columns, *names]
    assert sorted((r["doc_id"], r["_gone_id"], r["own_gone_id"]) for r in kept.collect()) == [(1, 101, 301), (3, 103, 303), (4, 104, 304)]
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    clean = decontamination.without_contaminated(with_columns(docs, *names), items)
    assert clean.columns == [*docs.columns, *names]
    assert sorted((r["doc_id"], r["_gone_id"], r["_GONE_HASH"]) for r in clean.collect()) == [(3, 103, 203), (4, 104, 204)]


def test_next_rows_keep_such_columns(documents):
    names = ("_order", "_hash", "_block", "_place", "_head", "_to")
    docs = with_columns(documents((1, "a"), (5, "b"), (9, "c")), *names)
    found = fingerprints.with_next(docs, ["text"])
    assert found.columns == [*docs.columns, "next_text"]
    assert sorted((r["doc_id"], r["_order"], r["_place"], r["next_text"]) for r in found.collect()) == [
        (1, 101, 401, "c"), (5, 105, 405, "a"), (9, 109, 409, "b"),
    ]


def test_licence_texts_are_found_in_an_archive(tmp_path):
    """As ``--py-files`` ships the package."""
    root = Path(licences.__file__).parents[2]
    archive = tmp_path / "package.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in (root / "orderloom").rglob("*"):
            if file.suffix in (".py", ".txt"):
                packed.write(file, file.relative_to(root))
    code = "from orderloom.llm import licences as x; print(x.__file__, sum(map(len, x.known()[0].values())))"
    told = subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYTHONPATH": str(archive)}, cwd=tmp_path, capture_output=True, text=True)
    assert ".zip" in told.stdout and int(told.stdout.split()[-1]) == sum(map(len, licences.known()[0].values()))
