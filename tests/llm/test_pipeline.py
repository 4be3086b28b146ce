from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest

import brute
from tables import documents  # noqa: F401
import corpus_pipeline
from orderloom.llm import pieces
from orderloom.llm.queries import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables are not here")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def other_engine():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@needs_tables
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_against_sql(spark, other_engine, name):
    got = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(got.columns)
    result = other_engine.execute(ORACLES[name])
    place = {column[0]: i for i, column in enumerate(result.description)}
    assert sorted(place) == columns
    wanted = Counter(tuple(row[place[c]] for c in columns) for row in result.fetchall())
    assert Counter(tuple(row) for row in got.select(*columns).collect()) == wanted


@needs_tables
@pytest.mark.skipif(not Path(pieces.MODEL).exists(), reason="no vocabulary here")
def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs}  # all have letters and a language
    lines = brute.kept_lines(texts)
    texts = {d: kept if gone else texts[d] for d, (_, gone, kept) in lines.items() if not gone or kept.strip()}
    near = brute.components(texts, 5, 80)
    texts = {d: t for d, t in texts.items() if near[d] == d}
    bad = brute.contaminated(texts, items)
    texts = {d: t for d, t in texts.items() if not bad[d][3]}
    got = corpus_pipeline.run(spark, str(SF_DIR))
    rows = {r["doc_id"]: r for r in got.collect()}
    assert set(rows) == set(texts)
    vocabulary = pieces.load_vocabulary()
    for d, text in texts.items():
        assert rows[d]["round_trip"]
        assert rows[d]["ids"] == list(vocabulary.path(pieces.prepared(text.encode()))[1])


def test_stages_keep_the_columns(spark, documents):
    tables = "/nowhere"
    docs = documents((1, "The words of a text here", "en", "s", 24), (2, "Other words of it", "en", "s", 17))
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, tables)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert docs.count() == 2
