from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from tables import documents  # noqa: F401
from orderloom.llm import token_files

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")
PATH = token_files.public_tokenizer()
pytestmark = pytest.mark.skipif(not Path(PATH).exists(), reason="no vocabulary here")


@pytest.fixture(scope="module")
def plain():
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def wanted(docs, plain):
    """Rows in order of their ids, nulls last; the order of rows of one id is open."""
    result, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        ids = [*plain(text), 2]
        result.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return result


def in_order(frame):
    return sorted((tuple(row) for row in frame.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


PARTS = ["a", "the", "Word", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!?", "'s", "'", "é", "×", "ü", "1", "23", "中", "😀", "\r\n"]
PARTS += ["\x85", "\xa0", "\x1c", "\x00", "<|endoftext|>", " don't", "É", "́", " ", "_", "'t", "'ll", " x", "x" * 30]


def test_pieces_give_the_ids_of_whole_texts(plain):
    r = random.Random(2)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(40))) for _ in range(3000)]
    own = token_files.Encoder(PATH)
    assert own.by_pieces
    for i in range(0, len(texts), 100):  # small batches, so that most pieces come from memory
        got = own.batch([text.encode() for text in texts[i : i + 100]])
        assert [ids.tolist() for ids in got] == [plain(text) for text in texts[i : i + 100]]


def test_chunks_of_long_texts(plain, monkeypatch):
    r = random.Random(3)
    monkeypatch.setattr(token_files, "CHUNK", 50)
    own = token_files.Encoder(PATH)
    mixed = "".join(r.choice(PARTS) for _ in range(800))
    for text in [mixed, mixed.replace("<|endoftext|>", ""), "x" * 700, " " * 700, "a b " * 300]:
        assert own.encode(text.encode()).tolist() == plain(text)


def test_other_tokenizers_encode_whole_texts():
    path = token_files.public_tokenizer("word_bpe_49k.json")
    own, tokenizer = token_files.Encoder(path), tokenizers.Tokenizer.from_file(path)
    assert not own.by_pieces
    assert own.encode("The  quick fox.".encode()).tolist() == tokenizer.encode("The  quick fox.", add_special_tokens=False).ids


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 50, rng.integers(1, 9)) for _ in range(40)]
    for ids in (
        np.concatenate([words[i] for i in np.minimum(rng.geometric(0.1, 5000), 40) - 1]),
        np.zeros(1000, int), np.array([3]), np.array([], int), np.arange(500), np.tile([1, 2, 1], 999),
    ):
        grammar = token_files.compress(ids.astype(np.uint32), 50 if len(ids) and ids.max() < 50 else 500)
        assert grammar.expanded(grammar.symbols).tolist() == ids.tolist()
        assert len(grammar.symbols) <= len(ids) and grammar.sizes(grammar.symbols).sum() == len(ids)
        for _ in range(50):
            a, b = sorted(rng.integers(0, len(ids) + 1, 2))
            assert grammar.between(a, b).tolist() == ids[a:b].tolist()
    text = np.tile(rng.integers(0, 50, 100), 100)
    assert len(token_files.compress(text.astype(np.uint32), 50).symbols) < len(text) / 20


def test_digest_of_odd_rows(spark, documents, plain):
    r = random.Random(5)
    docs = [(i * 3 % 101, "".join(r.choice(PARTS) for _ in range(r.randrange(60)))) for i in range(101)]
    docs += [(500, ""), (501, None), (None, "no id"), (None, "no id"), (7, docs[0][1]), (502, "same"), (502, "same")]
    table = documents(*docs).withColumnsRenamed({"source": "part", "lang": "row"})
    got = in_order(token_files.packed_digest(table))
    assert [row[1] for row in got] == np.concatenate(([0], np.cumsum([row[2] for row in got])[:-1])).tolist()
    assert sorted(map(repr, ((d, n, c) for d, _, n, c in got))) == sorted(map(repr, ((d, n, c) for d, _, n, c in wanted(docs, plain))))
    assert [row[0] for row in got] == [row[0] for row in wanted(docs, plain)]
    once = {row[0]: row for row in got if row[0] not in (7, None)}
    assert once == {row[0]: row for row in wanted(docs, plain) if row[0] not in (7, None)} | {502: once[502]}
    assert in_order(token_files.packed_digest(documents())) == []


def test_documents_of_several_shards(spark, documents, plain, tmp_path):
    docs = [(i, "a b c d e f g h " * (i % 7) * 5) for i in range(20)]
    folder = str(tmp_path / "ids")
    token_files.write_token_files(documents(*docs), folder, PATH, shard=64)
    shards = token_files.read_shards(spark, folder)
    assert shards.count() > 20
    assert in_order(token_files.token_digest(shards)) == wanted(docs, plain)
    every = [i for _, text in docs for i in [*plain(text), 2]]
    for start, stop in ((0, len(every)), (10, 11), (100, 333), (5, 5)):
        rows = sorted(token_files.read_ids(shards, start, stop).collect())
        assert [i for row in rows for i in row["ids"]] == every[start:stop]
        assert not rows or rows[0]["start"] == start


def test_long_text(spark, documents, plain):
    text = "Über allen Gipfeln ist Ruh, in allen Wipfeln spürest du\n" * 100_000
    assert in_order(token_files.packed_digest(documents((1, text), (2, "x")))) == wanted([(1, text), (2, "x")], plain)


def test_crc_of_both():
    r = random.Random(6)
    for size in (0, 1, 5, 4096):
        a, b = r.randbytes(37), r.randbytes(size)
        assert token_files.crc32_of_both(zlib.crc32(a), zlib.crc32(b), size) == zlib.crc32(a + b)
