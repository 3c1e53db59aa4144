"""SentencePiece encoding and decoding against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prepkit.llm import queries, sentence_pieces
from prepkit.llm.sentence_pieces import PieceModel

FOLDER = "/root/testdata/sf0.001"
TABLES = ["documents", "odd", "empty"]
MODEL = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return PieceModel(MODEL)


def agree(model, library, texts):
    ids, counts = model.encode(pa.array(texts, pa.string()))
    want = library.encode([t or "" for t in texts])
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert model.decode(ids, counts).to_pylist() == [library.decode(w) for w in want]


SIGNS = [*" \n\t\r\xa0 \x1c\x85  ab'sé1²٣漢\U0001f600.,!-\x00​▁", "the", "'ll", "<s>", " \n", "x" * 90, "  ",
         "    ", "aa", "tion", "<0x41>", "</s>", "▁▁"]


@pytest.mark.parametrize("signs", [SIGNS, [*"abcdefghijklmnopqrstuvwxyzeeeettttaaaaooo"], [*"eateateat n sr"], [*" ="]])
def test_merges_are_the_libraries(model, library, signs):
    random.seed(4)
    agree(model, library, ["".join(random.choices(signs, k=random.randint(0, 40))) for _ in range(4000)] + [None, ""])


def test_runs_and_long_words(model, library):
    # Runs of spaces have pieces of one score: the leftmost pair goes first, not all pairs at once.
    texts = [" " * k for k in range(70)] + ["x" + " " * k + "y" for k in range(40)] + ["a" * k for k in range(200)]
    texts += ["=-" * 3000, "漢字" * 3000, " " * 5000, "the" * 5000, "".join(random.Random(1).choices("abcdefgh" * 3 + "XYZ", k=100_000))]
    agree(model, library, texts)


@given(st.lists(st.text(max_size=30), max_size=8))
@settings(max_examples=200, deadline=None)
def test_any_text(texts):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids, counts = sentence_pieces.piece_model(MODEL).encode(pa.array(texts, pa.string()))
    want = processor.encode(texts)
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_any_ids_decode_as_the_library_does(model, library):
    random.seed(5)
    some = [0, 1, 2, 3, 35, 200, 230, 231, 258, 259, 260, 300, 29871, 29900]
    rows = [random.choices(some + random.sample(range(3, 259), 10) + random.sample(range(259, 32000), 10),
                           k=random.randint(0, 8)) for _ in range(4000)]
    flat, counts = np.array([i for r in rows for i in r], np.int32), np.array([len(r) for r in rows])
    assert model.decode(flat, counts).to_pylist() == [library.decode(r) for r in rows]
    with pytest.raises(ValueError, match="vocabulary"):
        model.decode(np.array([32000]), np.array([1]))


def digests(library, rows):
    out = []
    for key, text in rows:
        ids = [*library.encode(text or ""), library.eos_id()]
        out.append((key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query(spark, library, documents):
    got = queries.op11_sentencepiece(spark, FOLDER).collect()
    assert sorted(map(tuple, got), key=repr) == digests(library, [(r.doc_id, r.text) for r in documents.collect()])


@pytest.mark.parametrize("name", TABLES)
def test_operators(request, library, name, monkeypatch):
    df = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    for end in (True, False):
        coded = sentence_pieces.encode(df.withColumnRenamed("size", "IDS"), MODEL, end=end)
        assert coded.columns == [*[c for c in df.columns if c != "size"], "ids"]
        tail = [library.eos_id()] if end else []
        want = [(k, t, [*library.encode(t or ""), *tail]) for k, t in rows]
        assert sorted(((r.doc_id, r.text, r.ids) for r in coded.collect()), key=repr) == sorted(want, key=repr)
    back = sentence_pieces.decode(coded, MODEL)
    assert sorted(((r.doc_id, r.decoded) for r in back.collect()), key=repr) == sorted(
        ((k, library.decode(ids)) for k, _, ids in want), key=repr)
    both = sentence_pieces.round_trip(df, MODEL, end=False)
    assert sorted(((r.doc_id, r.text, r.ids) for r in both.collect()), key=repr) == sorted(want, key=repr)


def test_odd_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [2])], "k int, ids array<int>")
    assert sorted((r.k, r.decoded) for r in sentence_pieces.decode(df, MODEL).collect()) == [(1, None), (2, ""), (3, "")]
