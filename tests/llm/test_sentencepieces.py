from __future__ import annotations

import random

import pytest
import sentencepiece

from lakegate.llm import sentencepieces
from tests.llm.helpers import awkward, documents, prose


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)


def test_equals_the_library(spark, library):
    rng = random.Random(11)
    alphabets = ["abcdefghij ", "the andoring  ", "äöüßéèñ ", "▁ a", "日本語中文 x", "\n\t a0123456789.,-", "🙂é́​ ñ", "aaab"]
    rows = [(i, "".join(rng.choices(rng.choice(alphabets), k=rng.randint(0, 60)))) for i in range(100, 900)]
    rows += [(1000 + i, prose(i, 200)) for i in range(40)]
    rows += [(2000, " leading and trailing "), (2001, "a" * 3000), (2002, "\u0000 nul"), (2003, "Hello  wörld 你好 🙂\n\tx"),
             (2004, "https://example.org/a_b?c=d&e=f#g"), (2005, "def f(x):\n    return x ** 2\n")]
    rows = awkward(rows)
    found = sentencepieces.decode(sentencepieces.encode(documents(spark, rows))).collect()
    want = sorted((str(k), library.encode(t or ""), library.decode(library.encode(t or ""))) for k, t in rows)
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in found) == want


def test_vocabulary_pieces_and_pairs(library):
    """Every piece of the vocabulary, and random joins of pieces, alone."""
    rng = random.Random(1)
    pieces = sentencepieces.Pieces(open(sentencepieces.MODEL, "rb").read())
    names = [n.replace("▁", " ") for n in pieces.names]
    texts = names + ["".join(rng.choices(names, k=rng.randint(2, 6))) for _ in range(20_000)]
    for text, ids in zip(texts, pieces.encode_batch(texts), strict=True):
        assert ids.tolist() == library.encode(text), text


def test_round_trip(spark):
    rows = [(i, prose(i, 100) + "\n\x01🙂") for i in range(50)]
    found = sentencepieces.decode(sentencepieces.encode(documents(spark, rows))).collect()
    assert {r.doc_id: r.decoded for r in found} == dict(rows)


def test_empty_table_and_null_ids(spark):
    assert sentencepieces.encode(documents(spark, [])).collect() == []
    df = spark.createDataFrame([(None,), ([],), ([1, 2, 0],), ([3 + 0xC3],)], "ids array<int>")
    assert [r.decoded for r in sentencepieces.decode(df).collect()] == [None, "", " ⁇ ".removeprefix(" "), "�"]
