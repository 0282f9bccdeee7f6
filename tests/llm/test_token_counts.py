from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lakegate.llm import token_counts
from tests.llm.helpers import awkward, documents, prose

FILE = public_tokenizers.path("byte_bpe_50k.json")


def by_library(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def strange(rng):
    pools = [
        "abc XYZ  ", "'s't're've'm'll'd ", "0123 ²½Ⅷ٣", "\t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　 a", "中文字かなéßİ̇ ", "!?.,;:- _",
        "".join(map(chr, rng.sample(range(0x20, 0x3000), 40))), "՘֋࢏₏\U0003fc36 a1!", "😀👩‍👧\U00010330 ",
    ]
    return "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 120)))


def test_equals_the_library(spark):
    rng = random.Random(13)
    texts = [strange(rng) for _ in range(1500)]
    texts += ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>'s", "<|endoftext", " <|endoftext|>  x", "it's we'll 's ''s"]
    rows = [*awkward(), *enumerate(texts, 100)]
    got = token_counts.count(documents(spark, rows), FILE, limit=60).collect()
    whole = [t or "" for _, t in rows]
    expected = [(i, len(t.encode()), n, n > 60) for (i, _), t, n in zip(rows, whole, by_library(whole), strict=True)]
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert got[0].asDict().keys() == {"doc_id", "n_bytes", "n_tokens", "over_limit"}


@pytest.mark.parametrize("text", [prose(5, 4000), "a  b\n\nc   'd  " * 900, "x" * 5000, " " * 5000, "é<|endoftext|> ü" * 500])
def test_slices_cut_no_pre_token(monkeypatch, text):
    monkeypatch.setattr(token_counts, "SLICE", 50)
    parts = list(token_counts._slices(text))
    assert "".join(parts) == text
    assert sum(by_library(parts)) == by_library([text])[0]


def test_small_tables_and_caches_change_no_count(spark):
    docs = documents(spark, [(i, prose(i % 50, 80)) for i in range(300)])
    full = token_counts.count(docs, FILE).orderBy("doc_id").collect()
    assert token_counts.count(docs, FILE, words=1, cached=3).orderBy("doc_id").collect() == full


def test_frequent_words_are_found_over_all_texts(spark):
    docs = documents(spark, [(i, f"often word{i} often seldom{i}") for i in range(400)]).repartition(7)
    assert token_counts.frequent_words(docs, words=1) == ["often"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # partitions without a sketch
    try:
        assert token_counts.frequent_words(docs.where("doc_id < 3").repartition(40), words=1) == ["often"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_tables_and_other_models(spark):
    assert token_counts.count(documents(spark, []), FILE).collect() == []
    only_null = documents(spark, [(1, None)])
    assert [tuple(r) for r in token_counts.count(only_null, FILE).collect()] == [(1, 0, 0, False)]
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.count(only_null, public_tokenizers.path("word_bpe_49k.json"))


def test_query_counts_whole_texts(spark):
    from lakegate.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op13_token_counts"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    counts = by_library([t for _, t in rows])
    assert got == {i: (len(t.encode()), n, n > 1024) for (i, t), n in zip(rows, counts, strict=True)}
