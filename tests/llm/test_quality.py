from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from lakegate.llm import quality
from tests.llm.helpers import awkward, documents, prose


def measures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {w for w in windows if windows.count(w) > 1} if len(words) < 3000 else set()
    covered = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), again, len(covered), failed


def test_base_equals_brute_force(spark):
    rng = random.Random(3)
    rows = awkward()
    for i in range(100, 180):
        part = prose(i, rng.randint(5, 30))
        bits = [part, part, prose(i + 500, 20), "#$ %", " ", "\t", "", "  x", "a|b<c>"]
        rows.append((i, "\n".join(rng.choices(bits, k=rng.randint(1, 8)))))
    labels = spark.createDataFrame([(100, 1, 0), (100, 1, 1), (101, 1, 0), (101, 0, 0), (None, 1, 0), (102, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(documents(spark, rows), labels).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(map(str, ([r.doc_id, *[r[n] for n in names]] for r in got))) == sorted(
        str([k, *measures(t)]) for k, t in rows
    )
    assert all(not r.kept for r in got if r.base_failed)


def test_likelihood_ratio_equals_brute_force(spark):
    rows = [(i, prose(i, 60) if i % 4 else " ".join(w + "$$$" for w in prose(i, 60).split())) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(30)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score(documents(spark, rows), labels, bits=10).collect()}
    hashes = quality.WordHashes()
    raw, target = np.zeros(1024), np.zeros(1024)
    grams = {}
    for key, text in rows:
        one = hashes.array(text.encode())
        grams[key] = quality.buckets_of(one, 10)
        assert len(grams[key]) == 2 * len(one) - 1
        for b in grams[key]:
            raw[b] += 1
            target[b] += key < 30 and key % 4 > 0
    p = (raw + 1) / (raw.sum() + 1024)
    q = (target + 1024 * p) / (target.sum() + 1024)
    llr = {key: np.log(q / p)[grams[key]].mean() for key, _ in rows}
    held = []
    for key in (k for k in range(30) if k % 4):
        others = target.copy()
        for b in grams[key]:
            others[b] -= 1
        held.append(np.log((others + 1024 * p) / (others.sum() + 1024) / p)[grams[key]].mean())
    threshold = np.median(held) - 2 * (np.median(held) - np.quantile(held, 0.01))
    for key, _ in rows:
        assert abs(got[key].llr - llr[key]) < 1e-9 and abs(got[key].threshold - threshold) < 1e-9
        assert got[key].kept == (got[key].llr >= got[key].threshold)
    kept = quality.keep(documents(spark, rows), labels, bits=10)
    assert kept.columns == documents(spark, []).columns
    assert {r.doc_id for r in kept.collect()} == {k for k in got if got[k].kept}
    assert max(got[k].llr for k in got if k % 4 == 0) < min(got[k].llr for k in got if k % 4)


def test_held_out_accuracy(spark):
    """Trusted texts of half of the labels tell apart the other half."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.score(spark.read.parquet(f"{folder}/documents.parquet"), labels.where("doc_id % 2 = 0"))
    rows = found.join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    clean, junk = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert len(clean) > 1000 and sum(clean) >= 0.99 * len(clean)
    assert len(junk) > 100 and sum(junk) <= 0.1 * len(junk)


def test_few_labels_give_a_threshold_too(spark):
    """The given labels at their smallest size, and a single trusted text."""
    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.score(docs, labels).collect()
    assert all(np.isfinite(r.threshold) for r in found)
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    clean = [r.kept for r in found if r.doc_id in good and not r.base_failed]
    assert len(clean) > 50 and sum(clean) >= 0.97 * len(clean)
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = quality.score(documents(spark, [(1, prose(1, 40)), (2, prose(2, 40)), (3, "x")]), one).collect()
    assert {r.threshold for r in rows} == {0.0} and {r.doc_id for r in rows if r.kept} >= {1}


def test_all_trusted_texts_count_and_set_the_threshold(spark, monkeypatch):
    texts = [(key, prose(key, 30)) for key in range(1, 41)]
    texts.append((50_000, "zebra quagga okapi " * 20))
    labels = spark.range(1, 50_001).selectExpr("id AS doc_id", "IF(id IN (1, 2), 0, 1) AS quality")
    trusted = quality.trusted_rows(labels, "doc_id", "quality")
    assert trusted.count() == 49_998  # more than the 20 000 that were picked before
    docs = documents(spark, texts)
    raw, target = quality.bucket_counts(quality.ngram_counts(docs, trusted, "doc_id", "text", 10), 10)
    words = {key: len(text.split()) for key, text in texts}
    assert target.sum() == sum(2 * n - 1 for key, n in words.items() if key > 2)
    assert raw.sum() == sum(2 * n - 1 for n in words.values())
    sent = quality.score(docs, labels, bits=10).orderBy("doc_id").collect()
    monkeypatch.setattr(quality, "SENT", 0)  # joined instead
    assert quality.score(docs, labels, bits=10).orderBy("doc_id").collect() == sent


def test_percentiles_are_exact(spark):
    values = spark.range(1001).selectExpr("cast(xxhash64(id) % 500 AS double) / 7 AS v")
    low, middle = values.agg(F.percentile("v", F.lit(0.01)), F.median("v")).first()
    assert quality.percentiles(values, "v", (0.01, 0.5)) == [low, middle]
    assert quality.percentiles(values.where("v > 1e9"), "v", (0.01, 0.5)) is None


def test_trusted_ids_are_bounded(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    some = quality.trusted_ids(labels, "doc_id", "quality", 7)
    assert len(some) == 7 and some == quality.trusted_ids(labels.orderBy("doc_id", ascending=False), "doc_id", "quality", 7)


def test_without_labels_and_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(documents(spark, []), none).collect() == []
    (row,) = quality.score(documents(spark, [(1, prose(1, 40))]), none).collect()
    assert row.llr == 0 and row.kept
