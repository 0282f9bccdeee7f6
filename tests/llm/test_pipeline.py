from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakegate.llm import packing
from lakegate.session import materialised
from tests.llm import test_line_dedup, test_secret_scan, test_simhash
from tests.llm.helpers import CLASHING

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and what comes out last."""
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialised(stage(spark, docs[-1], FOLDER), "test"))
    return docs


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_order(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "simhash near-dedup", "secret scans", "best-fit packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.dtypes == stages[0].dtypes
        assert all(r.n_chars == len(r.text) for r in df.collect())


def test_quality_stage_keeps_clean_documents(spark, stages):
    before, after = dict(rows(stages[0])), dict(rows(stages[1]))
    assert after.items() <= before.items()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    long = [k for k, t in before.items() if labels.get(k) == 1 and len(set(t.split())) > 30]
    assert len(long) > 20 and sum(k in after for k in long) >= 0.97 * len(long)


def test_line_stage_equals_brute_force(stages):
    assert sorted(rows(stages[2])) == sorted(test_line_dedup.equal_or_near(rows(stages[1]), 20))


def test_simhash_stage_equals_brute_force(stages):
    listed = sorted(rows(stages[2]))
    prints = [test_simhash.fingerprint(t) for _, t in listed]
    tops = test_simhash.classes(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(rows(stages[3])) == [row for i, row in enumerate(listed) if tops[i] == i]


def test_secret_stage_leaves_no_base_secret(stages):
    before, after = dict(rows(stages[3])), dict(rows(stages[4]))
    assert before.keys() == after.keys()
    for key, text in before.items():
        if not test_secret_scan.base(text):
            assert after[key] == text
        assert not test_secret_scan.base(after[key])


def test_packing_stage_holds_every_byte(stages):
    want = Counter()
    for key, text in rows(stages[4]):
        want[key] += len(text.encode()) + len(packing.END)
    got = Counter()
    for r in stages[5].collect():
        assert r.n_tokens <= r.capacity and r.doc_ids == [p.doc_id for p in r.pieces]
        for p in r.pieces:
            got[p.doc_id] += p.length
    assert got == want


def test_stages_take_nulls_repeated_rows_and_clashing_columns(spark):
    some = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 40")
    first = some.where("n_chars > 1000").orderBy("doc_id").first()
    odd = [first.asDict(), {**first.asDict(), "doc_id": None}, dict.fromkeys(some.columns), {**dict.fromkeys(some.columns), "doc_id": 7}]
    docs = some.unionByName(spark.createDataFrame([tuple(r.values()) for r in odd], some.schema))
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit(None).cast("string"))
    for rows_in in (docs, docs.limit(0)):
        columns, found = rows_in.columns, [rows_in]
        for _, stage in corpus_pipeline.STAGES:
            found.append(materialised(stage(spark, found[-1], FOLDER), "test"))
        assert all(df.columns == columns for df in found[:-1])
        if rows_in is docs:
            kept = [r.doc_id for r in found[4].collect()]
            assert kept.count(first.doc_id) == 1 and all(r.text is not None for r in found[1].collect())
            assert sorted(k for r in found[5].collect() for k in set(r.doc_ids) if k is not None) == sorted(
                k for k in kept if k is not None
            )
        else:
            assert not any(df.count() for df in found)


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, FOLDER).columns == stages[-1].columns
