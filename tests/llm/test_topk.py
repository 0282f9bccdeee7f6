from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from lakegate.llm import topk


def brute_force(rows, k):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return tuple(math.floor(256 * x) for x in v)

    good = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    out = []
    for q, v in sorted({x for x in good if x[0] % 5 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([0.0, 0.0, rng.uniform(-2, 2), 0.25]) for _ in range(rng.choice([8, 8, 5]))]) for i in range(170)]
    rows += [(None, [1.0] * 8), (500, None), (505, [None, 1.0]), (510, [math.nan]), (515, [math.inf, 1.0]), (520, [])]
    rows += [rows[3]] * 40 + [rows[10]] * 3 + [(10, [0.5] * 8)] + [(600 + i, [1.0] * 8) for i in range(9)]
    df = spark.createDataFrame([(*r, 1, 2.0, "x") for r in rows], "vec_id long, embedding array<float>, id int, w double, part string")
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in [(r[0], r[1]) for r in df.collect()]]
    for at_once in ((4096, 1024), (16, 4)):
        got = topk.top_k(df, F.col("vec_id") % 5 == 0, 5, candidates_at_once=at_once[0], queries_at_once=at_once[1])
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute_force(rows, 5)


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0]), (7, [0.5])], schema)
    assert [tuple(r) for r in topk.top_k(two, F.col("vec_id") % 5 == 0, 5).collect()] == [(0, 1, 7, 32768)]
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 5 == 0).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0])], schema), F.col("vec_id") % 5 == 0).collect() == []
