from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegate.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id int, part string, w double, n int, query string, windows int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2.0, 3, "q", 4) for r in rows], SCHEMA)


def brute_force(rows, positives=5, negatives=10, low=30, high=90):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return tuple(math.floor(256 * x) for x in v)

    good = [(i, y, w) for i, v, y in rows if i is not None and y is not None and (w := whole(v)) is not None]
    out = []
    for anchor in sorted({r for r in good if r[0] % 5 == 0}):
        others = list(good)
        others.remove(anchor)
        scored = sorted((-sum(a * b for a, b in zip(anchor[2], w, strict=False)), i, y) for i, y, w in others)
        same = [(i, -s) for s, i, y in scored if y == anchor[1]][:positives]
        for place, (i, s) in enumerate(same, 1):
            window = [(j, -t) for t, j, y in scored if y != anchor[1] and low * s <= 100 * -t <= high * s]
            out += [(anchor[0], i, rank, j, s, t, place) for rank, (j, t) in enumerate(window[:negatives], 1)]
    return sorted(out)


def mined(df, **options):
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 5 == 0, **options).collect()))


def as_stored(df):
    """The rows as 32-bit floats hold them."""
    rows = df.select("vec_id", "embedding", "label").collect()
    return [(i, None if v is None else [None if x is None else float(x) for x in v], y) for i, v, y in rows]


def cloud(seed, rows, dims=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    out = []
    for i in range(rows):
        c = rng.choice(centres)
        v = [x + rng.gauss(0, 0.4) if rng.random() < 0.8 else 0.0 for x in c]
        out.append((i, v[: rng.choice([dims, dims, dims, 3])], rng.choice([0, 0, 0, 1, 2])))
    return out


@pytest.mark.parametrize("blocks", [{}, {"candidates_at_once": 16, "anchors_at_once": 3}])
def test_equals_brute_force(spark, blocks):
    rows = cloud(12, 160)
    rows += [(None, [1.0] * 6, 0), (500, None, 0), (505, [1.0], None), (510, [math.nan, 1.0], 1), (515, [None], 1)]
    rows += [(520, [math.inf, 0.0], 1), (525, [], 1), (530, [0.0] * 6, 2), (535, [-1.0] * 6, 0), (540, [1.0] * 6, 9)]
    rows += [rows[3]] * 30 + [rows[10]] * 3 + [(10, [0.5] * 6, 1), (10, [0.5] * 6, 2)]  # copies; one id, several rows
    rows += [(600 + i, [1.0] * 6, i % 2) for i in range(40)]  # one vector under many ids
    df = table(spark, rows)
    expected = brute_force(as_stored(df))
    assert len({r[0] for r in expected}) > 20
    assert mined(df, **blocks) == expected
    few = {"positives": 2, "negatives": 3, "low_percent": 10, "high_percent": 100}
    assert mined(df, **few, **blocks) == brute_force(as_stored(df), 2, 3, 10, 100)


def test_few_and_no_rows(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(0, [1.0], 1)])) == []
    assert mined(table(spark, [(0, [1.0], 1), (1, [1.0], 1)])) == []  # a positive, but no other label
    assert mined(table(spark, [(0, [1.0], 1), (1, [0.5], 2)])) == []  # no positive
    three = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]
    assert mined(table(spark, three)) == [(0, 1, 1, 2, 65536, 32768, 1)]
    assert mined(table(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)])) == []  # a negative score opens no window


def test_the_index_leaves_dimensions_out_and_loses_no_pair():
    rng = np.random.default_rng(3)
    rows = np.floor(rng.normal(0, 60, (300, 16)) * np.linspace(2, 0.05, 16)).astype(np.int64)
    rows[25::60] //= 50  # too short to reach a high threshold
    anchors = rows[:20]
    norms, a_norms = hard_negatives._suffix_norms(rows), hard_negatives._suffix_norms(anchors)
    scores = anchors @ rows.T
    for kind in (np.int64, np.float64):
        for least in (60_000, 20_000, 1, 0, -5_000):
            limits = np.full(20, least) + np.arange(20)
            even = lambda a, r: (a + r) % 2 == 0
            found = hard_negatives._joined(anchors.astype(kind), limits, rows.astype(kind), norms, a_norms, even)
            a, r = np.nonzero(scores >= limits[:, None])
            a, r = a[even(a, r)], r[even(a, r)]
            assert sorted(zip(*map(np.ndarray.tolist, found), strict=True)) == sorted(zip(a.tolist(), r.tolist(), scores[a, r].tolist(), strict=True))
    covered = norms * a_norms.max(axis=0) < 60_000
    assert (covered.argmax(axis=1) < 16).any() and covered[:, 0].any()  # suffixes left out; rows not indexed at all
