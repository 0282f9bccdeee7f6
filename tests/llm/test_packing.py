from __future__ import annotations

import random
from collections import defaultdict

from lakegate.llm import packing
from tests.llm.helpers import awkward, documents, prose


def rebuilt(packed):
    found = defaultdict(list)
    for row in packed:
        assert row.n_tokens == len(row.tokens) <= row.capacity
        end = 0
        for p in row.pieces:
            assert p.offset == end
            end += p.length
            found[p.doc_id].append((p.piece, p.start, bytes(row.tokens[p.offset : p.offset + p.length])))
        assert end == row.n_tokens
    return found


def test_every_token_once(spark):
    rng = random.Random(3)
    rows = awkward([(i, prose(i, rng.randint(1, 300))) for i in range(100, 300)])
    sizes = (256, 512, 1024)
    packed = packing.pack(documents(spark, rows), capacities=sizes, shard_tokens=60_000).collect()
    assert len({r.sequence_id for r in packed}) == len(packed)
    for r in packed:
        assert r.capacity == min(s for s in sizes if s >= r.n_tokens)
    found = rebuilt(packed)
    for key in {k for k, _ in rows}:
        texts = [(t or "").encode() + packing.END for k, t in rows if k == key]
        assert len(set(texts)) == 1
        whole = texts[0]
        want = sorted((i // 1024, i, whole[i : i + 1024]) for i in range(0, len(whole), 1024)) * len(texts)
        assert sorted(found[key]) == sorted(want)
    filled = sum(r.n_tokens for r in packed) / sum(r.capacity for r in packed)
    assert filled > 0.9


def test_best_fit_by_hand():
    # 9 opens a bin of 10 (room 1); 6 opens another (room 4); 4 leaves least room in the second; 1 fills the first.
    assert packing.best_fit([9, 6, 4, 1], (10,), cost=float) == [(10, [0, 3]), (10, [1, 2])]
    # One piece of 3 alone: the cheapest size is the small one; with 5 more to come the large one costs less a token.
    assert packing.best_fit([3], (4, 16), cost=lambda c: c + 1) == [(4, [0])]
    assert packing.best_fit([8, 8], (8, 16), cost=lambda c: c + 4) == [(16, [0, 1])]
    assert packing.best_fit([8, 8], (8, 16), cost=lambda c: c * c) == [(8, [0]), (8, [1])]
    # Opened at 16 for the pieces to come, a bin shrinks to what it got.
    assert packing.best_fit([], (4,)) == []


def test_result_is_the_same_again(spark):
    rows = [(i, prose(i % 7, 50)) for i in range(200)]
    a, b = (sorted(map(str, packing.pack(documents(spark, rows), capacities=(512, 2048)).collect())) for _ in "ab")
    assert a == b


def test_empty_table(spark):
    assert packing.pack(documents(spark, [])).collect() == []
