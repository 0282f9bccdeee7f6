from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from lakegate.llm import substrings
from tests.llm.helpers import awkward, documents, prose


def brute_force(rows, size):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(raw[i : i + size] for raw in raws for i in range(len(raw) - size + 1))
    out = []
    for (key, _), raw in zip(rows, raws, strict=True):
        gone = np.zeros(len(raw) + 1, np.int64)
        for i in range(len(raw) - size + 1):
            if seen[raw[i : i + size]] > 1:
                gone[i] += 1
                gone[i + size] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~mask])
        out.append((str(key), len(raw), int(mask.sum()), runs, kept))
    return sorted(out)


def mixed_rows(seed, n=120):
    rng = random.Random(seed)
    passages = [prose(1000 + i, rng.randint(5, 40)) for i in range(12)]
    rows = awkward()[:6] + [(7, "x" * 3000), (8, "ab" * 700), (9, "")]
    for i in range(100, 100 + n):
        parts = [prose(i, rng.randint(1, 30))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            parts.append(p[rng.randint(0, 9) : len(p) - rng.randint(0, 9)])
        rng.shuffle(parts)
        rows.append((i, rng.choice([" ", "", "\n"]).join(parts)))
    base = prose(77, 120).split()
    for i in range(40):  # near copies
        words = list(base)
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((500 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("size", "core"), [(40, 12), (200, 96), (30, 29)])
@pytest.mark.parametrize("lookup_rows", [1_000_000, 0])
def test_equals_brute_force(spark, size, core, lookup_rows):
    rows = mixed_rows(size)
    got = substrings.dedup(documents(spark, rows), min_bytes=size, core_bytes=core, lookup_rows=lookup_rows).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_force(rows, size)


def test_crowded_anchors(spark, monkeypatch):
    """Anchors with more windows than a task sorts: the strings are counted, with the same result."""
    monkeypatch.setattr(substrings, "GROUP_WINDOWS", 3)
    monkeypatch.setattr(substrings, "BATCH_WINDOWS", 10)
    rows = mixed_rows(5)
    got = substrings.dedup(documents(spark, rows), min_bytes=40, core_bytes=16).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_force(rows, 40)


def test_long_texts_in_blocks(monkeypatch):
    """Anchors do not depend on where a text is cut into blocks."""
    raw = (prose(3, 4000) + "y" * 500).encode()
    whole = substrings.Anchors(50, 20).of(raw)
    monkeypatch.setattr(substrings, "BLOCK", 700)
    cut = substrings.Anchors(50, 20).of(raw)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert np.diff(whole[0]).max() <= 31


def test_columns_equal_brute_force(tmp_path):
    rng = random.Random(2)
    windows = []
    for _ in range(300):
        left = "".join(rng.choices("ab", k=rng.randint(0, 7))).encode()
        windows.append((left, "".join(rng.choices("ab", k=rng.randint(3, 8))).encode()))
    size, width = 8, 8
    got = substrings.Columns(str(tmp_path), size, width).repeated(windows)
    rows = [b"\xff" * (width - 1 - len(a)) + a + b + b"\xff" * (size - len(b)) for a, b in windows]
    for start in range(width):
        count = Counter(r[start : start + size] for r in rows)
        for i, r in enumerate(rows):
            part = r[start : start + size]
            assert got[i, start] == (b"\xff" not in part and count[part] > 1)


def test_empty_table_and_bounds(spark):
    assert substrings.dedup(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        substrings.dedup(documents(spark, []), min_bytes=10, core_bytes=10)
