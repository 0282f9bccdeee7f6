from __future__ import annotations

import random

import pytest
from xxhash import xxh64_intdigest

from lakegate.llm import graph, simhash
from tests.llm.helpers import awkward, documents, prose


def fingerprint(text, shingle=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if sum(h >> j & 1 for h in hashes) * 2 > len(hashes))


def classes(values, linked):
    names = list(range(len(values)))

    def top(i):
        while names[i] != i:
            i = names[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = sorted((top(i), top(j)))
                names[b] = a
    return [top(i) for i in range(len(values))]


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = awkward()
    for i in range(100, 160):
        words = prose(i % 20, 150).split()
        for _ in range(i % 3):
            words[rng.randrange(len(words))] = "CHANGED"
        rows.append((i, " ".join(words)))
    rows += [(200, "one"), (201, "ONE\t"), (202, "one two"), (203, "KK É")]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    prints = [fingerprint(t) for _, t in rows]
    tops = classes(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (key, _), top in zip(rows, tops, strict=True):
        least[top] = min((x for x in (least.get(top), key) if x is not None), default=None)
    want = sorted((str(k), f"{p:016x}", str(least[t])) for (k, _), p, t in zip(rows, prints, tops, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_of_crowded_buckets(spark, bits):
    """Hundreds of fingerprints that share a half, three quarters and more: cut again, and no link is lost."""
    rng = random.Random(bits)
    values = {0, 1, 3, 7, (1 << 63) - 1, -1}
    values |= {rng.getrandbits(32) for _ in range(150)}  # one half in common
    values |= {0x1234567800000000 | rng.getrandbits(9) << 3 for _ in range(250)}  # all but nine bits in common
    values |= {0x0BADCAFE00000000 | rng.getrandbits(16) << 16 for _ in range(300)}
    for v in list(values)[:200]:
        for _ in range(3):
            v ^= 1 << rng.randrange(63)
            values.add(v)
    values = sorted(values)
    got = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), bits).collect()
    mask = (1 << 64) - 1
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & mask).bit_count() <= bits}
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_bounds(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 4)
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_one_of_each_stays(spark):
    rows = [(5, prose(1, 80)), (3, prose(1, 80)), (9, prose(2, 80)), (None, prose(1, 80)), (None, prose(3, 80))]
    rows += [(9, prose(2, 80)), (7, prose(4, 80)), (7, prose(5, 80)), (8, None), (6, "")]
    df = documents(spark, rows)
    got = simhash.first_of_each(df)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted(
        [("3", prose(1, 80)), ("9", prose(2, 80)), ("None", prose(3, 80)), ("7", prose(4, 80)), ("7", prose(5, 80)), ("6", "")]
    )


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)] + [(7000, 7000), (5, None)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n for n, c in got.items() if c == 0} == set(range(301))
    assert {n for n, c in got.items() if c == 1000} == {1000, *range(2000, 2300)}
    assert len(got) == 602
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []
