from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from lakegate.llm import periodic_runs
from tests.llm.helpers import awkward, documents, prose


def brute_runs(words, min_length=6, min_exponent=4):
    """Every period at every place: maximal stretches, each under its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= 2 * q:
                found.setdefault((start, length), q)
    rows = [(s, length, q) for (s, length), q in found.items() if length >= min_length and length >= min_exponent * q]
    return sorted(rows, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_in(text):
    return [w.decode() for w in (text or "").encode().split()]


def texts(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = rng.choices("abcd"[: rng.randint(1, 4)], k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            unit = rng.choices("abcé", k=rng.randint(1, 5))
            at = rng.randint(0, len(words))
            words[at:at] = (unit * 9)[: rng.randint(2, 9 * len(unit))]
        out.append(rng.choice([" ", "\n", " \t", "\x0b "]).join(words))
    return out


def found(df, **options):
    return [
        (r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find(df, **options).collect()
    ]


def expected(rows, **options):
    out = []
    for i, text in rows:
        words = words_in(text)
        runs = brute_runs(words, **options)
        out.append((i, len(words), runs, brute_collapsed(words, runs)))
    return out


ORDER = lambda r: (r[0] is None, str(r))


@pytest.mark.parametrize("options", [{}, {"min_length": 2, "min_exponent": 2}, {"min_length": 3, "min_exponent": 2.5}])
def test_equals_brute_force(spark, options):
    rows = [*enumerate(texts(11, 700), 100)]
    rows += [r for r in awkward() if r[0] != 6]
    got = found(documents(spark, rows), **options)
    assert sorted(got, key=ORDER) == sorted(expected(rows, **options), key=ORDER)
    assert sum(len(r[2]) > 1 for r in got) > 20


def test_texts_of_one_array_never_meet(monkeypatch, spark):
    rows = [(i, t) for i, t in enumerate(["a a a", "a a a", "a a a a a a", "b a b a b", "a b a b a", "", "a a a"])]
    assert sorted(found(documents(spark, rows).coalesce(1))) == sorted(expected(rows))
    codes = [np.array(words) for words in ([0, 0, 0], [0, 0, 0, 0, 0, 0], [0, 0])]
    assert {k: v.tolist() for k, v in periodic_runs._found(codes, 6, 4).items()} == {1: [[0, 6, 1]]}


@pytest.mark.parametrize("words", [["x"] * 30_000, list("ab") * 15_000, list("aab") * 9_000 + list("ba") * 4_000])
def test_long_runs(words):
    codes = periodic_runs._Codes()
    got = periodic_runs._found([codes.of(" ".join(words).encode())], 6, 4)[0].tolist()
    assert [list(r) for r in brute_ends(words)] == got


def brute_ends(words):
    """Runs of small periods only, for texts whose periods are known to be small."""
    out = set()
    for q in range(1, 9):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q) and not any((start, length) == r[:2] for r in out):
                out.add((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_long_texts_and_small_pieces(monkeypatch):
    rng = random.Random(4)
    words = rng.choices("abcdefgh", k=3000) + list("abcab") * 40 + rng.choices("ab", k=1500)
    monkeypatch.setattr(periodic_runs, "SUFFIXES_AT_ONCE", 7)
    got = periodic_runs._found([periodic_runs._Codes().of(" ".join(words).encode())], 4, 2)[0].tolist()
    assert got == [list(r) for r in brute_runs(words, 4, 2)]


def test_empty_table_and_wrong_bounds(spark):
    assert found(documents(spark, [])) == []
    with pytest.raises(ValueError, match="two periods"):
        periodic_runs.find(documents(spark, []), min_exponent=1)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_equals_brute_force(spark, tmp_path):
    from lakegate.llm.queries import QUERIES

    rows = [*enumerate(texts(5, 400), 1), *((1000 + i, prose(i, 70)) for i in range(60)), (2000, None), (2001, " \n"), (None, "a " * 9)]
    documents(spark, rows).drop("id").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    wanted, changed = [], 0
    for i, text in rows:
        before = words_in(text)
        words = before if i is None else planted(i, before)
        changed += words != before
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        wanted.append((i, len(runs), *best, milli, sha(lines), sha(brute_collapsed(words, runs))))
    result = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in result.dtypes[1:6]] == ["bigint"] * 5
    assert sorted(map(tuple, result.collect()), key=ORDER) == sorted(wanted, key=ORDER)
    assert changed > 20 and QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001").count() == 200
