from __future__ import annotations

import random

import pytest

from lakegate.llm import line_dedup
from tests.llm.helpers import CLASHING, awkward, documents, prose


def distance_at_most_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def brute_force(rows, edits, least):
    forms = {}
    for key, text in rows:
        for no, line in enumerate((text or "").encode().split(b"\n")):
            form = b" ".join(line.lower().split()).decode()
            if len(form) >= least:
                place = (key is None, key or 0, no)
                forms[form] = min(forms.get(form, place), place)
    gone = {
        f for f, p in forms.items() if edits and any(q < p and distance_at_most_one(f, g) for g, q in forms.items() if f != g)
    }
    out = []
    for key, text in rows:
        if text is None:
            out.append((key, None))
            continue
        kept = []
        for no, line in enumerate(text.encode().split(b"\n")):
            form = b" ".join(line.lower().split()).decode()
            if len(form) < least or (form not in gone and forms[form] == (key is None, key or 0, no)):
                kept.append(line.decode())
        out.append((key, "\n".join(kept)))
    return out


def edited(line: str, rng: random.Random) -> str:
    at = rng.randrange(len(line))
    return rng.choice([line[:at] + line[at + 1 :], line[:at] + "é" + line[at:], line[:at] + "z" + line[at + 1 :]])


def sort(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))


@pytest.mark.parametrize("edits", [0, 1])
def test_equals_brute_force(spark, edits):
    rng = random.Random(5)
    lines = [prose(i, rng.randint(3, 14)) for i in range(60)]
    pool = [*lines, *[edited(rng.choice(lines), rng) for _ in range(60)]]
    pool += [edited(x, rng) for x in pool[60:]] + [x.upper() for x in lines[:5]] + ["  " + x + "\t" for x in lines[5:9]]
    pool += ["ab", "", "aaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaab", "tokens 1234567890123", "tokens 1234567890124"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 9)))) for i in rng.sample(range(1000), 90)]
    rows = awkward(rows)
    got = line_dedup.dedup(documents(spark, rows), max_edits=edits, min_chars=20)
    assert got.columns == documents(spark, rows[:1]).columns and set(CLASHING) < set(got.columns)
    assert sort([(r.doc_id, r.text) for r in got.collect()]) == sort(brute_force(rows, edits, 20))


def test_one_id_with_two_texts(spark):
    a, b = "a first line that is long enough", "another line that is long enough"
    rows = [(1, f"{a}\n{b}"), (1, f"{b}\n{a}")]
    got = line_dedup.dedup(documents(spark, rows))
    assert sorted(r.text for r in got.collect()) == sorted([a, b])


def test_common_line_and_many_variants(spark):
    """A third of all rows hold one line; a bucket of hundreds of lines is reduced, not paired."""
    common = "this line is in a third of all documents"
    rows = [(i, common if i % 3 == 0 else f"entry number {chr(0x4E00 + i)} of a long list") for i in range(600)]
    got = {r.doc_id: r.text for r in line_dedup.dedup(documents(spark, rows)).collect()}
    assert got[0] == common and got[1] == rows[1][1]
    assert all(t == "" for i, t in got.items() if i > 1)


def test_variants_of_every_position():
    for form in ("a", "ab", "aab", prose(3, 9), "x" * 40):
        deleted, whole = line_dedup.deletion_hashes(form)
        assert len(deleted) == len(form)
        for p in range(len(form)):
            assert int(deleted[p]) == line_dedup.deletion_hashes(form[:p] + form[p + 1 :])[1]


def test_empty_table_and_bounds(spark):
    assert line_dedup.dedup(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        line_dedup.dedup(documents(spark, []), max_edits=2)


def equal_or_near(rows, least):
    """Brute force: all lines that are not blank take part in equality, those of ``least`` characters in edits."""
    equal = brute_force(rows, 0, 1)
    near = [None if t is None else t.split("\n") for _, t in brute_force(rows, 1, least)]
    out = []
    for (key, text), lines in zip(equal, near, strict=True):
        if text is None:
            out.append((key, None))
            continue
        form = lambda x: b" ".join(x.encode().lower().split()).decode()
        left = {form(x) for x in lines}
        out.append((key, "\n".join(x for x in text.split("\n") if len(form(x)) < least or form(x) in left)))
    return out


def test_short_lines_that_repeat_go(spark):
    rng = random.Random(6)
    short = ["}", "é", "  Yes. ", "yes.", "YES.", "the last line", "the last lines", "", " \t", "nineteen characters", "twenty characters ok"]
    long = [prose(i, 9) for i in range(8)]
    pool = [*short, *long, *[edited(x, rng) for x in long]]
    rows = awkward([(i, "\n".join(rng.choices(pool, k=rng.randint(1, 8)))) for i in rng.sample(range(100, 900), 60)])
    got = sort([(r.doc_id, r.text) for r in line_dedup.dedup(documents(spark, rows)).collect()])
    assert got == sort(equal_or_near(rows, 20))
    kept = [line for _, t in got if t is not None for line in t.split("\n")]
    assert kept.count("}") == 1 and kept.count("the last line") == kept.count("the last lines") == 1 and kept.count("") > 5
