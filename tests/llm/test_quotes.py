from __future__ import annotations

import random

from lakegate.llm import quotes
from tests.llm.helpers import prose

SCHEMA = "conv_id long, turn long, role string, text string, parent string, root int, row string, body int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


def test_nested_quotes_build_the_thread(spark):
    a = "First idea, over\ntwo lines.\n\nSecond paragraph of it."
    b = "> first  idea, over two\n> lines.\n\nI agree with that."
    c = ">> First idea, over two lines.\n> I agree with THAT.\n\nMe too."
    d = "> > Second paragraph of it.\n> nobody said this\nStray."
    e = "No quote at all."
    rows = [(1, 0, "user", a), (1, 1, "assistant", b), (1, 2, "user", c), (1, 3, "assistant", e), (1, 4, "user", d)]
    got = {r.turn: r for r in quotes.linked(table(spark, rows)).collect()}
    assert [got[t].parent for t in range(5)] == [None, 0, 1, None, 0]
    assert [got[t].root for t in range(5)] == [0, 0, 0, 3, 0]
    assert [got[t].depth for t in range(5)] == [0, 1, 2, 0, 1]
    assert [got[t].n_quoted for t in range(5)] == [0, 1, 2, 0, 2]
    assert [got[t].n_linked for t in range(5)] == [0, 1, 2, 0, 1]
    assert got[0].body == a and got[2].body == "Me too." and got[4].body == "Stray."
    (whole,) = quotes.conversations(table(spark, rows)).collect()
    assert whole.turns == [0, 1, 2, 4, 3] and whole.parents == [None, 0, 1, 0, None]
    assert whole.chat.startswith("<|user|>\nFirst idea") and whole.chat.endswith("<|assistant|>\nNo quote at all.\n<|end|>\n")
    assert ">" not in whole.chat.replace("|>", "")


def brute_force(rows):
    own = {}
    for conv, turn, _, text in rows:
        for level, norm in parsed(text):
            if level == 0 and turn is not None:
                own[conv, norm] = min(own.get((conv, norm), turn), turn)
    parent = {}
    for conv, turn, _, text in rows:
        best = {}
        for level, norm in parsed(text):
            if level and turn is not None and own.get((conv, norm), turn) < turn:
                best.setdefault(level, []).append(own[conv, norm])
        if best:
            level = min(best)
            old = parent.get((conv, turn))
            if old is None or level < old[0] or (level == old[0] and max(best[level]) > old[1]):
                parent[conv, turn] = (level, max(best[level]))
    return {k: v[1] for k, v in parent.items()}


def parsed(text):
    out, last = [], None
    for line in (text or "").split("\n"):
        level, rest = 0, line
        while rest.lstrip(" \t").startswith(">"):
            rest, level = rest.lstrip(" \t")[1:], level + 1
        norm = " ".join(rest.lower().split())
        if not norm:
            last = None
            continue
        if last == level:
            out[-1] = (level, out[-1][1] + " " + norm)
        else:
            out.append((level, norm))
        last = level
    return out


def test_links_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for conv in [None, *range(12)]:
        said = []
        for turn in range(rng.randint(1, 14)):
            parts = [prose(rng.randrange(40), 4) for _ in range(rng.randint(1, 2))]
            for quote in rng.sample(said, min(len(said), rng.randint(0, 2))):
                parts.insert(0, "\n".join(">" * rng.randint(1, 3) + " " + x for x in quote.split("\n")))
            said += parts
            rows.append((conv, turn, "user", "\n\n".join(parts)))
    rows += [(3, None, "user", "> " + prose(1, 4)), (4, 1, None, None), (4, 1, None, None), (5, 2, "user", "")]
    found = quotes.linked(table(spark, rows)).collect()
    want = brute_force(rows)
    assert len(found) == len(rows)
    assert {(r.conv_id, r.turn): r.parent for r in found if r.parent is not None} == want
    for r in found:
        root, depth = r.turn, 0
        while (r.conv_id, root) in want:
            root, depth = want[r.conv_id, root], depth + 1
        assert (r.root, r.depth) == (root, depth)


def test_long_chain_and_large_conversation(spark):
    """A chain of replies over several blocks; a conversation that holds most of the rows."""
    rows = [(7, t, "user", (f"> message number {t - 1}\n\n" if t else "") + f"message number {t}") for t in range(700)]
    rows += [(8, 0, "user", "same"), (8, 0, "user", "same")]
    got = {(r.conv_id, r.block): r for r in quotes.conversations(table(spark, rows)).collect()}
    assert sorted(got) == [(7, 0), (7, 1), (7, 2), (8, 0)]
    assert [t for b in range(3) for t in got[7, b].turns] == list(range(700))
    assert got[7, 2].n_messages == 700 - 512 and got[8, 0].turns == [0, 0]
    assert {r.depth for r in quotes.linked(table(spark, rows)).collect()} == set(range(700))


def test_empty_table(spark):
    assert quotes.conversations(table(spark, [])).collect() == []
