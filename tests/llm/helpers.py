"""Small inputs with everything that operators must stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["id", "no", "h1", "v", "p", "key", "low", "fp", "kept", "kept_id", "kept_lines", "gone", "spans", "place", "c0"]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["an", "the", "or", "ti", "on", "éa", "sch", "qu", "ly", "nd"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words))


def documents(spark, rows):
    """A ``documents`` table of (id, text) rows, with extra columns whose names clash with inner ones."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def awkward(extra=()):
    """Null ids, null and empty texts, white space, repeated rows, a long text."""
    return [
        (None, "a null id has a line of its own"),
        (1, None),
        (2, ""),
        (3, " \n\t\n"),
        (4, prose(1, 60)),
        (4, prose(1, 60)),
        (5, prose(1, 60)),
        (6, prose(2, 40_000)),
        (7, "x" * 200_000),
        *extra,
    ]
