"""One rule operator for every validation table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# (parsed document, its top-level keys) -> output columns and ordered rules
Build = Callable[[Column, Column], tuple[dict[str, Column], list[tuple[str, Column]]]]


def violations(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """One row per broken rule: the key columns and the rule's name.

    A rule is a predicate that must hold; NULL counts as broken. Narrow: no shuffle, rows without a finding vanish.
    """
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules.items()]),
        lambda r: r.isNotNull(),
    )
    return df.select(*keys, F.explode(broken).alias("rule"))


def checked_documents(df: DataFrame, document: str, schema: str, build: Build) -> tuple[DataFrame, DataFrame]:
    """Parse every document once and split the rows into good ones and rejects.

    ``build(parsed, keys)`` returns the output columns and the rules in order. Rows are kept or dropped by a generator
    over the one parsed value, so no filter can inline the parse a second time. Typed parsing is strict: a number of
    the wrong kind, or a text where a number belongs, reads as NULL and breaks its rule.
    """
    others = [c for c in df.columns if c != document]

    def parse(text: Column) -> Column:
        return F.struct(F.from_json(text, schema).alias("d"), F.json_object_keys(text).alias("k"))

    def row(r: Column) -> Column:
        columns, rules = build(r["d"], r["k"])
        reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])
        return F.struct(*[c.alias(n) for n, c in columns.items()], reason.alias("reject_reason"))

    rows = F.transform(F.transform(F.array(F.col(document)), parse), row)
    good = df.select(*others, F.inline(F.filter(rows, lambda r: r["reject_reason"].isNull()))).drop("reject_reason")
    rejects = F.transform(F.filter(rows, lambda r: r["reject_reason"].isNotNull()), lambda r: r["reject_reason"])
    return good, df.select("*", F.explode(rejects).alias("reject_reason"))


def exactly(keys: Column, wanted: Sequence[str]) -> Column:
    return (F.size(keys) == len(wanted)) & (
        F.size(F.array_except(keys, F.array(*[F.lit(k) for k in wanted]))) == 0
    )
