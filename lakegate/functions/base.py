"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(value: str) -> Column:
    return F.lit(value)


def case(branches: Iterable[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """First matching branch wins."""
    out: Column | None = None
    for condition, value in branches:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    assert out is not None
    return out if otherwise is None else out.otherwise(otherwise)


def lookup(key: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """Map a key through a small fixed table, as an expression rather than a join."""
    return case([(key == k, F.lit(v)) for k, v in table.items()], default)


def contains_any(value: Column, parts: Iterable[str]) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | value.contains(part)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    Repeating a costly expression (a parse, a set of patterns) inside conditions defeats common-subexpression
    elimination, and filters on derived columns inline it again; a bound lambda variable cannot be duplicated.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
