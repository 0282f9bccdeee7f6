"""The closed set of normalisation steps, each a plain ``DataFrame -> DataFrame`` callable.

Steps check names against the live schema, so every step sees what the step before it produced. Each step adds one
projection or filter; Catalyst merges them and pushes filters and column pruning into the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from functools import lru_cache, reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.errors import TransformFailure
from lakegate.functions.base import quoted

Step = Callable[[DataFrame], DataFrame]


def _require(df: DataFrame, names: Iterable[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise TransformFailure(f"{what} {missing!r} not in the schema; available: {', '.join(sorted(df.columns))}")


def _unique(names: Sequence[str]) -> None:
    twice = sorted({n for n in names if list(names).count(n) > 1})
    if twice:
        raise TransformFailure(f"column names would be duplicated: {twice!r}")


@dataclass(frozen=True)
class Filter:
    """Keep rows whose predicate is true; a NULL predicate drops the row."""

    predicate: Column | str

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.where(self.predicate)


@dataclass(frozen=True)
class SelectColumns:
    """Keep the named columns, in the given order."""

    columns: Sequence[str]

    def __post_init__(self) -> None:
        if not self.columns:
            raise ValueError("select at least one column")

    def __call__(self, df: DataFrame) -> DataFrame:
        _require(df, self.columns, "columns")
        return df.select(*[F.col(quoted(c)) for c in self.columns])


@dataclass(frozen=True)
class RenameColumns:
    """Rename by ``old -> new``; other columns pass through."""

    mapping: Mapping[str, str]

    def __call__(self, df: DataFrame) -> DataFrame:
        _require(df, self.mapping, "columns to rename")
        _unique([self.mapping.get(c, c) for c in df.columns])
        return df.withColumnsRenamed(dict(self.mapping))


_EXACT_INTEGERS = {"float": 2**24, "double": 2**53}


_EXACT_DIGITS = {"float": 6, "double": 15}  # significant digits that always survive
_DATE = r"^\s*[+-]?\d{4,7}(?:-\d{1,2}){0,2}"


def _digits(number: Column) -> Column:
    """The significant digits of a number's text, without sign, point, exponent and outer zeros."""
    mantissa = F.regexp_replace(F.split(number, "[eE]")[0], "[^0-9]", "")
    return F.regexp_replace(mantissa, "^0+|0+$", "")


def _kept_text(value: Column, tried: Column, target: T.DataType) -> Column:
    """Whether a text that can be read as ``target`` holds nothing that the value read from it lacks."""
    name = target.simpleString()
    if isinstance(target, T.DateType):
        return value.rlike(rf"{_DATE}\s*$")
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        time = r"[0-9:.]*" if isinstance(target, T.TimestampNTZType) else r".*"  # a wall clock has no zone
        return value.rlike(rf"{_DATE}(?:[ T]{time})?\s*$") & ~value.rlike(r"\.\d{6}\d*[1-9]")
    if name in _EXACT_DIGITS:
        digits = _digits(value)
        same = (F.length(digits) <= _EXACT_DIGITS[name]) | (digits == _digits(tried.cast("string")))
        bounded = (tried != 0) & (F.abs(tried) < F.lit(float("inf")).cast(target))
        return (digits == "") | (same & bounded)
    if isinstance(target, T.DecimalType):
        wide = value.try_cast("decimal(38,18)")
        short = value.rlike(r"^\s*[+-]?\d*\.?\d{0,9}[eE][+-]?\d\s*$")
        fraction = F.regexp_extract(value, r"\.(\d*?)0*\s*$", 1)
        return F.when(value.rlike("[eE]"), short & tried.try_cast("decimal(38,18)").eqNullSafe(wide)).otherwise(
            F.length(fraction) <= target.scale
        )
    return F.lit(True)


def _scalar_cast(value: Column, source: T.DataType, target: T.DataType) -> tuple[Column | None, Column, str]:
    """(whether nothing is lost, the cast value, what would be lost) for plain types; NULL always passes.

    The first is None where Spark's own cast loses nothing, or raises.
    """
    name = target.simpleString()
    plain, tried = value.cast(target), value.try_cast(target)
    if isinstance(source, T.StringType) and not isinstance(target, (T.StringType, T.BinaryType)):
        return value.isNull() | (tried.isNotNull() & _kept_text(value, tried, target)), tried, "loss"
    if isinstance(source, T.BinaryType) and isinstance(target, T.StringType):
        return value.isNull() | F.is_valid_utf8(plain), plain, "no UTF-8"
    if isinstance(source, T.IntegralType) and isinstance(target, T.FractionalType) and name in _EXACT_INTEGERS:
        bound = _EXACT_INTEGERS[name]
        return value.isNull() | value.between(-bound, bound), plain, "precision"
    if isinstance(source, T.NumericType) and isinstance(target, T.NumericType):
        if isinstance(source, T.IntegralType) and not isinstance(target, (T.IntegralType, T.DecimalType)):
            return None, plain, ""
        kept = tried.isNotNull()
        if not (isinstance(source, T.IntegralType) and isinstance(target, T.IntegralType)):
            kept = kept & (tried.cast(source).eqNullSafe(value) | F.isnan(value.cast("double")))
            if isinstance(target, T.IntegralType):
                kept = kept & ~F.isnan(value.cast("double"))
        return value.isNull() | kept, tried, "loss"
    if isinstance(source, T.NumericType) and isinstance(target, T.BooleanType):
        return value.isNull() | value.isin(0, 1), plain, "loss"
    if isinstance(source, T.NumericType) and isinstance(target, T.TimestampType):
        return value.isNull() | (tried.isNotNull() & tried.try_cast(source).eqNullSafe(value)), tried, "no such instant"
    if isinstance(source, T.TimestampType) and isinstance(target, T.NumericType):
        return value.isNull() | plain.cast(T.TimestampType()).eqNullSafe(value), plain, "fraction of a second"
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)) and isinstance(target, T.DateType):
        return plain.cast(source).eqNullSafe(value), plain, "time of day"
    return None, plain, ""


def _shown(value: Column, source: T.DataType) -> Column:
    return F.hex(value) if isinstance(source, T.BinaryType) else value.cast("string")


def safe_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that raises instead of losing anything: overflow, fractions, precision, zones, unreadable text.

    Texts must hold just what their target can: no time of day for a date, no zone for a wall clock, nothing finer than a
    microsecond, no digits beyond a decimal's scale or a float's precision, nothing too large or too small for a float.
    Bytes must be UTF-8 to become text; numbers must be seconds that Spark can tell as an instant.
    """
    name = target.simpleString()
    if source == target:
        return value
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(value, lambda v: safe_cast(v, source.elementType, target.elementType))
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                safe_cast(e["key"], source.keyType, target.keyType).alias("key"),
                safe_cast(e["value"], source.valueType, target.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        if len(source.fields) != len(target.fields):
            raise TransformFailure(f"cannot cast {source.simpleString()} to {name}: other number of fields")
        members = [  # by position, as Spark casts structs
            safe_cast(value.getField(a.name), a.dataType, b.dataType).alias(b.name)
            for a, b in zip(source.fields, target.fields, strict=True)
        ]
        return F.when(value.isNotNull(), F.struct(*members))
    kept, cast, reason = _scalar_cast(value, source, target)
    if kept is None:
        return cast
    message = F.concat(F.lit(f"unsafe cast to {name} ({reason}): "), _shown(value, source))
    return F.when(kept, cast).otherwise(F.raise_error(message).cast(target))


def cast_rejects(df: DataFrame, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """The cells that :class:`CastSchema` would stop at, one row each: ``key`` columns, column_name, target, reason, value.

    All of them are found in one pass without a shuffle, so a load can be cleared of them first. Plain types only.
    """
    _require(df, [*key, *schema.names], "columns")
    checks = []
    for f in schema.fields:
        source = df.schema[f.name].dataType
        if any(isinstance(t, (T.ArrayType, T.MapType, T.StructType)) for t in (source, f.dataType)):
            raise TransformFailure(f"{f.name!r} is nested; only plain columns can be checked cell by cell")
        kept, _, reason = _scalar_cast(F.col(quoted(f.name)), source, f.dataType)
        if source != f.dataType and kept is not None:
            cell = [f.name, f.dataType.simpleString(), reason]
            shown = _shown(F.col(quoted(f.name)), source)
            fault = F.struct(*[F.lit(c).alias(n) for c, n in zip(cell, ("column_name", "target", "reason"), strict=True)], shown.alias("value"))
            checks.append(F.when(~kept, fault))
    if not checks:
        nothing = [F.lit("").alias(n) for n in ("column_name", "target", "reason", "value")]
        return df.select(*[F.col(quoted(k)) for k in key], *nothing).where(F.lit(False))
    return df.select(*[F.col(quoted(k)) for k in key], F.inline(F.array_compact(F.array(*checks))))


@dataclass(frozen=True)
class CastSchema:
    """Cast the whole frame to a schema with the same column names, without silent loss."""

    schema: T.StructType

    def __call__(self, df: DataFrame) -> DataFrame:
        if self.schema.names != df.columns:
            raise TransformFailure(f"target columns {self.schema.names!r} differ from {df.columns!r}")
        return df.select(
            *[
                safe_cast(F.col(quoted(f.name)), df.schema[f.name].dataType, f.dataType).alias(f.name)
                for f in self.schema.fields
            ]
        )


_UNITS = {"us": 1, "ms": 1_000, "s": 1_000_000}  # microseconds


@lru_cache(maxsize=64)
def zone_irregularities(zone: str, first_year: int, last_year: int) -> tuple[tuple[datetime, datetime], ...]:
    """Local intervals of a zone that do not exist or happen twice (one pair per clock change)."""
    tz = ZoneInfo(zone)

    def offset(at: datetime) -> timedelta:
        return at.astimezone(tz).utcoffset() or timedelta(0)

    out: list[tuple[datetime, datetime]] = []
    step = timedelta(hours=12)
    at, end = datetime(first_year, 1, 1, tzinfo=UTC), datetime(last_year + 1, 1, 1, tzinfo=UTC)
    before = offset(at)
    while at < end:
        after = offset(at + step)
        if after != before:
            low, high = at, at + step
            while high - low > timedelta(seconds=1):
                middle = low + timedelta(seconds=(high - low) // timedelta(seconds=2))
                low, high = (middle, high) if offset(middle) == before else (low, middle)
            change = high.replace(tzinfo=None)
            out.append((change + min(before, after), change + max(before, after)))
        before = after
        at += step
    return tuple(out)


def _irregular(value: Column, zone: str, first_year: int, last_year: int) -> Column:
    """True inside a clock change; the intervals sit in a constant array indexed by year, so a row sees only a few."""
    changes = zone_irregularities(zone, first_year, last_year)

    def moment(at: datetime) -> Column:
        return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")

    nothing = F.array().cast("array<struct<lo:timestamp_ntz,hi:timestamp_ntz>>")
    by_year = [
        F.array(*found) if found else nothing
        for year in range(first_year, last_year + 1)
        for found in [
            [F.struct(moment(lo).alias("lo"), moment(hi).alias("hi")) for lo, hi in changes if year in (lo.year, hi.year)]
        ]
    ]
    of_year = F.get(F.array(*by_year), F.year(value) - first_year)
    inside = F.coalesce(F.exists(of_year, lambda g: (value >= g["lo"]) & (value < g["hi"])), F.lit(False))
    return inside | ~F.coalesce(F.year(value).between(first_year, last_year), F.lit(True))


@dataclass(frozen=True)
class NormalizeTimestamps:
    """Bring every timestamp column to instants.

    Naive columns are read in ``assume_naive_tz``; a local time that does not exist or happens twice there raises, and
    so does one outside ``years``, for which clock changes are known. Instants carry no zone in Spark, so a
    ``target_tz`` other than UTC is the wall clock there, in naive columns. ``target_unit`` is ``us``, ``ms`` or ``s``; a
    value with a finer part raises.
    """

    assume_naive_tz: str = "UTC"
    target_tz: str = "UTC"
    target_unit: str = "us"
    years: tuple[int, int] = (1900, 2200)

    def __call__(self, df: DataFrame) -> DataFrame:
        if self.target_unit not in _UNITS:
            raise TransformFailure(f"unit {self.target_unit!r} is not one of {', '.join(_UNITS)}")
        return df.select(*[self._normal(F.col(quoted(f.name)), f).alias(f.name) for f in df.schema.fields])

    def _normal(self, value: Column, field: T.StructField) -> Column:
        if not isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return value
        if isinstance(field.dataType, T.TimestampNTZType):
            value = self._instant(value, field.name)
        if (size := _UNITS[self.target_unit]) > 1:
            message = F.concat(F.lit(f"{field.name}: finer than {self.target_unit}: "), value.cast("string"))
            whole = value.isNull() | (F.unix_micros(value) % size == 0)
            value = F.when(whole, value).otherwise(F.raise_error(message).cast("timestamp"))
        return value if self.target_tz == "UTC" else F.convert_timezone(
            F.lit("UTC"), F.lit(self.target_tz), F.convert_timezone(None, F.lit("UTC"), value.cast("timestamp_ntz"))
        )

    def _instant(self, value: Column, name: str) -> Column:
        zone = self.assume_naive_tz
        instant = F.make_timestamp_ltz(
            F.year(value),
            F.month(value),
            F.dayofmonth(value),
            F.hour(value),
            F.minute(value),
            F.extract(F.lit("SECOND"), value),
            F.lit(zone),
        )
        if not zone_irregularities(zone, *self.years):
            return instant
        message = F.concat(F.lit(f"{name}: ambiguous or missing local time in {zone}: "), value.cast("string"))
        return F.when(_irregular(value, zone, *self.years), F.raise_error(message).cast("timestamp")).otherwise(instant)


@dataclass(frozen=True)
class Flatten:
    """Turn struct fields into top-level columns, ``max_depth`` levels down; lists stay as they are."""

    max_depth: int = 1
    separator: str = "."

    def __post_init__(self) -> None:
        if self.max_depth < 1:
            raise ValueError("max_depth must be at least 1")

    def __call__(self, df: DataFrame) -> DataFrame:
        leaves = [
            leaf for f in df.schema.fields for leaf in self._leaves(F.col(quoted(f.name)), f.name, f.dataType, 0)
        ]
        _unique([name for name, _ in leaves])
        return df.select(*[value.alias(name) for name, value in leaves])

    def _leaves(self, value: Column, name: str, kind: T.DataType, depth: int) -> list[tuple[str, Column]]:
        if not isinstance(kind, T.StructType) or depth >= self.max_depth:
            return [(name, value)]
        return [
            leaf
            for f in kind.fields
            for leaf in self._leaves(value.getField(f.name), f"{name}{self.separator}{f.name}", f.dataType, depth + 1)
        ]


@dataclass(frozen=True)
class Steps:
    """Steps applied from left to right; reusable, and named for provenance."""

    steps: Sequence[Step] = field(default_factory=tuple)

    def __call__(self, df: DataFrame) -> DataFrame:
        return reduce(lambda d, step: d.transform(step), self.steps, df)

    @property
    def names(self) -> list[str]:
        return [getattr(s, "__name__", type(s).__name__) for s in self.steps]


def compose(steps: Iterable[Step]) -> Steps:
    return Steps(tuple(steps))


# Portal column types and their Spark types.
ADVISORY_TYPES: dict[str, T.DataType] = {
    "integer": T.LongType(),
    "int": T.LongType(),
    "number": T.DoubleType(),
    "float": T.DoubleType(),
    "string": T.StringType(),
    "text": T.StringType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampNTZType(),
}


def advisory_schema(columns: Iterable[Mapping[str, object]]) -> T.StructType:
    """Schema described by a portal; unknown types are strings, columns are nullable unless said otherwise."""
    return T.StructType(
        [
            T.StructField(
                str(c.get("name", "")),
                ADVISORY_TYPES.get(str(c.get("type", "")).lower(), T.StringType()),
                bool(c.get("nullable", True)),
            )
            for c in columns
        ]
    )


def preview(df: DataFrame, rows: int, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first rows, in a stated order when one is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def json_lines(df: DataFrame, name: str = "line") -> DataFrame:
    """Every row as one compact JSON text."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))
