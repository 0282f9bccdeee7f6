"""Union by name with numeric widening and null filling, refused where it would lose or mix meanings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.errors import UnificationError
from lakegate.functions.base import quoted

_INTEGRAL_RANK = ("tinyint", "smallint", "int", "bigint")


def common_type(a: T.DataType, b: T.DataType, path: str) -> T.DataType:
    """The narrowest type holding both without mixing meanings."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = {a.simpleString(), b.simpleString()}
    if names <= set(_INTEGRAL_RANK):
        return max((a, b), key=lambda t: _INTEGRAL_RANK.index(t.simpleString()))
    if names <= {*_INTEGRAL_RANK, "float", "double"}:
        return T.DoubleType()
    if names == {"string", "binary"}:
        return T.BinaryType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType, f"{path}[]"), a.containsNull or b.containsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and _same_shape(a, b):
        return a
    raise UnificationError(
        f"{path}: {a.simpleString()} and {b.simpleString()} cannot be unified"
        " (normalise timestamps and align structs first)"
    )


def _same_shape(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]


def unified_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """Schema of the union; raises before any data is read."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            types[f.name] = common_type(types[f.name], f.dataType, f.name) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def unify(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name: integers widen, missing columns become NULL, text meets binary as binary."""
    if not frames:
        raise ValueError("nothing to unify")
    target = unified_schema([f.schema for f in frames])

    def aligned(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *[
                (F.col(quoted(f.name)) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in target.fields
            ]
        )

    return reduce(DataFrame.unionAll, [aligned(f) for f in frames])


def concat_shards(shards: Sequence[DataFrame]) -> DataFrame:
    """Strict union of shards with one schema; the shard number is kept, as a union has no order."""
    first = shards[0].schema
    for number, shard in enumerate(shards):
        if [(f.name, f.dataType) for f in shard.schema.fields] != [(f.name, f.dataType) for f in first.fields]:
            raise UnificationError(f"shard {number} differs in schema")
    return reduce(DataFrame.unionAll, [s.withColumn("shard", F.lit(n)) for n, s in enumerate(shards)])
