"""Content fingerprints that Spark can compute in one partial aggregation, and an order-aware digest as a tree."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.functions.base import quoted
from lakegate.operators.ordering import with_row_number

LANES = (1, 16, 31, 46)
LANE_DIGITS = 15
LIMBS, LIMB_BITS = 3, 20
PART_BITS = LIMBS * LIMB_BITS
FAN_IN = 4096


def schema_fingerprint(schema: T.StructType) -> str:
    """Digest of names, types and nullability, in order."""
    described = json.dumps([[f.name, f.dataType.simpleString(), f.nullable] for f in schema.fields])
    return hashlib.sha256(described.encode()).hexdigest()


def encode_value(value: Column, kind: T.DataType) -> Column:
    """Text that tells values and types apart: NULL is ``N``, anything else starts with ``V``.

    Texts carry their length, and numbers, dates and the like end with a ``;`` they cannot contain, so no two rows
    with different values read the same.
    """
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        tagged = F.concat(F.lit("V"), value.cast("string"), F.lit(";"))
    elif isinstance(kind, T.TimestampType):  # an instant reads differently in every session zone
        tagged = F.concat(F.lit("Vi"), F.unix_micros(value).cast("string"), F.lit(";"))
    elif isinstance(kind, (T.DateType, T.TimestampNTZType)):
        tagged = F.concat(F.lit("Vt"), value.cast("string"), F.lit(";"))
    elif isinstance(kind, T.BinaryType):
        tagged = F.concat(F.lit("Vb"), F.lower(F.hex(value)), F.lit(";"))
    elif isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda v: encode_value(v, kind.elementType))
        tagged = F.concat(F.lit("V["), F.array_join(items, ""), F.lit("]"))
    elif isinstance(kind, T.StructType):
        members = [encode_value(value.getField(f.name), f.dataType) for f in kind.fields]
        tagged = F.when(value.isNotNull(), F.concat(F.lit("V{"), *members, F.lit("}")))
    elif isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        pairs = F.transform(F.map_entries(value), lambda e: encode_value(e, entry))
        tagged = F.concat(F.lit("Vm"), F.array_join(F.array_sort(pairs), ""), F.lit("]"))
    else:
        body = value.cast("string")
        tagged = F.concat(F.lit("V"), F.length(body).cast("string"), F.lit(":"), body)
    return F.coalesce(tagged, F.lit("N"))


def row_digest(schema: T.StructType) -> Column:
    """SHA-256 of one row in schema order."""
    return F.sha2(F.concat(*[encode_value(F.col(quoted(f.name)), f.dataType) for f in schema.fields]), 256)


def lane_sums(digest: Column) -> dict[str, Column]:
    """Sums of four 60-bit parts of hex digests: commutative and mergeable, so partial aggregation does the work.

    Each part is added up as three 20-bit limbs in plain 64-bit integers, which cannot overflow below 2**43 rows and
    is much faster than decimal sums. :func:`lane_totals` puts the limbs together again.
    """
    return limb_sums([F.conv(F.substring(digest, start, LANE_DIGITS), 16, 10).cast("bigint") for start in LANES])


def lane_parts(digest: Column) -> Column:
    """The four parts of hex digests that :func:`lane_sums` adds up, as a struct (``p0`` to ``p3``).

    Cut out of the digest's bytes in Arrow batches, which takes a fraction of the time of ``conv`` where every row of a
    table has a digest; :func:`limb_sums` adds them up.
    """

    @F.arrow_udf(", ".join(f"p{lane} bigint" for lane in range(len(LANES))))
    def parts(digests: pa.Array) -> pa.Array:
        fixed = digests.cast(pa.binary(32))
        words = np.frombuffer(fixed.buffers()[1], ">u8", 4 * len(fixed), 32 * fixed.offset).astype(np.uint64).reshape(-1, 4)
        cut = []
        for lane in range(len(LANES)):
            word, bit = divmod(lane * PART_BITS, 64)
            value = words[:, word] << np.uint64(bit)
            if bit:
                value |= words[:, word + 1] >> np.uint64(64 - bit)
            cut.append(pa.array((value >> np.uint64(64 - PART_BITS)).astype(np.int64)))
        return pa.StructArray.from_arrays(cut, names=[f"p{lane}" for lane in range(len(LANES))])

    return parts(F.unhex(digest))


def limb_sums(parts: Sequence[Column]) -> dict[str, Column]:
    """Sums of the limbs of four 60-bit numbers, see :func:`lane_sums`."""
    sums = {}
    for lane, part in enumerate(parts):
        for limb in range(LIMBS):
            bits = F.shiftright(part, LIMB_BITS * limb).bitwiseAND((1 << LIMB_BITS) - 1)
            sums[f"_l{lane}_{limb}"] = F.coalesce(F.sum(bits), F.lit(0))
    return sums


def lane_totals() -> list[Column]:
    """The lane sums as decimal texts."""

    def total(lane: int) -> Column:
        limbs = [
            F.col(f"_l{lane}_{limb}").cast("decimal(20,0)") * F.lit(1 << (LIMB_BITS * limb)).cast("decimal(14,0)")
            for limb in range(LIMBS)
        ]
        return reduce(lambda a, b: a + b, limbs).cast("decimal(38,0)").cast("string")

    return [total(lane) for lane in range(len(LANES))]


def table_fingerprint(
    df: DataFrame, by: Sequence[str] = (), as_stored: bool = False, body: Sequence[str] | None = None
) -> DataFrame:
    """Row count and order-free content digest of a frame, or of every group of it.

    Duplicates count, order does not, and any changed cell changes the digest. The schema takes part through its
    own digest; ``as_stored`` describes it as Parquet gives it back, with every column nullable. ``body`` names the
    columns that make up the content, if that is not all: the digest then says nothing of the others, not even of ``by``.
    One pass, no collected rows, no shuffle beyond one short row per task and group.
    """
    content = df.schema if body is None else T.StructType([df.schema[c] for c in body])
    seen = T.StructType([T.StructField(f.name, f.dataType) for f in content.fields]) if as_stored else content
    described = schema_fingerprint(seen)
    hashed_fields = T.StructType([f for f in content.fields if body is not None or f.name not in by])
    hashed = df.select(*[F.col(quoted(c)) for c in by], lane_parts(row_digest(hashed_fields)).alias("_h"))
    sums = limb_sums([F.col(f"_h.p{lane}") for lane in range(len(LANES))])
    summed = hashed.groupBy(*[F.col(quoted(c)) for c in by]).agg(
        F.count(F.lit(1)).alias("row_count"), *[c.alias(n) for n, c in sums.items()]
    )
    lanes = [f"lane_{i}" for i in range(len(LANES))]
    totals = summed.select(*by, "row_count", *[t.alias(n) for n, t in zip(lanes, lane_totals(), strict=True)])
    digest = F.sha2(F.concat_ws("|", F.lit(described), F.col("row_count").cast("string"), *lanes), 256)
    return totals.select(*by, "row_count", digest.alias("content_digest"), *lanes)


def fingerprint_of(df: DataFrame, as_stored: bool = False) -> tuple[int, str]:
    """Count and digest of a frame as plain values (one aggregated row comes to the driver)."""
    row = table_fingerprint(df, as_stored=as_stored).select("row_count", "content_digest").first()
    assert row is not None
    return row["row_count"], row["content_digest"]


def digest_tree(
    numbered: DataFrame, index: str, digest: str, fan_in: int = FAN_IN, unique: Sequence[str] = ()
) -> DataFrame:
    """Fold ordered digests level by level, ``fan_in`` neighbours at a time, until one is left.

    No task ever holds more than ``fan_in`` digests, whatever the size of the table. Equal ``unique`` keys are
    neighbours in the order; every node carries its first and last key, so they are noticed on the way up, without a
    pass of their own.
    """
    total = numbered.count()
    key = F.struct(*[F.col(quoted(c)) for c in unique]) if unique else F.lit(None).cast("string")
    level = numbered.select(
        F.col(index).alias("i"), F.col(digest).alias("h"), key.alias("first"), key.alias("last")
    )
    members, place = F.col("members"), lambda j: F.get(F.col("members"), j)
    repeated = F.exists(
        F.when(F.size(members) > 1, F.sequence(F.lit(1), F.size(members) - 1)),
        lambda j: place(j)["first"] == place(j - 1)["last"],
    )
    folded = F.sha2(F.array_join(F.transform(members, lambda m: m["h"]), ""), 256)
    if unique:
        refused = F.raise_error(F.lit(f"{list(unique)!r} are not unique, so the row order is undefined"))
        folded = F.when(F.coalesce(repeated, F.lit(False)), refused.cast("string")).otherwise(folded)
    remaining = total
    while remaining > 1:
        level = (
            level.groupBy(F.expr(f"i div {fan_in}").alias("g"))
            .agg(F.array_sort(F.collect_list(F.struct("i", "h", "first", "last"))).alias("members"))
            .select(
                F.col("g").alias("i"),
                folded.alias("h"),
                place(F.lit(0))["first"].alias("first"),
                F.element_at("members", -1)["last"].alias("last"),
            )
        )
        remaining = -(-remaining // fan_in)
    return level.select(F.lit(total).alias("row_count"), F.col("h").alias("ordered_digest"))


def ordered_digest(df: DataFrame, keys: Sequence[str], fan_in: int = FAN_IN) -> DataFrame:
    """Digest that depends on row order along ``keys``; the result raises if they are not unique."""
    hashed = df.select(*keys, row_digest(df.schema).alias("_h"))
    return digest_tree(with_row_number(hashed, keys), "row_index", "_h", fan_in, keys)


def text_digests(value: Column) -> dict[str, Column]:
    return {"sha256": F.sha2(value.cast("binary"), 256), "md5": F.md5(value.cast("binary"))}


