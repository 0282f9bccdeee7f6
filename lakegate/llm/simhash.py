"""SimHash near-dedup: fingerprints of shingles, linked by equal one-wildcard variants of their segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import arrow_rows, free_names, materialised, sized, text_column, words_of
from lakegate.llm.graph import components

SEED = 42
BITS = 64
SMALL = 64  # fingerprints of one bucket that are compared in pairs; larger buckets are cut again
LEAST_WIDTH = 8  # below this many open bits a bucket cannot hold more than 2 ** (8 + 3) fingerprints


def fingerprint_of(raw: bytes, shingle: int = 3) -> int:
    """Bit j is set if it is set in over half of the shingles' XXH64; 0 without words."""
    from xxhash import xxh64_intdigest

    ones, total, carry = np.zeros(BITS, np.int64), 0, []
    seen = False
    for words in words_of(raw.lower()):  # bytes: A-Z only
        carry += words
        if len(carry) < shingle:
            continue
        seen = True
        columns = [carry[k : len(carry) - shingle + 1 + k] for k in range(shingle)]
        hashes = [xxh64_intdigest(b" ".join(ws), SEED) for ws in zip(*columns, strict=True)]
        for at in range(0, len(hashes), 1 << 15):
            part = np.array(hashes[at : at + (1 << 15)], "<u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
        carry = carry[len(carry) - shingle + 1 :]
    if not seen:
        return xxh64_intdigest(b" ".join(carry), SEED) if carry else 0
    return int(sum(1 << j for j in np.flatnonzero(ones * 2 > total).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fingerprint as signed 64-bit long) of every row."""

    def rows(columns: list[list]) -> Iterator[tuple]:
        for key, text in zip(*columns, strict=True):
            value = fingerprint_of(text.encode(), shingle)
            yield key, value - (1 << 64) if value >> 63 else value

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_rows(docs, [F.col(id_col), text_column(text_col)], rows, f"`{id_col}` {kind}, fingerprint long")


def _variants(members: DataFrame, width: int) -> DataFrame:
    """Each member under the one-wildcard variants of both halves of its open bits; the other half stays open."""
    half = width // 2
    made = []
    for side in (0, 1):
        low = F.col("low") + F.lit(side * half)
        part = F.call_function("shiftrightunsigned", F.col("fp"), low).bitwiseAND(F.lit((1 << half) - 1))
        for bit in range(half):
            key = F.xxhash64("key", low, F.lit(bit), part.bitwiseAND(F.lit(((1 << half) - 1) & ~(1 << bit))))
            made.append(F.struct(key.alias("key"), (F.col("low") + F.lit((1 - side) * half)).alias("low")))
    return members.select("fp", F.explode(F.array(*made)).alias("v")).select("v.key", "v.low", "fp")


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): all pairs a < b of the distinct fingerprints in column ``fp`` that differ in ``max_bits`` bits or fewer.

    Of the two halves of up to three differing bits, one has at most one of them, so both fingerprints share a variant
    of that half with that bit left out: all variants are joined by equality and each pair is verified. Buckets over
    ``SMALL`` members are not paired; their members go on with variants of the half that is still open, again and again,
    so all links come out and no bucket is ever paired in full that could be large.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3: of two segments one must differ by at most one bit")
    # Each row becomes BITS rows, so short rows are dealt to all tasks first.
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = distinct.repartition(partitions, "fp").select(F.lit(0).cast("long").alias("key"), F.lit(0).alias("low"), "fp")
    width, found = BITS, []
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    while True:
        variants = _variants(members, width)
        width //= 2
        sizes = variants.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        sizes = materialised(sizes.where("n > 1"), "buckets")
        found.append(sizes.where("n = 2").where(near).select("a", "b"))
        more = sized(sizes.where("n > 2").select("key", "n"))
        if more.isEmpty():
            break
        shared = materialised(variants.join(more, "key"), "members")
        last = width <= LEAST_WIDTH
        few = shared if last else shared.where(F.col("n") <= SMALL)
        pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key")
        found.append(pairs.where("a < b").where(near).select("a", "b"))
        members = shared.where(F.col("n") > SMALL).select("key", "low", "fp")
        if last or members.isEmpty():
            break
    result = found[0]
    for part in found[1:]:
        result = result.union(part)
    return result.where("a != b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(id, fingerprint, component_id) for every row: 16 hexadecimal digits, and the smallest id it is linked to.

    Words are runs of non-white-space after lower-casing A-Z; shingles of ``shingle`` words are hashed with XXH64. Rows
    with equal fingerprints are one node, however many they are; distinct nodes are linked at ``max_bits`` differing
    bits or fewer, and linked through other nodes. Texts without words (null or empty) share fingerprint 0, which is
    linked like any other. Null ids keep a row but are no component's id, unless the component has no other (then
    null). Repeated rows and ids get one result row each; an empty table gives an empty one; other columns are not read.
    """
    found = materialised(
        fingerprints(docs, id_col, text_col, shingle).select(F.col(id_col).alias("id"), F.col("fingerprint").alias("fp")),
        "fingerprints",
    )
    nodes = materialised(found.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    linked = materialised(components(links(nodes.select("fp"), max_bits)), "components")
    joined = nodes.join(linked, nodes["fp"] == linked["node"])
    firsts = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    moved = joined.select("fp", "component").join(firsts, "component").select("fp", "component_id")
    # Nodes without links keep their own first id; one row a fingerprint, so the last join makes no row more.
    ids = nodes.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return found.join(ids, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def first_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id; null ids come last, ties go by content.

    Of repeated rows one stays. All columns stay.
    """
    name, other = free_names(docs, "row_key", "gone_key")
    key = F.struct(F.col(id_col).isNull().alias("z"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    keyed = docs.withColumn(name, key)
    found = near_duplicates(keyed.select(name, text_col), name, text_col, shingle, max_bits)
    found = materialised(found.groupBy(name).agg(F.min("component_id").alias("least"), F.count(F.lit(1)).alias("n")), "keys")
    gone = found.where(~F.col(name).eqNullSafe(F.col("least"))).select(F.col(name).alias(other))
    kept = keyed.join(gone, F.col(name).eqNullSafe(F.col(other)), "left_anti")
    twice = found.where((F.col("n") > 1) & F.col(name).eqNullSafe(F.col("least"))).select(F.col(name).alias(other))
    if not twice.isEmpty():
        same = F.col(name).eqNullSafe(F.col(other))
        kept = kept.join(twice, same, "left_anti").union(kept.join(twice, same, "left_semi").dropDuplicates([name]))
    return kept.select(*docs.columns)
