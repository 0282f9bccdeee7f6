"""Best-fit packing of token sequences into bins of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import ceil_div, release, small_batches, text_column

# Fixed values.
END = b"\xff"  # closes each document; no byte of UTF-8 text
CAPACITIES = (4096, 8192, 16384, 32768)
SHARD_TOKENS = 1 << 24


def sequence_cost(capacity: int) -> float:
    """What training on one sequence costs: its tokens, and as much as 256 tokens for having one more sequence."""
    return capacity + 256


def best_fit(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = sequence_cost
) -> list[tuple[int, list[int]]]:
    """Bins as (capacity, positions in ``lengths``) for lengths in decreasing order, none above the largest capacity.

    Each piece goes to the open bin that it leaves the least room in. If it fits into none, a bin is opened: for every
    permitted capacity, the bin is filled for trial with the longest pieces still to come, and the capacity of least
    cost a token wins (the smaller one on ties). At the end each bin shrinks to the smallest capacity that holds it.
    """
    sizes = sorted(capacities)
    falling = [-n for n in lengths]
    rooms: list[tuple[int, int]] = []  # (room, bin) in order
    bins: list[list[int]] = []
    room_of: list[int] = []
    for at, length in enumerate(lengths):
        where = bisect_left(rooms, (length, -1))
        if where < len(rooms):
            room, index = rooms.pop(where)
        else:
            best = None
            for size in sizes:
                if size < length:
                    continue
                room, nxt = size - length, at + 1
                while room and (nxt := bisect_left(falling, -room, nxt)) < len(falling):
                    room -= lengths[nxt]
                    nxt += 1
                price = cost(size) / (size - room) if size > room else cost(size)
                if best is None or price < best[0]:
                    best = (price, size)
            index, room = len(bins), best[1]
            bins.append([])
            room_of.append(best[1])
        bins[index].append(at)
        if room > length:
            insort(rooms, (room - length, index))
    out = []
    for members in bins:
        used = sum(lengths[i] for i in members)
        out.append((next(s for s in sizes if s >= used), members))
    return out


def pieces(docs: DataFrame, id_col: str, text_col: str, longest: int) -> DataFrame:
    """Documents as byte-level tokens, cut every ``longest`` tokens: (id, piece, start, length, data)."""
    data = text_column(text_col).cast("binary")
    whole = docs.select(F.col(id_col).alias("id"), data.alias("data")).withColumn("total", F.octet_length("data") + 1)
    last = F.floor((F.col("total") - 1) / F.lit(longest)).cast("int")
    cut = whole.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece") * F.lit(longest)
    return cut.select(
        "id",
        "piece",
        start.alias("start"),
        F.least(F.lit(longest), F.col("total") - start).alias("length"),
        F.substring("data", start + 1, F.lit(longest)).alias("data"),
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per packed sequence: sequence_id, capacity, n_tokens, pieces, tokens.

    Tokens are the UTF-8 bytes of the text and one ``END`` byte after each document; documents longer than the largest
    capacity are cut there, and every token of every document is in exactly one sequence. ``pieces`` names, in order,
    each piece's id, number, first token in its document, length, and offset in the sequence. Pieces are dealt evenly
    (round robin, so no key can be hot) into shards of about ``shard_tokens`` tokens, each packed alone in one task:
    a shard's memory is bounded, and the text is shuffled once.

    Null ids stay null; null and empty texts are an ``END`` byte alone; repeated rows are packed as often as they come;
    ties in length go by id, piece and content; an empty table gives an empty one; other columns are not read.
    """
    sizes = sorted(set(capacities))
    if not sizes or sizes[0] < 1:
        raise ValueError("capacities must be positive")
    total = docs.agg(F.sum(F.octet_length(text_column(text_col)).cast("long") + 1)).first()[0] or 0
    dealt = pieces(docs, id_col, text_col, sizes[-1]).repartition(ceil_div(total, shard_tokens))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        "sequence_id long, capacity int, n_tokens int, pieces array<struct<doc_id:"
        f"{kind},piece:int,start:long,length:int,offset:int>>, tokens binary"
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    target = docs.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
        rows.sort(key=lambda r: (-r[3], r[0] is None, 0 if r[0] is None else r[0], r[1], r[4]))
        shard = TaskContext.get().partitionId() << 32
        made: list[dict] = []
        for number, (capacity, members) in enumerate(best_fit([r[3] for r in rows], sizes, cost)):
            listed, data, offset = [], [], 0
            for i in members:
                key, piece, start, length, part = rows[i]
                listed.append({"doc_id": key, "piece": piece, "start": start, "length": length, "offset": offset})
                data.append(part + END if len(part) < length else part)
                offset += length
            made.append(
                {
                    "sequence_id": shard + number,
                    "capacity": capacity,
                    "n_tokens": offset,
                    "pieces": listed,
                    "tokens": b"".join(data),
                }
            )
            if len(made) >= 256:
                yield pa.RecordBatch.from_pylist(made, schema=arrow)
                made = []
        yield pa.RecordBatch.from_pylist(made, schema=arrow)
        del rows, made
        release()

    return small_batches(dealt).mapInArrow(run, target)
