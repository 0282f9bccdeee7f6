"""Suffix-array dedup: bytes inside long strings that occur again anywhere in the corpus go."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import arrow_rows, materialised, sized, small_batches, text_column

LOOKUP_ROWS = 4_000_000  # rows of 17 bytes that scans may look up in memory; beyond, joins shuffle the anchors
GROUP_WINDOWS = 50_000  # windows of one anchor that one task sorts; beyond, their strings are counted one by one
BATCH_WINDOWS = 20_000  # windows that are sorted together, whole groups of them
BLOCK = 1 << 20  # bytes of a text that are looked at together

ONCE, SOURCE, COVERED, CROWDED = 0, 1, 2, 3  # what is known of a window, see _windows()

_BASE = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, from running ones inside blocks of that width."""
    n = len(values)
    fill = np.uint64(0xFFFFFFFFFFFFFFFF if pick is np.minimum else 0)
    blocks = np.concatenate([values, np.full(-n % width, fill)]).reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - width + 1], ahead[width - 1 : n])


class Anchors:
    """Places that depend only on what stands around them: every string of ``size`` bytes has one at least.

    Of the hashes of all ``core`` bytes in a row, the smallest inside each string of ``size`` bytes marks an anchor (all
    of them on ties). Equal strings thus have their anchors at equal places.
    """

    def __init__(self, size: int, core: int):
        self.size, self.core, self.width = size, core, size - core + 1
        room = BLOCK + 2 * size
        self.powers, self.inverse = _powers(_BASE, room), _powers(pow(_BASE, -1, 1 << 64), room)

    def _block(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        n = len(raw)
        codes = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * self.powers[:n], dtype=np.uint64)])
        hashes = (sums[self.core :] - sums[: -self.core]) * self.inverse[: n - self.core + 1]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(_MIX)
        hashes ^= hashes >> np.uint64(29)
        least = _slide(hashes, self.width, np.minimum)
        edge = np.zeros(self.width - 1, np.uint64)
        places = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), self.width, np.maximum) == hashes)
        return places, hashes[places]

    def of(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of all anchors of a text."""
        parts = [
            (places + at, hashes)
            for at in range(0, max(0, len(raw) - self.size) + 1, BLOCK)
            if len(block := raw[at : at + BLOCK + self.size - 1]) >= self.size
            for places, hashes in [self._block(block)]
        ]
        if len(parts) < 2:
            return parts[0] if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        places, first = np.unique(np.concatenate([p for p, _ in parts]), return_index=True)
        return places, np.concatenate([h for _, h in parts])[first]

    def window(self, raw: bytes, place: int) -> tuple[bytes, bytes]:
        """What can belong to a string of ``size`` bytes around the anchor: before it, and from it on."""
        return raw[max(0, place - self.width + 1) : place], raw[place : place + self.size]


def _window_hash(left: bytes, right: bytes) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(left + b"\xff" + right)


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges that touch or overlap."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], ends[np.concatenate([new[1:], [True]])]


def _counted(texts: DataFrame, anchors: Anchors, only: np.ndarray | None, with_window: bool) -> DataFrame:
    """Anchors of all texts, or those of sorted ``only``, with counts: (anchor, n) or (anchor, window, n)."""
    listed = None if only is None else texts.sparkSession.sparkContext.broadcast(only)  # LOOKUP_ROWS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, windows = [], []
            for raw in batch.column(2).to_pylist():
                places, hashes = anchors.of(raw)
                if listed is not None and len(places):
                    near = np.searchsorted(listed.value, hashes)
                    near[near == len(listed.value)] = 0
                    known = listed.value[near] == hashes
                    places, hashes = places[known], hashes[known]
                found.append(hashes)
                if with_window:
                    windows += [_window_hash(*anchors.window(raw, p)) for p in places.tolist()]
            # What a batch repeats goes out once, so common strings are few rows.
            columns = [np.concatenate(found), *([np.array(windows, np.uint64)] if with_window else [])]
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
            new = np.ones(len(order), bool)
            if len(order):
                new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            first = np.flatnonzero(new)
            counts = np.diff(np.concatenate([first, [len(order)]]))
            arrays = [pa.array(c[first].view(np.int64)) for c in columns] + [pa.array(counts)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["anchor", *(["window"] if with_window else []), "n"]
    return small_batches(texts).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _windows(texts: DataFrame, anchors: Anchors, lookup_rows: int) -> DataFrame:
    """(anchor, window, kind) of every distinct window that matters.

    A window of which there are two is COVERED wherever it stands, as all of its strings are repeated. If an anchor has
    windows of several kinds, and one of them but once, that one (ONCE) must be compared with the others (SOURCE, when
    they are covered themselves). If an anchor has more windows than one task should sort, they are CROWDED.
    """
    seen = _counted(texts, anchors, None, False).groupBy("anchor").agg(F.sum("n").alias("n"))
    repeated = materialised(seen.where("n > 1").select("anchor"), "anchors")
    only = None
    if repeated.count() <= lookup_rows:
        only = np.sort(repeated.toArrow()["anchor"].to_numpy().view(np.uint64))
    windows = _counted(texts, anchors, only, True).groupBy("anchor", "window").agg(F.sum("n").alias("n"))
    windows = materialised(windows, "windows")
    groups = windows.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    groups = materialised(groups.where("kinds > 1 and least = 1"), "groups")
    joined = windows.join(groups, "anchor", "left")
    kind = (
        F.when(F.col("kinds").isNull(), F.when(F.col("n") > 1, COVERED))
        .when(F.col("kinds") > GROUP_WINDOWS, F.when(F.col("n") > 1, COVERED).otherwise(CROWDED))
        .when(F.col("n") > 1, SOURCE)
        .otherwise(ONCE)
    )
    # Covered windows of a crowded anchor are partners of the others there: their strings are counted, too.
    kind = F.when((F.col("kinds") > GROUP_WINDOWS) & (F.col("n") > 1), CROWDED).otherwise(kind)
    found = joined.select("anchor", "window", kind.cast("tinyint").alias("kind"), (F.col("n") > 1).alias("twice"))
    return materialised(found.where("kind is not null"), "kinds")


def _placed(texts: DataFrame, anchors: Anchors, kinds: DataFrame) -> DataFrame:
    """(tk, n_bytes, hits) by joins: the anchors of each text that matter."""

    def rows(columns: list[list]) -> Iterator[tuple]:
        for tk, size, raw in zip(*columns, strict=True):
            places, hashes = anchors.of(raw)
            for place, value in zip(places.tolist(), hashes.view(np.int64).tolist(), strict=True):
                window = np.uint64(_window_hash(*anchors.window(raw, place))).view(np.int64)
                yield tk, size, place, value, int(window)

    found = arrow_rows(
        texts, [F.col(c) for c in texts.columns], rows, "tk long, n_bytes int, place int, anchor long, window long"
    )
    hits = found.join(kinds, ["anchor", "window"]).groupBy("tk", "n_bytes")
    # Copies of a text have equal hits, so a set holds each once: as many as the text has anchors.
    return hits.agg(F.collect_set(F.struct("place", "anchor", "window", "kind", "twice")).alias("hits"))


_FOUND = (
    "tk long, n_bytes int, start int, end int, anchor long, window long, place int, once boolean, "
    "left binary, right binary, string binary"
)


def _found(texts: DataFrame, anchors: Anchors, kinds: DataFrame, lookup_rows: int) -> DataFrame:
    """What the texts hold: covered ranges (start, end), windows to compare (anchor), strings to count (string)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = texts.sparkSession
    schema = spark.createDataFrame([], _FOUND).schema
    arrow, names = to_arrow_schema(schema), schema.names
    table = None
    if kinds.count() <= lookup_rows:
        listed = kinds.toArrow()
        columns = [listed[c].to_numpy() for c in ("anchor", "window", "kind", "twice")]
        columns = [c.view(np.uint64) if c.dtype == np.int64 else c for c in columns]
        order = np.lexsort((columns[1], columns[0]))
        table = spark.sparkContext.broadcast([c[order] for c in columns])  # 18 bytes a row
    else:
        placed = _placed(texts, anchors, kinds)
        texts = texts.alias("t").join(placed.alias("p"), ["tk", "n_bytes"]).select("tk", "n_bytes", "data", "hits")

    def looked_up(raw: bytes) -> Iterator[tuple]:
        listed, windows, kind, twice = table.value
        places, hashes = anchors.of(raw)
        lo, hi = np.searchsorted(listed, hashes, "left"), np.searchsorted(listed, hashes, "right")
        for place, a, b, value in zip(places.tolist(), lo.tolist(), hi.tolist(), hashes, strict=True):
            if a < b:
                window = np.uint64(_window_hash(*anchors.window(raw, place)))
                at = a + int(np.searchsorted(windows[a:b], window))
                if at < b and windows[at] == window:
                    yield place, int(value.view(np.int64)), int(window.view(np.int64)), int(kind[at]), bool(twice[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        sent: set[tuple[int, int]] = set()
        empty = dict.fromkeys(names)
        for batch in batches:
            out: list[dict] = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                tk, size, raw = row[:3]
                hits = looked_up(raw) if table is not None else [tuple(h.values()) for h in row[3]]
                of, ranges, strings = empty | {"tk": tk, "n_bytes": size}, [], set()
                for place, anchor, window, kind, twice in hits:
                    left, right = anchors.window(raw, place)
                    if twice:
                        if len(left) + len(right) >= anchors.size:
                            ranges.append((place - len(left), place + len(right)))
                        # Of a covered window, one place a task is enough to compare others with.
                        if kind == COVERED or kind == SOURCE and (anchor, window) in sent:
                            continue
                        if kind == SOURCE and len(sent) < LOOKUP_ROWS:
                            sent.add((anchor, window))
                    if kind == CROWDED:
                        strings.update(range(place - len(left), place + len(right) - anchors.size + 1))
                    else:
                        part = {"anchor": anchor, "window": window, "place": place, "once": not twice}
                        out.append(of | part | {"left": left, "right": right})
                if ranges:
                    starts, ends = _merged(*np.array(ranges, np.int64).T)
                    out += [of | {"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                out += [of | {"start": s, "string": xxh3_128_digest(raw[s : s + anchors.size])} for s in strings]
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return small_batches(texts).mapInArrow(run, schema)


class Columns:
    """Column-wise sorting of windows that are aligned at their anchors, through sequential files.

    Columns are taken from the last to the first; each round puts one symbol in front of every window's suffix. The
    order of the new suffixes is that of the symbols, read in the order of the old ones (the round's Burrows-Wheeler
    transform), kept stable; the prefix that neighbours have in common is one longer than the least common prefix
    between them in the old order, if their symbols are equal, else empty. The symbols, the order and the common
    prefixes are files, read and written from front to back once a round.
    """

    MISSING = 0xFF  # no byte of UTF-8: before the beginning or behind the end of a text

    def __init__(self, folder: str, size: int, width: int):
        self.folder, self.size, self.width = folder, size, width
        self.columns = width - 1 + size

    def _file(self, name: str) -> str:
        return os.path.join(self.folder, name)

    def repeated(self, windows: list[tuple[bytes, bytes]]) -> np.ndarray:
        """For each window and start, whether the string of ``size`` bytes from there stands in another window, too."""
        m = len(windows)
        table = np.full((m, self.columns), self.MISSING, np.uint8)
        for row, (left, right) in zip(table, windows, strict=True):
            row[self.width - 1 - len(left) : self.width - 1] = np.frombuffer(left, np.uint8)
            row[self.width - 1 : self.width - 1 + len(right)] = np.frombuffer(right, np.uint8)
        table.T[::-1].tofile(self._file("symbols"))  # the last column first
        del table
        np.arange(m, dtype=np.int32).tofile(self._file("order"))
        np.zeros(m, np.int16).tofile(self._file("common"))
        flags = np.zeros((self.width, m), bool)
        with open(self._file("symbols"), "rb") as symbols:
            for column in range(self.columns - 1, -1, -1):
                text = np.fromfile(symbols, np.uint8, m)
                order, common = np.fromfile(self._file("order"), np.int32), np.fromfile(self._file("common"), np.int16)
                transform = text[order]
                moved = np.argsort(transform, kind="stable")
                ranked = transform[moved]
                same = (ranked[1:] == ranked[:-1]) & (ranked[1:] != self.MISSING)
                fresh = np.zeros(m, np.int16)
                if same.any():
                    lo, hi = moved[:-1][same] + 1, moved[1:][same] + 1
                    # Least common prefix of the old order from behind one suffix up to the other.
                    padded = np.append(common, np.int16(0))
                    least = np.minimum.reduceat(padded, np.column_stack([lo, hi]).ravel())[::2]
                    fresh[1:][same] = np.minimum(least + 1, self.size)
                order = order[moved]
                order.tofile(self._file("order"))
                fresh.tofile(self._file("common"))
                if column < self.width:
                    pairs = np.flatnonzero(fresh >= self.size)
                    flags[column, order[pairs]] = True
                    flags[column, order[pairs - 1]] = True
        return flags.T


def _compared(found: DataFrame, anchors: Anchors) -> DataFrame:
    """(tk, n_bytes, start, end): covered ranges of the windows that stand once, anchor by anchor."""
    names = ["anchor", "window", "once", "tk", "n_bytes", "place", "left", "right"]
    windows = found.where("anchor is not null").select(*names)
    dealt = windows.repartition("anchor").sortWithinPartitions("anchor", "window")
    size, width = anchors.size, anchors.width

    def ranges(rows: list[tuple], folder: str) -> pa.RecordBatch:
        flags = Columns(folder, size, width).repeated([(r[6], r[7]) for r in rows])
        out: list[tuple] = []
        for row, marks in zip(rows, flags, strict=True):
            if row[2] and marks.any():
                starts = np.flatnonzero(marks) + (row[5] - width + 1)
                a, b = _merged(starts, starts + size)
                out += [(row[3], row[4], s, e) for s, e in zip(a.tolist(), b.tolist(), strict=True)]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["tk", "n_bytes", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:  # scratch of this task alone
            waiting: list[tuple] = []
            for batch in batches:
                for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    # A source comes once from each task that met it.
                    if waiting and row[:2] == waiting[-1][:2]:
                        continue
                    if len(waiting) >= BATCH_WINDOWS and row[0] != waiting[-1][0]:
                        yield ranges(waiting, folder)
                        waiting = []
                    waiting.append(row)
            if waiting:
                yield ranges(waiting, folder)

    return small_batches(dealt).mapInArrow(run, "tk long, n_bytes int, start int, end int")


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_bytes: int = 200,
    core_bytes: int = 96,
    lookup_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes, n_removed, n_spans and ``kept``, the remaining bytes.

    A byte goes if a string of ``min_bytes`` bytes over it also starts anywhere else in the texts' UTF-8 bytes, the same
    text included; all strings are judged on the input, and none goes beyond its text.

    Every string of that length has an anchor, chosen by content alone, so equal strings meet at equal anchors. Anchors
    are counted first; only those seen twice go on, with the window of bytes that strings around them can reach. Equal
    windows cover each other; an anchor's different windows are sorted column by column (see :class:`Columns`). Anchors
    and windows are added up before they are shuffled; anchors with very many different windows have their strings
    counted by hash, which spreads them; so no group grows with the corpus.

    Null ids pass through; null and empty texts have no bytes; copies (repeated rows, too) are strings that start
    elsewhere, so they go as a whole; an empty table gives an empty one; other columns are not read.
    """
    if not 0 < core_bytes < min_bytes <= 10_000:
        raise ValueError("core_bytes must be above 0 and below min_bytes, min_bytes 10 000 at most")
    anchors = Anchors(min_bytes, core_bytes)
    data = text_column(text_col)
    whole = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(data).alias("tk"),
        F.octet_length(data).alias("n_bytes"),
        data.cast("binary").alias("data"),
    )
    texts = whole.where(F.col("n_bytes") >= min_bytes).select("tk", "n_bytes", "data")
    kinds = _windows(texts, anchors, lookup_rows)
    found = materialised(_found(texts, anchors, kinds, lookup_rows), "found")
    covered = found.where("end is not null").select("tk", "n_bytes", "start", "end").union(_compared(found, anchors))
    strings = found.where("string is not null").select("tk", "n_bytes", "start", "string")
    often = sized(strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string"))
    crowded = strings.join(often, "string").select("tk", "n_bytes", "start", (F.col("start") + min_bytes).alias("end"))
    # As many ranges as the text has anchors, or as it has bytes where they are crowded.
    ranges = covered.union(crowded).groupBy(F.col("tk").alias("r_tk"), F.col("n_bytes").alias("r_bytes"))
    ranges = ranges.agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    joined = whole.join(ranges, (F.col("tk") == F.col("r_tk")) & (F.col("n_bytes") == F.col("r_bytes")), "left")

    def rows(columns: list[list]) -> Iterator[tuple]:
        for key, raw, listed in zip(*columns, strict=True):
            if not listed:
                yield key, len(raw), 0, 0, raw
                continue
            starts, ends = _merged(*np.array([(r["start"], r["end"]) for r in listed], np.int64).T)
            kept, at = [], 0
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                kept.append(raw[at:a])
                at = b
            yield key, len(raw), int((ends - starts).sum()), len(starts), b"".join([*kept, raw[at:]])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_rows(
        joined,
        [F.col("id"), F.col("data"), F.col("ranges")],
        rows,
        f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary",
    )
