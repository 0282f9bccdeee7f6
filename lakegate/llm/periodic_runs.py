"""Runs of periodic words, found as branching squares in the intervals of an enhanced suffix array."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import arrow_rows, text_column, words_of

WORDS_AT_ONCE = 200_000  # words of the texts that share one suffix array; a longer text has its own
SUFFIXES_AT_ONCE = 1 << 20  # suffixes whose neighbours at a depth are looked up together


class _Codes:
    """Numbers for words, text by text: what is kept of a text is 4 bytes a word."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}

    def of(self, raw: bytes) -> np.ndarray:
        parts = []
        for words in words_of(raw):
            coded = pa.array(words, pa.binary()).dictionary_encode()
            ids = [self.ids.setdefault(w, len(self.ids)) for w in coded.dictionary.to_pylist()]
            parts.append(np.array(ids, np.int32)[coded.indices.to_numpy()] if words else np.zeros(0, np.int32))
        return np.concatenate(parts)


def _candidates(symbols: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: float) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that may hold a run, each ended by a symbol of its own, and the position of every symbol.

    Every word of a run comes as often in its text as the run has whole periods. Symbols tell texts apart, so nothing
    ever matches across two texts.
    """
    _, symbols, times = np.unique(doc.astype(np.int64) << 32 | symbols, return_inverse=True, return_counts=True)
    often = times[symbols] >= math.floor(min_exponent)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]]).astype(np.int8)) | _new_doc(doc, often))
    start, end = edge[:-1], edge[1:]
    long = often[start] & (end - start >= min_length) if len(edge) > 1 else np.zeros(0, bool)
    start, end = start[long], end[long]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = end - start + 1
    first = np.cumsum(sizes) - sizes
    position = np.arange(sizes.sum()) - np.repeat(first - start, sizes)
    own = first + sizes - 1  # the place of each stretch's end mark
    symbols = symbols[np.minimum(position, len(symbols) - 1)]
    symbols[own] = len(times) + np.arange(len(own))
    return symbols, position


def _new_doc(doc: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Where a text begins inside a stretch of frequent words, as one entry more than there are words."""
    change = np.zeros(len(doc) + 1, bool)
    change[1:-1] = (doc[1:] != doc[:-1]) & often[1:] & often[:-1]
    return change


def _ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... symbols, until they differ; ties share the rank of their first.

    Only suffixes still tied are sorted again. A tied one has its symbols, and one after them, inside the array, as the
    last symbol is unlike all others.
    """
    sorted_symbols = np.sort(symbols)
    rank = np.searchsorted(sorted_symbols, symbols, "left").astype(np.int32)
    levels = [rank]
    tied = np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)
    step = 1
    while len(tied):
        by = rank[tied].astype(np.int64) * len(rank) + rank[tied + step]
        order = np.argsort(by, kind="stable")
        tied, by = tied[order], by[order]
        place = np.arange(len(by))
        group = rank[tied]
        first_of_class = np.maximum.accumulate(np.where(np.diff(by, prepend=-1) != 0, place, 0))
        first_of_group = np.maximum.accumulate(np.where(np.diff(group, prepend=-1) != 0, place, 0))
        rank = rank.copy()
        rank[tied] = group + (first_of_class - first_of_group).astype(np.int32)
        levels.append(rank)
        alone = np.bincount(first_of_class, minlength=len(by))[first_of_class] == 1
        tied = tied[~alone]
        step *= 2
    return levels


def _common_prefixes(suffixes: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in order; -1 in front and behind."""
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        same = levels[level][a] == levels[level][b]
        a[same] += 1 << level
        b[same] += 1 << level
    return np.concatenate([[-1], b - suffixes[1:], [-1]])


def _children(prefixes: np.ndarray) -> tuple[np.ndarray, ...]:
    """All children but the largest of each interval: (depth, interval's first, last, child's first, last) places.

    An interval of depth d ends where a shorter prefix stands, and its places with prefix d part its children. One pass
    with a stack of open parting places finds both; no tree is built.
    """
    values = prefixes.tolist()
    stack = [0]  # parting places, one for each depth
    owner = {0: 0}  # the first parting place of the interval that an open one belongs to
    left: list[int] = []  # children to the left of each parting place ...
    right: list[int] = []
    whose: list[int] = []
    ends: dict[int, tuple[int, int]] = {}  # interval -> its first and last place
    for i in range(1, len(values)):
        value = values[i]
        while len(stack) > 1 and values[stack[-1]] > value:
            last = stack.pop()
            head = owner.pop(last)
            left.append(last)  # ... and the child behind the last one
            right.append(i - 1)
            whose.append(head)
            ends[head] = (ends[head][0], i - 1)
        if value <= 0:  # depth 0 holds everything and no square
            stack, owner = [i], {i: i}
            continue
        top = stack[-1]
        if values[top] == value:
            stack.pop()
            head = owner.pop(top)
        else:
            head = i
            ends[i] = (top, top)
        left.append(top)
        right.append(i - 1)
        whose.append(head)
        stack.append(i)
        owner[i] = head
    if not whose:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    a, b, head = np.array(left), np.array(right), np.array(whose)
    order = np.lexsort((a - b, head))
    smaller = order[1:][head[order][1:] == head[order][:-1]]  # the first of each interval is its largest child
    a, b, head = a[smaller], b[smaller], head[smaller]
    bounds = np.zeros((len(values), 2), np.int64)
    bounds[list(ends)] = list(ends.values())
    return prefixes[head], bounds[head, 0], bounds[head, 1], a, b


def _squares(suffixes: np.ndarray, rank: np.ndarray, prefixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all branching squares: repeated once, and followed by another symbol.

    A suffix and the one ``depth`` symbols on (or back) make a square if both stand in the interval of that depth, and
    it branches if they stand in different children. Looking from the smaller children is enough to see each pair.
    """
    depth, low, high, a, b = _children(prefixes)
    starts, periods = [], []
    done = np.concatenate([[0], np.cumsum(b - a + 1)])
    at = 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(done, done[at] + SUFFIXES_AT_ONCE, "right")) - 1)
        sizes = (b - a + 1)[at:to]
        child = np.repeat(np.arange(at, to), sizes)
        suffix = suffixes[np.arange(sizes.sum()) - np.repeat(done[at:to] - done[at] - a[at:to], sizes)]
        d = depth[child]
        for other, start in ((suffix + d, suffix), (suffix - d, suffix - d)):
            inside = (other >= 0) & (other < len(rank))
            place = rank[np.where(inside, other, 0)]
            inside &= (place >= low[child]) & (place <= high[child]) & ((place < a[child]) | (place > b[child]))
            starts.append(start[inside])
            periods.append(d[inside])
        at = to
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _runs(symbols: np.ndarray, min_length: int, min_exponent: float) -> np.ndarray:
    """Rows (start, length, period) of all runs of an array whose last symbol is unlike all others.

    A branching square is the last of its run; rotating it to the left as long as the symbols agree gives the run's
    start. Squares of several periods that give one run leave it with the smallest.
    """
    levels = _ranks(symbols)
    rank = levels[-1].astype(np.int64)
    suffixes = np.empty(len(rank), np.int64)
    suffixes[rank] = np.arange(len(rank))
    start, period = _squares(suffixes, rank, _common_prefixes(suffixes, levels))
    end = start + 2 * period
    for level in range(len(levels) - 1, -1, -1):
        before = start - (1 << level)
        same = before >= 0
        same &= levels[level][np.where(same, before, 0)] == levels[level][np.where(same, before + period, 0)]
        start = np.where(same, before, start)
    length = end - start
    fits = (length >= min_length) & (length >= min_exponent * period)
    start, length, period = start[fits], length[fits], period[fits]
    order = np.lexsort((period, length, start))
    rows = np.stack([start[order], length[order], period[order]], axis=1)
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


def _found(texts: list[np.ndarray], min_length: int, min_exponent: float) -> dict[int, np.ndarray]:
    """Rows (start, length, period), ordered by start and period, of each text that has runs."""
    sizes = np.array([len(t) for t in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    if not len(doc):
        return {}
    symbols, position = _candidates(np.concatenate(texts), doc, min_length, min_exponent)
    if not len(symbols):
        return {}
    rows = _runs(symbols, min_length, min_exponent)
    rows[:, 0] = position[rows[:, 0]]
    of = doc[rows[:, 0]]
    rows[:, 0] -= (np.cumsum(sizes) - sizes)[of]
    order = np.lexsort((rows[:, 2], rows[:, 0], of))
    rows, of = rows[order], of[order]
    cuts = np.flatnonzero(np.diff(of)) + 1
    return dict(zip(of[np.concatenate([[0], cuts])].tolist(), np.split(rows, cuts), strict=True)) if len(of) else {}


def _collapsed(raw: bytes, n_words: int, runs: np.ndarray | None) -> str:
    """The words that no run holds after its first period, joined by one blank."""
    if runs is None:
        return b" ".join(b" ".join(words) for words in words_of(raw) if words).decode()
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    stays = np.cumsum(change[:-1]) == 0
    kept, at = [], 0
    for words in words_of(raw):
        kept += [words[i] for i in np.flatnonzero(stays[at : at + len(words)])]
        at += len(words)
    return b" ".join(kept).decode()


def find(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_exponent: float = 4
) -> DataFrame:
    """(id, n_words, runs, collapsed) for each row: the runs of its words, and its text without their repetitions.

    Words stand between ASCII white space. A run is a stretch whose words ``period`` apart agree, with the smallest such
    period, that no neighbouring word extends; it has ``min_length`` words or more and is ``min_exponent`` (2 at least)
    periods long or more. Runs are structs (start, length, period) ordered by start, then period. ``collapsed`` leaves out
    every word that any run holds after its first period, and joins the others by one blank.

    The texts of a batch share a suffix array over the words that come often enough in their own text to be part of a
    run, with an alphabet of its own for each text. Everything happens inside one task: no shuffle, any skew is
    harmless. Work grows with n log n of the words of a text, whatever their order.

    Null ids pass through; null texts count as empty: no words, no runs, an empty text. A very long text is worked on
    whole, with some 100 bytes a word that may be part of a run. Repeated rows give repeated rows; there are no ties; an
    empty table gives an empty one; other columns are not read.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")

    def group(rows: list[tuple], codes: list[np.ndarray]) -> Iterator[tuple]:
        found = _found(codes, min_length, min_exponent)
        for i, ((key, raw), code) in enumerate(zip(rows, codes, strict=True)):
            runs = found.get(i)
            listed = [] if runs is None else [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()]
            yield key, len(code), listed, _collapsed(raw, len(code), runs)

    def rows(columns: list[list]) -> Iterable[tuple]:
        held, codes, words, numbers = [], [], 0, _Codes()
        for key, text in zip(*columns, strict=True):
            raw = text.encode()
            code = numbers.of(raw)
            if held and words + len(code) > WORDS_AT_ONCE:
                yield from group(held, codes)
                held, codes, words = [], [], 0
            held.append((key, raw))
            codes.append(code)
            words += len(code)
        yield from group(held, codes)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return arrow_rows(docs, [F.col(id_col), text_column(text_col)], rows, schema)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One flat row for each row of :func:`find`'s result: counts, the longest run and digests."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    longest = found.withColumn("best", best)
    return longest.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
