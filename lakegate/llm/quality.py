"""Quality rules: heuristics of the text itself, and how much likelier trusted text makes its n-grams than raw text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import arrow_rows, release, small_batches, text_column, words_of
from lakegate.operators.ordering import with_row_number
from lakegate.session import materialised

# Fixed values.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
SENT = 5_000_000  # trusted ids that every executor may hold

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


class WordHashes(dict):
    """64-bit hashes of words, remembered for a bounded number of words."""

    def __init__(self, most: int = 50_000):
        from xxhash import xxh3_64_intdigest

        self.most, self.of = most, xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        value = self.of(word)
        if len(word) <= 64 and len(self) < self.most:
            self[word] = value
        return value

    def array(self, raw: bytes) -> np.ndarray:
        parts = [np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws)) for ws in words_of(raw)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def buckets_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of all words and of all pairs of neighbouring words."""
    one, two = np.uint64(_ODD[0]), np.uint64(_ODD[1])
    shift = np.uint64(64 - bits)
    left, right = hashes[:-1] * one, hashes[1:] * two
    pairs = (left ^ (right >> np.uint64(29)) ^ right) * np.uint64(_ODD[2])
    return np.concatenate([(hashes * one) >> shift, pairs >> shift]).astype(np.int64)


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that the text holds twice or more (windows are told apart by 64-bit hashes)."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    sums = np.zeros(n, np.uint64)
    for k in range(window):
        sums = (sums ^ (sums >> np.uint64(31))) * np.uint64(_ODD[3]) + hashes[k : k + n]
    order = np.argsort(sums, kind="stable")
    ranked = sums[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[starts] += 1
    edges[starts + window] -= 1
    return int((np.cumsum(edges)[:-1] > 0).sum())


def trusted_rows(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """All ids labelled 1 and never 0."""
    good = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias("_least"))
    return good.where("_least = 1").select(id_col)


def trusted_ids(labels: DataFrame, id_col: str, label_col: str, most: int) -> list[int]:
    """At most ``most`` trusted ids, by the order of their hashes: to look at some. Counts and threshold take all."""
    picked = trusted_rows(labels, id_col, label_col).orderBy(F.xxhash64(id_col), id_col).limit(most)
    return [r[0] for r in picked.collect()]


def with_trust(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, how: str = "left") -> DataFrame:
    """Ids and texts of ``docs`` and whether they are ``_trusted``. Ids are sent to all tasks up to ``SENT``, joined beyond."""
    sent = F.broadcast(trusted) if trusted.count() <= SENT else trusted
    joined = docs.select(id_col, text_col).join(sent.withColumn("_trusted", F.lit(True)), id_col, how)
    return joined.withColumn("_trusted", F.col("_trusted").isNotNull())


def ngram_counts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """(bucket, raw, target): counts over all texts and over the trusted ones, added up inside each task first."""
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, hashes = np.zeros(size, np.int64), np.zeros(size, np.int64), WordHashes()
        for batch in batches:
            for good, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found = np.bincount(buckets_of(hashes.array(text.encode()), bits), minlength=size)
                raw += found
                if good:
                    target += found
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"]
        )
        release()

    marked = with_trust(small_batches(docs), trusted, id_col, text_col)
    parts = marked.select("_trusted", text_column(text_col)).mapInArrow(count, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def bucket_counts(counts: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The counts of all buckets, raw and trusted. The number of buckets is fixed, whatever the input."""
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    for row in counts.collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log p(bucket | trusted) - log p(bucket | raw).

    The trusted counts are smoothed towards the raw distribution by the weight of one count a bucket, so buckets that
    neither side knows say nothing. Without trusted text all ratios are 0.
    """
    size = len(raw)
    p = (raw + 1) / (raw.sum() + size)
    return np.log((target + size * p) / (target.sum() + size) / p)


def ratio_without(found: np.ndarray, raw: np.ndarray, target: np.ndarray) -> float:
    """The mean ratio of a trusted text's buckets as the other trusted texts alone give it."""
    size, (used, own) = len(raw), np.unique(found, return_counts=True)
    p = (raw[used] + 1) / (raw.sum() + size)
    q = (target[used] - own + size * p) / (target.sum() - len(found) + size)
    return float((np.log(q / p) * own).sum() / len(found))


def percentiles(values: DataFrame, column: str, shares: Sequence[float]) -> list[float] | None:
    """Exact percentiles, interpolated between neighbours, by one ordered pass: no task holds all values. None of no rows."""
    numbered = with_row_number(values.select(column), [column])
    total = numbered.count()
    if not total:
        return None
    places = [share * (total - 1) for share in shares]
    wanted = {edge for place in places for edge in (int(place), -int(-place // 1))}
    at = {r["row_index"]: r[column] for r in numbered.where(F.col("row_index").isin(*wanted)).collect()}  # two a share
    edges = [(place, int(place), -int(-place // 1)) for place in places]
    return [at[low] if low == high else (high - place) * at[low] + (place - low) * at[high] for place, low, high in edges]


def measures(text: str, hashes: WordHashes, ratios: np.ndarray, bits: int) -> tuple[int, int, int, int, int, float]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and llr of one text."""
    found = hashes.array(text.encode())
    lines, again = set(), 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in lines:
                again += 1
            elif line.strip(SPACES):
                lines.add(line)
    llr = float(ratios[buckets_of(found, bits)].mean()) if len(found) else 0.0
    chars = len(text) - sum(map(text.count, SPACES))
    return len(found), chars, sum(map(text.count, SYMBOLS)), again, repeated_words(found), llr


def _scored(docs: DataFrame, id_col: str, text_col: str, ratios: np.ndarray, bits: int) -> DataFrame:
    """(id, measures, llr) of every row."""
    table = docs.sparkSession.sparkContext.broadcast(ratios)  # 2 ** bits numbers

    def rows(columns: list[list]) -> Iterator[tuple]:
        hashes = WordHashes()
        for key, text in zip(*columns, strict=True):
            yield key, *measures(text, hashes, table.value, bits)

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_rows(
        docs,
        [F.col(id_col), text_column(text_col)],
        rows,
        f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double",
    )


def _failed(min_words: int, max_repeat_percent: int) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    bits: int,
    spread: float,
    min_words: int,
    max_repeat_percent: int,
) -> tuple[np.ndarray, float]:
    """The ratios of all buckets and the threshold, see :func:`score`."""
    spark = docs.sparkSession
    trusted = materialised(trusted_rows(labels, id_col, label_col), "trusted")
    raw, target = bucket_counts(ngram_counts(docs, trusted, id_col, text_col, bits), bits)
    ratios = log_ratios(raw, target)
    table = spark.sparkContext.broadcast((raw, target))  # 2 ** bits numbers each

    def rows(columns: list[list]) -> Iterator[tuple]:
        hashes = WordHashes()
        for key, text in zip(*columns, strict=True):
            found = hashes.array(text.encode())
            if len(found) >= min_words and 100 * repeated_words(found) <= max_repeat_percent * len(found):
                yield key, ratio_without(buckets_of(found, bits), *table.value) if len(found) else 0.0

    texts = with_trust(docs, trusted, id_col, text_col, "inner")
    kind = docs.schema[id_col].dataType.simpleString()
    good = arrow_rows(texts, [F.col(id_col), text_column(text_col)], rows, f"`{id_col}` {kind}, llr double")
    each = good.groupBy(id_col).agg(F.min("llr").alias("llr"))
    found = percentiles(each, "llr", (0.01, 0.5))
    if found is None:
        return ratios, float("-inf")
    low, middle = found
    return ratios, middle - spread * (middle - low)


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    bits: int = 14,
    spread: float = 2.0,
    min_words: int = 20,
    max_repeat_percent: int = 30,
) -> DataFrame:
    """One row per row of ``docs``: the rules' measures, ``base_failed``, ``llr``, ``threshold`` and ``kept``.

    ``llr`` is the mean, over all words and pairs of neighbours, of the log-likelihood ratio of their hashed buckets
    between the multinomial of trusted texts (all ids of ``labels`` with ``label_col`` 1 and never 0) and that of all
    texts. Every trusted text that the rules pass is also scored by the counts of the
    others, without its own; with m the median of these scores and q the first percentile, the threshold is
    m - ``spread`` * (m - q), however many there are. A document is kept if it has ``min_words`` words, not more than
    ``max_repeat_percent`` % of them repeated in windows of eight, and a ``llr`` of the threshold or more: one test for
    every document, without a random draw. Only where no trusted text passes the rules do these decide alone.

    The counts cover all texts and are added up inside tasks before the only shuffle; skew is harmless. Null ids pass
    through and are never trusted; null and empty texts have no words (``llr`` 0) and fail; repeated rows count each;
    an empty table gives an empty one; other columns are not read. Memory grows with the longest text.
    """
    ratios, threshold = fitted(
        docs, labels, id_col, text_col, label_col, bits, spread, min_words, max_repeat_percent
    )
    return (
        _scored(docs, id_col, text_col, ratios, bits)
        .withColumn("base_failed", _failed(min_words, max_repeat_percent))
        .withColumn("threshold", F.lit(threshold))
        .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.col("threshold")))
    )


def keep(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    bits: int = 14,
    spread: float = 2.0,
    min_words: int = 20,
    max_repeat_percent: int = 30,
) -> DataFrame:
    """The rows of ``docs`` that :func:`score` keeps, with all columns. The verdict is a filter: nothing is joined.

    Repeated rows stay or go together; an empty table gives an empty one; columns pass through whatever their names.
    """
    ratios, threshold = fitted(
        docs, labels, id_col, text_col, label_col, bits, spread, min_words, max_repeat_percent
    )
    table = docs.sparkSession.sparkContext.broadcast(ratios)  # 2 ** bits numbers

    @F.pandas_udf("boolean")
    def passes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for texts in batches:
            verdicts = []
            for text in texts:
                n_words, _, _, _, repeats, llr = measures(text, hashes, table.value, bits)
                fails = n_words < min_words or 100 * repeats > max_repeat_percent * n_words
                verdicts.append(not fails and llr >= threshold)
            yield pd.Series(verdicts, dtype=bool)
        release()

    return small_batches(docs).where(passes(text_column(text_col)))
