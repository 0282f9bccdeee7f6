"""Token counts: lengths of frequent pre-tokens from a broadcast table, of all others through a cache in each worker."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import arrow_rows, per_process, text_column

# Fixed value: how a byte-level vocabulary cuts text into pre-tokens.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

GROUPS = 64  # sketches are merged in so many groups before the last merge
LONGEST_FREQUENT = 24  # characters of a word that the sketch follows
LONGEST_CACHED = 64  # characters of a pre-token that is worth a cache entry
SLICE = 1 << 20  # characters of a text that are cut into pre-tokens at once

_PIECES = regex.compile(SPLIT)
_CUT = regex.compile(r"(?<=\S) (?=\S)")  # no pre-token reaches over the place before such a blank


def frequent_words(docs: DataFrame, text_col: str = "text", words: int = 16_384, tracked: int = 65_536) -> list[str]:
    """The most frequent blank-separated words of all texts, by a mergeable sketch of frequent items.

    A sketch follows ``tracked`` words at most. Each task makes one, and sketches are what is shuffled, never words; so
    the size of what is sent depends on the number of tasks only. The answer is approximate, which the counts of tokens
    do not feel: it decides where a length is looked up, not what it is.
    """
    word = docs.select(F.explode(F.split(F.col(text_col).cast("string"), " ")).alias("word"))
    short = word.where(F.length("word").between(1, LONGEST_FREQUENT))
    sketches = short.groupBy((F.spark_partition_id() % GROUPS).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("sketch")
    )
    best = F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {words})").alias("best")
    merged = sketches.groupBy(F.lit("all")).agg(best).first()  # grouped, as partitions without a sketch have none to merge
    return [row["item"] for row in merged["best"]] if merged else []


def _tokenizer(definition: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work; a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_buffer(definition)


def _lengths(tokenizer, texts: list[str]) -> list[int]:
    return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _packed(tokenizer, words: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The table to broadcast: pre-tokens of the words, one behind the other, their sizes and numbers of tokens."""
    pieces = sorted({p for word in words for text in (word, " " + word) for p in _PIECES.findall(text)})
    encoded = [p.encode() for p in pieces]
    return b"".join(encoded), np.array([len(p) for p in encoded], np.uint16), np.array(_lengths(tokenizer, pieces), np.uint8)


class _Lengths(dict):
    """Tokens by pre-token: the frequent ones in the table itself, others in two generations of bounded size."""

    def __init__(self, definition: bytes, packed: tuple[bytes, np.ndarray, np.ndarray], cached: int):
        joined, sizes, lengths = packed
        ends = np.cumsum(sizes, dtype=np.int64)
        super().__init__(
            (joined[end - size : end].decode(), int(n)) for end, size, n in zip(ends, sizes.astype(np.int64), lengths, strict=True)
        )
        self.tokenizer = _tokenizer(definition)
        self.added = [t["content"] for t in json.loads(definition)["added_tokens"]]
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.limit = cached
        self.seen: set[str] = set(map(chr, range(128)))
        self.odd: set[str] = set()

    def __missing__(self, piece: str) -> int:
        n = self.young.get(piece)
        if n is not None:
            return n
        n = self.old.get(piece)
        if n is None:
            n = len(self.tokenizer.encode(piece, add_special_tokens=False))
        if len(piece) <= LONGEST_CACHED:
            if len(self.young) >= self.limit:
                self.old, self.young = self.young, {}
            self.young[piece] = n
        return n

    def _same_class(self, char: str) -> bool:
        """Whether the library puts a character into the class that the pattern puts it into (Unicode versions differ)."""
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        return all([e - s for _, (s, e) in cut(t)] == [len(p) for p in _PIECES.findall(t)] for t in (f"a{char}a", f"1{char}1", f"!{char}!"))

    def count(self, text: str) -> int:
        total = 0
        for part in _slices(text):
            if not part.isascii():
                new = set(part) - self.seen
                self.seen |= new
                self.odd.update(c for c in new if not self._same_class(c))
            if any(a in part for a in self.added) or (self.odd and not self.odd.isdisjoint(part)):
                total += _lengths(self.tokenizer, [part])[0]
            else:
                total += sum(map(self.__getitem__, _PIECES.findall(part)))
        return total


def _slices(text: str) -> Iterator[str]:
    """The text in slices of about ``SLICE`` characters, cut where no pre-token is cut; a longer word stays whole."""
    start = 0
    while len(text) - start > SLICE:
        cut = _CUT.search(text, start + SLICE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _checked(definition: bytes) -> None:
    model = json.loads(definition)
    cut = model["pre_tokenizer"] or {}
    if (
        model["normalizer"] is not None
        or model["model"]["type"] != "BPE"
        or cut.get("type") != "ByteLevel"
        or cut.get("add_prefix_space")
        or not cut.get("use_regex")
        or any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in model["added_tokens"])
    ):
        raise ValueError("token counts need a byte-level BPE without normalisation, prefix blanks or stripping added tokens")


def count(
    docs: DataFrame,
    definition_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    words: int = 16_384,
    cached: int = 200_000,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row: UTF-8 bytes and tokens of its whole text, and tokens > ``limit``.

    Counts are those of the tokenizers library for the byte-level BPE of ``definition_file``, with no special token added;
    strings of added tokens inside texts are one token each, as by its default. A text is cut into pre-tokens, whose
    lengths add up: those of the ``words`` most frequent words (:func:`frequent_words`, over all texts) come from a
    broadcast table of a few hundred KB, the others from the library through a cache of twice ``cached`` entries in each
    worker. No pre-token is shuffled. Slices that hold an added token, or a character of a Unicode version that library
    and pattern class differently, go to the library whole.

    Null ids pass through; null texts count as empty: 0 bytes, 0 tokens. Very long texts are cut in slices between words,
    a word of any length stays whole. Repeated rows give repeated rows; there are no ties; an empty table gives an empty
    one; other columns are not read.
    """
    with open(definition_file, "rb") as file:
        definition = file.read()
    _checked(definition)
    packed = _packed(_tokenizer(definition), frequent_words(docs, text_col, words))
    shared = docs.sparkSession.sparkContext.broadcast((definition, packed))

    def rows(columns: list[list]) -> Iterable[tuple]:
        lengths = per_process("token_lengths", shared.value[0], lambda data: _Lengths(data, shared.value[1], cached))
        for key, text, n_bytes in zip(*columns, strict=True):
            tokens = lengths.count(text)
            yield key, n_bytes, tokens, tokens > limit

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_column(text_col)
    columns = [F.col(id_col), text, F.octet_length(text).cast("long")]
    return arrow_rows(docs, columns, rows, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
