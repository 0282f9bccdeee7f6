"""Secret scans: fixed signatures, and random strings found by how badly a token vocabulary compresses them."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import arrow_rows, per_process, release, small_batches, text_column

# Fixed values.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)  # hexadecimal digits of the common digests
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a run of 18 characters at least; shorter runs hold no longer match
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[0-9A-Za-z+/_=-]{16,}")  # holds every hexadecimal match and every random candidate
_ALL_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_BASE64 = {"md5": "{22}(?:==)?", "sha1": "{27}=?", "sha224": "{38}(?:==)?", "sha256": "{43}=?", "sha384": "{64}", "sha512": "{86}(?:==)?"}
_DIGESTS = "|".join(f"(?i:{name})[-_=][0-9A-Za-z+/_-]{length}" for name, length in _BASE64.items())  # tagged, in base64
_UUID = r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_WHOLE = re.compile(rf"(?<![0-9A-Za-z])(?:{_DIGESTS}|{_UUID})(?![0-9A-Za-z])")  # known, separators and all
_SEGMENT = re.compile(rf"{_WHOLE.pattern}|[0-9A-Za-z]+")
_PADDING = re.compile(r"={1,2}(?![0-9A-Za-z=])")
# Each character fits one part of an alternative only: time grows with the length, not with the ways to cut it.
_IDENTIFIER = re.compile(r"[a-z]*(?:[A-Z][a-z]+)*\d{0,4}|[A-Z]+\d{0,4}|\d+|v\d+[a-z]?")
_VERSION = re.compile(r"v\d+[a-z]?")
_SHORT_WORD = re.compile(r"(?<![^\W\d_])[^\W\d_]{1,15}(?![^\W\d_])")  # too short to be tested
LIKE_WORDS = 0.5  # by how much the letters of the text must explain a string better than chance does


def _encoder(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("secrets", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})


def _tokens(text: str, encoder) -> int:
    """Tokens of a text. Long ones are encoded in slices, which bounds the encoder's time; slices cost a token more at most."""
    return sum(len(encoder.encode_ordinary(text[k : k + 512])) for k in range(0, len(text), 512))


def _plain(segment: str, encoder, ratio: float) -> bool:
    """Numbers, versions, and words that are one token or that the vocabulary compresses."""
    if not _IDENTIFIER.fullmatch(segment):
        return False
    letters = segment.rstrip("0123456789")
    if len(letters) < 2 or _VERSION.fullmatch(segment):
        return True
    tokens = _tokens(letters, encoder)
    return tokens == 1 or len(letters) >= ratio * tokens


class _Letters:
    """How the short words of a text follow letter upon letter; counted once the first long word asks for it."""

    def __init__(self, text: str):
        self.text, self.log = text, None

    @staticmethod
    def _numbers(text: str) -> np.ndarray:
        numbers = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype(np.int64) - 97
        return np.where((numbers >= 0) & (numbers < 26), numbers, 26)

    def explain(self, segment: str) -> bool:
        """Whether a string of the letters A to Z is a word of this text, long or compound, and not a random string.

        That is, whether its pairs of letters are more likely among the text's words than by chance: by ``LIKE_WORDS``, in
        the mean of the logarithms. Random letters stay near 0 or below; words of the text's language are at 1 or above.
        """
        if self.log is None:
            at = self._numbers(" ".join(_SHORT_WORD.findall(self.text)))
            counts = np.bincount(at[:-1] * 27 + at[1:], minlength=27 * 27).reshape(27, 27)[:26, :26]
            self.log = np.log(26 * (counts + 1) / (counts.sum(1, keepdims=True) + 26))
        at = self._numbers(segment)
        return float(self.log[at[:-1], at[1:]].mean()) >= LIKE_WORDS


def _known(segment: str, encoder, ratio: float, letters: _Letters) -> bool:
    """Digests, UUIDs, numbers, plain words and words like those of the text: long, but no secrets."""
    if len(segment) >= 16 and segment.isalpha() and letters.explain(segment):
        return True
    if _WHOLE.fullmatch(segment) or (_ALL_HEX.fullmatch(segment) and len(segment) in DIGEST_LENGTHS):
        return True
    return _plain(segment, encoder, ratio)


def _base(text: str, raw: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base spans as (start, kind, end), and the long runs of the text."""
    spans = []
    low = raw.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    runs = [m.span() for m in _RUN.finditer(text)]
    for a, b in runs:
        spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text, a, b)]
    return sorted(spans), runs


def _pieces(text: str, a: int, b: int, covered: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What spans (in order, apart) leave of a run: neighbouring segments that no span holds as a whole."""
    if not covered:
        yield a, b
        return
    start, end, i = -1, a, 0
    for m in _SEGMENT.finditer(text, a, b):
        while i < len(covered) and covered[i][1] < m.end():
            i += 1
        if i < len(covered) and covered[i][0] <= m.start():
            if start >= 0:
                yield start, end
            start = -1
        else:
            start, end = m.start() if start < 0 else start, m.end()
    if start >= 0:
        yield start, end


def _judged(text: str, a: int, b: int, encoder, ratio: float, letters: _Letters) -> Iterator[tuple[int, int]]:
    """The piece, if it is random as a whole, else its random segments; neighbours are one string.

    Up to two separators, or a known segment of up to two characters, may stand inside such a string: these lie below the
    threshold too (a token has a character at least), so the string does.
    """
    segments = [(m.start(), m.end(), _known(m.group(), encoder, ratio, letters)) for m in _SEGMENT.finditer(text, a, b)]
    if all(known for _, _, known in segments):
        return
    if b - a < ratio * _tokens(text[a:b], encoder):
        yield a, b
        return
    start = end = last = -1  # the string so far; the end of what may still stand inside it
    for s, e, known in segments:
        random = not known and e - s < ratio * _tokens(text[s:e], encoder)
        if start >= 0 and (s - last > 2 or not (random or (known and e - s <= 2))):
            yield start, end
            start = -1
        if random:
            start, end = s if start < 0 else start, e
        last = e
    if start >= 0:
        yield start, end


def _random(text: str, runs, base, encoder, min_chars: int, ratio: float) -> list[tuple[int, int, int]]:
    """Random strings of the runs, as far as base spans do not hold them."""
    united: list[tuple[int, int]] = []
    for a, _, b in base:
        if united and a <= united[-1][1]:
            united[-1] = (united[-1][0], max(b, united[-1][1]))
        else:
            united.append((a, b))
    found, i, letters = [], 0, _Letters(text)
    for a, b in runs:
        if b - a < min_chars:
            continue
        while i < len(united) and united[i][1] <= a:
            i += 1
        k = i
        while k < len(united) and united[k][0] < b:
            k += 1
        for x, y in _pieces(text, a, b, united[i:k]):
            if y - x < min_chars:
                continue
            for s, e in _judged(text, x, y, encoder, ratio, letters):
                padded = _PADDING.match(text, e, b)
                e = padded.end() if padded else e
                if e - s >= min_chars:
                    found.append((s, 3, e))
        i = max(i, k - 1)
    return found


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    min_chars: int = 16,
    max_chars_per_token: float = 2.2,
) -> DataFrame:
    """One row per row of ``docs``: its secrets as spans (kind, start, end) in code points, ends exclusive.

    A run of ``min_chars`` or more (never under 16) of ``[0-9A-Za-z+/_=-]`` is random when the vocabulary gets fewer than
    ``max_chars_per_token`` characters into a token, unless all its segments between separators are known: digests, UUIDs,
    numbers, plain words. Letters are plain if they are one token or reach that many characters a token, and, from 16 on,
    if they follow each other as in the text's own short words (``_Letters``). Of a run that reaches them as a whole, those
    neighbouring segments are random that do not, with ``min_chars`` in all. What base spans hold is left out first.
    Everything happens inside one row: no shuffle, any skew is harmless; time and memory grow with the text's length.

    Null ids pass through; null texts count as empty and give no span; repeated rows give repeated rows; an empty table
    gives an empty one; other columns are not read. Result: the id, ``spans`` array of structs ordered by start, then
    kind as listed in ``KINDS``.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(open(vocabulary, "rb").read())  # a vocabulary file: about 1 MB

    def rows(columns: list[list]) -> Iterable[tuple]:
        encoder = None
        for key, text in zip(*columns, strict=True):
            spans, runs = _base(text, text.encode())
            if any(b - a >= min_chars for a, b in runs):
                encoder = encoder or per_process("encoder", ranks.value, _encoder)
                spans = sorted(spans + _random(text, runs, spans, encoder, min_chars, max_chars_per_token))
            yield key, [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return arrow_rows(docs, [F.col(id_col), text_column(text_col)], rows, schema)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every found span (overlapping ones united) replaced by ``mark``; all rows and columns stay.

    Texts without a span, null ones too, stay as they are. Columns pass through whatever their names.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(open(options.get("vocabulary", VOCABULARY), "rb").read())
    least, ratio = options.get("min_chars", 16), options.get("max_chars_per_token", 2.2)

    @F.pandas_udf("string")
    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def clean(text):
            if text is None:
                return None
            spans, runs = _base(text, text.encode())
            if any(b - a >= least for a, b in runs):
                encoder = per_process("encoder", ranks.value, _encoder)
                spans = sorted(spans + _random(text, runs, spans, encoder, least, ratio))
            out, at = [], 0
            for a, _, b in spans:
                if a >= at:
                    out += [text[at:a], mark]
                at = max(at, b)
            return text if not spans else "".join([*out, text[at:]])

        for texts in batches:
            yield texts.map(clean, na_action="ignore")
        release()

    return small_batches(docs).withColumn(text_col, cleaned(F.col(text_col)))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns of :func:`scan`'s result."""
    base = F.filter("spans", lambda s: s["kind"] != "random")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_col,
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
