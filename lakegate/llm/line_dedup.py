"""Line dedup: lines equal to, or one edit away from, an earlier line of the corpus go."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegate.llm.common import SMALL_ROWS, arrow_rows, free_names, materialised, sized, small_batches, text_column

BASE = 0x9E3779B97F4A7C15
LINE = ("id", "no", "h1")  # names a line: its document, its number there, the hash of its form


def normal(line: bytes) -> bytes:
    """Form in which lines are compared: A-Z in lower case, ASCII white space as single blanks."""
    return b" ".join(line.lower().split())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _keys(form: str) -> list[int]:
    """What two forms one edit apart have in common one of: half a line beside the edit.

    Let L be the shorter length. If the edit lies behind the first L // 2 characters, these are equal, else the last
    L - L // 2 are. A form of length n meets partners for L = n (equal length, or the partner is longer) and for
    L = n - 1 (the partner is shorter).
    """
    from xxhash import xxh3_64_intdigest

    out = []
    for shorter in (len(form), len(form) - 1):
        head = shorter // 2
        out.append(_signed(xxh3_64_intdigest(form[:head].encode(), 2 * shorter)))
        out.append(_signed(xxh3_64_intdigest(form[len(form) - (shorter - head) :].encode(), 2 * shorter + 1)))
    return out


def form_of(line: bytes, least: int) -> str | None:
    """Normal form of a line that takes part, else None."""
    if len(line) < least:
        return None
    form = normal(line).decode()
    return form if len(form) >= least else None


def hash_of(form: str) -> int:
    from xxhash import xxh3_64_intdigest

    return _signed(xxh3_64_intdigest(form.encode()))


def _forms(text: str, least: int) -> Iterator[tuple[int, str]]:
    for number, line in enumerate(text.encode().split(b"\n")):
        if (form := form_of(line, least)) is not None:
            yield number, form


def lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_edit_chars: int) -> DataFrame:
    """(id, no, h1, h2, keys) of every line that takes part; the keys are null if only equal lines are looked for."""

    def rows(columns: list[list]) -> Iterator[tuple]:
        from xxhash import xxh64_intdigest

        for key, text in zip(*columns, strict=True):
            for number, form in _forms(text, min_chars):
                keys = _keys(form) if len(form) >= min_edit_chars else [None] * 4
                yield key, number, hash_of(form), _signed(xxh64_intdigest(form.encode())), *keys

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_rows(
        docs,
        [F.col(id_col), text_column(text_col)],
        rows,
        f"id {kind}, no int, h1 long, h2 long, p0 long, s0 long, p1 long, s1 long",
    )


def deletion_hashes(form: str) -> tuple[np.ndarray, int]:
    """Hash of the form without its character p, for every p, and hash of the whole form; all in linear time."""
    codes = np.frombuffer(form.encode("utf-32-le"), "<u4").astype(np.uint64)
    n = len(codes)
    with np.errstate(over="ignore"):
        mixed = (codes + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x165667B19E3779F9)
        powers = np.ones(n + 1, np.uint64)
        powers[1:] = np.uint64(BASE)
        powers = np.cumprod(powers, dtype=np.uint64)
        # Character i adds mixed[i] * BASE ** i; characters behind a deleted one move by one place.
        terms = mixed * powers[:n]
        before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        moved = mixed[1:] * powers[: n - 1] if n else mixed
        behind = np.concatenate([np.cumsum(moved[::-1], dtype=np.uint64)[::-1], np.zeros(1, np.uint64)])
        return before[:n] + behind[:n], int(before[n])


def _fetched(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """(id, text, want) of the documents that ``wanted`` (id, ...) names; broadcast if these are few (and short) rows."""
    wanted = materialised(wanted, "wanted")
    few = wanted.count() <= SMALL_ROWS
    grouped = wanted.groupBy("id").agg(F.collect_set(F.struct(*[c for c in wanted.columns if c != "id"])).alias("want"))
    found = docs.select(F.col(id_col).alias("d"), text_column(text_col).alias("text"))
    grouped = F.broadcast(grouped) if few else grouped
    return found.join(grouped, F.col("d").eqNullSafe(F.col("id"))).drop("d")


def _variants(found: DataFrame, min_chars: int, id_type: str) -> DataFrame:
    """(v, p, id, no, h1): hashes of the wanted lines without character p; p = -1 is the whole line."""

    def rows(columns: list[list]) -> Iterator[tuple]:
        for key, text, wanted in zip(*columns, strict=True):
            want = {(w["no"], w["h1"]): (w["head"], w["tail"]) for w in wanted}
            numbers = {w["no"] for w in wanted}
            for number, form in _forms(text, min_chars):
                if number not in numbers or (number, h1 := hash_of(form)) not in want:
                    continue
                head, tail = want[number, h1]
                deleted, whole = deletion_hashes(form)
                yield _signed(whole), -1, key, number, h1
                # Equal first halves leave the edit to the rest, equal last halves leave it to the front.
                lo = 0 if tail else (len(form) - 1) // 2
                hi = len(form) if head else len(form) - (len(form) - 1) // 2 + 1
                for p, v in enumerate(deleted[lo:hi].astype(np.int64).tolist(), lo):
                    yield v, p, key, number, h1

    return arrow_rows(
        found, [F.col("id"), F.col("text"), F.col("want")], rows, f"v long, p int, id {id_type}, no int, h1 long"
    )


def _place() -> Column:
    """Order of lines in the corpus: by id, nulls last, then by number. The hash names the line."""
    return F.struct(F.col("id").isNull().alias("z"), F.col("id"), F.col("no"), F.col("h1"))


def near_lines(docs: DataFrame, firsts: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, no, h1) of the distinct lines ``firsts`` that lie one edit from an earlier one.

    Only lines that share half of themselves with another distinct line can have a partner; these emit all variants
    within one deletion. Lines with equal variants at one position differ by a substitution there; a whole line equal to
    a variant differs by an insertion. The earliest line of each bucket is the partner of all others in it, so buckets
    are reduced to minima and never paired; every (line, partner) is verified by its edit distance. A bucket holds the
    distinct lines that one insertion makes of one string, however large the corpus.
    """
    sides = [("p0", 1), ("s0", 0), ("p1", 1), ("s1", 0)]
    halves = firsts.select(
        *LINE, F.explode(F.array(*[F.struct(F.col(c).alias("key"), F.lit(s).alias("head")) for c, s in sides])).alias("h")
    ).select(*LINE, "h.key", "h.head")
    shared = sized(halves.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    suspects = (
        halves.join(shared, "key")
        .groupBy(*LINE)
        .agg((F.max("head") == 1).alias("head"), (F.min("head") == 0).alias("tail"))
    )
    kind = docs.schema[id_col].dataType.simpleString()
    variants = _variants(_fetched(docs, id_col, text_col, suspects), min_chars, kind)
    whole, deleted = F.col("p") < 0, F.col("p") >= 0
    here, there = Window.partitionBy("v", "p"), Window.partitionBy("v")
    partners = variants.select("*", _place().alias("place")).select(
        *LINE,
        "place",
        F.array(
            F.when(deleted, F.min("place").over(here)),
            F.min(F.when(whole, F.col("place"))).over(there),
            F.when(whole, F.min(F.when(deleted, F.col("place"))).over(there)),
        ).alias("earlier"),
    )
    pairs = materialised(
        partners.select(*LINE, "place", F.explode("earlier").alias("other"))
        .where(_before(F.col("other"), F.col("place")))
        .select(*LINE, *[F.col(f"other.{c}").alias(f"{c}_2") for c in LINE])
        .distinct(),
        "pairs",
    )
    wanted = pairs.select(*LINE).union(pairs.select(*[f"{c}_2" for c in LINE])).distinct()

    def texts(columns: list[list]) -> Iterator[tuple]:
        for key, text, want in zip(*columns, strict=True):
            named = {(w["no"], w["h1"]) for w in want}
            numbers = {w["no"] for w in want}
            for number, form in _forms(text, min_chars):
                if number in numbers and (number, h1 := hash_of(form)) in named:
                    yield key, number, h1, form

    forms = arrow_rows(
        _fetched(docs, id_col, text_col, wanted),
        [F.col("id"), F.col("text"), F.col("want")],
        texts,
        f"id {kind}, no int, h1 long, form string",
    )
    forms = materialised(forms, "forms")
    one = forms.select(*[F.col(c).alias(f"{c}_1") for c in LINE], F.col("form").alias("form_1"))
    two = forms.select(*[F.col(c).alias(f"{c}_2") for c in LINE], F.col("form").alias("form_2"))
    named = pairs.select(*[F.col(c).alias(f"_{c}") for c in pairs.columns])
    both = named.join(one, _same("_", "", "", "_1")).join(two, _same("_", "_2", "", "_2"))
    near = F.levenshtein("form_1", "form_2", 1).between(0, 1)
    return both.where(near).select(*[F.col(f"_{c}").alias(c) for c in LINE]).distinct()


def _before(a: Column, b: Column) -> Column:
    """Whether place ``a`` comes before ``b``; the hash takes no part."""
    plain = lambda c: F.struct(c["z"], c["id"], c["no"])
    return plain(a) < plain(b)


def _same(prefix: str, suffix: str, other_prefix: str, other_suffix: str) -> Column:
    """Whether two sets of line columns name one line."""
    equal = [F.col(f"{prefix}{c}{suffix}").eqNullSafe(F.col(f"{other_prefix}{c}{other_suffix}")) for c in LINE]
    return equal[0] & equal[1] & equal[2]


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_edits: int = 1,
    min_chars: int = 1,
    min_edit_chars: int = 20,
) -> DataFrame:
    """``docs`` with the removed lines taken out of ``text_col``; all rows and columns stay.

    Lines are cut at newlines and compared with A-Z in lower case and white space as single blanks; lines with fewer
    than ``min_chars`` characters in that form always stay; 1 leaves out the blank ones alone. Of the others a line goes if
    an earlier line (by id, then line number) is equal, or, with ``max_edits`` 1 and both of ``min_edit_chars`` characters
    or more, is one inserted, deleted or replaced character away, be that line itself kept or not. Equal lines are reduced to their first place before anything is shuffled by line, so a line that
    a third of all documents hold is one row a task.

    Null ids come last in order and are one document; null texts stay null; rows under one id are one document given
    several times (equal texts get equal results); an empty table gives an empty one; other columns pass through.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits must be 0 or 1")
    min_edit_chars = max(min_edit_chars, min_chars)
    found = lines(docs, id_col, text_col, min_chars, min_edit_chars)
    keys = ["p0", "s0", "p1", "s1"]
    firsts = found.groupBy("h1", "h2").agg(F.min(_place()).alias("place"), *[F.min(k).alias(k) for k in keys])
    firsts = materialised(firsts.select(*[F.col(f"place.{c}").alias(c) for c in LINE], *keys), "firsts")
    kept = firsts.select(*LINE)
    if max_edits:
        long = firsts.where("p0 IS NOT NULL")
        gone = sized(near_lines(docs, long, id_col, text_col, min_edit_chars))
        gone = gone.select(*[F.col(c).alias(f"_{c}") for c in LINE])
        kept = kept.join(gone, _same("", "", "_", ""), "left_anti")
    owner, keep_col = free_names(docs, "kept_id", "kept_lines")
    by_doc = kept.groupBy(F.col("id").alias(owner)).agg(F.collect_set(F.struct("no", "h1")).alias(keep_col))

    @F.pandas_udf("string")
    def rebuilt(texts, numbers):
        def one(text, keep):
            if text is None:
                return None
            keep = set() if keep is None else {(k["no"], k["h1"]) for k in keep}
            parts = text.encode().split(b"\n")
            forms = [form_of(part, min_chars) for part in parts]
            out = [p for i, (p, f) in enumerate(zip(parts, forms, strict=True)) if f is None or (i, hash_of(f)) in keep]
            return text if len(out) == len(parts) else b"\n".join(out).decode()

        return texts.combine(numbers, one)

    joined = small_batches(docs).join(by_doc, F.col(id_col).eqNullSafe(F.col(owner)), "left")
    return joined.withColumn(text_col, rebuilt(F.col(text_col), F.col(keep_col))).select(*docs.columns)
