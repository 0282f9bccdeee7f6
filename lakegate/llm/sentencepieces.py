"""SentencePiece encoding and decoding by suffix-array matching."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import per_process, small_batches, text_column

# Fixed values.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # how SentencePiece writes a blank
NORMAL, UNKNOWN, BYTE, UNUSED = 1, 2, 6, 5
BPE = 2

_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")
GROUP = 200_000  # characters of distinct words in one suffix array
SLICE = 1_000_000  # characters of texts that are encoded together
REMEMBERED = 150_000  # words whose pieces a worker remembers
SEEN = 1 << 18  # pairs of pieces that a worker remembers


def _words(text: str) -> list[str]:
    """A text as words that start at blanks, where no piece goes across; the one blank in front is left out of the name."""
    if not text:
        return []
    if "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    chunks = _CHUNK.findall(SPACE + text.replace(" ", SPACE))
    return [c if c.startswith(SPACE * 2) else c[1:] for c in chunks]


def _apart(left: int, right: int, made: dict[tuple[int, int], int], halves: list, rank: list[int]) -> bool:
    """Whether merging best pairs first, the leftmost of equal ones, leaves two neighbouring pieces apart.

    The merges that made the two are undone, the latest first. A merge across the border comes first if it is better than
    what was undone last; if it is equal, the one that lies further left comes first.
    """
    limit = len(rank)
    while True:
        across = made.get((left, right))
        if across is not None and rank[across] < limit:
            return False
        if max(rank[left], rank[right]) < 0:
            return True
        if rank[left] > rank[right]:
            limit, left = rank[left], halves[left][1]
        else:
            limit, right = rank[right] + 1, halves[right][0]


class Pieces:
    """A BPE model with byte fallback: its pieces, how pairs of them behave, and the words encoded so far."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("the model must be BPE with byte fallback")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("the model must not normalise texts")
        if not norm.add_dummy_prefix:
            raise ValueError("the model must put a blank in front of texts")
        self.names = [p.piece for p in proto.pieces]
        kinds = [p.type for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        number = {name: i for i, name in enumerate(self.names) if kinds[i] == NORMAL}
        letters = sorted({c for name in number for c in name})
        if any(c not in number for c in letters) or any(SPACE in n.lstrip(SPACE) for n in number):
            raise ValueError("pieces must be made of single-character pieces, with blanks in front only")
        self.bytes_id = {int(self.names[i][3:5], 16): i for i, k in enumerate(kinds) if k == BYTE}
        # What decoding writes for each id.
        self.plain = [n.replace(SPACE, " ").encode() if k == NORMAL else b"" for n, k in zip(self.names, kinds, strict=True)]
        for value, i in self.bytes_id.items():
            self.plain[i] = bytes([value])
        for i, kind in enumerate(kinds):
            if kind == UNKNOWN:
                self.plain[i] = proto.trainer_spec.unk_surface.encode()
        # Letters get the codes 1, 2, ...; 0 ends a word; all unknown characters share the code after the last.
        self.unknown = len(letters) + 1
        self.code = np.full(0x110000, self.unknown, np.uint16)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.number = number
        self.length = np.ones(len(self.names) + 2, np.int64)
        self.forget()

    @cached_property
    def searched(self) -> np.ndarray:
        """Ids of the pieces that are on a path: the others are none that the model would make of their characters.

        Filled in beside them: the last merge of each (``halves``), its rank, and the pairs that are merged. A piece is
        made of two pieces of better rank that the merges before it leave apart; there is one such pair at most.
        """
        size = len(self.names) + 2
        self.rank = np.full(size, -1, np.int64)  # single characters are there from the start, and are never merged into
        self.halves = np.repeat(np.arange(size), 2).reshape(size, 2)
        halves = self.halves.tolist()
        made: dict[tuple[int, int], int] = {}
        found: dict[str, int] = {name: i for name, i in self.number.items() if len(name) == 1}
        order = sorted((n for n in self.number if len(n) > 1), key=lambda n: (-self.score[n], self.number[n]))
        ranks = [-1] * size
        for rank, name in enumerate(order):
            i = self.number[name]
            for k in range(1, len(name)):
                left, right = found.get(name[:k]), found.get(name[k:])
                if left is not None and right is not None and _apart(left, right, made, halves, ranks):
                    found[name], made[left, right], halves[i], ranks[i] = i, i, [left, right], rank
                    break
            else:
                if self.survives(name):
                    raise ValueError("pieces must be made of pieces with better scores")
        self.halves, self.rank = np.array(halves, np.int64), np.array(ranks, np.int64)
        merged = np.array(sorted((a * size + b, ranks[i]) for (a, b), i in made.items()), np.int64).reshape(-1, 2)
        self.merged, self.merged_rank = np.append(merged[:, 0], size * size), np.append(merged[:, 1], size)
        self.seen_pair, self.seen_fits = np.full(SEEN, -1, np.int64), np.zeros(SEEN, bool)
        searched = np.array([i for _, i in sorted((list(self.codes(n)), i) for n, i in found.items())], np.int64)
        self.length[searched] = [len(self.names[i]) for i in searched]
        self.width = int(self.length.max())
        packed = np.zeros((len(searched), self.width), ">u2")
        for row, i in enumerate(searched):
            packed[row, : self.length[i]] = self.codes(self.names[i])
        kind = f"S{2 * self.width}"
        self.low = packed.view(kind).ravel()
        ends = np.where(np.arange(self.width) < self.length[searched, None], packed, 0xFFFF).astype(">u2")
        self.high = np.ascontiguousarray(ends).view(kind).ravel()
        return searched

    def forget(self) -> None:
        """Start anew: word -> number, the ids of word i at ``ids[first[i] : first[i + 1]]``, how often it was met."""
        self.words: dict[str, int] = {}
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.met = np.zeros(0, np.int64)

    def forget_rare(self) -> None:
        """Keep the words that were met most, half of what is remembered at most, and none that was met once only."""
        kept = np.argsort(-self.met, kind="stable")[: REMEMBERED // 2]
        kept = np.sort(kept[self.met[kept] > 1])
        names = list(self.words)  # in the order of their numbers
        self.words = {names[i]: n for n, i in enumerate(kept.tolist())}
        first, counts = self.first[kept], self.first[kept + 1] - self.first[kept]
        self.first = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        self.ids = self.ids[np.arange(self.first[-1]) + np.repeat(first - self.first[:-1], counts)]
        self.met = self.met[kept] >> 1

    def codes(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("utf-32-le"), "<u4")]

    def survives(self, text: str) -> bool:
        """Whether merging ``text`` from its characters, best pair first, ends with one piece."""
        score, parts = self.score, list(text)
        while len(parts) > 1:
            values = [score.get(a + b, -math.inf) for a, b in pairwise(parts)]
            best = max(values)
            if best == -math.inf:
                return False
            where = values.index(best)
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return True

    def fits(self, pairs: np.ndarray) -> np.ndarray:
        """Whether the model leaves the two pieces of each pair (left * size + right) apart when they meet.

        What is found is remembered in a table of fixed size, where a pair replaces the one before it.
        """
        slots = (pairs * 0x9E3779B97F4A7C1 >> 17) & (SEEN - 1)
        good = self.seen_fits[slots]
        new = np.flatnonzero(self.seen_pair[slots] != pairs)
        if len(new):
            unknown, back = np.unique(pairs[new], return_inverse=True)
            found = self._apart(unknown)
            good[new] = found[back]
            slots = (unknown * 0x9E3779B97F4A7C1 >> 17) & (SEEN - 1)
            kept = np.unique(slots, return_index=True)[1]
            self.seen_pair[slots[kept]], self.seen_fits[slots[kept]] = unknown[kept], found[kept]
        return good

    def _apart(self, pairs: np.ndarray) -> np.ndarray:
        """:func:`_apart` for all pairs side by side."""
        size = len(self.names) + 2
        result = np.ones(len(pairs), bool)
        left, right = np.divmod(pairs, size)
        open_ = np.flatnonzero((left < size - 2) & (right < size - 2))  # else the start of a word, an unknown character
        left, right = left[open_], right[open_]
        limit = np.full(len(open_), size)
        while len(open_):
            pair = left * size + right
            at = np.searchsorted(self.merged, pair)
            crossed = (self.merged[at] == pair) & (self.merged_rank[at] < limit)
            result[open_[crossed]] = False
            lr, rr = self.rank[left], self.rank[right]
            undo_left = lr > rr
            limit = np.where(undo_left, lr, rr + 1)
            going = ~crossed & (np.maximum(lr, rr) >= 0)
            left, right = np.where(undo_left, self.halves[left, 1], left), np.where(undo_left, right, self.halves[right, 0])
            open_, left, right, limit = open_[going], left[going], right[going], limit[going]
        return result

    def suffixes(self, codes: np.ndarray) -> np.ndarray:
        """Positions in the order of the ``width`` characters from there on, by prefix doubling."""
        ahead = np.concatenate([codes, np.zeros(3, codes.dtype)]).astype(np.uint64)
        key, step = ahead[:-3], 4  # four characters of 16 bits to start from
        for k in range(1, 4):
            key = key << np.uint64(16) | ahead[k : len(codes) + k]
        order = np.argsort(key)
        rank = self._ranked(key, order)
        while step < self.width:
            behind = np.zeros_like(rank)
            behind[:-step] = rank[step:] if step < len(rank) else 0
            key = rank * (int(rank.max()) + 1) + behind
            order = np.argsort(key)
            step *= 2
            if step < self.width:
                rank = self._ranked(key, order)
        return order

    @staticmethod
    def _ranked(key: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The ranks of keys, which ``order`` sorts; equal ones share theirs."""
        ranked = key[order]
        rank = np.zeros(len(key), np.int64)
        rank[order[1:]] = np.cumsum(ranked[1:] != ranked[:-1])
        return rank

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, piece) of every occurrence of every piece: a range of the suffix array each."""
        searched = self.searched
        order = self.suffixes(codes)
        padded = np.concatenate([codes, np.zeros(self.width, codes.dtype)]).astype(">u2")
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.width)
        keys = np.ascontiguousarray(windows[order]).view(self.low.dtype).ravel()
        lo, hi = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        counts = hi - lo
        total = int(counts.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        return order[np.repeat(lo, counts) + inside], np.repeat(searched, counts)

    def learn(self, words: list[str]) -> None:
        """Encode distinct words, as :func:`_words` names them: match all pieces, then relax the edges by where they end.

        The last piece of a prefix's encoding is the one piece ending there that stays apart from the last piece of the
        prefix before it; so positions are settled from left to right, all words side by side.
        """
        named, words = words, [w if w.startswith(SPACE) else SPACE + w for w in words]
        joined = "\0".join(words) + "\0"
        codes = self.codes(joined)
        sizes = np.array([len(w) for w in words])
        starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes + 1)[:-1]])
        codes[starts + sizes] = 0
        at, piece = self.edges(codes)
        strange = np.flatnonzero(codes == self.unknown)
        no_id = len(self.names)
        at, piece = np.concatenate([at, strange]), np.concatenate([piece, np.full(len(strange), no_id)])
        word = np.repeat(np.arange(len(words)), sizes + 1)
        end = at + self.length[piece]
        rounds = end - starts[word[at]]
        order = np.argsort(rounds.astype(np.uint16) if len(rounds) and rounds.max() < 1 << 16 else rounds, kind="stable")
        at, piece, end, rounds = at[order], piece[order], end[order], rounds[order]
        last = np.full(len(codes) + 1, -1, np.int64)
        last[starts] = no_id + 1
        bounds = np.flatnonzero(np.concatenate([[True], rounds[1:] != rounds[:-1], [True]])) if len(rounds) else []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            good = self.fits(last[at[a:b]] * (no_id + 2) + piece[a:b])
            last[end[a:b][good]] = piece[a:b][good]
        self._remember(named, joined, last, starts, starts + sizes)

    def _remember(self, words: list[str], joined: str, last: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Walk back from the ends of all words side by side, and keep their ids."""
        no_id = len(self.names)
        owner, place, walked = np.arange(len(words)), ends.copy(), []
        while len(owner):
            token = last[place]
            strange = np.flatnonzero(token == no_id)
            walked.append((owner, token))
            if len(strange):  # an unknown character is its bytes, the last one first
                keep = np.ones(len(token), bool)
                keep[strange] = False
                walked[-1] = (owner[keep], token[keep])
                raw = [joined[x - 1].encode()[::-1] for x in place[strange].tolist()]
                for k in range(max(map(len, raw))):
                    some = [(w, self.bytes_id[r[k]]) for w, r in zip(owner[strange].tolist(), raw, strict=True) if k < len(r)]
                    walked.append(tuple(np.array(column, np.int64) for column in zip(*some, strict=True)))
            place = place - self.length[token]
            open_ = place > starts[owner]
            owner, place = owner[open_], place[open_]
        owners, tokens = (np.concatenate(column)[::-1] for column in zip(*walked, strict=True))
        order = np.argsort(owners, kind="stable")
        counts = np.bincount(owners, minlength=len(words))
        base = len(self.words)
        self.words.update((w, base + n) for n, w in enumerate(words))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, tokens[order].astype(np.int32)])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of all texts of a batch; distinct words that are new are encoded together."""
        if len(self.words) > REMEMBERED:
            self.forget_rare()
        chunks = [_words(t) for t in texts]
        group, size = [], 0
        for word in set(chain.from_iterable(chunks)).difference(self.words):
            if size + len(word) > GROUP and group:
                self.learn(group)
                group, size = [], 0
            group.append(word)
            size += len(word) + 1
        if group:
            self.learn(group)
        total = sum(map(len, chunks))
        numbers = np.fromiter(map(self.words.__getitem__, chain.from_iterable(chunks)), np.int64, total)
        self.met = np.bincount(numbers, minlength=len(self.words)) + np.append(self.met, np.zeros(len(self.words) - len(self.met), np.int64))
        first, counts = self.first[numbers], self.first[numbers + 1] - self.first[numbers]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        ids = self.ids[np.arange(ends[-1]) + np.repeat(first - ends[:-1], counts)]
        bounds = ends[np.concatenate([[0], np.cumsum([len(c) for c in chunks])]).astype(np.int64)]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids): the SentencePiece ids of every row's whole text, the same as the reference library's.

    Batch by batch, the distinct words that the worker has not met yet are joined into one text; its suffix array gives
    every piece's occurrences by binary search; these edges are sorted by position and relaxed. Words end before
    blanks, which no piece spans. A worker remembers a bounded number of words. No shuffle, any skew is harmless.

    Null ids pass through; null and empty texts have no ids; characters outside the vocabulary become their bytes;
    repeated rows give repeated rows; an empty table gives an empty one; other columns are not read. Memory grows with
    the longest text without a blank.
    """
    data = docs.sparkSession.sparkContext.broadcast(open(model, "rb").read())  # a model file: below 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = per_process("pieces", data.value, Pieces)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):  # slices bound the memory of a batch's ids
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < SLICE):
                    size += len(texts[end])
                    end += 1
                found = pieces.encode_batch(texts[at:end])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), ids], names=[id_col, "ids"])
                at = end

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs).select(F.col(id_col), text_column(text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, ids_col: str = "ids", out_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``encoded`` with the text of its ids: bytes are joined to characters, the blank put in front goes.

    Null ids give null, an empty list an empty text; bytes that are no UTF-8 become replacement characters.
    """
    data = encoded.sparkSession.sparkContext.broadcast(open(model, "rb").read())  # a model file: below 1 MB

    @F.pandas_udf("string")
    def decoded(lists):
        pieces = per_process("pieces", data.value, Pieces)
        return lists.map(lambda ids: pieces.decode(ids.tolist()), na_action="ignore")

    return small_batches(encoded).withColumn(out_col, decoded(F.col(ids_col)))
