"""Hard-negative mining by threshold joins over an inverted index that leaves out what suffix norms cover."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegate.llm.common import ceil_div, materialised
from lakegate.llm.topk import quantised

ROWS_AT_ONCE = 128  # anchors whose partial scores are filled together
SLACK = 1 + 1e-9  # norms are rounded; bounds must not be
POSTINGS_AT_ONCE = 2048  # rows whose postings are gone through while their partial scores are near
COMPONENTS_AT_ONCE = 1 << 20  # components of the vectors of one block
POSITIVE_STEPS = (0.75, 0.625, 0.5625, 0.5, 0.0)  # from the least possible score to the largest: cosines 1/2 ... 0, then all
NEGATIVE_STEPS = (0.5, 0.25, 0.0)  # from the lower end of a window to the upper one

_FOUND = "anchor long, part long, slot int, vec_id long, score long, n long"


def _dense(lists: pa.ListArray, width: int) -> np.ndarray:
    """The vectors as rows of one matrix; shorter ones are filled up with zeros."""
    offsets = np.asarray(lists.offsets)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[row, term] = np.asarray(lists.values)[offsets[0] : offsets[-1]].astype(np.int64)
    return out


def _suffix_norms(rows: np.ndarray) -> np.ndarray:
    """Norm of what is left of each row from every dimension on; the last column is 0."""
    squares = np.zeros((rows.shape[0], rows.shape[1] + 1))
    squares[:, :-1] = np.cumsum((rows.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(squares)


def _joined(
    anchors: np.ndarray,
    least: np.ndarray,
    rows: np.ndarray,
    norms: np.ndarray,
    a_norms: np.ndarray,
    wanted: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all wanted pairs that reach the anchor's threshold: positions in both blocks.

    The index holds each row's dimensions up to the place from which on its norm times the anchors' largest cannot reach
    the lowest threshold: a pair that meets in no indexed dimension cannot either. Rows are ordered by that place, so the
    postings of a dimension are the first rows; they are gone through in blocks, dimension by dimension, each adding its
    weighted postings to the partial scores. Partial scores that the norms left over cannot lift to the threshold are
    pruned; the rest is added for the others.
    """
    width = rows.shape[1]
    covered = norms * (a_norms.max(axis=0) * SLACK) < least.min()
    cut = np.where(covered.any(axis=1), covered.argmax(axis=1), width)
    order = np.argsort(-cut, kind="stable")
    by_term = np.ascontiguousarray(anchors.T)
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, int(np.count_nonzero(cut)) if least.min() > 0 else len(cut), POSTINGS_AT_ONCE):
        block = order[at : at + POSTINGS_AT_ONCE]
        place, last = cut[block], int(cut[block[0]])
        postings = rows[block, :last].T * (np.arange(last)[:, None] < place)
        scores = np.einsum("ta,tr->ar", by_term[:last], postings)
        left = norms[block, place] * SLACK
        anchor, row = np.nonzero(scores >= least[:, None] - a_norms.max(axis=0)[place] * left)
        near = wanted(anchor, block[row]) & (scores[anchor, row] + a_norms[anchor, place[row]] * left[row] >= least[anchor])
        anchor, row = anchor[near], row[near]
        exact = scores[anchor, row]
        least_place = int(place.min())
        rest = rows[block, least_place:] * (np.arange(least_place, width) >= place[:, None])  # what the index leaves out
        at_once = COMPONENTS_AT_ONCE // max(width - least_place, 1) + 1
        for start in range(0, len(anchor) if least_place < width else 0, at_once):
            a, r = anchor[start : start + at_once], row[start : start + at_once]
            exact[start : start + at_once] += np.einsum("pt,pt->p", anchors[a, least_place:], rest[r])
        reached = exact >= least[anchor]
        found.append((anchor[reached], block[row[reached]], exact[reached].astype(np.int64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def _cell(table: pa.Table, same: bool, k: int) -> pa.Table:
    """One block of anchors against one block of rows: for each window of an anchor the best ``k`` rows inside it."""
    label = table["label"].combine_chunks().dictionary_encode().indices
    table = table.drop_columns(["label"]).append_column("label", label)
    asked = table.filter(table["query"]).combine_chunks()
    rows = table.filter(pc.invert(table["query"])).sort_by([("id", "ascending"), ("part", "ascending")]).combine_chunks()
    out: list[tuple] = []
    if asked.num_rows and rows.num_rows:
        one = lambda t, name: t[name].combine_chunks()
        width = max(int(pc.max(pc.list_value_length(table["w"])).as_py()), 1)
        windows = [[(w["slot"], w["t"], w["hi"]) for w in ws] for ws in one(asked, "windows").to_pylist()]
        least = np.array([min(t for _, t, _ in ws) for ws in windows], np.int64)
        order = np.argsort(-least, kind="stable")  # anchors of like thresholds share an index
        anchors, matrix = _dense(one(asked, "w"), width), _dense(one(rows, "w"), width)
        dims = np.argsort(-(matrix.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        anchors, matrix = anchors[:, dims], matrix[:, dims]
        norms, a_norms = _suffix_norms(matrix), _suffix_norms(anchors)
        if norms.max() * a_norms.max() < 2**52:  # no partial score is larger, so floats add up without rounding
            anchors, matrix = anchors.astype(np.float64), matrix.astype(np.float64)
        a_id, a_part, a_label = (np.asarray(one(asked, c)) for c in ("id", "part", "label"))
        r_id, r_part, r_label, copies = (np.asarray(one(rows, c)) for c in ("id", "part", "label", "n"))
        for at in range(0, len(order), ROWS_AT_ONCE):
            chunk = order[at : at + ROWS_AT_ONCE]
            wanted = lambda a, r, chunk=chunk: (r_label[r] == a_label[chunk[a]]) == same
            anchor, row, score = _joined(anchors[chunk], least[chunk], matrix, norms, a_norms[chunk], wanted)
            anchor = chunk[anchor]
            n = copies[row] - ((r_id[row] == a_id[anchor]) & (r_part[row] == a_part[anchor]))  # an anchor is not its own
            anchor, row, score, n = anchor[n > 0], row[n > 0], score[n > 0], n[n > 0]
            best = np.lexsort((row, -score, anchor))
            anchor, row, score, n = anchor[best], row[best], score[best], n[best]
            for a in np.unique(anchor):
                lo, hi = np.searchsorted(anchor, a, "left"), np.searchsorted(anchor, a, "right")
                falling = -score[lo:hi]
                for slot, t, top in windows[a]:
                    start = lo + np.searchsorted(falling, -top, "left")
                    end = min(lo + np.searchsorted(falling, -t, "right"), start + k)
                    for i in range(start, end):
                        out.append((a_id[a], a_part[a], slot, r_id[row[i]], score[i], n[i]))
    schema = pa.schema([(name, pa.int32() if kind == "int" else pa.int64()) for name, kind in map(str.split, _FOUND.split(", "))])
    columns = zip(*out, strict=True) if out else [[]] * len(schema)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _search(rows: DataFrame, anchors: DataFrame, total: int, same: bool, k: int, steps: tuple, at_once: tuple[int, int]) -> DataFrame:
    """(anchor, part, slot, rank, vec_id, score): the best ``need`` rows inside each window of each anchor.

    Each round asks for the rows that reach a threshold inside the window. Windows that hold as many rows as they need
    are done; the others come again with a lower threshold, at last the window's lower end.
    """
    done: list[DataFrame] = []
    busy = min(ceil_div(total, 1024), rows.sparkSession.sparkContext.defaultParallelism)
    blocks = max(ceil_div(total, at_once[0]), busy)
    key = ["anchor", "part", "slot"]
    for step in steps:
        asked = anchors.count()
        if not asked:
            break
        parts = ceil_div(asked, at_once[1])
        windows = F.transform(
            "windows",
            lambda w: F.struct(
                w["slot"].alias("slot"), (w["lo"] + F.ceil((w["hi"] - w["lo"]) * F.lit(step)).cast("long")).alias("t"), w["hi"].alias("hi")
            ),
        )
        no_windows = F.lit(None).cast("array<struct<slot:int,t:bigint,hi:bigint>>")
        spread = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
        common = ["id", "part", "label", "w", "n"]
        grid = rows.select(
            *common,
            F.lit(False).alias("query"),
            no_windows.alias("windows"),
            F.pmod("spread", F.lit(blocks)).alias("block"),
            spread(parts).alias("ask"),
        ).union(
            anchors.select(
                *common,
                F.lit(True),
                windows,
                spread(blocks),
                F.pmod(F.xxhash64("part", "id"), F.lit(parts)),
            )
        )
        best = grid.groupBy("block", "ask").applyInArrow(lambda table: _cell(table, same, k), _FOUND)
        copies = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k)))))
        order = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id", "copy")
        ranked = copies.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found = materialised(ranked.select(*key, "rank", "vec_id", "score"), "found")
        if step == 0.0:
            done.append(found)
            break
        window = anchors.select(F.col("id").alias("anchor"), "part", F.explode("windows").alias("window"))
        held = window.select("*", F.col("window.slot").alias("slot")).join(
            found.groupBy(*key).agg(F.count(F.lit(1)).alias("held")), key, "left"
        )
        state = materialised(held.withColumn("full", F.coalesce("held", F.lit(0)) >= F.col("window.need")), "windows")
        done.append(found.join(state.where("full").select(*key), key, "left_semi"))
        still = state.where("not full").groupBy(F.col("anchor").alias("id"), "part").agg(F.collect_list("window").alias("windows"))
        anchors = materialised(anchors.drop("windows").join(still, ["id", "part"]).select(*common, "windows"), "anchors")
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | Column = "label",
    scale: int = 256,
    candidates_at_once: int = 16_384,
    anchors_at_once: int = 16_384,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank): hard negatives.

    Vectors become integers ``floor(scale * x)``; a score is an inner product. An anchor's positives are the other rows of
    its label with the ``positives`` highest scores; each positive opens a window from ``low_percent`` to
    ``high_percent`` of its score, and its negatives are the ``negatives`` highest rows of other labels in the window.

    Both are threshold joins (:func:`_search`): blocks of anchors meet blocks of rows of bounded size, an inverted index
    leaves out the dimensions that suffix norms cover at the block's threshold, partial scores are pruned by the norms left
    over, and thresholds fall until the windows are full. The last threshold is the window's end, so nothing is lost. A
    block returns only what reaches the threshold, and of that only the best of each window.

    Ties go to the smaller id. Only the anchor's own row is no candidate; another row under its id is one. Rows without
    an id or label, and vectors null or with null or non-finite parts, take no part; vectors of different lengths meet in
    the components both have; an empty vector scores 0. Each copy of a repeated row is a candidate of its own, and equal
    anchors are answered once. A negative positive score leaves an empty window. Anchors without positives or negatives have
    no rows; an empty table gives an empty one. Other columns are not read. Scores are exact as long as they fit into
    64 bits.
    """
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        label.alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        quantised(F.col(vector_col), scale).alias("w"),
    ).where("id is not null and label is not null and w is not null")
    counted = rows.groupBy("id", "label", "w", "anchor").agg(F.count(F.lit(1)).alias("n"))
    keyed = counted.select("*", F.xxhash64("label", "w").alias("part"), F.xxhash64("id", "w").alias("spread"))
    square = F.aggregate("w", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    counted = materialised(keyed.withColumn("norm", F.sqrt(square)), "vectors")
    total, widest, largest = counted.agg(F.count(F.lit(1)), F.max(F.size("w")), F.max("norm")).first()
    fitting = max(64, COMPONENTS_AT_ONCE // max(widest or 1, 1))
    at_once = (min(candidates_at_once, fitting), min(anchors_at_once, fitting))

    members = counted.groupBy("label").agg(F.sum("n").alias("members"))
    end = (F.floor(F.col("norm") * F.lit(float(largest or 0.0) * SLACK)) + 1).cast("long")
    asked = counted.where("anchor").join(members, "label").where("members > 1").select(
        "id", "part", "label", "w", "n",
        F.array(
            F.struct(
                F.lit(0).alias("slot"),
                (-end).alias("lo"),
                end.alias("hi"),
                F.least(F.lit(positives).cast("long"), F.col("members") - 1).alias("need"),
            )
        ).alias("windows"),
    )
    candidates = counted.select("id", "part", "label", "w", "n", "spread")
    anchors = materialised(asked, "anchors")
    if not anchors.count():
        empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"
        return vectors.sparkSession.createDataFrame([], empty)
    nearest = materialised(
        _search(candidates, anchors, total, True, positives, POSITIVE_STEPS, at_once).select(
            F.col("anchor").alias("id"), "part", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("s")
        ),
        "positives",
    )
    opened = nearest.select(  # the ends of a window are rounded inwards, in integers
        "*",
        F.expr(f"(s * {low_percent} + pmod(-(s * {low_percent}), 100L)) div 100").alias("lo"),
        F.expr(f"(s * {high_percent} - pmod(s * {high_percent}, 100L)) div 100").alias("hi"),
    ).where("lo <= hi")
    per_anchor = opened.groupBy("id", "part").agg(
        F.collect_list(F.struct("slot", "lo", "hi", F.lit(negatives).cast("long").alias("need"))).alias("windows")
    )
    asked = materialised(anchors.drop("windows").join(per_anchor, ["id", "part"]), "anchors")
    if not asked.count():
        found = vectors.sparkSession.createDataFrame([], "anchor long, part long, slot int, rank int, vec_id long, score long")
    else:
        found = _search(candidates, asked, total, False, negatives, NEGATIVE_STEPS, at_once)
    return found.withColumnRenamed("anchor", "id").join(nearest, ["id", "part", "slot"]).select(
        F.col("id").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("s").alias("positive_score"),
        F.col("score").alias("negative_score"),
        F.col("slot").alias("positive_rank"),
    )
