"""Exact top-k search by exhaustive term-at-a-time accumulation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegate.llm.common import ceil_div, materialised

ROWS_AT_ONCE = 64  # query rows whose score arrays are filled together


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a double; null for a null vector or one with null or non-finite parts."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(good, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _sparse(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of all non-zero components."""
    offsets = np.asarray(lists.offsets)
    weights = np.asarray(lists.values)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(weights)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    used = weights != 0
    return row[used], term[used], weights[used].astype(np.int64)


def _postings(lists: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    row, term, weight = _sparse(lists)
    order = np.argsort(term, kind="stable")
    row, term, weight = row[order], term[order], weight[order]
    terms, starts = np.unique(term, return_index=True)
    return {
        int(t): (row[a:b], weight[a:b]) for t, a, b in zip(terms, starts, [*starts[1:], len(term)], strict=True)
    }


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores, ties to the smaller position: selection, then a sort of the selected."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        picked = np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
    else:
        picked = np.arange(len(scores))
    return picked[np.lexsort((picked, -scores[picked]))]


def _cell(rows: pa.Table, k: int) -> pa.Table:
    """Scores of one block of queries against one block of candidates: the best ``k`` of each query."""
    rows = rows.combine_chunks()
    is_query = np.asarray(rows["query"].combine_chunks())
    queries = rows.filter(pa.array(is_query)).combine_chunks()
    candidates = rows.filter(pa.array(~is_query)).sort_by("id").combine_chunks()
    out: dict[str, list] = {"query_id": [], "part": [], "vec_id": [], "score": [], "n": []}
    if queries.num_rows and candidates.num_rows:
        one = lambda table, name: table[name].combine_chunks()
        ids, copies = np.asarray(one(candidates, "id")), np.asarray(one(candidates, "n"))
        postings = _postings(one(candidates, "w"))
        q_ids, parts = np.asarray(one(queries, "id")), np.asarray(one(queries, "part"))
        by_term = _postings(one(queries, "w"))
        for at in range(0, len(q_ids), ROWS_AT_ONCE):
            end = min(at + ROWS_AT_ONCE, len(q_ids))
            scores = np.zeros((end - at, len(ids)), np.int64)
            for term, (q_rows, q_weights) in by_term.items():
                if term not in postings:
                    continue
                where, weights = postings[term]
                lo, hi = np.searchsorted(q_rows, (at, end))
                if lo == hi:
                    continue
                whole = len(where) == len(ids)
                if whole and hi - lo == end - at:
                    scores += q_weights[lo:hi, None] * weights
                    continue
                for row, weight in zip(q_rows[lo:hi] - at, q_weights[lo:hi], strict=True):
                    if whole:
                        scores[row] += weight * weights
                    else:
                        scores[row, where] += weight * weights
            for row in range(at, end):
                a, b = np.searchsorted(ids, q_ids[row], "left"), np.searchsorted(ids, q_ids[row], "right")
                mine = scores[row - at]
                picked = _best(mine, k + b - a)
                picked = picked[(picked < a) | (picked >= b)][:k]
                out["query_id"].append(np.full(len(picked), q_ids[row]))
                out["part"].append(np.full(len(picked), parts[row]))
                out["vec_id"].append(ids[picked])
                out["score"].append(mine[picked])
                out["n"].append(copies[picked])
    return pa.table({c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for c, v in out.items()})


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    candidates_at_once: int = 4096,
    queries_at_once: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest integer inner product for each row of the query set.

    Vectors are turned into integers ``floor(scale * x)``; their non-zero components are the postings. Queries and
    candidates are dealt into blocks of bounded size, and every pair of blocks is one group: each query row scatters its
    weighted postings into score arrays over the block, the best ``k`` are selected there, and the selections are
    merged. Blocks grow in number, not in size.

    Ties go to the smaller id. A query's own id is no candidate. Vectors null or with null or non-finite parts, and rows
    without an id, take no part; vectors of different lengths meet in the components both have; an empty vector scores
    0. Repeated rows are counted before they are dealt out: each copy is a candidate, equal queries are answered once,
    and different vectors under one id are queries of their own. An empty table gives an empty one; other columns are
    not read. Scores are exact as long as they fit into 64 bits.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), is_query.alias("query"), quantised(F.col(vector_col), scale).alias("w")
    )
    rows = rows.where("id is not null and w is not null").withColumn("query", F.coalesce("query", F.lit(False)))
    counted = materialised(rows.groupBy("id", "w", "query").agg(F.count(F.lit(1)).alias("n")), "vectors")
    total, asked = counted.agg(F.count(F.lit(1)), F.count_if("query")).first()
    blocks, parts = ceil_div(total, candidates_at_once), ceil_div(asked or 0, queries_at_once)
    spread = F.xxhash64("id", "w")
    common = [F.col("id"), F.col("w"), F.col("n"), spread.alias("part")]
    grid = (
        counted.select(
            F.lit(False).alias("query"),
            *common,
            F.pmod(spread, F.lit(blocks)).alias("block"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("ask"),
        )
    ).union(
        counted.where("query").select(
            F.lit(True).alias("query"),
            *common,
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
            F.pmod(F.xxhash64("w", "id"), F.lit(parts)).alias("ask"),
        )
    )
    best = grid.groupBy("block", "ask").applyInArrow(
        lambda table: _cell(table, k), "query_id long, part long, vec_id long, score long, n long"
    )
    copies = best.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k)))))
    order = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id", "_copy")
    ranked = copies.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
