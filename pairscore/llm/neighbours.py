"""Nearest neighbours by cosine: a block matrix join with int8 tiles and exact recomputation.

Vectors are dealt over blocks of bounded size by a hash of their id; each query block meets each block of rows in
one task. There both sides are scaled to unit length and rounded to int8. With x' the rounded form of a unit vector
x and e = |x - x'|, |x.y - x'.y'| <= e_x + (1 + e_x) e_y, so a tile of int8 products bounds every cosine. A row whose
upper bound reaches the k-th best lower bound of a query survives; survivors are recomputed from the original
components in double precision. Each task returns k rows a query, and a heap merges those of all tasks.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

RESULT = "query_id long, vec_id long, score double"


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, step, error bound e) of the rows of ``v``, scaled to unit length."""
    unit = v / np.sqrt(np.square(v).sum(1))[:, None]
    step = np.abs(unit).max(1) / 127
    code = np.rint(unit / step[:, None]).astype(np.int8)
    error = np.sqrt(np.square(unit - code * step[:, None]).sum(1)) + 1e-9
    return code, step, error


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the pairs of rows, each sum taken in the order of the components."""
    dot, x, y = (np.zeros(len(a)) for _ in range(3))
    for j in range(a.shape[1]):
        dot += a[:, j] * b[:, j]
        x += a[:, j] * a[:, j]
        y += b[:, j] * b[:, j]
    return dot / np.sqrt(x * y)


def block_search(query_ids, queries, ids, rows, k: int, tile: int = 4096, group: int = 256):
    """Yields (query id, ids, scores): the k best rows of each query, best first, ties to the smaller id."""
    code, step, error = quantise(rows)
    wide = np.float32 if rows.shape[1] * 127 * 127 < 1 << 24 else np.float64  # int products stay exact
    for at in range(0, len(queries), group):
        own, own_ids = queries[at: at + group], query_ids[at: at + group]
        qcode, qstep, qerror = quantise(own)
        qwide = qcode.astype(wide)
        reached = np.full(len(own), -np.inf)
        kept: list[list] = [[] for _ in own]
        for lo in range(0, len(rows), tile):
            part = slice(lo, lo + tile)
            near = (qwide @ code[part].astype(wide).T).astype(np.float64) * qstep[:, None] * step[part]
            near[own_ids[:, None] == ids[part]] = -np.inf
            slack = qerror[:, None] + (1 + qerror[:, None]) * error[part] + 1e-9
            low = near - slack
            if low.shape[1] > k:
                reached = np.maximum(reached, np.partition(low, -k, axis=1)[:, -k])
            q, r = np.nonzero((near + slack >= reached[:, None]) & (near > -np.inf))
            for cut in range(0, len(q), 1 << 16):
                qq, rr = q[cut: cut + (1 << 16)], r[cut: cut + (1 << 16)] + lo
                score = cosines(own[qq], rows[rr])
                order = np.lexsort((ids[rr], -score, qq))
                place = np.arange(len(order)) - np.searchsorted(qq[order], qq[order])
                for i in order[place < k]:
                    kept[qq[i]].append((-score[i], int(ids[rr[i]])))
        for i, found in enumerate(kept):
            best = heapq.nsmallest(k, found)
            yield int(own_ids[i]), [x[1] for x in best], [-x[0] for x in best]


def _matrix(column) -> np.ndarray:
    """The vectors as rows, each scaled by a power of two so that its largest component is near 1: squares then neither over-
    nor underflow, and as such a factor is exact, cosines keep every digit."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1))[1][:, None])


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, block_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` (vec_id, embedding) with the largest cosine for
    each row where ``is_query`` holds, without the query's own vec_id, ties to the smaller vec_id; all rows, where
    there are fewer.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null vec_id, take no
    part. Of rows that repeat a vec_id the smallest array counts, once. Vectors meet only those of the same length.
    Other columns are ignored; an empty table, or one without queries, gives an empty result."""
    e = F.col("embedding")
    usable = (F.col("vec_id").isNotNull() & (F.size(e) > 0)
              & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(e, lambda x: x != 0))
    rows = store(vectors.withColumn("is_query", F.coalesce(is_query, F.lit(False)))
                 .select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "is_query").where(usable)
                 .groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.max("is_query").alias("is_query"))
                 .withColumn("dim", F.size("embedding")), "vectors")
    counts = rows.agg(F.count("*"), F.count_if("is_query")).first()
    row_blocks, query_blocks = (max(1, -(-int(c) // block_rows)) for c in counts)
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["dim", "qb", "rb", "vec_id", "embedding"]
    left = (rows.where("is_query").withColumn("qb", deal(query_blocks)).withColumn("rb", spread(row_blocks))
            .select(columns))
    # other names than on the left: both sides come from one table, and cogroup tells their columns apart by name
    right = (rows.withColumn("rb", deal(row_blocks)).withColumn("qb", spread(query_blocks))
             .select(*[F.col(c).alias(f"r_{c}") for c in columns]))

    def tile(queries: pa.Table, block: pa.Table) -> pa.Table:
        q, v, s = [], [], []
        if queries.num_rows and block.num_rows:
            sides = [(t.column(p + "vec_id").to_numpy(), _matrix(t.column(p + "embedding")))
                     for t, p in ((queries, ""), (block, "r_"))]
            for query, ids, scores in block_search(*sides[0], *sides[1], k):
                q += [query] * len(ids)
                v += ids
                s += scores
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()),
                         "score": pa.array(s, pa.float64())})

    found = left.groupBy("dim", "qb", "rb").cogroup(right.groupBy("r_dim", "r_qb", "r_rb")).applyInArrow(tile, RESULT)

    def merge(part: pa.Table) -> pa.Table:
        rows = zip(part.column("score").to_pylist(), part.column("vec_id").to_pylist())
        best = heapq.nsmallest(k, ((-s, v) for s, v in rows))
        return pa.table({"query_id": part.column("query_id").slice(0, len(best)),
                         "rank": pa.array(range(1, len(best) + 1), pa.int32()),
                         "vec_id": pa.array([v for _, v in best], pa.int64()),
                         "score": pa.array([-s for s, _ in best], pa.float64())})
    return found.groupBy("query_id").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")
