"""Hard-negative mining by a GNAT: a multiway hyperplane tree whose split points store distance ranges to siblings.

The tree is chosen on the driver from a bounded sample: every inner node has up to ``FAN`` split points, picked far
from each other, and a row goes to the child of its nearest split point. All rows are dealt down the tree by Spark,
and for each pair of split point i and sibling subtree j one grouped minimum and maximum gives the range of distances
from i to the rows below j, and the range of their squared lengths.

A request is an anchor with windows [low, high] of inner products. As |a - x|^2 = |a|^2 + |x|^2 - 2 a.x, a window and
the lengths below j make an annulus around the anchor; a sibling goes where the annulus, seen from some split point,
does not meet its range. The leaves that stay are compared exactly, in blocks of bounded size. Each search looks at
the anchor's own leaf first; the k-th best row found there narrows the windows for the other leaves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import smallest_hashes, store

FAN = 8
#: Rows that the tree is chosen from: bounds the driver's memory and, with LEAF_SAMPLE, the number of leaves.
SAMPLE_ROWS = 4096
LEAF_SAMPLE = 16
LEAF_ROWS = 2048
ROW_BLOCK, ANCHOR_BLOCK = 32_768, 8_192
#: Rows whose scaled components have a larger sum of squares could have scores that no long holds.
MOST_SQUARE = float(1 << 54)
ANY = 1 << 60
REQUEST = "anchor_id long, label long, point array<int>, leaf int, windows array<struct<ask:long,low:long,high:long>>"


# ------------------------------------------------------------------------ tree

class Tree:
    """Inner nodes with split points; ``child[node][i]`` is an inner node, or -1 - leaf."""

    def __init__(self, points: np.ndarray, depth: int):
        self.dim, self.split, self.child, self.leaves = points.shape[1], [], [], 0
        self.root = self._grow(points, depth)

    def _grow(self, points: np.ndarray, depth: int) -> int:
        chosen = self._far_points(points) if depth > 0 and len(points) >= 2 * LEAF_SAMPLE else []
        if len(chosen) < 2:
            self.leaves += 1
            return -self.leaves
        node, pivots = len(self.split), points[chosen]
        self.split.append(pivots)
        self.child.append([])
        nearest = distances(points, pivots).argmin(1)
        self.child[node] = [self._grow(points[nearest == i], depth - 1) for i in range(len(pivots))]
        return node

    @staticmethod
    def _far_points(points: np.ndarray) -> list[int]:
        chosen, gap = [0], distances(points, points[:1])[:, 0]
        while len(chosen) < FAN and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(points, points[chosen[-1:]])[:, 0])
        return chosen

    def route(self, points: np.ndarray) -> tuple[np.ndarray, list]:
        """The leaf of each point, and (node, child, rows, distances to the node's split points) of all its steps."""
        leaf, steps = np.zeros(len(points), np.int32), []
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                leaf[rows] = -1 - node
                continue
            d = distances(points[rows], self.split[node])
            nearest = d.argmin(1)
            for i, below in enumerate(self.child[node]):
                own = nearest == i
                if own.any():
                    steps.append((node, i, rows[own], d[own]))
                    todo.append((below, rows[own]))
        return leaf, steps

    def set_ranges(self, rows) -> None:
        """``near`` and ``far`` [node][i, j]: the range of distances from split point i to the rows below j; ``light``
        and ``heavy`` [node][j]: that of their squared lengths. An empty subtree has an empty range."""
        self.near = [np.full((len(p), len(p)), np.inf) for p in self.split]
        self.far = [np.full((len(p), len(p)), -np.inf) for p in self.split]
        self.light = [np.full(len(p), np.inf) for p in self.split]
        self.heavy = [np.full(len(p), -np.inf) for p in self.split]
        for node, i, j, low, high in rows:
            if i < 0:
                self.light[node][j], self.heavy[node][j] = low, high
            else:
                self.near[node][i, j], self.far[node][i, j] = low, high

    def visits(self, point: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[int]:
        """Leaves that can hold a row with an inner product in one of the windows."""
        square, found, todo = float(point @ point), [], [self.root]
        while todo:
            node = todo.pop()
            if node < 0:
                found.append(-1 - node)
                continue
            d = distances(point[None], self.split[node])[0]
            outer = square + self.heavy[node] - 2.0 * low[:, None]                       # windows x children
            inner = square + self.light[node] - 2.0 * high[:, None]
            slack = 1e-9 * (square + np.abs(self.heavy[node]) + np.abs(2.0 * low[:, None]) + np.abs(2.0 * high[:, None])) + 1e-6
            alive = (outer >= -slack) & np.isfinite(self.light[node])
            r_out = np.sqrt(np.maximum(outer + slack, 0))
            r_in = np.sqrt(np.where(np.isfinite(inner), np.maximum(inner - slack, 0), 0))
            edge = 1e-9 * d.max() + 1e-6
            least = np.maximum(d[:, None] - r_out[:, None, :], r_in[:, None, :] - d[:, None])   # windows x i x children
            most = d[:, None] + r_out[:, None, :]
            alive &= ((most >= self.near[node] - edge) & (least <= self.far[node] + edge)).all(1)
            todo += [self.child[node][j] for j in np.flatnonzero(alive.any(0))]
        return found


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows; each from its own differences, so that equal rows are at 0."""
    out = np.empty((len(a), len(b)))
    for i, p in enumerate(b):
        out[:, i] = np.sqrt(np.square(a - p).sum(1))
    return out


def _matrix(column, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), kind)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def build(rows: DataFrame, dim: int, n_rows: int) -> Tree:
    """The tree for the rows of one length, with the ranges of all of them; a row of ``rows`` has (vec_id, point)."""
    own = rows.where(F.size("point") == dim)
    sample = smallest_hashes(own.select("vec_id", "point"), "vec_id", SAMPLE_ROWS, 4).toArrow()
    depth = int(np.ceil(np.log(max(1.0, n_rows / LEAF_ROWS)) / np.log(FAN)))
    tree = Tree(_matrix(sample.column("point")), depth)

    def ranges(batches):
        found = {}
        for batch in batches:
            points = _matrix(batch.column("point"))
            square = np.square(points).sum(1)
            for node, j, at, d in tree.route(points)[1]:
                low = np.append(square[at].min(), d.min(0))
                high = np.append(square[at].max(), d.max(0))
                was = found.get((node, j))
                found[node, j] = (low, high) if was is None else (np.minimum(low, was[0]), np.maximum(high, was[1]))
        flat = [(node, i - 1, j, low[i], high[i]) for (node, j), (low, high) in found.items() for i in range(len(low))]
        yield pa.RecordBatch.from_pylist([dict(zip(("node", "i", "j", "low", "high"), r)) for r in flat], schema=pa.schema(
            [("node", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]))

    # at most FAN * (FAN + 1) rows a node come to the driver
    tree.set_ranges(own.select("point").mapInArrow(ranges, "node int, i int, j int, low double, high double")
                    .groupBy("node", "i", "j").agg(F.min("low"), F.max("high")).collect())
    return tree


def route(rows: DataFrame, tree: Tree) -> DataFrame:
    """``rows`` with ``leaf``; rows of another length than the tree's have a leaf for each length, below zero."""
    columns = ["vec_id", "label", "is_anchor", "point"]

    def work(batches):
        for batch in batches:
            size = np.diff(np.asarray(batch.column("point").offsets))
            leaf = (-1 - size).astype(np.int32)
            own = np.flatnonzero(size == tree.dim)
            if len(own):
                leaf[own] = tree.route(_matrix(batch.column("point").take(pa.array(own))))[0]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(leaf, pa.int32())], [*columns, "leaf"])
    return rows.select(columns).mapInArrow(work, "vec_id long, label long, is_anchor boolean, point array<int>, leaf int")


# ---------------------------------------------------------------------- search

def best_of(score: np.ndarray, fits: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` largest scores where ``fits``, ties to the smaller index, in no special order."""
    at = np.flatnonzero(fits)
    if len(at) > k:
        own = score[at]
        edge = np.partition(own, -k)[-k]
        above = at[own > edge]
        at = np.concatenate([above, at[own == edge][: k - len(above)]])
    return at


def compare(requests: pa.Table, rows: pa.Table, k: int, same: bool) -> pa.Table:
    """(anchor_id, ask, vec_id, score) of the k best rows in each window, with the anchor's label or with others."""
    if not requests.num_rows:
        rows = rows.slice(0, 0)
    if not rows.num_rows:
        requests = requests.slice(0, 0)
    rows = rows.sort_by("r_vec_id")
    ids, labels = rows.column("r_vec_id").to_numpy(), rows.column("r_label").to_numpy()
    points, anchors = _matrix(rows.column("r_point")), _matrix(requests.column("point"))
    # sums below 2^53 are exact in double precision, and matrix products fast
    bound = np.square(points).sum(1).max() ** 0.5 * np.square(anchors).sum(1).max() ** 0.5 if points.size and anchors.size else 0
    kind = np.float64 if bound < 1 << 52 else np.int64
    points = points.astype(kind)
    own_ids, own_labels = (requests.column(c).to_numpy() for c in ("anchor_id", "label"))
    windows = requests.column("windows").to_pylist()
    out = ([], [], [], [])
    for lo in range(0, len(anchors), 64):
        part = anchors[lo: lo + 64].astype(kind) @ points.T
        for i, score in enumerate(part, lo):
            score = score.astype(np.int64)
            fits = (labels == own_labels[i]) & (ids != own_ids[i]) if same else labels != own_labels[i]
            for w in windows[i]:
                at = best_of(score, fits & (score >= w["low"]) & (score <= w["high"]), k)
                for column, value in zip(out, (np.full(len(at), own_ids[i]), np.full(len(at), w["ask"]), ids[at], score[at])):
                    column.append(value)
    return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64())
                     for c, v in zip(("anchor_id", "ask", "vec_id", "score"), out)})


def _scan(requests: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """The k best rows of each window among the rows of the request's leaf, of every block by itself."""
    # both tables have a row a leaf: at most SAMPLE_ROWS / LEAF_SAMPLE leaves and one for each other vector length
    sizes = (rows.groupBy("leaf").agg(F.ceil(F.count("*") / ROW_BLOCK).cast("int").alias("blocks"))
             .join(requests.groupBy("leaf").agg(F.ceil(F.count("*") / ANCHOR_BLOCK).cast("int").alias("sets")), "leaf"))
    sizes = store(sizes, "negatives-sizes")
    deal = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (requests.join(sizes, "leaf").withColumn("part", deal("anchor_id", "sets")).withColumn("block", spread("blocks"))
            .select("leaf", "part", "block", "anchor_id", "label", "point", "windows"))
    right = (rows.join(sizes, "leaf").withColumn("block", deal("vec_id", "blocks")).withColumn("part", spread("sets"))
             .select(*[F.col(c).alias(f"r_{c}") for c in ("leaf", "part", "block", "vec_id", "label", "point")]))

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        return compare(a, b, k, same)
    return (left.groupBy("leaf", "part", "block").cogroup(right.groupBy("r_leaf", "r_part", "r_block"))
            .applyInArrow(tile, "anchor_id long, ask long, vec_id long, score long"))


def _first(found: DataFrame, k: int) -> DataFrame:
    """(anchor_id, ask, rank, vec_id, score): the k best of each request, ties to the smaller vec_id."""
    order = Window.partitionBy("anchor_id", "ask").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _other_leaves(requests: DataFrame, tree: Tree) -> DataFrame:
    """The requests at each further leaf that their windows can reach. Rows of other lengths have one leaf, their own."""
    def work(batches):
        for batch in batches:
            points, home = batch.column("point"), batch.column("leaf").to_numpy()
            row, leaf = [], []
            for i, windows in enumerate(batch.column("windows").to_pylist()):
                if home[i] < 0 or not windows:
                    continue
                low, high = (np.array([w[c] for w in windows], np.float64) for c in ("low", "high"))
                found = [x for x in tree.visits(np.asarray(points[i].values, np.float64), low, high) if x != home[i]]
                row += [i] * len(found)
                leaf += found
            if row:
                part = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([part.column(c) if c != "leaf" else pa.array(leaf, pa.int32())
                                                  for c in part.schema.names], part.schema.names)
    return requests.mapInArrow(work, REQUEST)


def _search(requests: DataFrame, rows: DataFrame, tree: Tree, k: int, same: bool, name: str) -> DataFrame:
    """(anchor_id, ask, rank, vec_id, score): the k best rows of each window over all leaves."""
    home = store(_first(_scan(requests, rows, k, same), k), f"negatives-{name}-home")
    # k rows in the own leaf raise the lower end: what lies below their last cannot be among the k best
    last = home.where(F.col("rank") == k).select("anchor_id", F.col("ask"), F.col("score").alias("reached"))
    asks = (requests.select("anchor_id", F.explode("windows").alias("w")).select("anchor_id", "w.*")
            .join(last, ["anchor_id", "ask"], "left").groupBy("anchor_id")
            .agg(F.collect_list(F.struct("ask", F.greatest("low", "reached").alias("low"), "high")).alias("windows")))
    narrowed = requests.drop("windows").join(asks, "anchor_id").select("anchor_id", "label", "point", "leaf", "windows")
    away = store(_other_leaves(narrowed, tree), f"negatives-{name}-visits")
    return store(_first(home.drop("rank").unionByName(_scan(away, rows, k, same)), k), f"negatives-{name}")


def scaled_rows(vectors: DataFrame, is_anchor: Column, label: Column, scale: int) -> DataFrame:
    """(vec_id, label, is_anchor, point) of the rows that take part, each vec_id once."""
    e = F.col("embedding")
    part = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), e,
                          F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate(e, F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") * scale, F.lit(2.0)))
    point = F.when(square <= MOST_SQUARE, F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("int")))
    return (part.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & finite)
            .select("vec_id", "label", "is_anchor", point.alias("point")).where("point is not null")
            .groupBy("vec_id").agg(F.min(F.struct("label", "point")).alias("r"), F.max("is_anchor").alias("is_anchor"))
            .select("vec_id", "r.label", "is_anchor", "r.point"))


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row of ``vectors`` (vec_id,
    embedding, ...) where ``is_anchor`` holds, its ``positives`` best other rows of the same ``label``, and for each of
    these the ``negatives`` best rows of other labels with ``low * p <= 100 * n <= high * p``, where p and n are their
    scores. A score is the inner product of the components floor(scale * x); ties go to the smaller vec_id. Fewer rows
    are returned where there are fewer.

    Rows with a null vec_id, label or vector, or a null or non-finite component, take no part; nor do rows whose scaled
    components have a sum of squares above 2^54, as a long might not hold their scores. Of rows that repeat a vec_id the
    one with the smallest label, then vector, counts, once. Vectors meet only those of the same length; empty ones meet
    with score 0. Other columns are ignored. An empty table, or one without anchors, gives an empty result."""
    rows = store(scaled_rows(vectors, is_anchor, label, scale), "negatives-rows")
    top = rows.groupBy(F.size("point").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    tree = build(rows, *top) if top else Tree(np.zeros((0, 1)), 0)
    rows = store(route(rows, tree), "negatives-leaves")
    everything = F.array(F.struct(F.lit(-1).cast("long").alias("ask"), F.lit(-ANY).alias("low"), F.lit(ANY).alias("high")))
    anchors = rows.where("is_anchor").select(F.col("vec_id").alias("anchor_id"), "label", "point", "leaf")
    near = _search(anchors.withColumn("windows", everything), rows, tree, positives, True, "positives")
    near = near.select("anchor_id", F.col("vec_id").alias("ask"), F.col("score").alias("positive_score"))
    floor = lambda c: F.expr(f"({c} - pmod({c}, 100)) div 100")
    window = F.struct("ask", (-floor(f"(-{low} * positive_score)")).alias("low"), floor(f"({high} * positive_score)").alias("high"))
    asked = near.select("anchor_id", window.alias("w")).groupBy("anchor_id").agg(F.collect_list("w").alias("windows"))
    requests = anchors.join(asked, "anchor_id").select("anchor_id", "label", "point", "leaf", "windows")
    found = _search(requests, rows, tree, negatives, False, "negatives")
    return (found.join(near, ["anchor_id", "ask"])
            .select("anchor_id", F.col("ask").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


#: DuckDB SQL of hard_negatives() over ``embeddings``, with the anchors, labels and defaults of the registered query.
SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
  WHERE k <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
