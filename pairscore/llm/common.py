"""Helpers shared by the operators: tables in the shared folder, joins against
id sets of checked size, vectorised word hashing, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairscore.session import stage_root

#: A frame of (id) rows is broadcast only when its counted rows are at most this many (16 MB of longs).
BROADCAST_IDS = 2_000_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's part of the folder that ``spark.checkpoint.dir`` names (``session.remove_stages``
    deletes it), with its file system: what Spark resolves by the cluster's default, tasks must not resolve by their own."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{stage_root(spark)}/llm/{name}-{uuid.uuid4().hex}")
    return path.getFileSystem(conf).makeQualified(path).toString()


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``store`` that no later step reads: their readers have been stored themselves."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def semi_join(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the distinct one-column frame ``ids``; broadcast only up to
    BROADCAST_IDS counted rows, a shuffled join beyond."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, key, "left_semi")


def hash_share(key: str, share: float) -> Column:
    """Whether the hash of ``key`` lies in the lowest ``share`` of all hashes."""
    if share >= 1:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(key), 11) < F.lit(int(share * (1 << 53)))


def smallest_hashes(df: DataFrame, key: str, n: int, ahead: int, find=lambda df: df) -> DataFrame:
    """The ``n`` rows of ``find(df)`` whose ``key`` hashes smallest (ties by key), or all, if there are fewer.

    A bounded sample that does not depend on the partitions. Only the share of ``df`` that is expected to hold
    ``ahead`` times ``n`` rows is looked at, then eight times as much, until it gives n; so what the last sort sees
    does not grow with the input."""
    share = min(1.0, ahead * n / max(1, df.count()))
    while True:
        found = store(find(df.where(hash_share(key, share))), "sample")
        if share >= 1 or found.count() >= n:
            break
        share *= 8
    order = F.shiftrightunsigned(F.xxhash64(key), 11)
    return found.orderBy(order, *found.columns).limit(n)


# ---------------------------------------------------------------- word hashing

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = 0x9E3779B97F4A7C15
_PIECE = 1 << 18
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = len(_powers.get("p", ()))
    if have < n:
        n = max(n, _PIECE + 1)
        for key, base in (("p", _ODD), ("i", pow(_ODD, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["p"], _powers["i"]


def hash_ranges(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each values[start:end] (ranges ascending), from prefix sums of value * odd^position."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        lo = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, lo + _PIECE, "right")))
        hi = int(end[j - 1])
        power, inverse = _power_table(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((values[lo:hi].astype(np.uint64) + np.uint64(1)) * power[: hi - lo], out=sums[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return mix(out)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, row bounds) of an Arrow string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def split_words(data: np.ndarray, bounds: np.ndarray, word: np.ndarray | None = None):
    """(start, end, first): byte ranges of the words of all rows, and the index of each row's first word.

    Words are runs of bytes other than space and \\x09-\\x0D, or of the bytes that ``word`` marks."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~_SEPARATOR[data] if word is None else word[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, bounds)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text (one row at least), which bounds a task's memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
            yield batch.slice(at, to - at)
            at = to


# -------------------------------------------------------- connected components

def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): smallest node reachable over ``edges`` (a, b), for every node of an edge.

    Alternating large-star and small-star steps; each works on (node, neighbour) rows through one grouped minimum
    and a join, so no node's neighbours meet in one task. Every round is written to the shared folder."""
    spark = edges.sparkSession
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = store(pairs, name)
    before = None
    while True:
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.join(least, "a").where("b > a and b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        last, pairs = pairs, store(small.select("e.a", "e.b").where("a <> b").distinct(), name)
        discard(last)
        # checksum in wrap-around arithmetic of 64-bit hashes, split in two to stay in range
        h = F.xxhash64("a", "b")
        now = pairs.agg(F.count("*"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def clean(df: DataFrame, *columns: str) -> list[Column]:
    """The named columns, resolved on ``df`` itself."""
    return [df[c] for c in columns]
