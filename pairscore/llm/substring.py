"""Removal of long passages that occur in an earlier document, by a compacted de Bruijn graph over token k-mers.

Every window of ``window`` words has a minimiser: the smallest (leftmost on ties) hash of its k-mers. Equal windows
have equal minimisers at equal offsets. A maximal run of windows with the same minimiser occurrence is an edge of the
graph: it is identified by the hash of the k-mer and the hash of all words that its windows touch (128 bits together),
and consecutive runs of a document are consecutive edges. So a text of n words gives about 2n / (window - k + 2)
edges, and only those whose k-mer occurs in two documents are kept.

Edge e is joined to its successor f; they lie on one nonbranching path when every occurrence of e is followed by f and
every occurrence of f preceded by e. All occurrences of such a path are parallel, so it is compacted in the source
coordinates of its first occurrence, the smallest document, and its other occurrences are spans found in one step.
Where a k-mer begins different edges, the graph branches: the single windows of the first occurrences of these edges
are hashed from the texts and compared. A window is removed exactly where its words also start in a smaller doc_id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, discard, hash_ranges, semi_join, split_words, store, text_bytes

EDGES = "kmer long, edge long, doc_id long, start int, windows int, before long, after long"
WINDOWS = "kmer long, hash long, doc_id long, start int"


def minimisers(values: np.ndarray, span: int) -> np.ndarray:
    """For each i, the index of the smallest of values[i:i + span], leftmost on ties; len(values) - span + 1 rows."""
    at, width = np.arange(len(values)), 1
    while width < span:
        step = min(width, span - width)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        width += step
    return at


def text_words(column) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(column)
    start, end, first = split_words(data, bounds)
    return hash_ranges(data, start, end), first


def text_edges(words: np.ndarray, first: np.ndarray, window: int, k: int):
    """(row, kmer, edge, start in the row, windows) arrays of the edges of all rows, in order."""
    if len(words) < window:
        return (np.zeros(0, np.int64),) * 5
    places = np.arange(len(words) - k + 1)
    kmers = hash_ranges(words, places, places + k)
    lead = minimisers(kmers, window - k + 1)  # by window start
    row = np.searchsorted(first, np.arange(len(lead)), "right") - 1
    valid = np.arange(len(lead)) + window <= first[row + 1]
    new = valid.copy()
    new[1:] &= (lead[1:] != lead[:-1]) | (row[1:] != row[:-1]) | ~valid[:-1]
    start = np.flatnonzero(new)
    # windows of a row that are valid are its first ones, so a run ends at the next run or at the row's last window
    last_valid = np.maximum(first[row[start] + 1] - window, 0)
    following = np.append(start[1:], len(lead))
    windows = np.minimum(following, last_valid + 1) - start
    edges = hash_ranges(words, start, start + windows - 1 + window)
    return row[start], kmers[lead[start]], edges, start - first[row[start]], windows


def edge_table(docs: DataFrame, window: int, k: int) -> DataFrame:
    def work(batches):
        for batch in by_bytes(batches, "text"):
            words, first = text_words(batch.column("text"))
            row, kmer, edge, start, windows = text_edges(words, first, window, k)
            if not len(row):
                continue
            ids = batch.column("doc_id").cast(pa.int64()).to_numpy()
            edge = edge.view(np.int64)
            inner = row[1:] == row[:-1]
            before = pa.array(np.append(0, edge[:-1]), mask=~np.append(False, inner))
            after = pa.array(np.append(edge[1:], 0), mask=~np.append(inner, False))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kmer.view(np.int64)), pa.array(edge), pa.array(ids[row]), pa.array(start.astype(np.int32)),
                 pa.array(windows.astype(np.int32)), before, after],
                ["kmer", "edge", "doc_id", "start", "windows", "before", "after"])
    return docs.mapInArrow(work, EDGES)


def window_table(docs: DataFrame, window: int) -> DataFrame:
    """The single windows of ``docs`` (doc_id, text, edges: array of (kmer, start, windows))."""
    def work(batches):
        for batch in by_bytes(batches, "text"):
            words, first = text_words(batch.column("text"))
            kmers, docs_, starts, places = [], [], [], []
            for i, (doc, edges) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("edges").to_pylist())):
                for e in sorted(edges, key=lambda e: e["start"]):
                    at = np.arange(e["start"], e["start"] + e["windows"])
                    starts.append(at)
                    places.append(at + first[i])
                    kmers.append(np.full(len(at), e["kmer"]))
                    docs_.append(np.full(len(at), doc))
            if not places:
                continue
            at = np.concatenate(places)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(kmers)), pa.array(hash_ranges(words, at, at + window).view(np.int64)),
                 pa.array(np.concatenate(docs_)), pa.array(np.concatenate(starts).astype(np.int32))],
                ["kmer", "hash", "doc_id", "start"])
    return docs.select("doc_id", "text", "edges").mapInArrow(work, WINDOWS)


def paths(occurrences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, paths) of the repeated part of the graph. edges: kmer, edge, source (smallest doc_id), branching;
    paths: kmer and edge of the first edge, source, source_start, windows."""
    key = ["kmer", "edge"]
    edges = store(occurrences.groupBy(key).agg(
        F.min(F.struct("doc_id", "start")).alias("at"), F.max("windows").alias("windows"), F.count("*").alias("n"),
        *[f(c).alias(f"{c}_{n}") for c in ("before", "after") for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]),
        "substring-graph")
    only = lambda c: (F.col(f"{c}_n") == F.col("n")) & (F.col(f"{c}_lo") == F.col(f"{c}_hi"))
    out = edges.where(only("after")).select(F.col("edge").alias("p_edge"), F.col("after_lo").alias("p_after"))
    into = edges.where(only("before"))
    linked = (into.join(out, (F.col("before_lo") == F.col("p_edge")) & (F.col("edge") == F.col("p_after")))
              .select(*key, F.lit(1).alias("linked")).distinct())
    many = edges.groupBy("kmer").agg(F.count("*").alias("c")).where("c > 1").select("kmer", F.lit(True).alias("branching"))
    edges = (edges.join(linked, key, "left").join(many, "kmer", "left")
             .select(*key, "windows", F.col("at.doc_id").alias("source"), F.col("at.start").alias("source_start"),
                     F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("branching", F.lit(False)).alias("branching")))
    edges = store(edges, "substring-edges")
    run = F.sum(1 - F.col("linked")).over(Window.partitionBy("source").orderBy("source_start"))
    found = (edges.withColumn("run", run).groupBy("source", "run")
             .agg(F.min(F.struct("source_start", *key)).alias("head"), F.sum("windows").alias("windows"))
             .select("head.kmer", "head.edge", "source", F.col("head.source_start").alias("source_start"), "windows"))
    return edges, found


def repeated_spans(docs: DataFrame, window: int = 50, k: int = 20) -> DataFrame:
    """(doc_id, start, end): word spans (end exclusive, may overlap) of ``docs`` (doc_id, text) made up of windows
    whose words also start in a smaller doc_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    every = store(edge_table(docs, window, k), "substring-kmers")
    shared = (every.groupBy("kmer").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
              .where("lo < hi").select("kmer"))
    # stored, so that the join is broadcast when the k-mers are few, and else has two plain exchanges, which Spark can
    # split at a k-mer that is a large part of all
    shared = store(shared, "substring-repeated")
    occurrences = store(semi_join(every, shared, "kmer"), "substring-shared")
    discard(every, shared)
    edges, found = paths(occurrences)

    spans = (occurrences.select("kmer", "edge", "doc_id", "start")
             .join(found.withColumnRenamed("windows", "length"), ["kmer", "edge"]).where("doc_id > source")
             .select("doc_id", "start", (F.col("start") + F.col("length") - 1 + window).cast("int").alias("end")))

    branch = (occurrences.select("kmer", "edge", "doc_id", "start", "windows")
              .join(edges.where("branching").select("kmer", "edge", "source"), ["kmer", "edge"])
              .where("doc_id = source")
              .groupBy("doc_id").agg(F.collect_list(F.struct("kmer", "start", "windows")).alias("edges")))
    branch = store(branch, "substring-branches")
    texts = semi_join(docs, branch.select("doc_id"), "doc_id")
    single = store(window_table(texts.join(branch, "doc_id"), window), "substring-windows")
    first = single.groupBy("kmer", "hash").agg(F.min("doc_id").alias("source"))
    more = (single.join(first, ["kmer", "hash"]).where("doc_id > source")
            .select("doc_id", "start", (F.col("start") + window).alias("end")))
    return spans.unionByName(more)


def remove_repeats(docs: DataFrame, window: int = 50, k: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): ``docs`` (doc_id, text) without the words that lie in a
    window of ``window`` words whose sequence also starts in a document with a smaller doc_id.

    Words are runs other than space and \\x09-\\x0D, unchanged; all windows are judged on the input. kept is the rest
    joined by single spaces, kept_sha256 the lower-case hex of its UTF-8. Null, empty or short texts lose nothing
    and null gives kept = ''. Rows with a null doc_id are not compared and lose nothing. Rows that repeat a doc_id are
    one document in this sense: none of them is smaller than another, and a word goes from each of them where a
    smaller doc_id covers that place in any of them. Other columns are ignored; an empty table stays empty."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = store(repeated_spans(docs, window, k), "substring-spans")
    lists = spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    ids = spans.select("doc_id").distinct()
    changed = semi_join(docs, ids, "doc_id").join(lists, "doc_id")
    same = _anti_join(docs, ids).withColumn("spans", F.lit(None).cast("array<struct<start:int,end:int>>"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"

    def work(batches):
        for batch in by_bytes(batches, "text"):
            total, gone, sha, kept = [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                total.append(len(words))
                if found:
                    cover = np.zeros(len(words) + 1, np.int32)
                    starts, ends = (np.minimum([s[x] for s in found], len(words)) for x in ("start", "end"))
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, ends, -1)
                    stay = np.cumsum(cover[:-1]) == 0
                    words = [w for w, s in zip(words, stay) if s]
                gone.append(total[-1] - len(words))
                rest = b" ".join(words)
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha),
                 pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
    return changed.select("doc_id", "text", "spans").unionByName(same).mapInArrow(work, schema)


def _anti_join(docs: DataFrame, ids: DataFrame) -> DataFrame:
    from .common import BROADCAST_IDS

    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_anti")
