"""Benchmark decontamination by spaced seeds.

A mask names the token positions of a seed that must agree and leaves out others, which may differ. Seeds of the
benchmark and of the documents are joined on their hash; a hit fixes an alignment (document position minus item
position), and along it the tokens are compared. An item overlaps a document where some ``overlap`` aligned tokens
(all tokens of a shorter item) hold at most a sixth of their number in substitutions. Every placement of two substitutions
in 12 tokens, and of one in 9 to 11, leaves a seed of one of the three masks whole. Items of up to 8 tokens have seeds of
their own length besides: all their tokens, and from 6 tokens on, where one may differ, all but each single one. So at the
defaults no such overlap is missed. Items under ``min_tokens`` are out of scope.

Before the join the documents' seeds pass a bit table of fixed size that Spark fills from the benchmark: it only
saves shuffling seeds that cannot join. The join itself has no limits on hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, hash_ranges, mix, split_words, store, text_bytes

MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 6, 8), (0, 1, 2, 6, 8))
#: Bits of the table; 2^27 bits are 16 MB, whatever the benchmark's size.
TABLE_BITS = 27
SPAN = max(max(m) for m in MASKS) + 1
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def token_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased tokens (letters, digits and all beyond ASCII) of each text, and each text's first."""
    data, bounds = text_bytes(pc.utf8_lower(pc.fill_null(column, "")))
    start, end, first = split_words(data, bounds, _WORD)
    return hash_ranges(data, start, end), first


def short_masks(length: int) -> list[tuple[int, tuple[int, ...]]]:
    """(number, mask) for items of ``length`` tokens: all of them, and where one may differ all but each single one."""
    everything = tuple(range(length))
    left_out = [everything[:j] + everything[j + 1:] for j in everything] if length >= 6 else []
    return [(1000 + 64 * length + j, mask) for j, mask in enumerate([everything, *left_out])]


def seeds(tokens: np.ndarray, first: np.ndarray, whole: list[int]):
    """Yields (position, hash) arrays: the seeds of every mask, and those for items of each length in ``whole``."""
    row_end = np.repeat(first[1:], np.diff(first))
    for number, mask in [*enumerate(MASKS), *[m for n in whole for m in short_masks(n)]]:
        n = len(tokens) - mask[-1]
        if n <= 0:
            continue
        at = np.flatnonzero(np.arange(n) + mask[-1] < row_end[:n])
        h = np.full(len(at), number, np.uint64)
        for offset in mask:
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + tokens[at + offset])
        yield at, h


def item_table(benchmark: DataFrame, min_tokens: int) -> DataFrame:
    """(item_id, tokens, seeds) of the items with ``min_tokens`` tokens or more."""
    def work(batches):
        for batch in by_bytes(batches, "text"):
            tokens, first = token_hashes(batch.column("text"))
            ids = batch.column("item_id").to_pylist()
            rows = {"item_id": [], "tokens": [], "seeds": []}
            for i, item in enumerate(ids):
                own = tokens[first[i]: first[i + 1]]
                if len(own) < min_tokens or item is None:
                    continue
                whole = [len(own)] if len(own) < SPAN else []
                found = [{"hash": int(h), "item_pos": int(p)}
                         for at, hs in seeds(own, np.array([0, len(own)]), whole) for p, h in zip(at, hs.view(np.int64))]
                rows["item_id"].append(item)
                rows["tokens"].append(own.view(np.int64).tolist())
                rows["seeds"].append(found)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("item_id", pa.int64()), ("tokens", pa.list_(pa.int64())),
                ("seeds", pa.list_(pa.struct([("hash", pa.int64()), ("item_pos", pa.int32())])))]))
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        work, "item_id long, tokens array<long>, seeds array<struct<hash:long,item_pos:int>>")


def _bit_table(hashes: DataFrame) -> np.ndarray:
    """The bit table of the benchmark's hashes: at most 2^(TABLE_BITS - 5) words come from Spark."""
    slot = F.shiftrightunsigned("hash", 64 - TABLE_BITS)
    words = (hashes.select(F.shiftrightunsigned(slot, 5).cast("int").alias("w"), slot.bitwiseAND(F.lit(31)).cast("int").alias("b"))
             .distinct().groupBy("w").agg(F.sum(F.pow(F.lit(2.0), F.col("b")).cast("long")).alias("bits")))
    table = np.zeros(1 << (TABLE_BITS - 5), np.uint32)
    part = words.toArrow()
    table[part.column("w").to_numpy()] = part.column("bits").to_numpy().astype(np.uint32)
    return table


def hit_documents(docs: DataFrame, table, lengths: list[int]) -> DataFrame:
    """(doc_id, tokens, seeds) of the documents with a seed whose bit is set."""
    def work(batches):
        bits = table.value
        for batch in by_bytes(batches, "text"):
            tokens, first = token_hashes(batch.column("text"))
            places, hashes = [], []
            for at, h in seeds(tokens, first, lengths):
                slot = h >> np.uint64(64 - TABLE_BITS)
                on = (bits[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32)) & np.uint32(1)
                places.append(at[on > 0])
                hashes.append(h[on > 0])
            if not places or not sum(map(len, places)):
                continue
            at, h = np.concatenate(places), np.concatenate(hashes).view(np.int64)
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            rows = np.searchsorted(first, at, "right") - 1
            ids, doc, own, found = batch.column("doc_id").to_pylist(), [], [], []
            lead = np.flatnonzero(np.diff(rows, prepend=-1))
            for lo, hi in zip(lead.tolist(), [*lead[1:].tolist(), len(rows)]):
                i = int(rows[lo])
                doc.append(ids[i])
                own.append(tokens[first[i]: first[i + 1]].view(np.int64))
                found.append([{"hash": int(x), "pos": int(p)} for p, x in zip(at[lo:hi] - first[i], h[lo:hi])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(own, pa.list_(pa.int64())),
                 pa.array(found, pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int32())])))],
                ["doc_id", "tokens", "seeds"])
    return docs.mapInArrow(work, "doc_id long, tokens array<long>, seeds array<struct<hash:long,pos:int>>")


def overlaps(docs: DataFrame, benchmark: DataFrame, overlap: int = 12, min_tokens: int = 5) -> DataFrame:
    """(doc_id, item_id, matched): the verified overlaps of ``docs`` (doc_id, text) with ``benchmark`` (item_id, text),
    with the largest count of agreeing tokens along one alignment."""
    spark = docs.sparkSession
    items = store(item_table(benchmark, min_tokens), "seeds-items")
    index = items.select("item_id", F.explode("seeds").alias("s")).select("item_id", "s.hash", "s.item_pos")
    lengths = [r[0] for r in items.select(F.size("tokens").alias("n")).where(F.col("n") < SPAN).distinct().collect()]
    table = spark.sparkContext.broadcast(_bit_table(index.select("hash")))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    hit = store(hit_documents(docs, table, sorted(lengths)), "seeds-documents")
    aligned = (hit.select("doc_id", F.explode("seeds").alias("s")).select("doc_id", "s.hash", "s.pos")
               .join(index, "hash").select("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct())
    # the part of the document that lies along the item: both start at the first common position
    start = F.greatest(F.col("shift"), F.lit(0))
    skip = F.greatest(-F.col("shift"), F.lit(0))
    length = F.greatest(F.least(F.size("d") - start, F.size("i") - skip), F.lit(0))
    pairs = (aligned.join(items.select("item_id", F.col("tokens").alias("i")), "item_id")
             .join(hit.select("doc_id", F.col("tokens").alias("d")), "doc_id")
             .select("doc_id", "item_id", F.size("i").alias("n"),
                     F.zip_with(F.slice("d", start + 1, length), F.slice("i", skip + 1, length), lambda a, b: a == b).alias("same")))

    def work(batches):
        for batch in batches:
            best = []
            for n, same in zip(batch.column("n").to_pylist(), batch.column("same")):
                same = np.asarray(same.values, dtype=bool)
                width = min(n, overlap)
                sums = np.concatenate([[0], np.cumsum(same)])
                ok = len(same) >= width and (sums[width:] - sums[:-width]).max() >= width - width // 6
                best.append(int(same.sum()) if ok else 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("item_id"), pa.array(best, pa.int64())],
                                             ["doc_id", "item_id", "matched"])
    return (pairs.mapInArrow(work, "doc_id long, item_id long, matched long").where("matched > 0")
            .groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, overlap: int = 12, min_tokens: int = 5) -> DataFrame:
    """(doc_id, item_ids, matched, kept) for each row of ``docs``: the benchmark items that overlap it (sorted; empty if
    none), the most tokens that agree with one of them, and whether the document is clean of all.

    Tokens are runs of ASCII letters, digits and characters beyond ASCII, in lower case; items with fewer than
    ``min_tokens`` are no evidence and match nothing. Null and empty texts overlap nothing; items with a null id or
    text take no part; documents with a null doc_id are kept. Rows that repeat a doc_id share their overlaps; an item
    that is repeated, or repeats in a text, is listed once. Other columns are ignored. An empty table of documents
    gives an empty result; an empty benchmark keeps every document."""
    found = (overlaps(docs, benchmark, overlap, min_tokens).groupBy("doc_id")
             .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("matched").alias("matched")))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(store(found, "seeds-found"), "doc_id", "left")
            .select("doc_id", F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
                    F.coalesce("matched", F.lit(0)).alias("matched"), F.col("item_ids").isNull().alias("kept")))
