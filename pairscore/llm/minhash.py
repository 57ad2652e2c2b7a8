"""Near-duplicate groups by HyperMinHash sketches, with links confirmed on full shingle sets.

A document's shingles are hashed to 64 bits and dealt over buckets by the leading bits. A bucket keeps, of its smallest
hash, the count of leading zeros and the 10 bits after the leading one: a 16-bit register, 0 when empty. A sketch has
448 registers. Sets of 512 and more fill 448 buckets at once; smaller ones fill as many buckets as about half to all
of their size, again for each of several rehashes, so that bands of short texts stay as telling as those of long ones.

Candidates. Seven adjacent registers form a band; documents that agree in one of the 64 bands are candidates. At
Jaccard 0.8 a register agrees with probability 0.8 or (where both may be empty) more, so all bands differ with
probability (1 - 0.8^7)^64 < 3e-7 at most. Registers compare only within a size class; a document writes keys for
its own class and, where its partners may be of the class below, for that one.

Links. Copies (equal sets) are collapsed first. The hub of a band group is its member with the largest groups over all
bands, which is the most typical of a group of near copies. Each member is tested against the hub; components follow;
then only those members that are still outside the hub's component are tested against the members of other components.
So a group of thousands of near copies costs about one test a member, and no link between different components is left
untested. A test first compares the size ratio and the collision-corrected estimate from the registers (cut six
standard errors below the threshold), then counts the intersection of the full sets.

In the second round, groups of more than 24 members are not paired row by row. The members outside a hub's component
and all members of its large groups are dealt over blocks of bounded size, and each pair of blocks counts the
intersections of its full sets by products of 0/1 matrices, returning only enough links to connect what is linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (by_bytes, components, discard, hash_ranges, lower_ascii, mix, semi_join, split_words, store, text_bytes)

REGISTERS, BAND, MANTISSA_BITS = 448, 7, 10
#: Sets of at least this size fill all registers at once.
LARGE = 512
#: Sets below this size have too few independent registers for the estimate to rule a pair out.
ESTIMATED = 16
#: Band groups beyond this size are tested in blocks: of so many members outside the hub's component, and of all.
LARGE_GROUP, OUTSIDE_BLOCK, ALL_BLOCK = 24, 256, 1024
#: Collisions of registers by chance: this factor * registers / 2^(mantissa bits) * 4nm / (n + m)^2.
COLLISION = 0.169919487159739

SKETCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()), T.StructField("sketch", T.BinaryType()),
    T.StructField("below", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType()))])
SETS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("shingles", T.BinaryType())])


def shingle_sets(column, width: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes: ``width`` words, or the whole sequence if it has fewer."""
    data, bounds = text_bytes(column)
    data = lower_ascii(data)
    start, end, first = split_words(data, bounds)
    words = hash_ranges(data, start, end)
    grams = np.full(max(0, len(words) - width + 1), width, np.uint64)
    for k in range(width):
        grams = mix(grams * np.uint64(0xD6E8FEB86659FD93) + words[k: k + len(grams)])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        n = b - a
        if n >= width:
            yield np.unique(grams[a: b - width + 1])
        elif n:
            whole = np.full(1, n, np.uint64)
            for k in range(n):
                whole = mix(whole * np.uint64(0xD6E8FEB86659FD93) + words[a + k: a + k + 1])
            yield whole
        else:
            yield words[:0]


def size_class(n: int) -> int:
    """Buckets of a set of n: the power of two from n / 2 to n, 4 at least, or all registers."""
    return REGISTERS if n >= LARGE else max(4, 1 << (n.bit_length() - 1))


def registers(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The registers of a sorted set of 64-bit hashes."""
    times = -(-REGISTERS // buckets)
    values = hashes[None, :]
    if times > 1:
        salt = np.arange(times, dtype=np.uint64)[:, None] * np.uint64(0xA0761D6478BD642F)
        values = np.sort(mix(values ^ salt), axis=1)
    scaled = (values >> np.uint64(32)) * np.uint64(buckets)
    bucket = (scaled >> np.uint64(32)).astype(np.int64) + np.arange(times)[:, None] * buckets
    bucket = bucket.ravel()
    head = np.flatnonzero(np.diff(bucket, prepend=-1))  # sorted, so the first of a bucket is its smallest
    rest = (((scaled & np.uint64(0xFFFFFFFF)) << np.uint64(32)) | (values & np.uint64(0xFFFFFFFF))).ravel()[head]
    rest >>= np.uint64(11)  # 53 bits, exact as a double
    mantissa, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.where(rest == 0, 53, 53 - exponent)
    bits = np.where(rest == 0, 0, (mantissa * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    out = np.zeros(times * buckets, np.uint16)
    out[bucket[head]] = 1 + (zeros << MANTISSA_BITS) + bits
    return out[:REGISTERS]


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimate, registers used) of rows of registers, corrected for collisions by chance."""
    used = ((a > 0) | (b > 0)).sum(1)
    same = ((a == b) & (a > 0)).sum(1)
    chance = COLLISION * REGISTERS / (1 << MANTISSA_BITS) * 4 * n * m / np.square(n + m)
    return np.maximum(same - chance, 0) / np.maximum(used, 1), used


def band_keys(sketch: np.ndarray, buckets: int) -> np.ndarray:
    """A key for each band that holds a register which is not empty."""
    rows = sketch.reshape(-1, BAND).astype(np.uint64)
    key = np.arange(len(rows), dtype=np.uint64) + np.uint64(1000 * buckets)
    for k in range(BAND):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + rows[:, k])
    return key[rows.any(1)].view(np.int64)


def sketches(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, sketch, bands); d1 and d2 name the set: equal for equal sets, 128 bits together."""
    def work(batches):
        for batch in by_bytes(batches, "text"):
            rows = []
            for h in shingle_sets(batch.column("text"), width):
                n = len(h)
                if not n:
                    rows.append((0, 0, 0, None, None, None))
                    continue
                own, least = size_class(n), size_class(-(-n * percent // 100))
                regs, below = registers(h, own), None if least == own else registers(h, least)
                keys = band_keys(regs, own)
                if below is not None:
                    keys = np.concatenate([keys, band_keys(below, least)])
                rows.append((n, int(mix(h + np.uint64(0x1234567)).sum(dtype=np.uint64).view(np.int64)),
                             int(np.bitwise_xor.reduce(mix(h ^ np.uint64(0x5BD1E995))).view(np.int64)),
                             regs.tobytes(), None if below is None else below.tobytes(), keys))
            number = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(
                    zip(*rows), [number, number, number, pa.binary(), pa.binary(), pa.list_(number)])], [f.name for f in SKETCH])
    return docs.select("doc_id", "text").mapInArrow(work, SKETCH)


def set_table(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingles): the full sets as sorted 64-bit hashes."""
    def work(batches):
        for batch in by_bytes(batches, "text"):
            sets = [h.tobytes() for h in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.binary())],
                                             ["doc_id", "shingles"])
    return docs.select("doc_id", "text").mapInArrow(work, SETS)


def _sketch_filter(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass the size ratio and the estimate from the registers of the smaller one's class."""
    sizes = sets.select("doc_id", "n_shingles")
    side = lambda doc, n, s, t: sets.select(F.col("doc_id").alias(doc), F.col("n_shingles").alias(n),
                                            F.col("sketch").alias(s), F.col("below").alias(t))
    both = (pairs.join(sizes.toDF("a", "n"), "a").join(sizes.toDF("b", "m"), "b")
            .where(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent).select("a", "b")
            .join(side("a", "n", "s", "s2"), "a").join(side("b", "m", "t", "t2"), "b"))

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (batch.column(c).to_numpy() for c in "nm")
            least = [size_class(x) for x in np.minimum(n, m).tolist()]

            def side(c, sizes):
                own, below = batch.column(c).to_pylist(), batch.column(c + "2").to_pylist()
                rows = [o if size_class(x) == k else b for o, b, x, k in zip(own, below, sizes.tolist(), least)]
                return np.frombuffer(b"".join(rows), np.uint16).reshape(-1, REGISTERS)
            guess, used = estimate(side("s", n), side("t", m), n.astype(float), m.astype(float))
            j = percent / 100
            keep = (np.minimum(n, m) < ESTIMATED) | (guess >= j - 6 * np.sqrt(j * (1 - j) / np.maximum(used, 1)))
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return both.select("a", "b", "n", "m", "s", "s2", "t", "t2").mapInArrow(work, "a long, b long")


def _confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    both = (pairs.join(full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s")), "a")
            .join(full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("t")), "b"))

    def work(batches):
        for batch in batches:
            keep = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                s, t = (np.frombuffer(x.as_buffer(), np.uint64) for x in (s, t))
                if len(s) > len(t):
                    s, t = t, s
                common = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return both.select("a", "b", "s", "t").mapInArrow(work, "a long, b long")


def _tested(pairs: DataFrame, sets: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The links among candidate pairs (a, b)."""
    pairs = store(_sketch_filter(pairs, sets, percent), "minhash-pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    full = store(set_table(semi_join(docs.select("doc_id", "text"), ids, "doc_id"), width), "minhash-sets")
    links = store(_confirm(pairs, full, percent), "minhash-links")
    discard(pairs, full)
    return links


def _intersections(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of 0/1 matrices over ``width`` shingles at a time."""
    names, place = np.unique(np.concatenate(left + right), return_inverse=True)
    sizes = [len(x) for x in left + right]
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(names), width):
        a, b = np.searchsorted(place, (lo, lo + width))
        cells = np.zeros((len(sizes), min(width, len(names) - lo)), np.float32)
        cells[row[a:b], place[a:b] - lo] = 1
        out += cells[: len(left)] @ cells[len(left):].T
    return out


def _block_links(named: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) of the members of large groups that are outside their hub's component (doc_id, component, main):
    all of them that connect different components, up to connectedness."""
    roles = named.select(F.col("main").alias("cluster"), "doc_id", (F.col("component") != F.col("main")).alias("out")).distinct()
    counts = roles.groupBy("cluster").agg(F.count_if("out").alias("n_out"), F.count("*").alias("n")).where("n_out > 0")
    blocks = lambda n, size: F.ceil(F.col(n) / size).cast("int")
    roles = store(roles.join(counts, "cluster").withColumns({
        "outs": blocks("n_out", OUTSIDE_BLOCK), "alls": blocks("n", ALL_BLOCK)}), "minhash-clusters")
    full = store(set_table(semi_join(docs.select("doc_id", "text"), roles.select("doc_id").distinct(), "doc_id"), width),
                 "minhash-cluster-sets")
    rows = roles.join(full, "doc_id")
    deal = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["cluster", "i", "j", "doc_id", "out", "shingles"]
    left = rows.where("out").withColumn("i", deal("outs")).withColumn("j", spread("alls")).select(columns)
    # other names than on the left: cogroup tells the columns of both sides apart by name
    right = (rows.withColumn("j", deal("alls")).withColumn("i", spread("outs"))
             .select(*[F.col(c).alias(f"r_{c}") for c in columns]))

    def link(some: pa.Table, every: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if some.num_rows and every.num_rows:
            ids, others = some.column("doc_id").to_pylist(), every.column("r_doc_id").to_pylist()
            outside = np.array(every.column("r_out").to_pylist(), bool)
            sets = [[np.frombuffer(x.as_buffer(), np.uint64) for x in t.column(c)]
                    for t, c in ((some, "shingles"), (every, "r_shingles"))]
            common = _intersections(*sets)
            n, m = (np.array([len(x) for x in side], np.float64) for side in sets)
            linked = 100 * common >= percent * (n[:, None] + m - common)
            root: dict[int, int] = {}

            def top(x: int) -> int:
                while root.get(x, x) != x:
                    x = root[x]
                return x
            for x, row in zip(ids, linked):
                inside = np.flatnonzero(row & ~outside)
                if len(inside):
                    found.append((x, others[inside[0]]))  # the others inside are in its component
                for y in np.flatnonzero(row & outside).tolist():
                    a, b = top(x), top(others[y])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        found.append((x, others[y]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})
    keys = ["cluster", "i", "j"]
    links = store(left.groupBy(*keys).cogroup(right.groupBy(*[f"r_{k}" for k in keys])).applyInArrow(link, "a long, b long"),
                  "minhash-block-links")
    discard(roles, full)
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): near-duplicate components of ``docs`` (doc_id, text).

    Words are runs other than space and \\x09-\\x0D, A-Z in lower case; a set is the distinct shingles of ``width``
    words, or the whole sequence where there are fewer. Documents are linked with 100 * |A & B| >= percent * |A | B|;
    component_id is the smallest doc_id reachable, and kept marks doc_id = component_id.

    Null or empty text, or text without words: an empty set, linked with nothing. Rows with a null doc_id take no
    part and are not returned. Rows that repeat a doc_id are returned once with the first text in text order.
    Other columns are ignored. An empty table gives an empty result."""
    # A repeated id is rare, so texts are only compared for those that a count by id has found.
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    again = docs.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
    again = store(again, "minhash-again")
    if not again.isEmpty():
        once = semi_join(docs, again, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
        docs = docs.join(again, "doc_id", "left_anti").unionByName(once)
    every = store(sketches(docs, width, percent), "minhash-sketches")
    some = every.where("n_shingles > 0")
    copies = store(some.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("doc_id")), "minhash-copies")
    sets = some.select("doc_id", "n_shingles", "sketch", "below")
    alike = lambda n, m: F.least(n, m) * 100 >= F.greatest(n, m) * percent
    pair = lambda x, y: [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]
    # dealt by band once: the groups' sizes and the join with them need no further exchange
    bands = (some.select("doc_id", F.col("n_shingles").cast("int").alias("n"), "bands")
             .join(copies.select("doc_id"), "doc_id", "left_semi")
             .select(F.explode("bands").alias("band"), "doc_id", "n").repartition("band"))
    groups = bands.groupBy("band").agg(F.count("*").alias("c")).where("c > 1")
    members = store(bands.join(groups, "band").select("band", "doc_id", "n", "c"), "minhash-members")
    typical = members.groupBy("doc_id").agg(F.sum("c").alias("total"))
    hubs = (members.select("band", "doc_id", "n").join(typical, "doc_id").groupBy("band")
            .agg(F.max(F.struct("total", (-F.col("doc_id")).alias("minus"), "n")).alias("top"))
            .select("band", (-F.col("top.minus")).alias("hub"), F.col("top.n").alias("m")))
    grouped, members = members, store(members.join(hubs, "band"), "minhash-hubs")
    discard(grouped)
    first = members.where((F.col("doc_id") != F.col("hub")) & alike("n", "m")).select(*pair("doc_id", "hub")).distinct()
    links = _tested(first, sets, docs, percent, width)

    labels = store(components(links), "minhash-labels")
    named = (members.join(labels.toDF("doc_id", "component"), "doc_id", "left")
             .join(labels.toDF("hub", "main"), "hub", "left")
             .select("band", "c", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"),
                     F.coalesce("main", "hub").alias("main")))
    named = store(named, "minhash-named")
    discard(labels)
    few = named.where(F.col("c") <= LARGE_GROUP)
    outside = few.where("component <> main").select("band", F.col("doc_id").alias("x"), "n", F.col("component").alias("one"))
    other = few.select("band", F.col("doc_id").alias("y"), F.col("n").alias("m"), F.col("component").alias("two"), "main")
    second = (outside.join(other, "band").where("one <> two and (two = main or x > y)").where(alike("n", "m"))
              .select(*pair("x", "y")).distinct().join(first, ["a", "b"], "left_anti"))
    links = links.union(_tested(second, sets, docs, percent, width))
    large = named.where(F.col("c") > LARGE_GROUP)
    if not large.isEmpty():
        links = links.union(_block_links(large, docs, percent, width))
    discard(members, named)

    found = store(components(links), "minhash-components")
    of_copy = copies.join(found, copies["doc_id"] == found["node"], "left").select(
        "d1", "d2", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return (every.join(of_copy, ["d1", "d2", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))
