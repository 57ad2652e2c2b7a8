"""Prefix trie of conversations by whole-sequence collapse.

A conversation is a sequence of turns, and every turn a hash of its place, role and text. The sums of these hashes (four
of 32 bits) over the first d turns are the key of the prefix of length d, so keys come from running totals and need
neither the texts nor arrays of them. Identical conversations collapse into one weighted sequence with a list of the
conversations that end there. Sequences that are a proper prefix of another are dropped by an anti-join; what stays are
the leaves. Every node is then an aggregate over the prefixes of the weighted sequences:

* members: the sum of the weights; smallest member: the least one;
* leaves: the number of leaf sequences;
* totals over a subtree: each node's value lies on the sequence of its smallest member, at its depth. The sum of the
  values from a depth downwards is a running total along a sequence, and a node's total is the sum over its prefixes.

Turns are numbered after a range sort, and running totals are taken in blocks of ``BLOCK`` turns, so that a very long
conversation is dealt over many tasks; counts are combined before every shuffle.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

#: Turns of one conversation that a window sees at once.
BLOCK = 4096
#: The conversation ids in one piece of an end list agree in all but so many of their last bits.
CHUNK_BITS = 12
SUMS = ["k1", "k2", "k3", "k4"]
KEY = ["depth", *SUMS]


def crc32(value: Column) -> Column:
    """Unsigned CRC-32 of the decimal text of a number."""
    return F.crc32(value.cast("string").cast("binary"))


def number_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_hash, chars): the turns of each conversation, numbered from 1 in the order of ``turn`` (null
    first), then role and text; a null role or text is empty, and rows with a null conv_id are left out."""
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                                text.alias("text")).where("conv_id is not null")
    order = ["conv_id", F.asc_nulls_first("turn"), "role"]
    rows = (rows.withColumn("head", F.substring("text", 1, 64)).repartitionByRange(*order, "head")
            .sortWithinPartitions(*order, "text")
            .select("conv_id", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("turn_hash"),
                    F.length("text").cast("long").alias("chars")))

    def work(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            lead = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
            pos = np.arange(1, len(ids) + 1) - np.repeat(lead, np.diff(np.append(lead, len(ids))))
            if ids[0] == last:
                pos[: lead[1] if len(lead) > 1 else len(ids)] += seen
            last, seen = ids[-1], int(pos[-1])
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(np.full(len(ids), part), pa.int32()), pa.array(pos),
                                              batch.column("turn_hash"), batch.column("chars")],
                                             ["conv_id", "part", "pos", "turn_hash", "chars"])
    local = store(rows.mapInArrow(work, "conv_id long, part int, pos long, turn_hash string, chars long"), "trie-local")
    # only a conversation that goes on from one partition to the next has rows here: fewer than there are partitions
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (local.groupBy("conv_id", "part").agg(F.max("pos").alias("n")).withColumn("ahead", F.sum("n").over(before))
             .where("ahead is not null").select("conv_id", "part", "ahead"))
    return (local.join(ahead, ["conv_id", "part"], "left")
            .select("conv_id", (F.col("pos") + F.coalesce("ahead", F.lit(0))).alias("pos"), "turn_hash", "chars"))


def rebuild(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths): every conversation c anew, as the first h turns of conversation c - c % group (all if fewer, none
    if absent) and its own turns after its first h, with h = crc32(c) % most. Lengths (conv_id, n) hold all of them, also
    those left without turns."""
    c = F.col("conv_id")
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    bases = counts.where(c % group == 0).select(c.alias("base"), F.col("own").alias("base_turns"))
    plan = (counts.withColumn("base", c - c % group).withColumn("h", crc32(c) % most).join(bases, "base", "left")
            .select("conv_id", "base", "h", F.least("h", F.coalesce("base_turns", F.lit(0))).alias("taken"), "own"))
    plan = store(plan, "trie-plan")
    # fewer than `most` turns of a base, for fewer than 2 * group conversations
    heads = turns.where((c % group == 0) & (F.col("pos") < most)).select(c.alias("base"), "pos", "turn_hash", "chars")
    first = plan.select("conv_id", "base", "taken").join(heads, "base").where("pos <= taken").select(*turns.columns)
    short = plan.where("taken < h").select("conv_id", (F.col("taken") - F.col("h")).alias("shift"))
    rest = (turns.where(F.col("pos") > crc32(c) % most).join(short, "conv_id", "left")
            .withColumn("pos", F.col("pos") + F.coalesce("shift", F.lit(0))).select(*turns.columns))
    lengths = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return first.unionByName(rest), lengths


def _hashes() -> list[Column]:
    """Four 32-bit hashes of a turn at its place."""
    out = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), "pos", "turn_hash")
        out += [h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)]
    return [h.alias(k) for h, k in zip(out, SUMS)]


def running(rows: DataFrame, columns: list[str], backwards: bool = False) -> DataFrame:
    """``rows`` (conv_id, pos, ...) with the totals of ``columns`` up to and with each row along pos, or from it on."""
    rows = rows.withColumn("block", F.floor(F.col("pos") / BLOCK))
    along = F.desc if backwards else F.asc
    here = Window.partitionBy("conv_id", "block").orderBy(along("pos")).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy(along("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in columns])
    ahead = (blocks.select("conv_id", "block", *[F.sum(c).over(earlier).alias(f"{c}_ahead") for c in columns])
             .where(F.col(f"{columns[0]}_ahead").isNotNull()))
    others = [c for c in rows.columns if c not in (*columns, "block")]
    total = [(F.sum(c).over(here) + F.coalesce(f"{c}_ahead", F.lit(0))).alias(c) for c in columns]
    return rows.join(ahead, ["conv_id", "block"], "left").select(*others, *total)


@dataclass(frozen=True)
class Trie:
    """``nodes`` (depth, k1..k4, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens), and ``ends``
    (depth, k1..k4, chunk, conv_ids): the sorted ids of the conversations that end at a node, in pieces."""
    nodes: DataFrame
    ends: DataFrame


def build(turns: DataFrame, lengths: DataFrame) -> Trie:
    """The trie of the conversations of ``lengths`` (conv_id, n) with ``turns`` (conv_id, pos, turn_hash, chars)."""
    turns = store(turns.select("conv_id", "pos", "chars", *_hashes()), "trie-turns")
    sums = turns.groupBy("conv_id").agg(*[F.sum(k).alias(k) for k in SUMS])
    whole = store(lengths.withColumnRenamed("n", "depth").join(sums, "conv_id", "left")
                  .select("conv_id", "depth", *[F.coalesce(k, F.lit(0)).alias(k) for k in SUMS]), "trie-whole")
    ends = (whole.groupBy(*KEY, F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
            .agg(F.array_sort(F.collect_list("conv_id")).alias("conv_ids")))

    # one weighted sequence for each group of identical conversations, with the turns of its smallest member
    sequences = store(whole.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight")), "trie-sequences")
    own = turns.join(sequences.select("conv_id", "weight", F.col("depth").alias("n")), "conv_id")
    last = [F.col(k).alias(f"own_{k}") for k in SUMS]
    prefixes = running(own.select("conv_id", "pos", "chars", "weight", "n", *SUMS, *last), SUMS)
    root = sequences.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("chars"), "weight",
                            F.col("depth").alias("n"), *[F.lit(0).cast("long").alias(k) for k in SUMS], *[
                                F.lit(0).cast("long").alias(f"own_{k}") for k in SUMS])
    prefixes = store(prefixes.unionByName(root).withColumnRenamed("pos", "depth"), "trie-prefixes")

    proper = prefixes.where("depth < n").select(*KEY).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))

    parent = [(F.col(k) - F.max(f"own_{k}")).alias(f"up_{k}") for k in SUMS]
    nodes = store(prefixes.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
                                             F.max("chars").alias("chars"), *parent), "trie-nodes")
    value = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    below = (prefixes.select("conv_id", *KEY).join(leaves, "conv_id", "left").join(value, ["conv_id", "depth"], "left")
             .select("conv_id", *KEY, F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("saved", F.lit(0)).alias("saved")))
    below = running(below.withColumnRenamed("depth", "pos"), ["saved"], backwards=True).withColumnRenamed("pos", "depth")
    totals = below.groupBy(*KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    up = [(F.col("depth") - 1).alias("depth"), *[F.col(f"up_{k}").alias(k) for k in SUMS]]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(totals, KEY).join(children, KEY, "left")
    nodes = store(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-counted")
    # the root's children, which may be very many, get the number of the root's one row
    top = nodes.where("depth = 0").select("conv_id").first()
    parents = nodes.where("n_children > 0 and depth > 0").select(
        (F.col("depth") + 1).alias("depth"), *[F.col(k).alias(f"up_{k}") for k in SUMS], F.col("conv_id").alias("parent_conv_id"))
    shape = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", *SUMS]
    deep = nodes.where("depth > 1").join(parents, ["depth", *[f"up_{k}" for k in SUMS]], "left").select(shape)
    flat = (nodes.where("depth <= 1")
            .withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(top and top[0]).cast("long"))).select(shape))
    return Trie(deep.unionByName(flat), ends)


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1..k4, ends_sha256): SHA-256 in hex of the decimal ids of each end list, joined by commas.

    SHA-256 takes its bytes one after the other, so the pieces of one list, 4,096 possible ids each, go to one task in
    order; the task holds one batch of pieces at a time."""
    pieces = (ends.withColumn("piece", F.array_join(F.transform("conv_ids", lambda x: x.cast("string")), ","))
              .select(*KEY, "chunk", "piece").repartition(*KEY).sortWithinPartitions(*KEY, "chunk"))

    def work(batches):
        key, digest = None, None
        schema = pa.schema([*[(k, pa.int64()) for k in KEY], ("ends_sha256", pa.string())])
        out = lambda done: pa.RecordBatch.from_pylist([dict(zip([*KEY, "ends_sha256"], r)) for r in done], schema=schema)
        for batch in batches:
            done = []
            for *own, piece in zip(*[batch.column(k).to_pylist() for k in KEY], batch.column("piece").to_pylist()):
                if own == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                digest.update(piece.encode())
            yield out(done)
        if key is not None:
            yield out([(*key, digest.hexdigest())])
    return pieces.mapInArrow(work, "depth long, k1 long, k2 long, k3 long, k4 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int = 100, most: int = 6) -> Trie:
    """The trie of the rebuilt conversations (see ``rebuild``) of ``conversations`` (conv_id, turn, role, text).

    Null roles and texts are empty, null turns come first, and turns that tie are ordered by role and text, each row a
    turn; rows with a null conv_id take no part. Texts are compared whole, by 128-bit hashes. Other columns are ignored.
    An empty table gives a trie without nodes."""
    turns = number_turns(conversations)
    return build(*rebuild(store(turns, "trie-numbered"), group, most))


def node_table(trie: Trie) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    nothing = hashlib.sha256(b"").hexdigest()
    return (trie.nodes.join(end_digests(trie.ends), KEY, "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing))).drop(*SUMS))


#: DuckDB SQL of node_table(prefix_trie(conversations)). 3988292384 is the polynomial of CRC-32, lowest bit first.
SQL = """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT conv_id, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS v FROM ids),
plan AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(v, 4294967295) % 6 AS h FROM crc),
t AS (SELECT conv_id, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS x,
    length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations),
r AS (SELECT p.conv_id, 0 AS own, pos, x, chars FROM plan p JOIN t ON t.conv_id = p.base AND pos <= h
  UNION ALL SELECT p.conv_id, 1, pos, x, chars FROM plan p JOIN t ON t.conv_id = p.conv_id AND pos > h),
s AS (SELECT ids.conv_id, coalesce(list(x ORDER BY own, pos) FILTER (x IS NOT NULL), []) AS xs,
    list(chars ORDER BY own, pos) AS cs FROM ids LEFT JOIN r ON r.conv_id = ids.conv_id GROUP BY ids.conv_id),
members AS (SELECT conv_id, d, xs[1:d] AS p, CASE WHEN d > 0 THEN cs[d] ELSE 0 END AS chars, d = len(xs) AS whole
  FROM (SELECT *, unnest(generate_series(0, len(xs))) AS d FROM s)),
nodes AS (SELECT p, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    coalesce(string_agg(CASE WHEN whole THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends FROM members GROUP BY p),
kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.p = n.p),
sub AS (SELECT p[1:k] AS p, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(generate_series(0, depth)) AS k FROM counted) GROUP BY 1)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, sub.leaves AS n_leaves,
  CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN sub ON sub.p = c.p LEFT JOIN nodes u ON c.depth > 0 AND u.p = c.p[1:c.depth - 1]
"""
