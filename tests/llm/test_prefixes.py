import hashlib
import random
import zlib

import pytest

from pairscore.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """{(conv_id, depth): the other columns} with every prefix in one dictionary."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        new = (own.get(base, [])[:h]) + ts[h:]
        for d in range(len(new) + 1):
            members.setdefault(tuple(new[:d]), []).append((c, d == len(new)))
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        todo = [p]
        while todo:
            q = todo.pop()
            yield q
            todo += children.get(q, [])
    least = {p: min(c for c, _ in m) for p, m in members.items()}
    return {(least[p], len(p)): (
        least[p[:-1]] if p else None, len(m), len(children.get(p, [])), sum(q not in children for q in below(p)),
        sum((len(members[q]) - 1) * (len(q[-1][1]) if q else 0) for q in below(p)),
        hashlib.sha256(",".join(str(c) for c in sorted(c for c, end in m if end)).encode()).hexdigest())
        for p, m in members.items()}


def found(df):
    out = {}
    for r in prefixes.node_table(prefixes.prefix_trie(df)).collect():
        assert (r.conv_id, r.depth) not in out
        out[r.conv_id, r.depth] = (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
    return out


def some_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 1000), n):
        for turn in range(rng.randrange(1, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "a longer one 😀"])))
    rows += [(5, None, "user", "first"), (5, None, "user", "first"), (5, 0, "user", "tie"), (5, 0, "system", "tie"), (None, 0, "user", "x")]
    rows += [(c, t, "user", "copy") for c in range(2000, 2120) for t in range(8)]   # a large group of copies
    return rows


@pytest.mark.parametrize("block", [3, 4096])
def test_same_as_all_prefixes(spark, monkeypatch, block):
    monkeypatch.setattr(prefixes, "BLOCK", block)
    rows = some_rows(block, 150)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as pos", "2 as depth", "3 as k1", "4 as n", "5 as part").repartition(7)
    assert found(df) == brute(rows)


def test_given_table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert found(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_one_conversation_over_many_partitions(spark):
    rows = [(100, t, "user", f"t{t % 3}") for t in range(900)] + [(101, t, "user", "x" * 5000) for t in range(3)] + [(7, 3, "user", "alone")]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(df) == brute(rows)
        parts = prefixes.number_turns(df).where("conv_id = 100").selectExpr("count(*)", "count(distinct pos)", "max(pos)").first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tuple(parts) == (900, 900, 900)


def test_empty_table_and_turnless_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(df) == {}
    alone = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 6 > 1][:4]
    rows = [(c, 1, None, None) for c in alone]      # own turns are cut, and there is no conversation 0
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert brute(rows)[alone[0], 0][1:5] == (4, 0, 1, 0)
