import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairscore.llm import negatives


def brute(rows, k=5, m=5):
    """{(anchor, positive): [(negative, score)]} by comparing all pairs."""
    best = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        if sum(float(256 * x) * float(256 * x) for x in v) > 2 ** 54:
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        own = (label, [int(np.floor(256 * x)) for x in v])
        best[i] = min(best.get(i, own), own)
    out = {}
    for a, (la, va) in best.items():
        if a % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(va, v)), i, label) for i, (label, v) in best.items() if len(v) == len(va)]
        for p, i, _ in sorted(s for s in scores if s[2] == la and s[1] != a)[:k]:
            found = sorted(s for s in scores if s[2] != la and -80 * p <= -100 * s[0] <= -100 * p)[:m]
            if found:
                out[a, i] = [(j, -s, -p) for s, j, _ in found]
    return out


def mined(df, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = {}
    for r in negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, label, **options).orderBy("anchor_id", "positive_id", "rank").collect():
        found = out.setdefault((r.anchor_id, r.positive_id), [])
        found.append((r.negative_id, r.negative_score, r.positive_score))
        assert r["rank"] == len(found)
    return out


def some_rows(n, dim, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, .3) for c in rng.choice(centres)], rng.randrange(10)) for i in range(n)]
    rows += [(n + i, rows[3][1], i % 4) for i in range(n // 3)]                  # a large group of copies, tied scores
    rows += [(-100, [-x for x in rows[0][1]], 1), (-7, rows[5][1], 9)]
    return rows


@pytest.mark.parametrize("blocks", [(20, 3), (32_768, 8_192)])
def test_same_as_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", blocks[1])
    monkeypatch.setattr(negatives, "LEAF_ROWS", 40)
    rows = some_rows(600, 6, 3)
    rows += [(5000, None, 1), (5001, [None] * 6, 1), (5002, [float("nan")] * 6, 1), (5003, [1e300] * 6, 2), (5004, [1.0] * 6, None),
             (None, [1.0] * 6, 1), (5100, [1.0, 2.0], 1), (5101, [1.0, 3.0], 1), (5102, [1.0, 1.9], 2), (5200, [], 1), (5201, [], 1),
             (5202, [], 2), (5300, [0.0] * 6, 4), (10, [9.0] * 6, 0), (10, [9.0] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as leaf", "'x' as point", "2 as anchor_id")
    assert mined(df) == brute(rows)


def test_given_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert mined(df) == want and want


def test_empty_and_alone(spark):
    df = spark.createDataFrame([(100, [1.0], 1), (101, [2.0], 2)], "vec_id long, embedding array<float>, label int")
    assert mined(df.limit(0)) == {} and mined(df.where("vec_id = 101")) == {} and mined(df) == {}
    rows = [(100, [1.0], 1), (101, [2.0], 1), (102, [1.8], 2)]
    assert mined(spark.createDataFrame(rows, df.schema)) == {(100, 101): [(102, 460 * 256, 512 * 256)]}


def test_leaves_left_out_hold_no_row_of_a_window():
    rng = np.random.default_rng(1)
    points = np.floor(256 * (rng.normal(size=(40, 5))[rng.integers(0, 40, 4000)] + .05 * rng.normal(size=(4000, 5))))
    tree = negatives.Tree(points[:1500], 3)
    leaf, steps = tree.route(points)
    square = np.square(points).sum(1)
    found = {}
    for node, j, at, d in steps:
        found[node, j] = (np.append(square[at].min(), d.min(0)), np.append(square[at].max(), d.max(0)))
    tree.set_ranges([(node, i - 1, j, low[i], high[i]) for (node, j), (low, high) in found.items() for i in range(len(low))])
    assert tree.leaves > 30
    visited = 0
    for a in points[::50]:
        score = points @ a
        for low, high in ((np.sort(score)[-5], 2.0 ** 60), (0.8 * score.max(), score.max())):
            inside = np.flatnonzero((score >= low) & (score <= high))
            seen = tree.visits(a, np.array([low]), np.array([high]))
            assert set(leaf[inside]) <= set(seen)
            visited += len(seen)
    assert visited < 0.8 * 160 * tree.leaves


def test_sums_beyond_double_precision_stay_exact(spark):
    big = 2.0 ** 18
    rows = [(100, [big, 1.0], 1), (101, [big, 3.0], 1), (102, [big, 2.0], 2), (103, [big, 2.9], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(df) == brute(rows)
