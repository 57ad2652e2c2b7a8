import math
import random

import pytest
from pyspark.sql import functions as F

from pairscore.llm import neighbours


def brute(rows, k):
    usable = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = min(usable.get(i, v), v)
    out = {}
    for q, a in usable.items():
        if q % 50 == 0:
            found = []
            for i, b in usable.items():
                if i != q and len(a) == len(b):
                    u, v = ([x / max(map(abs, w)) for x in w] for w in (a, b))
                    dot = sum(x * y for x, y in zip(u, v))
                    found.append((-dot / math.sqrt(sum(x * x for x in u) * sum(y * y for y in v)), i))
            out[q] = sorted(found)[:k]
    return out


@pytest.mark.parametrize("block", [7, 64, 8192])
def test_same_as_all_pairs(spark, block):
    rng = random.Random(4)
    rows = [(i, [float(rng.gauss(0, 1)) for _ in range(16)]) for i in range(300)]
    rows += [(i, list(rows[i % 7][1])) for i in range(300, 330)]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [None, 1.0]), (405, [1e300] * 16),
             (100, [1e200] * 8 + [2e200] * 8), (406, [1e-200 * (j - 7) for j in range(16)]), (150, [5e-324] * 16),
             (450, [1.0, 2.0]), (451, [2.0, 4.0]), (50, rows[50][1]), (50, [-9.0] + [0.0] * 15), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as dim")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0, 5, block).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(rows, 5)
    assert {q: [i for _, i in v] for q, v in want.items() if v} == {q: [i for i, _ in v] for q, v in got.items()}
    assert all(abs(s + w) < 1e-12 for q in got for (_, s), (w, _) in zip(got[q], want[q]))


def test_empty_tables_and_no_queries(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(df, F.col("vec_id") > 5).count() == 0
    assert [tuple(r) for r in neighbours.nearest(df, F.lit(True), 9).orderBy("query_id").collect()] == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]


def test_vectors_whose_squares_overflow(spark):
    df = spark.createDataFrame([(50, [1e200, 1.0]), (51, [1e200, 2.0]), (52, [1e-300, 1e-300])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in neighbours.nearest(df, F.col("vec_id") == 50).orderBy("rank").collect()]
    assert [r[:3] for r in got] == [(50, 1, 51), (50, 2, 52)] and got[0][3] == 1.0 and abs(got[1][3] - 0.5 ** 0.5) < 1e-12


def test_bounds_hold():
    import numpy as np
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(50, 24)), rng.standard_cauchy(size=(80, 24))
    (ca, sa, ea), (cb, sb, eb) = neighbours.quantise(a), neighbours.quantise(b)
    near = (ca.astype(float) @ cb.T) * sa[:, None] * sb
    exact = (a / np.linalg.norm(a, axis=1)[:, None]) @ (b / np.linalg.norm(b, axis=1)[:, None]).T
    assert (np.abs(near - exact) <= ea[:, None] + (1 + ea[:, None]) * eb).all()
