import random

import numpy as np
import pytest

from pairscore.llm import minhash, substring
from pairscore.llm.common import components
from tests.llm import brute


def texts(seed, n, vocabulary, longest):
    """Texts with exact copies, near copies and shared passages."""
    rng = random.Random(seed)
    word = lambda: f"w{int(vocabulary * rng.random() ** 2)}"
    passage = [word() for _ in range(70)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if out and kind < 0.45:
            words = (rng.choice(out) or "").split()
            for _ in range(rng.randrange(0, 1 + max(1, len(words) // 15))):
                if words:
                    words[rng.randrange(len(words))] = word()
        else:
            words = [word() for _ in range(rng.randrange(0, longest))]
        if kind > 0.9:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[: rng.randrange(45, 71)]
        out.append(rng.choice([" ", "\n", " \t"]).join(words))
    return out


@pytest.mark.parametrize("seed,width,vocabulary,longest", [(1, 2, 12, 9), (2, 2, 400, 60), (3, 5, 300, 600), (4, 2, 50, 300)])
def test_components_match_all_pairs(spark, seed, width, vocabulary, longest):
    rows = list(enumerate(texts(seed, 250, vocabulary, longest)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, width).collect()}
    assert got == brute.near_duplicates(rows, width)


def test_duplicate_edge_cases(spark):
    rows = [(3, None), (4, ""), (5, " \n"), (6, "One"), (7, "one"), (8, "É"), (9, "é"), (None, "one"), (10, "a b"), (10, "a b"),
            (2, "x " * 200_000), (1, "X\t" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_shingles", "2 as bands", "3 as a")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, 2).collect()}
    assert got == {3: (0, 3, True), 4: (0, 4, True), 5: (0, 5, True), 6: (1, 6, True), 7: (1, 6, False), 8: (1, 8, True),
                   9: (1, 9, True), 10: (1, 10, True), 1: (1, 1, True), 2: (1, 1, False)}
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_corrected_and_close():
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) * 2 for n in (4000, 500, 500))
    pair = [np.unique(np.concatenate([common, x])) for x in (a, b)]
    regs = [minhash.registers(s, minhash.size_class(len(s)))[None] for s in pair]
    guess, used = minhash.estimate(*regs, *[np.array([float(len(s))]) for s in pair])
    assert used[0] == minhash.REGISTERS and abs(guess[0] - 0.8) < 0.12
    other = np.unique(rng.integers(0, 1 << 63, 4500, dtype=np.uint64) * 2)
    far, _ = minhash.estimate(regs[0], minhash.registers(other, 288)[None], np.array([4500.0]), np.array([4500.0]))
    assert far[0] < 0.02


def test_chain_and_cycle_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)}


@pytest.mark.parametrize("seed,vocabulary,window,k", [(1, 300, 50, 20), (2, 3, 50, 20), (5, 40, 12, 5)])
def test_removed_words_match_a_dictionary_of_windows(spark, seed, vocabulary, window, k):
    rows = list(enumerate(texts(seed, 200, vocabulary, 300)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(df, window, k).collect()}
    assert got == brute.remove_repeats(rows, window)
    assert sum(x[1] for x in got.values())


def test_repeat_edge_cases(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "a " * 49), (4, "a " * 49), (5, "b " * 120), (6, "b " * 60), (None, "b " * 60), (7, long),
            (8, "x " + long), (9, "é  " * 60), (10, "c " * 55), (10, "c " * 55)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as spans", "3 as kmer")
    got = [(r.doc_id, r.n_words, r.n_removed) for r in substring.remove_repeats(df).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 0, 0), (2, 0, 0), (3, 49, 0), (4, 49, 0), (5, 120, 0), (6, 60, 60), (None, 60, 0), (7, 60_000, 0),
        (8, 60_001, 60_000), (9, 60, 0), (10, 55, 0), (10, 55, 0)], key=str)
    assert substring.remove_repeats(df.limit(0)).count() == 0


def test_large_groups_in_blocks_find_the_same_components(spark, monkeypatch):
    """Near copies of one text, many of them too far from the hub: with any block size the components are those of all pairs."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(220):
        words = list(base)
        for _ in range(rng.randrange(0, 16)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((d, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute.near_duplicates(rows, 2)
    assert len({c for _, c in want.values()}) > 5
    for limits in ((128, 256, 1024), (1, 7, 30), (1, 256, 1024), (10 ** 6, 1, 1)):
        for name, n in zip(("LARGE_GROUP", "OUTSIDE_BLOCK", "ALL_BLOCK"), limits):
            monkeypatch.setattr(minhash, name, n)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, 2).collect()} == want
