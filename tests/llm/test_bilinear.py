import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairscore.llm import bilinear

SCHEMA = "doc_id long, text string"


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def brute(rows):
    """[(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)], sorted."""
    c = Counter(w for doc, text in rows if not held(doc) for w in words(text))
    n, v = sum(c.values()), len(c)
    out = []
    for doc, text in rows:
        own = words(text)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)
        out.append((doc, held(doc), len(own), sum(c[w] > 0 for w in own), n, round(base, 6)))
    return sorted(out, key=str)


def scored(df):
    return bilinear.score(df, bilinear.held_out_by_id()).collect()


def same_base(df, rows):
    found = scored(df)
    assert sorted([(*r[:5], round(r.base_score, 6)) for r in found], key=str) == brute(rows)
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in found)
    return found


def phrases(seed, n):
    """Texts in which a word mostly fixes the next one."""
    rng = random.Random(seed)
    follow = {f"w{i}": [f"w{rng.randrange(60)}" for _ in range(3)] for i in range(60)}
    rows = []
    for doc in range(n):
        w, text = f"w{rng.randrange(60)}", []
        for _ in range(rng.randrange(20, 60)):
            text.append(w.upper() if rng.random() < .1 else w)
            w = rng.choice(follow[w]) if rng.random() < .95 else f"rare{rng.randrange(4000)}"
            w = w if w in follow else (text.append(w) or f"w{rng.randrange(60)}")
        rows.append((doc, " ".join(text)))
    return rows


def test_base_and_edges(spark):
    rows = [(i, "A b\tc  a" + " x" * (i % 5)) for i in range(40)]
    rows += [(2, None), (3, ""), (4, " \n "), (None, "null key É é"), (7, "b b b"), (7, "b b b"), (9, "long " * 30_000), (11, "y" * 200_000),
             (-5, "minus"), (10 ** 15, "only here")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as hash", "'h' as held_out", "2 as row", "3 as units").repartition(3)
    found = same_base(df, rows)
    assert len({round(r.score, 9) for r in found if r.doc_id == 7 and r.n_tokens == 4}) == 1


@pytest.mark.parametrize("head", [1, 40, 1 << 19])
def test_counts_by_join_give_the_same(spark, monkeypatch, head):
    monkeypatch.setattr(bilinear, "HEAD_WORDS", head)
    monkeypatch.setattr(bilinear, "FLUSH", 500)
    rows = phrases(5, 150)
    same_base(spark.createDataFrame(rows, SCHEMA), rows)


def test_empty_tables_and_no_training_rows(spark):
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    assert scored(df.limit(0)) == []
    out = [doc for doc in range(100) if held(doc)][:3]
    rows = [(doc, "a b") for doc in out]
    found = same_base(spark.createDataFrame(rows, SCHEMA), rows)
    assert [(r.n_known, r.train_tokens, r.base_score, round(abs(r.score), 12)) for r in found] == [(0, 0, 0.0, 0.0)] * 3


@pytest.mark.parametrize("head, own", [(1 << 19, 960), (50, 20), (300, 8)])
def test_probabilities_add_up_to_one(spark, monkeypatch, head, own):
    monkeypatch.setattr(bilinear, "HEAD_WORDS", head)
    monkeypatch.setattr(bilinear, "OWN_UNITS", own)
    counts = bilinear.count_tokens(spark.createDataFrame(phrases(1, 200), SCHEMA)).cache()
    vocab = bilinear.vocabulary(counts)
    units = len(vocab.unigram)
    flat = bilinear.start_parameters(vocab.unigram) + np.random.default_rng(0).normal(0, .3, len(bilinear.start_parameters(vocab.unigram)))
    z = bilinear.normalisers(spark, flat, units)
    tail = [r.c for r in vocab.tail().collect()]
    assert len(tail) + len(vocab.head) == vocab.distinct
    for c1, c2 in [(0, 0), (units, units), (units - 1, 1 % units), (0, units)]:
        p = np.exp(bilinear.log_probabilities(flat, z, np.full(units, c1), np.full(units, c2), np.arange(units), units))
        total = (p[vocab.unit] * 10 ** vocab.share).sum() + p[0] * (sum(c + 1 for c in tail) + 1) / vocab.rest
        assert abs(total - 1) < 1e-9


def test_score_is_the_sum_over_tokens(spark):
    rows = phrases(2, 120)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    vocab = bilinear.vocabulary(bilinear.count_tokens(df).cache())
    encoded = bilinear.encode(df, "doc_id", F.lit(False), vocab).cache()
    flat = bilinear.fit(encoded, vocab)
    units = len(vocab.unigram)
    context, a, b, target, bias = bilinear.unpack(flat, units)
    counts = Counter(w for _, t in rows for w in words(t))
    found = {r.doc_id: r.score for r in bilinear.score(df, F.lit(False)).collect()}
    at = {int(h): i for i, h in enumerate(vocab.head)}
    for r in encoded.limit(20).collect():
        text, before, total = words(dict(rows)[r.doc_id]), [units, units], 0.0
        for w, u in zip(text, r.units):
            energy = target @ (context[before[-1]] @ a + context[before[-2]] @ b) + bias
            total += (energy[u] - np.log(np.exp(energy).sum())) / np.log(10)
            if u:
                total += math.log10(counts[w] / sum(vocab.count[vocab.unit == u]))
            else:
                total += math.log10((counts[w] + 1) / vocab.rest)
            before.append(u)
        assert abs(total - found[r.doc_id]) < 1e-6
    assert len(at) == len(vocab.head)


def test_learns_what_follows(spark):
    found = scored(spark.createDataFrame(phrases(3, 3000), SCHEMA))
    for out in (False, True):
        own = [r for r in found if r.held_out == out]
        tokens = sum(r.n_tokens for r in own)
        assert sum(r.score for r in own) / tokens > sum(r.base_score for r in own) / tokens + 0.5


def test_better_than_the_counts_on_the_given_table(spark, sf):
    found = scored(spark.read.parquet(f"{sf}/documents.parquet"))
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
