"""Operators over the vocabulary (synonyms, rewriting, extraction), hash-keyed document vectors, hot-key sketch, scans and sinks."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairscore.functions import tokenize
from pairscore.operators import extraction, rewrite, skew, synonyms
from pairscore.operators.embed import document_vectors
from pairscore.sources import csv_io
from pairscore.sources.tables import table_in_file_order

# -------------------------------------------------------------------- synonyms


def _cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def _all_pairs(vectors, k, least):
    out = {}
    for w, v in vectors.items():
        near = sorted((-round(_cosine(v, u), 6), o) for o, u in vectors.items() if o != w and _cosine(v, u) >= least)
        out[w] = [(o, -s) for s, o in near[:k]]
    return out


def _found(spark, rows, **options):
    out = {}
    df = spark.createDataFrame(rows, "word string, vector array<double>")
    for r in synonyms.synonyms(df, **options).orderBy("word", "rank").collect():
        out.setdefault(r.word, []).append((r.synonym, r.similarity))
        assert r["rank"] == len(out[r.word])
    return out


def test_synonyms_find_nine_in_ten_of_all_pairs(spark):
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(60)]
    vectors = {f"w{i}": [c + rng.gauss(0, .45) for c in rng.choice(centres)] for i in range(900)}
    want = _all_pairs(vectors, 3, 0.8)
    got = _found(spark, list(vectors.items()), k=3, min_similarity=0.8)
    pairs = {(w, s) for w, found in want.items() for s in found}
    hit = {(w, s) for w, found in got.items() for s in found}
    assert len(pairs) > 1000 and len(pairs & hit) >= 0.9 * len(pairs)
    assert all(round(_cosine(vectors[w], vectors[s]), 6) == c and c >= 0.8 for w, (s, c) in hit)


def test_synonyms_of_equal_vectors_and_hot_codes(spark):
    rng = random.Random(2)
    rows = [(f"same{i:03}", [1.0, 2.0, 3.0]) for i in range(300)]                      # a third share one vector
    rows += [(f"tight{i:03}", [1.0 + rng.random() / 50, 2.0, 3.0]) for i in range(300)]  # and a third one code
    rows += [(f"far{i:03}", [rng.gauss(0, 1) for _ in range(3)]) for i in range(300)]
    got = _found(spark, rows, k=4, min_similarity=0.99)
    assert got["same007"] == [(f"same{i:03}", 1.0) for i in range(4)]
    assert got["same001"] == [(f"same{i:03}", 1.0) for i in (0, 2, 3, 4)]
    want = _all_pairs(dict(rows), 4, 0.99)
    pairs = [(w, s) for w, found in want.items() for s in found]
    assert sum(s in got.get(w, ()) for w, s in pairs) >= 0.9 * len(pairs)


def test_synonyms_edges(spark):
    assert _found(spark, [("a", None), ("b", [0.0, 0.0]), (None, [1.0, 1.0]), ("c", [1.0])]) == {}
    assert _found(spark, []) == {}
    rows = [("a", [1.0, 0.0]), ("a", [0.5, 0.0]), ("b", [2.0, 0.0]), ("c", [0.0, 1.0]), ("d", [1.0, 1.0, 1.0])]
    assert _found(spark, rows) == {"a": [("b", 1.0)], "b": [("a", 1.0)]}


def test_shape_grows_with_the_vocabulary():
    for n, least in ((10, .8), (10_000, .8), (10 ** 7, .7)):
        bits, bands = synonyms.shape(n, least)
        p = 1 - math.acos(least) / math.pi
        assert 1 - (1 - p ** bits) ** bands >= synonyms.RECALL
    assert synonyms.shape(10 ** 7, .8)[0] > synonyms.shape(10 ** 4, .8)[0] >= 4


# ------------------------------------------------------------------- rewriting

def test_rewrite_in_place(spark):
    rows = [(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["a", "b", "a"]), (5, ["x", "b"] * 2000)]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    change = spark.createDataFrame([("a", ["A"]), ("b", ["b", "bee"]), ("zz", ["q"])], "word string, words array<string>")
    got = {r.id: (r.t, r.u) for r in rewrite.rewrite(df, "t", change, "u", ["id"]).collect()}
    swap = {"a": ["A"], "b": ["b", "bee"]}
    assert got == {i: (t, None if t is None else [w for x in t for w in swap.get(x, [x])]) for i, t in rows}


def test_maps_one_after_the_other(spark):
    first = spark.createDataFrame([("a", ["b", "c"]), ("d", ["e"])], "word string, words array<string>")
    second = spark.createDataFrame([("b", ["bb"]), ("d", ["dd"]), ("x", ["y", "z"])], "word string, words array<string>")
    got = {r.word: r.words for r in rewrite.then(first, second).collect()}
    assert got == {"a": ["bb", "c"], "d": ["e"], "b": ["bb"], "x": ["y", "z"]}


def test_corrected_and_stemmed_features(spark):
    from pairscore.plans import features as FE
    pairs = spark.createDataFrame([(1, 1, "running shoes", "runing shoe", 2.0), (2, 2, "red chairs", "chair", 2.0)],
                                  "id long, product_uid long, product_title string, search_term string, relevance double")
    desc = spark.createDataFrame([(1, "Shoes for runs")], "product_uid long, product_description string")
    attrs = spark.createDataFrame([(2, "MFG Brand Name", "Chairing")], "product_uid long, name string, value string")
    for name, want in (("8s", {1: ["rune", "shoe"], 2: ["chair"]}), ("8cs", {1: ["run", "shoe"], 2: ["chair"]})):
        t = {r.id: r for r in FE.token_table(FE.FEATURE_SETS[name], pairs, desc, attrs).collect()}
        assert {i: r.search_term_ for i, r in t.items()} == want
        assert t[1].product_title_ == ["run", "shoe"] and t[2].product_attributes_ == ["chair"] and t[1].product_attributes_ == ["empty"]
        assert {e.t for e in t[1].desc_bag} == {"shoe", "run"}


# ------------------------------------------------------------------ extraction

def test_extraction_matches_brute_force(spark):
    rng = random.Random(3)
    words = ["red", "dark", "oak", "wood", "steel", "x"]
    values = [(rng.choice(["color", "material"]), " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4)))) for _ in range(14)]
    values += [("material", "Red"), (None, "red"), ("color", None), ("color", "   ")]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30)))) for i in range(60)] + [(99, None), (98, "oak " * 3000)]
    attrs = spark.createDataFrame(values, "name string, value string")
    df = spark.createDataFrame(texts, "uid int, text string").select("uid", tokenize("text").alias("t"))
    got = Counter(tuple(r) for r in extraction.extract(df, "uid", "t", extraction.dictionary(attrs, tokenize("value"))).collect())
    known = {}
    for name, value in {v for v in values if None not in v}:
        known.setdefault(tuple(value.lower().split()), []).append((name, value))
    known.pop((), None)
    want = Counter()
    for uid, text in texts:
        t = (text or "").lower().split()
        spans = {(i, n) for i in range(len(t)) for n in (1, 2, 3) if i + n <= len(t) and tuple(t[i: i + n]) in known}
        for i, n in spans:
            near = [(j, m) for j in range(i - 2, i + 1) for m in range(n + 1, 4)]
            if not any((j, m) in spans and j + m >= i + n for j, m in near):
                want.update((uid, i, n, name, value) for name, value in known[tuple(t[i: i + n])])
    assert got == want


def test_extraction_without_dictionary(spark):
    attrs = spark.createDataFrame([], "name string, value string")
    df = spark.createDataFrame([(1, ["a"])], "uid int, t array<string>")
    assert extraction.extract(df, "uid", "t", extraction.dictionary(attrs, tokenize("value"))).count() == 0


# ------------------------------------------------------------ document vectors

def test_document_vectors_of_long_and_repeated_texts(spark):
    rng = random.Random(4)
    vectors = {f"w{i}": [rng.gauss(0, 1) for _ in range(3)] for i in range(500)}
    texts = [["w1", "w2", "w1"]] * 40 + [["w3", "nope"], [], None, [f"w{i % 700}" for i in range(100_000)]]
    words = spark.createDataFrame(list(vectors.items()), "word string, vector array<double>")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t array<string>")
    got = {r.id: r.v for r in document_vectors(df, "t", words, 3, "v").collect()}
    for i, t in enumerate(texts):
        own = [vectors.get(w, [0.0] * 3) for w in t or []]
        mean = [sum(c) / len(own) for c in zip(*own)] if own else [0.0] * 3
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[i], mean)), i
    plan = document_vectors(df, "t", words, 3, "v")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any(re.search(r"(?<!\w)t#", line) for line in joins)


# -------------------------------------------------------------------- hot keys

@pytest.mark.parametrize("kind", ["long", "string", "struct"])
def test_hot_keys_equal_the_full_count(spark, kind):
    rng = random.Random(5)
    keys = [0] * 700 + [1] * 260 + [None] * 300 + [rng.randrange(2, 2000) for _ in range(2500)] + [7] * 240
    rng.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(9)
    if kind == "string":
        df = df.select(F.concat(F.lit("key "), F.col("k").cast("string")).alias("k"))
    if kind == "struct":
        df = df.select(F.struct("k", F.lit(1).alias("one")).alias("k"))
    for p in (2, 4, 8, 16):
        counts = df.groupBy("k").agg(F.count("*").alias("c"))
        want, got = skew.hot_from_counts(counts, "k", "c", p), skew.hot_keys(df, "k", p)
        table = lambda d: None if d is None else sorted(map(str, d.collect()))
        assert table(got) == table(want)
    assert skew.hot_keys(df.distinct(), "k", 4) is None and skew.hot_keys(df.limit(0), "k", 4) is None


# ------------------------------------------------------------- scans and sinks

def test_quarantine_keeps_every_record(spark, tmp_path):
    text = 'id,product_uid,product_title,search_term,relevance\n1,10,"a, ""b""",q,2.5\nx,10,t,q,2\n3,10,t\n4,10,t,q,2,more\n5,,,q,\n6,10,t,q,high\n'
    (tmp_path / "in.csv").write_text(text)
    good, bad = csv_io.read_csv_quarantine(spark, str(tmp_path), csv_io.PAIRS_SCHEMA)
    assert sorted(map(tuple, good.collect())) == [(1, 10, 'a, "b"', "q", 2.5), (5, None, None, "q", None)]
    assert sorted((r.raw, r.reason) for r in bad.collect()) == [
        ("3,10,t", "fields"), ("4,10,t,q,2,more", "fields"), ("6,10,t,q,high", "type: relevance"), ("x,10,t,q,2", "type: id")]
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"in.csv"}


def test_single_file_in_order(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id"), F.col("id").cast("double").alias("prediction")).repartition(6)
    path = str(tmp_path / "out.csv")
    csv_io.write_single_csv(df, path, "id")
    lines = open(path).read().splitlines()
    assert lines[0] == "id,prediction" and [int(x.split(",")[0]) for x in lines[1:]] == list(range(5000))
    assert sorted(csv_io.read_csv(spark, path, csv_io.PREDICTIONS_SCHEMA).collect()) == sorted(df.collect())
    assert [p.name for p in tmp_path.iterdir() if "parts" in p.name] == []
    csv_io.write_single_csv(df.limit(0), path, "id")
    assert open(path).read() == "id,prediction\n"
    csv_io.write_predictions(df, str(tmp_path / "folder"), single_file=True)
    assert [p.name for p in (tmp_path / "folder").iterdir() if p.suffix == ".csv"] == ["part-00000.csv"]
    assert open(tmp_path / "folder" / "part-00000.csv").read().splitlines() == lines


def test_file_order(spark, sf):
    import pyarrow.parquet as pq
    want = pq.read_table(f"{sf}/lineitem.parquet", columns=["l_orderkey"]).column(0).to_pylist()
    got = [r[0] for r in table_in_file_order(spark, sf, "lineitem").repartition(5).orderBy("position").select("l_orderkey").collect()]
    assert got == want
