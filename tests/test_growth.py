"""Steps that must not be repeated, and sizes that must follow the input."""

import pytest
from pyspark.sql import functions as F

from pairscore.functions import cosine, euclidean, word_match_bag
from pairscore.functions import vectors as V
from pairscore.operators import embed, skew
from pairscore.plans import catalogue
from pairscore.plans import features as FE
from pairscore.plans import models as M


def _joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_word_match_desc_counts_hot_products_on_written_pairs(spark, sf, monkeypatch):
    seen = []
    real = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda df, *a, **k: seen.append(_joins(df)) or real(df, *a, **k))
    catalogue.QUERIES["word_match_desc"](spark, sf)
    assert seen == [0]


def test_means_of_every_column_come_from_the_token_table(spark, monkeypatch):
    """One join each, with the word vectors: not those by which the columns before were attached."""
    rows = [(1, 5, 2.0, ["a", "b"], ["b"], ["c"], 2), (2, 6, 1.0, ["a"], [], ["c", "d"], 1)]
    names = ["id", "product_uid", "relevance", *[FE.TOKEN_COLS[k] for k in ("search", "title", "attributes")], "search_term_length"]
    tokens = spark.createDataFrame(rows, "id long, product_uid long, relevance double, " + ", ".join(f"{n} array<string>" for n in names[3:6])
                                   + ", search_term_length int").localCheckpoint()
    words = spark.createDataFrame([("a", [1.0] * 10), ("b", [2.0] * 10), ("c", [-1.0] + [3.0] * 9)], "word string, vector array<double>").localCheckpoint()
    seen = []
    real = embed.materialize
    monkeypatch.setattr(embed, "materialize", lambda df, name: seen.append(_joins(df)) or real(df, name))
    fs = FE.feature_set("8", features=("searchAndTitleED", "searchAndTitle", "searchAndAttributes"))
    out = {r.id: r for r in FE.FittedFeatures(fs, {k: words for k in fs.vector_inputs}).transform(tokens).collect()}
    assert seen == [1] * 3
    assert out[1].searchAndTitleED == pytest.approx(10 ** 0.5 * 0.5) and out[1].searchAndTitle == pytest.approx(1.0)
    assert out[1].searchAndAttributes == pytest.approx((27 - 1) * 1.5 / (10 ** 0.5 * 1.5 * 82 ** 0.5))
    assert out[2].searchAndTitle == 0.0 and out[2].searchAndTitleED == pytest.approx(10 ** 0.5)


@pytest.mark.parametrize("name", ["3", "6", "7", "8"])
def test_term_length_is_counted_only_where_it_is_a_feature(spark, name):
    pairs = spark.createDataFrame([(1, 5, "red  fox", "fox \tred ox", 2.0), (2, 6, None, None, 1.0)],
                                  "id long, product_uid long, product_title string, search_term string, relevance double")
    descriptions = spark.createDataFrame([(5, "a fox")], "product_uid long, product_description string")
    attributes = spark.createDataFrame([(5, "MFG Brand Name", "Ox")], "product_uid long, name string, value string")
    tokens = FE.prepare(FE.FEATURE_SETS[name], pairs, descriptions, attributes, checkpoint=False).pairs
    plan = tokens._jdf.queryExecution().optimizedPlan().toString()
    assert ("search_term_length" in tokens.columns) == ("regexp_" in plan) == (name == "8")
    assert tokens.count() == 2 and all(c in tokens.columns for c in ("id", "product_uid", "relevance", FE.TOKEN_COLS["search"]))
    if name == "8":
        assert {r.id: r.search_term_length for r in tokens.collect()} == {1: 3, 2: 0}


@pytest.mark.parametrize("hot", [False, True])
def test_product_arrays_are_not_broadcast(spark, monkeypatch, hot):
    """However small the planner believes them to be; the bags of a part table of 5 MB are 500 MB."""
    pairs = spark.createDataFrame([(i, i % 3 if i else None, "red fox", "fox", 1.0) for i in range(30)],
                                  "id long, product_uid long, product_title string, search_term string, relevance double").localCheckpoint()
    descriptions = spark.createDataFrame([(0, "a fox"), (1, None)], "product_uid long, product_description string")
    attributes = spark.createDataFrame([(0, "MFG Brand Name", "Ox"), (0, "MFG Brand Name", "Fox"), (2, "Brand", "x")], "product_uid long, name string, value string")
    monkeypatch.setattr(skew, "hot_keys", lambda df, key, *a: None if not hot else spark.createDataFrame([(1, 2), (2, 2)], "_hot_key long, _n_salts int")
                        .withColumn("_hot_key", F.col("_hot_key").cast(df.schema[key].dataType)))
    plans = {}
    for name in ("7", "8"):
        out = FE.token_table(FE.FEATURE_SETS[name], pairs, descriptions, attributes)
        plans[name] = out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == 30 + (9 if name == "8" else 0)
        assert out.where("size(desc_bag) > 0").select("product_uid").distinct().collect() == [(0,)]
        assert out._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 2
    assert all(p.count("rightHint=(strategy=merge)") == 2 for p in plans.values())
    tokens = FE._by_product(pairs.select("id", "product_uid"), descriptions)
    assert "rightHint=(strategy=merge)" in tokens._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.id, r.product_description) for r in tokens.collect() if r.product_description) == [(i, "a fox") for i in range(3, 30, 3)]


def test_written_out_vector_sums_equal_the_general_ones(spark):
    df = spark.createDataFrame([([0.1, -2.0, 3e5], [7.0, 0.3, 1e-9]), ([0.0] * 3, [1.0, 2.0, 3.0]), ([1.0, float("nan"), 2.0], [1.0] * 3)], "a array<double>, b array<double>")
    cos = V.cosine_of(V.dot("a", "b", 3), V.dot("a", "a", 3), V.dot("b", "b", 3))
    for r in df.select(cos.alias("x"), cosine("a", "b").alias("y"), euclidean("a", "b", 3).alias("v"), euclidean("a", "b").alias("w")).collect():
        assert repr(r.x) == repr(r.y) and (r.v == pytest.approx(r.w, nan_ok=True))


def test_bag_match_weighs_only_words_that_match(spark):
    df = spark.createDataFrame([(["Red", "ring", ""], [("red", 2), ("rings", 1), ("x", 3), ("r", 1)])], "q array<string>, b array<struct<t:string,n:int>>")
    score = lambda q, bag: sum(n * ((x in t) + (t in x)) for x in q for t, n in bag)
    got = df.select(word_match_bag("q", "b").alias("s"), word_match_bag("q", F.array(F.struct(F.lit(None).cast("string").alias("t"), F.lit(1).alias("n")))).alias("none")).first()
    assert got.s == score(["red", "ring", ""], [("red", 2), ("rings", 1), ("x", 3), ("r", 1)]) and got.none is None


def _rows(spark, n=400):
    x = F.col("id")
    return spark.range(0, n, 1, 3).select("id", (x % 7).cast("double").alias("a"), (x % 11).cast("double").alias("b"),
                                          (x % 2).cast("int").alias("fold"), ((x % 7) * 2 + x % 11).cast("double").alias("relevance"))


def test_forest_grown_in_parts_is_one_forest(spark, monkeypatch):
    df = _rows(spark).localCheckpoint()
    monkeypatch.setattr(M, "TREES_A_FIT", 3)
    assert M.fit_pipeline(df, ["a", "b"], M.random_forest(2, 2)).stages[1].getCacheNodeIds()
    monkeypatch.setattr(M, "NODE_ID_BYTES", 1000)
    model = M.fit_pipeline(df, ["a", "b"], M.random_forest(8, 3, seed=5))
    parts = [s for s in model.stages if isinstance(s, M.RandomForestRegressionModel)]
    assert [p.getNumTrees for p in parts] == [3, 3, 2] and not any(p.getCacheNodeIds() for p in parts)
    out = model.transform(df)
    assert out.columns == [*df.columns, "features", "prediction"]
    for r in out.limit(20).collect():
        each = [t.predict(r.features) for p in parts for t in p.trees]
        assert r.prediction == pytest.approx(sum(each) / 8)
    assert len({str(t.toDebugString) for p in parts for t in p.trees}) > 3
    sample = out.select("features", "relevance").limit(30)
    got = M.prefix_errors(parts, sample, [2, 5, 8])
    rows = sample.collect()
    each = [[t.predict(r.features) for p in parts for t in p.trees] for r in rows]
    for n, rmse in zip((2, 5, 8), got):
        assert rmse == pytest.approx((sum((sum(e[:n]) / n - r.relevance) ** 2 for e, r in zip(each, rows)) / len(rows)) ** 0.5)


def test_forest_on_many_rows_keeps_node_ids_of_fewer_trees(spark, monkeypatch):
    df = _rows(spark).localCheckpoint()
    rows = FE.assembler(["a", "b"]).transform(df).select("features", "relevance")
    monkeypatch.setattr(M, "TREES_A_FIT", 8)
    monkeypatch.setattr(M, "NODE_ID_BYTES", 1000)
    rf = M.random_forest(5, 3, seed=5)
    parts = M.fit_trees(rf, rows)
    assert [p.getNumTrees for p in parts] == [2, 2, 1]
    assert all(p.getCacheNodeIds() and p.getCheckpointInterval() == -1 for p in parts)
    for done, p in zip((0, 2, 4), parts):
        walked = rf.copy({rf.numTrees: p.getNumTrees, rf.seed: 5 + done, rf.cacheNodeIds: False}).fit(rows)
        assert [t.toDebugString.split(chr(10))[1:] for t in walked.trees] == [t.toDebugString.split(chr(10))[1:] for t in p.trees]
    assert not any(p.getCacheNodeIds() for p in M.fit_trees(rf.copy({rf.cacheNodeIds: False}), rows))


def test_nested_grid_on_many_rows_holds_one_forest_at_a_time(spark, monkeypatch):
    df = _rows(spark).localCheckpoint()
    real, now, most = M.fit_trees, [], []

    def counted(rf, rows):
        now.append(rf)
        most.append(len(now))
        try:
            return real(rf, rows)
        finally:
            now.pop()
    monkeypatch.setattr(M, "fit_trees", counted)
    grid = dict(depths=(1, 2), trees=(2, 4), feature_lists=(("a",), ("a", "b")), parallelism=4, fold_col="fold", nested=True)
    small = M.cross_validate(df, **grid)
    assert max(most) > 1
    most.clear()
    monkeypatch.setattr(M, "NODE_ID_BYTES", 1000)
    large = M.cross_validate(df, **grid)
    assert len(most) == 9 and max(most) == 1
    assert len(large.avgMetrics) == 8 and max(abs(a - b) for a, b in zip(small.avgMetrics, large.avgMetrics)) < 1


def test_fits_hold_bounded_partitions(spark, monkeypatch):
    df = _rows(spark).localCheckpoint()
    with M.spread(df, ["a", "relevance"], 20) as rows:
        assert rows is df
    monkeypatch.setattr(M, "PARTITION_BYTES", 400 * 256 // 10)
    with M.spread(df, ["a", "relevance"], 20) as rows:
        assert rows.rdd.getNumPartitions() >= 10 and sorted(rows.collect()) == sorted(df.select("a", "relevance").collect())
        assert max(rows.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 80
    same = [M.fit_pipeline(df, ["a", "b"], M.random_forest(4, 3)).transform(df).orderBy("id").select("prediction").collect() for _ in range(2)]
    assert same[0] == same[1]
    cv = M.cross_validate(df, depths=(2,), trees=(2, 4), feature_lists=(("a",), ("a", "b")), parallelism=2, fold_col="fold", nested=True)
    assert len(cv.avgMetrics) == 4 and cv.bestModel.transform(df).count() == 400


def test_word2vec_partitions_follow_the_sentences(spark, monkeypatch):
    df = spark.createDataFrame([(["a", "b"],)] * 50, "t array<string>").localCheckpoint()
    seen = []
    real = embed.Word2Vec
    monkeypatch.setattr(embed, "Word2Vec", lambda **k: seen.append(k["numPartitions"]) or real(**k))
    embed.fit_word2vec(df, "t", "v", embed.W2VParams(num_partitions=2, partition_rows=10))
    embed.fit_word2vec(df, "t", "v", embed.W2VParams(num_partitions=2))
    assert seen == [5, 2]
