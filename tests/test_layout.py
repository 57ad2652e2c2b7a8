"""Results that must not depend on partitions, null keys, hot products; options of the feature pipeline."""

import time

from pyspark.sql import functions as F

from pairscore.functions import levenshtein_scores, tokenize, word_match
from pairscore.operators import catalog, embed, spelling
from pairscore.plans import features as FE
from pairscore.plans import models as M


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_split_and_folds_do_not_depend_on_partitions(spark):
    a, b = (spark.range(2000).repartition(n) for n in (3, 8))
    assert _ids(M.random_split(a)[0]) == _ids(M.random_split(b)[0])
    assert 1300 < len(_ids(M.random_split(a)[0])) < 1500
    assert sorted(M.folds(a, 3).collect()) == sorted(M.folds(b, 3).collect())
    sizes = [r["count"] for r in M.folds(a, 3).groupBy("fold").count().collect()]
    assert len(sizes) == 3 and min(sizes) > 550


def test_rows_without_a_product_are_left_out_of_aggregates(spark):
    attrs = spark.createDataFrame([(1, "Brand", "a"), (None, "Brand", "b"), (None, "Brand", "c"), (2, "Size", None)],
                                  "product_uid long, name string, value string")
    assert [tuple(r) for r in catalog.attribute_text(attrs, ["brand"]).collect()] == [(1, "a")]
    assert sorted(tuple(r) for r in catalog.attribute_pivot(attrs, ["Brand", "Size"]).collect()) == [(1, "a", None), (2, None, None)]


def test_long_blank_runs_are_tokenised_in_linear_time(spark):
    df = spark.createDataFrame([("a" + " " * 20_000 + "b" + " \t" * 3,)] * 8, "t string")
    df.select(F.size(tokenize("t"))).collect()
    start = time.time()
    assert {r[0] for r in df.select(F.size(tokenize("t"))).collect()} == {20_001}
    assert time.time() - start < 5


def test_bound_matchers_take_expressions_columns_and_nulls(spark):
    df = spark.createDataFrame([("Red fox", "the RED foxes"), ("x", None), ("", "a")], "q string, d string")
    got = [r[0] for r in df.select(word_match(tokenize("q"), tokenize("d"))).collect()]
    assert got == [3, None, 1]  # '' is a substring of 'a'
    s = [r[0] for r in df.select(levenshtein_scores(tokenize("q"), tokenize("d"))).collect()]
    assert (s[0].lev_min, s[0].lev_inv) == (0, 1 + 1 / 3) and s[1].lev_min is None


def test_document_vectors_are_means_over_all_tokens(spark):
    words = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "word string, vector array<double>")
    rows = [(i, ["a"] * 50 + ["zz"] * 50) for i in range(40)] + [(90, ["a", "b"]), (91, []), (92, None), (93, ["q"]), (90, ["a", "b"])]
    df = spark.createDataFrame(rows, "id long, t array<string>").repartition(6)
    got = {(r.id, tuple(r.v)) for r in embed.document_vectors(df, "t", words, 2, "v").collect()}
    assert got == {(i, (0.5, 1.0)) for i in range(40)} | {(90, (2.0, 3.0)), (91, (0.0, 0.0)), (92, (0.0, 0.0)), (93, (0.0, 0.0))}
    assert embed.document_vectors(df, "t", words, 2, "v").count() == len(rows)


def _inputs(spark):
    rows = [(i, 7 if i % 3 == 0 else i, f"title {i % 5} red", "red fox nan", 1.0 + i % 3) for i in range(300)]
    pairs = spark.createDataFrame(rows, "id long, product_uid long, product_title string, search_term string, relevance double")
    descriptions = spark.createDataFrame([(7, "a red fox"), (7, "a blue fox"), (8, "nan red")], "product_uid long, product_description string")
    attributes = spark.createDataFrame([(7, "MFG Brand Name", "Fox"), (9, "Color Family", "red")], "product_uid long, name string, value string")
    return pairs, descriptions, attributes


def test_hot_products_and_partitions_do_not_change_features(spark):
    pairs, descriptions, attributes = _inputs(spark)
    for name in ("3", "6", "8"):
        out = []
        for partitions, split in ((3, True), (8, True), (5, False)):
            old = spark.conf.get("spark.sql.shuffle.partitions")
            spark.conf.set("spark.sql.shuffle.partitions", "16")
            try:
                fs = FE.feature_set(name, split_hot_products=split)
                tt = FE.prepare(fs, pairs.repartition(partitions), descriptions, attributes, checkpoint=False)
                words = spark.createDataFrame([(w, [float(i % 7), float(len(w))] * 5) for i, w in enumerate(
                    ["red", "fox", "title", "0", "1", "blue", "nan", "empty", "Fox"])], "word string, vector array<double>")
                df = FE.FittedFeatures(fs, {k: words for k in fs.vector_inputs}).transform(tt.pairs, products=tt.products)
                out.append(sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()))
            finally:
                spark.conf.set("spark.sql.shuffle.partitions", old)
        assert out[0] == out[1] == out[2] and len(out[0]) == 300


def test_missing_token_counts_in_the_description_bag(spark):
    pairs, descriptions, attributes = _inputs(spark)
    score = lambda token: {r.id: r.searchAndDescriptionMD for r in FE.lexical_features(
        FE.feature_set("8", missing_token=token), FE.token_table(FE.feature_set("8", missing_token=token), pairs, descriptions, attributes)).collect()}
    without, given = score(None), score("nan")
    assert without[1] == 0 and given[1] == 2 and without[8] == given[8] == 4
    assert without[0] == given[0] == 2  # of two descriptions of a product, the smaller text counts: a blue fox


def test_shared_space_fits_one_embedding(spark):
    pairs, descriptions, attributes = _inputs(spark)
    f, fitted = FE.build(FE.feature_set("3", shared_space=True), pairs, descriptions, attributes)
    assert len({id(v) for v in fitted.models.values()}) == 1 and f.count() == 300


def test_correct_tokens_keeps_order_with_a_hot_word(spark):
    df = spark.createDataFrame([(i, ["hte", "x", "hte"] if i % 2 else []) for i in range(200)], "k long, t array<string>")
    fixes = spark.createDataFrame([("hte", "the"), ("y", None)], "word string, correction string")
    got = {r.k: r.f for r in spelling.correct_tokens(df, "k", "t", fixes, "f").collect()}
    assert got == {i: ["the", "x", "the"] if i % 2 else [] for i in range(200)}
