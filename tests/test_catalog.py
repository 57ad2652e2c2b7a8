"""Catalog operators on hand-made rows."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairscore.operators import catalog, spelling


def test_clean_attributes(spark):
    rows = [(1.0, "MFG Brand Name", "Acme"), (None, None, None), (2.0, "Color", None)]
    df = spark.createDataFrame(rows, "product_uid double, name string, value string")
    got = sorted(tuple(r) for r in catalog.clean_attributes(df).collect())
    assert got == [(1, "MFG Brand Name", "Acme"), (2, "Color", "nan")]
    kept_null = catalog.clean_attributes(df, missing_token=None).where("product_uid = 2")
    assert kept_null.first().value is None


def test_brand_join_multiplicity_and_fill(spark):
    pairs = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id long, product_uid long")
    attrs = spark.createDataFrame(
        [(10, "MFG Brand Name", "A"), (10, "MFG Brand Name", "B"), (20, "mfg brand name", "C"),
         (30, "Material", "wood")], "product_uid long, name string, value string")
    brands = catalog.brand_rows(attrs)
    got = sorted(tuple(r) for r in catalog.attach_brand(pairs, brands)
                 .select("id", "product_attributes").collect())
    assert got == [(1, "A"), (1, "B"), (2, "empty"), (3, "empty")]
    dd = catalog.attach_brand(pairs, brands, dedupe=True).where("id = 1").collect()
    assert [r.product_attributes for r in dd] == ["A"]


def test_attribute_text_and_filters(spark):
    attrs = spark.createDataFrame(
        [(1, "Brand", "b1"), (1, "Color Family", "red"), (1, "Material", "oak"),
         (1, "Size", "9"), (2, "Size", "3")], "product_uid long, name string, value string")
    allt = dict(catalog.attribute_text(attrs).collect())
    assert allt == {1: "b1 red oak 9", 2: "3"}
    bcm = dict(catalog.attribute_text(attrs, ["brand", "color", "material"]).collect())
    assert bcm == {1: "b1 red oak"}


def test_attribute_pivot(spark):
    attrs = spark.createDataFrame(
        [(1, "MFG Brand Name", "Z"), (1, "MFG Brand Name", "A"), (1, "Size", "9"),
         (2, "Size", "3"), (3, "Other", "x")], "product_uid long, name string, value string")
    got = {r.product_uid: r for r in
           catalog.attribute_pivot(attrs, ["MFG Brand Name", "Size"]).collect()}
    assert set(got) == {1, 2}
    assert got[1].mfg_brand_name == "A Z" and got[1].size == "9"
    assert got[2].mfg_brand_name is None


def test_token_bags_counts(spark):
    df = spark.createDataFrame([(1, ["A", "a", "b"]), (2, [])], "k long, t array<string>")
    got = {r.k: [tuple(x) for x in r.bag] for r in catalog.token_bags(df, "k", "t", "bag").collect()}
    assert got == {1: [("a", 2), ("b", 1)]}


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _brute_force(queries, vocab_rows, k=2, min_length=1):
    expect = {}
    vs = dict(vocab_rows)
    for w in set(queries):
        if len(w) < min_length or w in vs:
            continue
        cands = sorted((_lev(w, v), -f, v) for v, f in vocab_rows if _lev(w, v) <= k)
        expect[w] = (cands[0][2], cands[0][0]) if cands else (None, None)
    return expect


def test_spelling_matches_brute_force(spark):
    long_word = "x" * 300 + "abc"
    vocab_rows = [("tan", 5), ("ton", 7), ("steel", 3), ("blue", 2), ("brass", 4), ("bass", 4),
                  ("grass", 1), ("cat", 9), ("coat", 9), ("a", 1), ("ab", 2), (long_word, 1)]
    queries = ["tin", "stell", "xyzzy", "tan", "bl", "brss", "crass", "cot", "blues", "abcdef",
               "abb", "bab", long_word[:-1] + "d", "x" * 299 + "abc", "x" * 5000]
    vocab = spark.createDataFrame(vocab_rows, "word string, freq long")
    words = spark.createDataFrame([(w,) for w in queries], "word string")
    got = {r.word: (r.correction, r.distance) for r in spelling.corrections(words, vocab).collect()}
    assert got == _brute_force(queries, vocab_rows)


short_words = st.text(alphabet="abc", min_size=1, max_size=9)


@settings(max_examples=4, deadline=None)
@given(st.lists(short_words, min_size=1, max_size=25, unique=True),
       st.lists(short_words, min_size=1, max_size=25), st.integers(1, 3))
def test_spelling_property_exact(spark, vocab_words, queries, k):
    vocab_rows = [(w, i % 3 + 1) for i, w in enumerate(vocab_words)]
    vocab = spark.createDataFrame(vocab_rows, "word string, freq long")
    words = spark.createDataFrame([(w,) for w in queries], "word string")
    got = {r.word: (r.correction, r.distance)
           for r in spelling.corrections(words, vocab, max_distance=k, min_length=1).collect()}
    assert got == _brute_force(queries, vocab_rows, k=k, min_length=1)


def test_correct_tokens_keeps_order(spark):
    df = spark.createDataFrame([(1, ["stell", "tin", "x"]), (2, [])], "k long, t array<string>")
    fixes = spark.createDataFrame([("stell", "steel"), ("tin", "ton")],
                                  "word string, correction string")
    got = {r.k: r.c for r in spelling.correct_tokens(df, "k", "t", fixes, "c").collect()}
    assert got == {1: ["steel", "ton", "x"], 2: []}


def test_joins_plan_without_python(spark, sf):
    from pairscore.plans import catalogue
    for name in ("word_match_desc", "brand_or_empty", "spell_correct"):
        plan = catalogue.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_stem_tokens_query_equals_per_word_stemming(spark, sf):
    from pairscore.functions import remove_stop_words, tokenize
    from pairscore.functions.porter import stem
    from pairscore.plans import catalogue
    from pairscore.sources.tables import table
    got = {r.doc_id: r.stems for r in catalogue.QUERIES["stem_tokens"](spark, sf).collect()}
    docs = (table(spark, sf, "documents")
            .select("doc_id", remove_stop_words(tokenize("text")).alias("t")).collect())
    assert len(got) == len(docs) > 0
    for r in docs:
        assert got[r.doc_id] == "|".join(stem(w) for w in r.t)


def test_stem_tokens_keeps_order_and_empties(spark):
    from pairscore.operators.stemming import stem_tokens
    df = spark.createDataFrame([(1, ["running", "cats", "running", ""]), (2, []), (3, None)],
                               "k long, t array<string>")
    got = {r.k: r.s for r in stem_tokens(df, "k", "t", "s").collect()}
    assert got == {1: ["run", "cat", "run", ""], 2: [], 3: None}


def test_feature_token_table_shuffles_pairs_once(spark, sf):
    """Planned as at scale (AQE and broadcast off) over a stored pair table:
    the feature token table adds three shuffles -- pairs by product_uid, the
    description bags, the attribute tokens -- and two sort-merge joins; the
    second join reuses the pairs' partitioning."""
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                    "tools"))
    from plan_summary import summarise
    from pairscore.plans import features as FE
    from pairscore.session import materialize
    from pairscore.sources import fixtures as fx
    pairs = materialize(fx.pairs(spark, sf), "test-pairs")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = summarise(pairs._jdf.queryExecution().executedPlan().toString())
        fs = FE.FEATURE_SETS["8"]
        tokens = FE.lexical_features(fs, FE.token_table(fs, pairs, fx.descriptions(spark, sf),
                                                        fx.attributes(spark, sf)))
        s = summarise(tokens._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert s["shuffles"] - base["shuffles"] == 3
    assert s["smj"] - base["smj"] == 2
    assert s["cartesian"] == 0 and s["python"] == 0


def test_hot_product_is_split_and_results_unchanged(spark, sf):
    """A product holding a third of the pairs: the split join gives the plain
    join's rows, the product gets several buckets, and no join task holds
    the third."""
    from pairscore.operators import skew
    from pairscore.sources import fixtures as fx
    pairs = fx.pairs(spark, sf)
    hotp = pairs.withColumn("product_uid", F.when(F.col("id") % 3 == 0, F.lit(1))
                            .otherwise(F.col("product_uid")))
    desc = fx.descriptions(spark, sf)
    hot = {r[0]: r[1] for r in skew.hot_keys(hotp, "product_uid", partitions=8).collect()}
    assert hot.get(1, 0) > 1
    assert skew.hot_keys(pairs, "product_uid", partitions=8) is None   # no product is hot
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = catalog.attach_description(hotp, desc)
        plain = hotp.join(desc, "product_uid", "left")
        cols = ["id", "product_uid", "product_description"]
        assert sorted(map(tuple, split.select(cols).collect())) == \
            sorted(map(tuple, plain.select(cols).collect()))
        total = hotp.count()
        biggest = (split.groupBy(F.spark_partition_id().alias("p")).count()
                   .agg(F.max("count")).first()[0])
        assert biggest < total / 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_split_join_keeps_brand_multiplicity_and_null_keys(spark):
    from pairscore.operators import skew
    rows = [(i, 7 if i % 2 else (None if i % 5 == 0 else i)) for i in range(200)]
    pairs = spark.createDataFrame(rows, "id long, product_uid long")
    brands = spark.createDataFrame([(7, "A"), (7, "B"), (4, "C"), (None, "N")],
                                   "product_uid long, product_attributes string")
    split = skew.split_left_join(pairs, brands, "product_uid", ["id"], partitions=4)
    plain = pairs.join(brands, "product_uid", "left")
    assert sorted(map(tuple, split.select("id", "product_attributes").collect()),
                  key=str) == sorted(map(tuple, plain.select("id", "product_attributes")
                                         .collect()), key=str)


def test_stem_tokens_with_a_hot_word(spark):
    """One word is a third of all tokens: it is split over salt buckets and
    every array still comes back in order."""
    from pairscore.functions.porter import stem
    from pairscore.operators.stemming import stem_tokens
    words = ["cats", "ponies", "generalizations", "running", "hopping"]
    rows = [(i, ["running" if (i + j) % 3 == 0 else words[(i * j) % 5] for j in range(6)])
            for i in range(300)]
    df = spark.createDataFrame(rows, "k long, t array<string>")
    got = {r.k: r.s for r in stem_tokens(df, "k", "t", "s").collect()}
    assert got == {k: [stem(w) for w in t] for k, t in rows}


def test_python_stems_equal_the_built_in_ones(spark):
    """Every word of up to four of some letters with some endings, long runs of y, capitals and marks."""
    import itertools
    from pairscore.functions.porter import STEP2, STEP3, STEP4, stem, stem_words
    heads = ["".join(t) for n in range(4) for t in itertools.product("bwyae", repeat=n)]
    ends = ["", "s", "sses", "ies", "ed", "eed", "ing", "y", "e", "ll", "yy", *(s for s, _ in STEP2 + STEP3), *STEP4]
    words = sorted({h + e for h in heads for e in ends} | {"y" * 3000, "Running", "running\u0085", "cat-s", "cafés"})
    table = spark.createDataFrame([(w,) for w in words], "word string")
    assert {r.word: r.stem for r in stem_words(table, "word", "stem").collect()} == {w: stem(w) for w in words}


def test_stem_tokens_shuffles_no_words(spark):
    """What is shuffled is one row per array, however many words it has."""
    from pairscore.operators.stemming import stem_tokens
    df = spark.range(4).select(F.col("id").alias("k"), F.transform(F.sequence(F.lit(1), F.lit(500)), lambda i: F.concat(
        F.lit("running"), F.when(i % 2 == 0, i.cast("string")).otherwise(""))).alias("t"))
    out = stem_tokens(df, "k", "t", "s")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan and "Join" not in plan
    assert {r.k: r.s for r in out.collect()} == {k: ["run", *(w for i in range(2, 501, 2) for w in (f"running{i}", "run"))][:500]
                                                 for k in range(4)}


def test_stem_tokens_of_repeated_and_null_keys(spark):
    """Arrays of one key are merged by position, NULL words stay, NULL is a key, and a NULL array makes the whole NULL."""
    from pairscore.operators.stemming import stem_tokens
    rows = [(1, ["cats", None]), (1, ["ponies"]), (2, ["cats"]), (2, None), (3, []), (3, ["cats"]), (None, ["running"]), (None, ["a", "dogs"])]
    df = spark.createDataFrame(rows, "k long, t array<string>")
    got = {r.k: r.s for r in stem_tokens(df, "k", "t", "s").collect()}
    assert got == {1: ["cat", "poni", None], 2: None, 3: ["cat"], None: ["a", "run", "dog"]}


def test_stem_tokens_with_words_longer_than_are_kept(spark):
    from pairscore.functions.porter import stem
    from pairscore.operators.stemming import KEPT_LENGTH, stem_tokens
    words = ["b" * n + "ations" for n in (KEPT_LENGTH - 7, KEPT_LENGTH, 5000)] + ["y" * 3000]
    df = spark.createDataFrame([(1, words)], "k long, t array<string>")
    assert stem_tokens(df, "k", "t", "s").first().s == [stem(w) for w in words]


def test_spelling_with_hot_segments_matches_brute_force(spark):
    """Many short words sharing segments, and enough shuffle partitions that
    the shared segment keys count as hot: the split join finds the same
    corrections as brute force."""
    import itertools
    vocab_words = ["".join(t) for t in itertools.product("ab", repeat=4)] + ["abcab", "bbbbb"]
    vocab_rows = [(w, i % 4 + 1) for i, w in enumerate(vocab_words)]
    queries = ["".join(t) for t in itertools.product("abc", repeat=3)] + ["aaaaaa", "cccc"]
    vocab = spark.createDataFrame(vocab_rows, "word string, freq long")
    words = spark.createDataFrame([(w,) for w in queries], "word string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = {r.word: (r.correction, r.distance)
               for r in spelling.corrections(words, vocab, max_distance=2, min_length=1).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == _brute_force(queries, vocab_rows, k=2, min_length=1)
