"""Column functions against hand-made rows and a pure-Python statement of
each formula."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairscore.functions import (cosine, euclidean, inverse_levenshtein, min_levenshtein,
                                 remove_stop_words, split_space, term_length, tokenize,
                                 word_match, word_match_bag)
from pairscore.functions.stopwords import ENGLISH
from pairscore.operators.catalog import token_bags


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_tokenize_edge_rows(spark):
    got = one(spark, tokenize("s"), [(" a  B\tc ",), ("",), ("   ",), (None,), ("Hi there",)],
              "s string")
    assert got == [["", "a", "", "b", "c"], [""], [], None, ["hi", "there"]]


def test_tokenize_matches_spark_ml_tokenizer(spark):
    from pyspark.ml.feature import Tokenizer
    rows = [(" a  B\tc ",), ("",), ("   ",), ("X\n\ny z  ",), ("one",), ("Été x",)]
    df = spark.createDataFrame(rows, "s string")
    ml = Tokenizer(inputCol="s", outputCol="t").transform(df).select("t").collect()
    ours = df.select(tokenize("s").alias("t")).collect()
    assert [r.t for r in ml] == [r.t for r in ours]


def test_split_space_keeps_case_and_empties(spark):
    assert one(spark, split_space("s"), [(" a  B\tc ",)], "s string") == \
        [["", "a", "", "B\tc", ""]]


def test_term_length(spark):
    got = one(spark, term_length("s"), [(" a  B\tc ",), ("",), ("   ",), ("one two",)],
              "s string")
    assert got == [3, 0, 0, 2]


def test_stop_words_list_is_spark_default():
    from pyspark.ml.feature import StopWordsRemover
    assert tuple(StopWordsRemover.loadDefaultStopWords("english")) == ENGLISH


def test_remove_stop_words_matches_remover(spark):
    from pyspark.ml.feature import StopWordsRemover
    rows = [(["The", "cat", "is", "on", "THE", "mat", "", "i'll"],), ([],)]
    df = spark.createDataFrame(rows, "t array<string>")
    ml = StopWordsRemover(inputCol="t", outputCol="o").transform(df).select("o").collect()
    ours = df.select(remove_stop_words("t").alias("o")).collect()
    assert [r.o for r in ml] == [r.o for r in ours]


def py_word_match(q, d):
    """The score as stated: 2 for equal words, 1 when one contains the other."""
    total = 0
    for x in q:
        for y in d:
            x2, y2 = x.lower(), y.lower()
            if x2 == y2:
                total += 2
            elif x2 in y2 or y2 in x2:
                total += 1
    return total


def test_word_match_worked_examples(spark):
    rows = [(["hi", "my", "name"], ["hi", "abc", "names"]), (["A", ""], ["ab", ""]),
            ([], ["x"]), (None, ["x"])]
    got = one(spark, word_match("q", "d"), rows, "q array<string>, d array<string>")
    assert got == [3, 5, 0, None]


words = st.lists(st.text(alphabet="abcAB", max_size=4), max_size=5)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=30))
def test_word_match_properties(spark, cases):
    df = spark.createDataFrame(cases, "q array<string>, d array<string>")
    bags = token_bags(df.withColumn("k", F.monotonically_increasing_id()), "k", "d", "bag")
    rows = (df.withColumn("k", F.monotonically_increasing_id())
              .join(bags, "k", "left")
              .select("q", "d", word_match("q", "d").alias("m"),
                      word_match("d", "q").alias("m2"),
                      F.coalesce(word_match_bag("q", "bag"), F.lit(0)).alias("mb"))
              .collect())
    for r in rows:
        assert r.m == py_word_match(r.q, r.d)
        assert r.m == r.m2                       # symmetric
        assert r.mb == r.m                       # bag form equals plain form


def test_cosine_and_euclid_examples(spark):
    schema = "a array<double>, b array<double>"
    rows = [([1.0, 0.0], [0.0, 1.0]), ([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0]),
            ([1.0], [1.0, 2.0])]
    cos = one(spark, cosine("a", "b"), rows, schema)
    assert cos[0] == 0.0 and abs(cos[1] - 1.0) < 1e-12 and cos[2] is None and cos[3] is None
    ed = one(spark, euclidean("a", "b"), [([10.0, 10.0, 10.0], [5.0, 5.0])], schema)
    assert abs(ed[0] - math.sqrt(150)) < 1e-12


vec = st.lists(st.floats(-100, 100, allow_nan=False), min_size=3, max_size=3)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(vec, vec), min_size=1, max_size=30))
def test_vector_properties(spark, cases):
    df = spark.createDataFrame(cases, "a array<double>, b array<double>")
    rows = df.select("a", "b", cosine("a", "b").alias("c"), cosine("b", "a").alias("c2"),
                     euclidean("a", "b").alias("e"), euclidean("b", "a").alias("e2"),
                     euclidean("a", "a").alias("e0")).collect()
    for r in rows:
        dot = sum(x * y for x, y in zip(r.a, r.b))
        na, nb = math.sqrt(sum(x * x for x in r.a)), math.sqrt(sum(y * y for y in r.b))
        if na * nb == 0:
            assert r.c is None
        else:
            assert -1 - 1e-9 <= r.c <= 1 + 1e-9
            assert abs(r.c - dot / (na * nb)) < 1e-9 and abs(r.c - r.c2) < 1e-12
        assert abs(r.e - r.e2) < 1e-9 and r.e0 == 0.0


def py_lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_levenshtein_features(spark):
    rows = [(["kitten", "abc"], ["sitting", "abd"]), (["x"], []), ([], ["y"])]
    df = spark.createDataFrame(rows, "q array<string>, d array<string>")
    got = df.select(min_levenshtein("q", "d").alias("m"),
                    inverse_levenshtein("q", "d").alias("i")).collect()
    assert got[0].m == 1 and abs(got[0].i - (1 / 4 + 1 / 2)) < 1e-12
    assert got[1].m is None and got[1].i == 0.0
    assert got[2].m is None and got[2].i == 0.0
    assert py_lev("kitten", "sitting") == 3


def test_native_functions_have_no_python_udf(spark):
    df = spark.createDataFrame([(["a"], ["b"], [1.0], [2.0], "x y")],
                               "q array<string>, d array<string>, a array<double>, "
                               "b array<double>, s string")
    out = df.select(word_match("q", "d"), cosine("a", "b"), euclidean("a", "b"),
                    tokenize("s"), term_length("s"), remove_stop_words("q"),
                    min_levenshtein("q", "d"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEval" not in plan


def test_porter_published_examples():
    from pairscore.functions.porter import stem
    cases = {"caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed",
             "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
             "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size",
             "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss",
             "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
             "sky": "sky", "relational": "relat", "conditional": "condit",
             "rational": "ration", "digitizer": "digit", "generalizations": "gener",
             "oscillators": "oscil", "triplicate": "triplic", "adjustable": "adjust",
             "controll": "control", "roll": "roll", "cease": "ceas", "rate": "rate",
             "adoption": "adopt", "effective": "effect", "goodness": "good",
             "allowance": "allow", "replacement": "replac", "electrical": "electr"}
    assert {w: stem(w) for w in cases} == cases
    assert stem("at") == "at" and stem(None) is None and stem("café") == "café"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(words, words, words), min_size=1, max_size=30))
def test_word_match_additive_in_query(spark, cases):
    df = spark.createDataFrame(cases, "q1 array<string>, q2 array<string>, d array<string>")
    rows = df.select(word_match(F.concat("q1", "q2"), "d").alias("both"),
                     (word_match("q1", "d") + word_match("q2", "d")).alias("total")).collect()
    assert all(r.both == r.total for r in rows)


def _score(q, d):
    q, d = [x.lower() for x in q], [y.lower() for y in d]
    return sum((x in y) + (y in x) for x in q for y in d)


def test_word_match_over_a_text_equals_the_loop(spark):
    """The scan of a text as one string gives the score of the nested loop, for any characters, empties and long words."""
    import random
    from pairscore.functions import token_text, word_match, word_match_text
    rng = random.Random(8)
    letters = ["a", "b", "B", ".", "*", "(", "[", "\\", "E", "Q", "$", "^", "|", "-", "\x01", "é", "ß", "İ", "日", "😀", "̈", "'", '"', "+", "?", "{"]
    word = lambda: "".join(rng.choice(letters[:rng.choice([3, len(letters)])]) for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 30])))
    rows = [(i, [word() for _ in range(rng.randrange(0, 5))], [word() for _ in range(rng.randrange(0, 25))]) for i in range(250)]
    rows += [(900, [], ["x"]), (901, ["x"], []), (902, [""], [""]), (903, [""], []), (904, None, ["x"]), (905, ["x"], None), (906, ["\\E"], ["a\\Eb"]),
             (907, ["aaaa"], ["aa", "a", "aaaa", "aaaaaaaa"])]
    df = spark.createDataFrame(rows, "id int, q array<string>, d array<string>")
    got = {r.id: (r.a, r.b) for r in df.select("id", word_match("q", "d").alias("a"), word_match_text("q", token_text("d")).alias("b")).collect()}
    assert all(a == b for a, b in got.values()), [k for k, (a, b) in got.items() if a != b][:5]
    for i, q, d in rows:
        assert q is None or d is None or "İ" in "".join(q + d) or got[i][1] == _score(q, d)


def test_word_match_over_a_long_text(spark):
    from pyspark.sql import functions as F

    from pairscore.functions import token_text, tokenize, word_match_text
    text = " ".join(f"word{i % 977} {'<' * (i % 5)}" for i in range(100_000))
    df = spark.createDataFrame([(text, "word9 <<< <<<<<<<<<< d " + "z" * 5000)], "t string, q string")
    got = df.select(word_match_text(tokenize("q"), token_text(tokenize("t"))).alias("s")).first()[0]
    words, query = text.split(" "), "word9 <<< <<<<<<<<<< d".split() + ["z" * 5000]
    assert got == sum((x in y) + (y in x) for y in words for x in query)
