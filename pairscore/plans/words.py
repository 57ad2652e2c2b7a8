"""Queries of the operators that work on the vocabulary (synonyms, stems in feature sets, attributes in free text) and of the
scans and sinks that keep every row. ``catalogue`` registers them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tokenize, word_match
from ..operators import catalog, extraction, rewrite, synonyms
from ..session import materialize, stage_root
from ..sources import csv_io
from ..sources import fixtures as fx
from ..sources.tables import table_in_file_order
from . import features as FE
from . import oracle_sql as S
from .catalogue import _inputs, _joined, query, table_word_vectors

# -------------------------------------------------------------------- synonyms

_SYNONYM_SQL = f""",
tokens AS (SELECT id, {S.tokenize("search_term")} AS q, {S.tokenize("product_title")} AS t FROM pairs),
hashed AS (SELECT w, CAST(concat('0x', substr(md5(w), 1, 8)) AS BIGINT) AS h
  FROM (SELECT DISTINCT w FROM (SELECT unnest(q) AS w FROM tokens UNION ALL SELECT unnest(t) FROM tokens))),
wv AS (SELECT w, CAST(embedding[1:10] AS DOUBLE[]) AS v FROM hashed JOIN embeddings
  ON vec_id = h % (SELECT count(*) FROM embeddings) WHERE h % 7 <> 0),
size AS (SELECT CAST(least(20, greatest(4, ceil(log2(count(*) / 16.0)))) AS BIGINT) AS bits FROM wv),
shape AS (SELECT bits, CAST(ceil(ln(1 - 0.98) / ln(1 - pow(1 - acos(0.6) / pi(), bits))) AS BIGINT) AS bands FROM size),
planes AS (SELECT j, i, CASE WHEN substr(md5(concat(j, ':', i)), 1, 1) < '8' THEN 1 ELSE -1 END AS r
  FROM (SELECT unnest(range((SELECT bits * bands FROM shape))) AS j), (SELECT unnest(range(10)) AS i)),
signs AS (SELECT w, j, CAST(sum(v[i + 1] * r) > 0 AS INTEGER) AS s FROM wv, planes GROUP BY w, j),
codes AS (SELECT w, j // bits AS band, string_agg(CAST(s AS VARCHAR), '' ORDER BY j) AS code FROM signs, shape GROUP BY w, j // bits),
met AS (SELECT DISTINCT a.w AS word, b.w AS synonym FROM codes a JOIN codes b ON a.band = b.band AND a.code = b.code AND a.w <> b.w),
close AS (SELECT word, synonym, round({S.cosine("a.v", "b.v")}, 6) AS similarity FROM met JOIN wv a ON a.w = word JOIN wv b ON b.w = synonym
  WHERE {S.cosine("a.v", "b.v")} >= 0.6),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY similarity DESC, synonym) AS rank FROM close),
found AS (SELECT * FROM ranked WHERE rank <= 3)"""


def _synonyms(spark, sf, terms: DataFrame) -> DataFrame:
    words = rewrite.words_of((terms, "q"), (terms, "t"))
    return synonyms.synonyms(table_word_vectors(spark, sf, words.select(F.array("word").alias("w"))), k=3, min_similarity=0.6)


def _terms(spark, sf) -> DataFrame:
    return materialize(fx.pairs(spark, sf).select("id", tokenize("search_term").alias("q"), tokenize("product_title").alias("t")), "terms")


@query("synonyms", fx.with_views("pairs") + _SYNONYM_SQL + """
SELECT word, CAST(rank AS INTEGER) AS rank, synonym, similarity FROM found""")
def synonyms_q(spark, sf):
    """Up to three synonyms of each word of the titles and search terms, by the cosine of word vectors taken from the
    embeddings table."""
    return _synonyms(spark, sf, _terms(spark, sf)).select("word", F.col("rank").cast("int").alias("rank"), "synonym", "similarity")


@query("word_match_expanded", fx.with_views("pairs") + _SYNONYM_SQL + f""",
places AS (SELECT id, unnest(q) AS w, generate_subscripts(q, 1) AS pos FROM tokens),
wide AS (SELECT id, w, pos, 0 AS rank FROM places UNION ALL SELECT id, synonym, pos, rank FROM places JOIN found ON word = w),
firsts AS (SELECT id, w, min(struct_pack(pos := pos, rank := rank)) AS spot FROM wide GROUP BY id, w),
lists AS (SELECT id, list(w ORDER BY spot) AS e FROM firsts GROUP BY id)
SELECT tokens.id AS id, {S.joined("coalesce(e, [])")} AS expanded, {S.word_match("coalesce(e, [])", "t")} AS match_score
FROM tokens LEFT JOIN lists ON lists.id = tokens.id""")
def word_match_expanded(spark, sf):
    """D4 + T7: each search word followed by its synonyms, every word once, against the title tokens."""
    terms = _terms(spark, sf)
    found = materialize(_synonyms(spark, sf, terms), "synonyms")
    wide = synonyms.expand(terms, "q", found, "e", ["id"])
    return wide.select("id", _joined("e").alias("expanded"), word_match("e", "t").alias("match_score"))


# ---------------------------------------------------- attributes in free text

@query("attr_extract", fx.with_views("descriptions", "attributes") + f""",
dict AS (SELECT DISTINCT name, value, {S.tokenize("value")} AS t FROM attributes WHERE name IS NOT NULL AND value IS NOT NULL),
texts AS (SELECT product_uid, {S.tokenize("product_description")} AS t FROM descriptions),
lengths AS (SELECT DISTINCT len(t) AS n FROM dict WHERE len(t) > 0),
runs AS (SELECT product_uid, p AS start, n, t[p + 1:p + n] AS run FROM (SELECT *, unnest(range(len(t))) AS p FROM texts), lengths
  WHERE p + n <= len(t)),
spans AS (SELECT * FROM runs WHERE run IN (SELECT t FROM dict)),
longest AS (SELECT * FROM spans a WHERE NOT EXISTS (SELECT 1 FROM spans b WHERE b.product_uid = a.product_uid AND b.n > a.n
  AND b.start <= a.start AND b.start + b.n >= a.start + a.n))
SELECT product_uid, CAST(start AS INTEGER) AS start, CAST(n AS INTEGER) AS n_tokens, name, value FROM longest JOIN dict ON t = run""")
def attr_extract(spark, sf):
    """Attribute values found in the descriptions, longest first; the dictionary is every value of the attribute table."""
    texts = fx.descriptions(spark, sf).select("product_uid", tokenize("product_description").alias("t"))
    return extraction.extract(texts, "product_uid", "t", extraction.dictionary(fx.attributes(spark, sf), tokenize("value")))


# --------------------------------------------------- stems in the feature sets

@query("features_8s_lexical", fx.with_views("pairs", "descriptions", "attributes") + f""",
j AS (SELECT p.id, {S.tokenize("p.search_term")} AS q, {S.tokenize("p.product_title")} AS t, {S.tokenize("b.value")} AS a,
             {S.remove_stop_words(S.tokenize("d.product_description"))} AS d, {S.term_length("p.search_term")} AS n
      FROM pairs p LEFT JOIN descriptions d ON p.product_uid = d.product_uid
      LEFT JOIN attributes b ON b.name = 'MFG Brand Name' AND p.product_uid = b.product_uid),
vocabulary AS (SELECT DISTINCT word FROM ({" UNION ALL ".join(f"SELECT unnest({c}) AS word FROM j" for c in "qtad")})),
{S.stems("vocabulary")},
m AS (SELECT map(list(word), list(stem)) AS to_stem FROM stems),
k AS (SELECT id, n, {", ".join(f"list_transform({c}, lambda w: map_extract_value(to_stem, w)) AS {c}" for c in "qtad")} FROM j, m),
f AS (SELECT id, n, q, t, d, coalesce(a, ['empty']) AS a FROM k)
SELECT id, {S.joined("a")} AS attribute_tokens, {S.word_match("q", "t")} AS searchAndTitleMD,
       {S.word_match("q", "a")} AS searchAndAttributesMD, coalesce({S.word_match("q", "d")}, 0) AS searchAndDescriptionMD,
       n AS search_term_length
FROM f""")
def features_8s_lexical(spark, sf):
    """D1 in feature set 8: word-match features on stems, which are made once per distinct word of all four texts."""
    fs = FE.FEATURE_SETS["8s"]
    i = _inputs(spark, sf)
    out = FE.lexical_features(fs, FE.token_table(fs, i.pairs, i.descriptions, i.attributes))
    return out.select("id", _joined(FE.TOKEN_COLS["attributes"]).alias("attribute_tokens"),
                      *[c for c in out.columns if c not in ("id", FE.TOKEN_COLS["attributes"])])


# ------------------------------------------------------- scans, sinks, order

@query("attr_concat_file_order", """
WITH placed AS (SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS part, row_number() OVER () AS place FROM lineitem)
SELECT l_orderkey AS product_uid, string_agg(part, ' ' ORDER BY place) AS product_attributes FROM placed GROUP BY l_orderkey""")
def attr_concat_file_order(spark, sf):
    """A1 in file order: the values of each key as they stand in the source files."""
    rows = table_in_file_order(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("product_uid"), F.lit("part").alias("name"), F.col("l_partkey").cast("string").alias("value"), "position")
    return catalog.attribute_text(rows, order_by="position")


_DAMAGED = """CASE WHEN id % 97 = 0 THEN concat_ws(',', id, product_uid, product_title, search_term, 'n/a')
            WHEN id % 101 = 0 THEN concat_ws(',', id, product_uid, product_title)
            WHEN id % 103 = 0 THEN concat_ws(',', id, product_uid, product_title, search_term, relevance, 'more')
            WHEN id % 107 = 0 THEN concat_ws(',', id, 'x', product_title, search_term, relevance) END"""


@query("csv_quarantine", fx.with_views("pairs") + f""",
d AS (SELECT *, {_DAMAGED} AS raw,
        CASE WHEN id % 97 = 0 THEN 'type: relevance' WHEN id % 101 = 0 THEN 'fields' WHEN id % 103 = 0 THEN 'fields'
             WHEN id % 107 = 0 THEN 'type: product_uid' END AS reason FROM pairs)
SELECT CASE WHEN reason IS NULL THEN id END AS id, CASE WHEN reason IS NULL THEN product_uid END AS product_uid,
       CASE WHEN reason IS NULL THEN search_term END AS search_term, CASE WHEN reason IS NULL THEN relevance END AS relevance, raw, reason
FROM d""")
def csv_quarantine(spark, sf):
    """Pairs as CSV with damaged records among them, read back; good rows and quarantined ones."""
    pairs = fx.pairs(spark, sf)
    plain = F.concat_ws(",", "id", "product_uid", "product_title", "search_term", "relevance")
    path = f"{stage_root(spark)}/csv-{uuid.uuid4().hex}"
    pairs.select(F.coalesce(F.expr(_DAMAGED), plain).alias("value")).write.text(path)
    good, bad = csv_io.read_csv_quarantine(spark, path, csv_io.PAIRS_SCHEMA, header=False)
    nothing = lambda *kinds: [F.lit(None).cast(k).alias(c) for c, k in kinds]
    return (good.select("id", "product_uid", "search_term", "relevance", *nothing(("raw", "string"), ("reason", "string")))
            .unionByName(bad.select(*nothing(("id", "long"), ("product_uid", "long"), ("search_term", "string"), ("relevance", "double")),
                                    "raw", "reason")))


@query("csv_single_file", fx.with_views("pairs") + "SELECT id, relevance AS prediction FROM pairs")
def csv_single_file(spark, sf):
    """S4 as one file in id order, read back."""
    path = f"{stage_root(spark)}/csv-{uuid.uuid4().hex}"
    csv_io.write_predictions(fx.pairs(spark, sf).select("id", F.col("relevance").alias("prediction")), path, single_file=True)
    return csv_io.read_csv(spark, path, csv_io.PREDICTIONS_SCHEMA)
