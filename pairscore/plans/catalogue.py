"""Query catalogue: every implemented operator as (Spark plan, DuckDB oracle).

Each Spark query takes (spark, sf_dir), reads the provided tables through the
fixture views and returns a DataFrame over the whole tables. Each oracle is
the same result as ANSI SQL over the same parquet tables. Arrays are returned
joined with ``'|'`` and doubles rounded to 6 places on both sides, so the two
engines hash the same values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (cosine, euclidean, levenshtein_scores, remove_stop_words, split_space, term_length, token_text, tokenize,
                         word_match, word_match_bag, word_match_text)
from ..operators import catalog, spelling, stemming
from ..operators.embed import document_vectors, fit_word2vec, word_vectors
from ..session import materialize, stage_root
from ..sources import csv_io
from ..sources import fixtures as fx
from ..sources.tables import table
from . import evaluate as EV
from . import features as FE
from . import models as M
from . import oracle_sql as S
from . import pipeline as PL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def _joined(c) -> F.Column:
    return F.array_join(c, "|")


# ---------------------------------------------------------------- scans, counts

@query("head_100", fx.with_views("pairs") + "SELECT * FROM pairs ORDER BY id LIMIT 100")
def head_100(spark, sf):
    """First 100 pairs, deterministic by id (a top-k, not a full sort)."""
    return fx.pairs(spark, sf).orderBy("id").limit(100)


@query("pair_counts", fx.with_views("pairs") + """
SELECT relevance, count(*) AS n_pairs FROM pairs GROUP BY relevance""")
def pair_counts(spark, sf):
    """Row counts, per label value."""
    return fx.pairs(spark, sf).groupBy("relevance").agg(F.count(F.lit(1)).alias("n_pairs"))


# ------------------------------------------------------ projection, cast, nulls

def _raw_attributes(spark, sf):
    """attributes as the reference reads them: float keys, wholly NULL rows
    and NULL values occur. The extra rows derive from ``part``."""
    part = table(spark, sf, "part")
    extra_null = part.where(F.col("p_partkey") % 11 == 0).select(
        F.lit(None).cast("long").alias("product_uid"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("value"))
    extra_noval = part.where(F.col("p_partkey") % 13 == 0).select(
        F.col("p_partkey").alias("product_uid"), F.lit("Warranty").alias("name"),
        F.lit(None).cast("string").alias("value"))
    out = fx.attributes(spark, sf).unionByName(extra_null).unionByName(extra_noval)
    return out.withColumn("product_uid", F.col("product_uid").cast("double"))


_RAW_ATTR_SQL = """,
raw_attributes AS (
  SELECT CAST(product_uid AS DOUBLE) AS product_uid, name, value FROM (
    SELECT product_uid, name, value FROM attributes
    UNION ALL SELECT NULL, NULL, NULL FROM part WHERE p_partkey % 11 = 0
    UNION ALL SELECT p_partkey, 'Warranty', NULL FROM part WHERE p_partkey % 13 = 0)
)
"""


@query("attr_clean", fx.with_views("attributes") + _RAW_ATTR_SQL + """
SELECT CAST(product_uid AS BIGINT) AS product_uid, name, coalesce(CAST(value AS VARCHAR), 'nan') AS value
FROM raw_attributes
WHERE NOT (product_uid IS NULL AND name IS NULL AND value IS NULL)""")
def attr_clean(spark, sf):
    """Drop all-NULL rows, float key to long, NULL value to 'nan'."""
    return catalog.clean_attributes(_raw_attributes(spark, sf))


@query("label_cast", fx.with_views("pairs") + """
SELECT id, TRY_CAST(CASE WHEN id % 97 = 0 THEN 'n/a' ELSE CAST(relevance AS VARCHAR) END AS DOUBLE) AS relevance
FROM pairs""")
def label_cast(spark, sf):
    """Text label to double; unparsable text becomes NULL."""
    text = (F.when(F.col("id") % 97 == 0, F.lit("n/a"))
             .otherwise(F.col("relevance").cast("string")))
    return fx.pairs(spark, sf).select("id", text.try_cast("double").alias("relevance"))


@query("brand_lookup", fx.with_views("attributes") + """
SELECT product_uid, value AS product_attributes FROM attributes WHERE name = 'MFG Brand Name'""")
def brand_lookup(spark, sf):
    """Brand rows, renamed, name column dropped."""
    return catalog.brand_rows(fx.attributes(spark, sf))


# ------------------------------------------------------------------------ joins

@query("join_description", fx.with_views("pairs", "descriptions") + """
SELECT p.id, p.product_uid, p.product_title, p.search_term, p.relevance, d.product_description
FROM pairs p LEFT JOIN descriptions d ON p.product_uid = d.product_uid""")
def join_description(spark, sf):
    """Pairs LEFT JOIN descriptions."""
    out = catalog.attach_description(fx.pairs(spark, sf), fx.descriptions(spark, sf))
    return out.select("id", "product_uid", "product_title", "search_term", "relevance",
                      "product_description")


_JOIN_BRAND_SQL = fx.with_views("pairs", "attributes") + """,
brands AS (SELECT product_uid, value AS product_attributes FROM attributes WHERE name = 'MFG Brand Name')
SELECT p.id, p.product_uid, {col} AS product_attributes
FROM pairs p LEFT JOIN brands b ON p.product_uid = b.product_uid"""


@query("join_brand", _JOIN_BRAND_SQL.format(col="b.product_attributes"))
def join_brand(spark, sf):
    """Pairs LEFT JOIN brand rows; NULLs and duplicates kept."""
    brands = catalog.brand_rows(fx.attributes(spark, sf))
    out = catalog.attach_brand(fx.pairs(spark, sf), brands, fill=None)
    return out.select("id", "product_uid", "product_attributes")


@query("brand_or_empty", _JOIN_BRAND_SQL.format(col="coalesce(b.product_attributes, 'empty')"))
def brand_or_empty(spark, sf):
    """J2 + P8: missing brand becomes 'empty'."""
    brands = catalog.brand_rows(fx.attributes(spark, sf))
    out = catalog.attach_brand(fx.pairs(spark, sf), brands)
    return out.select("id", "product_uid", "product_attributes")


# ------------------------------------------------------------------ aggregation

def _concat_sql(where: str) -> str:
    return fx.with_views("attributes") + f"""
SELECT product_uid, string_agg(value, ' ' ORDER BY name, value) AS product_attributes
FROM attributes {where} GROUP BY product_uid"""


@query("attr_concat_all", _concat_sql(""))
def attr_concat_all(spark, sf):
    """A1: every attribute value of a product, space-joined."""
    return catalog.attribute_text(fx.attributes(spark, sf))


@query("attr_concat_brand", _concat_sql("WHERE contains(lower(name), 'brand')"))
def attr_concat_brand(spark, sf):
    """A2: brand values only (name contains 'brand', any case)."""
    return catalog.attribute_text(fx.attributes(spark, sf), ["brand"])


@query("attr_concat_bcm", _concat_sql(
    "WHERE contains(lower(name), 'brand') OR contains(lower(name), 'color') "
    "OR contains(lower(name), 'material')"))
def attr_concat_bcm(spark, sf):
    """A3: brand, color and material values."""
    return catalog.attribute_text(fx.attributes(spark, sf), ["brand", "color", "material"])


@query("join_attr_text", fx.with_views("pairs", "attributes") + """,
txt AS (SELECT product_uid, string_agg(value, ' ' ORDER BY name, value) AS product_attributes
        FROM attributes WHERE contains(lower(name), 'brand') GROUP BY product_uid)
SELECT p.id, p.product_uid, t.product_attributes
FROM pairs p LEFT JOIN txt t ON p.product_uid = t.product_uid""")
def join_attr_text(spark, sf):
    """Pairs LEFT JOIN per-product brand text."""
    txt = catalog.attribute_text(fx.attributes(spark, sf), ["brand"])
    return (catalog.attach_description(fx.pairs(spark, sf), txt)
              .select("id", "product_uid", "product_attributes"))


# -------------------------------------------------------------------- text ops

@query("split_space", fx.with_views("pairs") + f"""
SELECT id, {S.joined("string_split(product_title, ' ')")} AS title_tokens,
       CAST(len(string_split(product_title, ' ')) AS INTEGER) AS n_tokens
FROM pairs""")
def split_space_q(spark, sf):
    """Literal single-space split of the title."""
    toks = split_space("product_title")
    return fx.pairs(spark, sf).select("id", _joined(toks).alias("title_tokens"),
                                      F.size(toks).alias("n_tokens"))


@query("tokenize_title", fx.with_views("pairs") + f"""
SELECT id, {S.joined(S.tokenize("product_title"))} AS title_tokens,
       CAST(len({S.tokenize("product_title")}) AS INTEGER) AS n_tokens
FROM pairs""")
def tokenize_title(spark, sf):
    """T2 over pair titles."""
    toks = tokenize("product_title")
    return fx.pairs(spark, sf).select("id", _joined(toks).alias("title_tokens"),
                                      F.size(toks).alias("n_tokens"))


@query("tokenize_documents", f"""
SELECT doc_id, {S.joined(S.tokenize("text"))} AS tokens,
       CAST(len({S.tokenize("text")}) AS INTEGER) AS n_tokens
FROM documents""")
def tokenize_documents(spark, sf):
    """T2 over full multilingual documents."""
    toks = tokenize("text")
    return table(spark, sf, "documents").select("doc_id", _joined(toks).alias("tokens"),
                                                F.size(toks).alias("n_tokens"))


@query("stopwords_description", fx.with_views("descriptions") + f"""
SELECT product_uid, {S.joined(S.remove_stop_words(S.tokenize("product_description")))} AS tokens
FROM descriptions""")
def stopwords_description(spark, sf):
    """Stop words removed from description tokens."""
    toks = remove_stop_words(tokenize("product_description"))
    return fx.descriptions(spark, sf).select("product_uid", _joined(toks).alias("tokens"))


@query("stopwords_documents", f"""
SELECT doc_id, {S.joined(S.remove_stop_words(S.tokenize("text")))} AS tokens
FROM documents""")
def stopwords_documents(spark, sf):
    """T3 over all documents."""
    toks = remove_stop_words(tokenize("text"))
    return table(spark, sf, "documents").select("doc_id", _joined(toks).alias("tokens"))


@query("term_length", fx.with_views("pairs") + f"""
SELECT id, {S.term_length("search_term")} AS search_term_length FROM pairs""")
def term_length_q(spark, sf):
    """T4: words in the search term."""
    return fx.pairs(spark, sf).select("id", term_length("search_term").alias("search_term_length"))


@query("term_length_docs", fx.with_views("doc_pairs") + f"""
SELECT id, {S.term_length("search_term")} AS search_term_length,
       {S.term_length("product_description")} AS description_length FROM doc_pairs""")
def term_length_docs(spark, sf):
    """T4 over real text (search term and whole document)."""
    return fx.doc_pairs(spark, sf).select(
        "id", term_length("search_term").alias("search_term_length"),
        term_length("product_description").alias("description_length"))


# ------------------------------------------------------------------ word match

@query("word_match_title", fx.with_views("pairs") + f"""
SELECT id, {S.word_match(S.tokenize("search_term"), S.tokenize("product_title"))} AS match_score
FROM pairs""")
def word_match_title(spark, sf):
    """Search term tokens against title tokens."""
    p = fx.pairs(spark, sf)
    return p.select("id", word_match(tokenize("search_term"),
                                     tokenize("product_title")).alias("match_score"))


@query("word_match_attr", fx.with_views("pairs", "attributes") + f""",
brands AS (SELECT product_uid, value AS product_attributes FROM attributes WHERE name = 'MFG Brand Name'),
j AS (SELECT p.id, p.search_term, coalesce(b.product_attributes, 'empty') AS product_attributes
      FROM pairs p LEFT JOIN brands b ON p.product_uid = b.product_uid)
SELECT id, product_attributes,
       {S.word_match(S.tokenize("search_term"), S.tokenize("product_attributes"))} AS match_score
FROM j""")
def word_match_attr(spark, sf):
    """Search term tokens against brand tokens (pairs with two brand rows
    appear twice; no brand -> the token 'empty')."""
    brands = catalog.brand_rows(fx.attributes(spark, sf))
    j = catalog.attach_brand(fx.pairs(spark, sf), brands)
    return j.select("id", "product_attributes",
                    word_match(tokenize("search_term"),
                               tokenize("product_attributes")).alias("match_score"))


def description_bags(descriptions: DataFrame, key: str = "product_uid",
                     text: str = "product_description") -> DataFrame:
    """(key, desc_bag): stop-word-free description tokens per product as a
    bag of (token, count)."""
    toks = descriptions.select(key, remove_stop_words(tokenize(text)).alias("_tok"))
    return catalog.token_bags(toks, key, "_tok", "desc_bag")


@query("word_match_desc", fx.with_views("pairs", "descriptions") + f""",
j AS (SELECT p.id, p.search_term, d.product_description
      FROM pairs p LEFT JOIN descriptions d ON p.product_uid = d.product_uid)
SELECT id, coalesce({S.word_match(S.tokenize("search_term"),
                                  S.remove_stop_words(S.tokenize("product_description")))}, 0)
       AS match_score
FROM j""")
def word_match_desc(spark, sf):
    """Search term tokens against description tokens (stop words
    removed), scored against a per-product bag of distinct tokens; a product
    without a description scores 0. The pairs are written first: the count of
    hot products then reads one column and does not derive them again, and
    no task holds the sorts of their joins beside those of this one."""
    bags = description_bags(fx.descriptions(spark, sf))
    pairs = materialize(fx.pairs(spark, sf).select("id", "product_uid", "search_term"), "pairs")
    j = catalog.attach_description(pairs, bags, shuffled=True)
    bag = F.coalesce(F.col("desc_bag"), F.array().cast("array<struct<t:string,n:int>>"))
    return j.select("id", word_match_bag(tokenize("search_term"), bag).alias("match_score"))


@query("word_match_docs", fx.with_views("doc_pairs") + f"""
SELECT id, {S.word_match(S.tokenize("search_term"), S.tokenize("product_description"))} AS match_score
FROM doc_pairs""")
def word_match_docs(spark, sf):
    """T7 against whole documents (long text): each document is scanned as one string, once a query word, with no loop over
    its words; the pairs carry ids and search terms only until they meet it."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("product_uid"), token_text(tokenize("text")).alias("words"))
    # the scans are the work, not the bytes: by the size of their files the pairs would be one task
    terms = fx.doc_terms(spark, sf).select("id", "product_uid", "search_term")
    terms = terms.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "product_uid")
    j = catalog.attach_description(terms, docs)
    score = F.when(F.col("search_term").isNotNull(), F.coalesce(word_match_text(tokenize("search_term"), "words"), F.lit(0)))
    return j.select("id", score.alias("match_score"))


# ------------------------------------------------- edit distance and spelling

_SPELL_SQL = f""",
titles AS (SELECT DISTINCT product_uid, product_title FROM pairs),
vocab AS (SELECT w AS word, count(*) AS freq
          FROM (SELECT unnest({S.tokenize("product_title")}) AS w FROM titles)
          WHERE w <> '' GROUP BY w),
qw AS (SELECT DISTINCT w AS word
       FROM (SELECT unnest({S.tokenize("search_term")}) AS w FROM pairs)
       WHERE length(w) >= 1 AND w NOT IN (SELECT word FROM vocab)),
cand AS (SELECT q.word, v.word AS cand, v.freq, levenshtein(q.word, v.word) AS dist
         FROM qw q JOIN vocab v ON abs(length(q.word) - length(v.word)) <= 2
         WHERE levenshtein(q.word, v.word) <= 2),
best AS (SELECT word, cand, dist,
                row_number() OVER (PARTITION BY word ORDER BY dist, freq DESC, cand) AS rk
         FROM cand)"""


@query("word_match_corrected", fx.with_views("pairs") + _SPELL_SQL + f""",
words AS (SELECT id, unnest(t) AS w, generate_subscripts(t, 1) AS pos
          FROM (SELECT id, {S.tokenize("search_term")} AS t FROM pairs)),
fixed AS (SELECT id, list(coalesce(b.cand, w) ORDER BY pos) AS q
          FROM words LEFT JOIN best b ON b.word = w AND b.rk = 1 GROUP BY id)
SELECT p.id AS id, {S.joined("coalesce(q, [])")} AS corrected,
       {S.word_match("coalesce(q, [])", S.tokenize("product_title"))} AS match_score
FROM pairs p LEFT JOIN fixed f ON p.id = f.id""")
def word_match_corrected(spark, sf):
    """D3 + T7: search terms with their unknown words corrected, against the title tokens."""
    p = materialize(fx.pairs(spark, sf), "pairs")
    terms = p.select("id", "product_title", tokenize("search_term").alias("q"))
    fixed = spelling.correct_tokens(terms, "id", "q", _fixes(p), "fixed")
    return fixed.select("id", _joined("fixed").alias("corrected"),
                        word_match("fixed", tokenize("product_title")).alias("match_score"))


@query("levenshtein_min", fx.with_views("pairs") + f"""
SELECT id,
       {S.min_levenshtein(S.tokenize("search_term"), S.tokenize("product_title"))} AS lev_min,
       round({S.inverse_levenshtein(S.tokenize("search_term"), S.tokenize("product_title"))}, 6)
         AS lev_inv
FROM pairs""")
def levenshtein_min(spark, sf):
    """Smallest edit distance between any search word and any title
    word, and the inverse-distance score summed over the search words."""
    q, d = tokenize("search_term"), tokenize("product_title")
    scores = fx.pairs(spark, sf).select("id", levenshtein_scores(q, d).alias("s"))
    return scores.select("id", "s.lev_min", F.round("s.lev_inv", 6).alias("lev_inv"))


@query("spell_correct", fx.with_views("pairs") + _SPELL_SQL + """
SELECT qw.word, b.cand AS correction, CAST(b.dist AS INTEGER) AS distance
FROM qw LEFT JOIN best b ON b.word = qw.word AND b.rk = 1""")
def spell_correct(spark, sf):
    """D3: every distinct search word missing from the title vocabulary, with
    its closest vocabulary word within edit distance 2."""
    return _fixes(fx.pairs(spark, sf))


def _fixes(pairs: DataFrame) -> DataFrame:
    titles = pairs.select("product_uid", "product_title").distinct().select(tokenize("product_title").alias("t"))
    words = pairs.select(F.explode(tokenize("search_term")).alias("word"))
    return spelling.corrections(words, spelling.vocabulary(titles, "t"), max_distance=2)


@query("stem_tokens", f"""
WITH toks AS (SELECT doc_id, {S.remove_stop_words(S.tokenize("text"))} AS t FROM documents),
occ AS (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM toks),
vocabulary AS (SELECT DISTINCT word FROM occ),
{S.stems("vocabulary")},
joined AS (SELECT doc_id, string_agg(stem, '|' ORDER BY pos) AS stems FROM occ JOIN stems USING (word) GROUP BY doc_id)
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, coalesce(stems, '') AS stems
FROM toks LEFT JOIN joined USING (doc_id)""")
def stem_tokens_q(spark, sf):
    """Porter stems of the stop-word-free tokens of every document."""
    docs = table(spark, sf, "documents").select("doc_id", remove_stop_words(tokenize("text")).alias("tokens"))
    out = stemming.stem_tokens(docs, "doc_id", "tokens", "stems")
    return out.select("doc_id", F.size("stems").alias("n_tokens"),
                      _joined("stems").alias("stems"))


# The attribute names turned into columns.
PIVOT_NAMES = ("MFG Brand Name", "Material", "Color Family", "Size")


@query("attr_pivot", fx.with_views("attributes") + """
SELECT product_uid,
       string_agg(value, ' ' ORDER BY value) FILTER (WHERE name = 'MFG Brand Name') AS mfg_brand_name,
       string_agg(value, ' ' ORDER BY value) FILTER (WHERE name = 'Material') AS material,
       string_agg(value, ' ' ORDER BY value) FILTER (WHERE name = 'Color Family') AS color_family,
       string_agg(value, ' ' ORDER BY value) FILTER (WHERE name = 'Size') AS size
FROM attributes
WHERE name IN ('MFG Brand Name', 'Material', 'Color Family', 'Size')
GROUP BY product_uid""")
def attr_pivot(spark, sf):
    """Attribute rows to one wide row per product."""
    return catalog.attribute_pivot(fx.attributes(spark, sf), PIVOT_NAMES)


# --------------------------------------------------------------------- vectors

_EMB_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT a.vec_id, {expr} AS {name}
FROM e a JOIN e b ON b.vec_id = a.vec_id + 1"""


def _emb_pairs(spark, sf):
    e = table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    a = e.select(F.col("vec_id"), F.col("v").alias("va"))
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("vb"))
    return a.join(b, "vec_id")


@query("cosine_pairs", _EMB_SQL.format(expr=f"round({S.cosine('a.v', 'b.v')}, 6)", name="cosine"))
def cosine_pairs(spark, sf):
    """V3: cosine of each embedding with the next one."""
    return _emb_pairs(spark, sf).select("vec_id", F.round(cosine("va", "vb"), 6).alias("cosine"))


@query("euclid_pairs", _EMB_SQL.format(expr=f"round({S.euclidean('a.v', 'b.v')}, 6)",
                                       name="euclid"))
def euclid_pairs(spark, sf):
    """V4: Euclidean distance of each embedding to the next one."""
    return _emb_pairs(spark, sf).select("vec_id", F.round(euclidean("va", "vb"), 6).alias("euclid"))


@query("euclid_padded", _EMB_SQL.format(
    expr=f"round({S.euclidean('a.v[1:40]', 'b.v')}, 6)", name="euclid"))
def euclid_padded(spark, sf):
    """V4 with unequal lengths: first 40 dims against all 64 (zero-padded)."""
    return _emb_pairs(spark, sf).select(
        "vec_id", F.round(euclidean(F.slice("va", 1, 40), "vb"), 6).alias("euclid"))


# ------------------------------------------------------------- scan and sink

@query("csv_roundtrip", fx.with_views("pairs") + """
SELECT id, product_uid, concat(product_title, ' Łódź 日本 "q", ', chr(10), 'x') AS product_title, search_term, relevance
FROM pairs""")
def csv_roundtrip(spark, sf):
    """S1 + S4: pairs, with Polish and Japanese characters, quotes and a line
    break in each title, written as CSV into the shared checkpoint folder and
    scanned back with the fixed schema; must equal the input."""
    path = f"{stage_root(spark)}/csv-{uuid.uuid4().hex}"
    title = F.concat("product_title", F.lit(' Łódź 日本 "q", \nx'))
    csv_io.write_csv(fx.pairs(spark, sf).withColumn("product_title", title), path)
    return csv_io.read_csv(spark, path, csv_io.PAIRS_SCHEMA, multi_line=True)


@query("csv_roundtrip_split", fx.with_views("pairs") + "SELECT * FROM pairs")
def csv_roundtrip_split(spark, sf):
    """S1 + S4 for a table without line breaks, whose files are read in splits."""
    path = f"{stage_root(spark)}/csv-{uuid.uuid4().hex}"
    csv_io.write_csv(fx.pairs(spark, sf), path)
    return csv_io.read_csv(spark, path, csv_io.PAIRS_SCHEMA)


# --------------------------------------------------------- split and evaluate

@query("holdout_split", fx.with_views("pairs") + """
SELECT id, product_uid, CASE WHEN product_uid % 10 < 7 THEN 'train' ELSE 'test' END AS split
FROM pairs""")
def holdout_split(spark, sf):
    """M4 (deterministic form): 70/30 split by product."""
    return fx.pairs(spark, sf).select("id", "product_uid", M.split_label().alias("split"))


@query("rmse_eval", fx.with_views("pairs") + f""",
t AS (SELECT id, relevance, {S.term_length("search_term")} AS len FROM pairs),
m AS (SELECT len, avg(relevance) AS prediction FROM t GROUP BY len)
SELECT count(*) AS n_pairs, round(sqrt(avg(pow(t.relevance - m.prediction, 2))), 6) AS rmse
FROM t LEFT JOIN m ON t.len IS NOT DISTINCT FROM m.len""")
def rmse_eval(spark, sf):
    """A5/M7/P10: RMSE of a baseline predictor (mean relevance of pairs with
    the same search-term length). The squared error around a group's mean is
    n * variance, so one pass of grouped moments states it without a join."""
    t = fx.pairs(spark, sf).select("relevance", term_length("search_term").alias("len"))
    m = t.groupBy("len").agg(F.count(F.lit(1)).alias("n"), F.var_pop("relevance").alias("v"))
    return m.agg(F.sum("n").alias("n_pairs"),
                 F.round(F.sqrt(F.sum(F.col("n") * F.col("v")) / F.sum("n")), 6).alias("rmse"))


# ------------------------------------------------- embeddings, features, models
# Word2Vec and full forests have no SQL oracle; the vector and model operators are also run on inputs SQL can follow.

def _inputs(spark, sf) -> PL.Inputs:
    """The three inputs of the model queries. The pair view is derived
    (lineitem aggregate and two joins) and each model query reads it several
    times (hot-product count, training and scoring token tables), so it is
    written once to the shared checkpoint folder, like a stored pair table."""
    return PL.Inputs(materialize(fx.pairs(spark, sf), "pairs"), fx.descriptions(spark, sf),
                     fx.attributes(spark, sf))


@query("w2v_title")
def w2v_title(spark, sf):
    """V1/V2: Word2Vec (size 10, minCount 0) over title tokens; mean vector
    per pair."""
    p = fx.pairs(spark, sf).select("id", tokenize("product_title").alias("t"))
    words = word_vectors(fit_word2vec(p, "t", "v"))
    return document_vectors(p, "t", words, 10, "title_vector").select("id", "title_vector")


def _features_query(name):
    def q(spark, sf):
        i = _inputs(spark, sf)
        feats, _ = FE.build(name, i.pairs, i.descriptions, i.attributes)
        return feats
    q.__doc__ = f"Feature set {name} over all pairs (Word2Vec fitted on them)."
    return q


for _n in ("3", "6", "7", "8"):
    query(f"features_{_n}")(_features_query(_n))


@query("features_8_lexical", fx.with_views("pairs", "descriptions", "attributes") + f""",
brands AS (SELECT product_uid, value AS brand FROM attributes WHERE name = 'MFG Brand Name'),
j AS (SELECT p.id, p.search_term, p.product_title, coalesce(b.brand, 'empty') AS brand,
             d.product_description
      FROM pairs p
      LEFT JOIN descriptions d ON p.product_uid = d.product_uid
      LEFT JOIN brands b ON p.product_uid = b.product_uid)
SELECT id,
       {S.joined(S.tokenize("brand"))} AS attribute_tokens,
       {S.word_match(S.tokenize("search_term"), S.tokenize("product_title"))} AS searchAndTitleMD,
       {S.word_match(S.tokenize("search_term"), S.tokenize("brand"))} AS searchAndAttributesMD,
       coalesce({S.word_match(S.tokenize("search_term"),
                              S.remove_stop_words(S.tokenize("product_description")))}, 0)
         AS searchAndDescriptionMD,
       {S.term_length("search_term")} AS search_term_length
FROM j""")
def features_8_lexical(spark, sf):
    """The embedding-free half of feature set 8 through the feature
    pipeline's own token table (brand join with multiplicity, 'empty' fill,
    description bags): the three word-match features and the term length."""
    fs = FE.FEATURE_SETS["8"]
    i = _inputs(spark, sf)
    tokens = FE.token_table(fs, i.pairs, i.descriptions, i.attributes)
    out = FE.lexical_features(fs, tokens)
    return out.select("id", _joined(FE.TOKEN_COLS["attributes"]).alias("attribute_tokens"),
                      *[c for c in out.columns if c not in ("id", FE.TOKEN_COLS["attributes"])])


@query("features_7_lexical", fx.with_views("pairs", "descriptions", "attributes") + f""",
txt AS (SELECT product_uid, string_agg(value, ' ' ORDER BY name, value) AS attr_text
        FROM attributes WHERE contains(lower(name), 'brand') GROUP BY product_uid),
j AS (SELECT p.id, p.search_term, p.product_title, t.attr_text, d.product_description
      FROM pairs p
      LEFT JOIN descriptions d ON p.product_uid = d.product_uid
      LEFT JOIN txt t ON p.product_uid = t.product_uid)
SELECT id,
       coalesce({S.joined(S.tokenize("attr_text"))}, '') AS attribute_tokens,
       {S.word_match(S.tokenize("search_term"), S.tokenize("product_title"))} AS searchAndTitleMD,
       coalesce({S.word_match(S.tokenize("search_term"), S.tokenize("attr_text"))}, 0)
         AS searchAndAttributesMD,
       coalesce({S.word_match(S.tokenize("search_term"),
                              S.remove_stop_words(S.tokenize("product_description")))}, 0)
         AS searchAndDescriptionMD
FROM j""")
def features_7_lexical(spark, sf):
    """The word-match half of feature set 7 through the pipeline's token
    table: brand-only attribute text per product (missing -> no tokens),
    description bags."""
    fs = FE.FEATURE_SETS["7"]
    i = _inputs(spark, sf)
    tokens = FE.token_table(fs, i.pairs, i.descriptions, i.attributes)
    out = FE.lexical_features(fs, tokens)
    return out.select("id", _joined(FE.TOKEN_COLS["attributes"]).alias("attribute_tokens"),
                      *[c for c in out.columns if c not in ("id", FE.TOKEN_COLS["attributes"])])


def _vector_sql(name: str) -> str:
    """Set ``name`` with word vectors from ``embeddings``: tokens per pair, mean vector per distinct token list, features."""
    fs = FE.FEATURE_SETS[name]
    tok = (lambda e: f"string_split({e}, ' ')") if fs.tokenizer == "split_space" else S.tokenize
    none = "[]::VARCHAR[]"
    names = " OR ".join(f"contains(lower(name), '{n}')" for n in fs.attribute_names or ())
    attrs = ("SELECT product_uid, value AS txt FROM attributes WHERE name = 'MFG Brand Name'" if fs.attribute_source == "brand_rows" else
             f"SELECT product_uid, string_agg(value, ' ' ORDER BY name, value) AS txt FROM attributes WHERE {names} GROUP BY product_uid")
    missing = "['empty']" if fs.attribute_source == "brand_rows" else none
    described = tok("d.product_description")
    if fs.stop_words_on_description:
        described = S.remove_stop_words(described)
    vectors = fs.vector_inputs
    match = lambda k: f"coalesce({S.word_match('search', k)}, 0)"

    def feature(f):
        kind, left, right = FE.FEATURE_DEFS[f]
        if kind == "md":
            return f"{match(right)} AS {f}"
        if kind == "len":
            return f"len AS {f}"
        pair = f"{left}_v", f"{right}_v"
        return f"round(coalesce({(S.cosine if kind == 'cos' else S.euclidean)(*pair)}, 0.0), 6) AS {f}"
    joins = "\n".join(f"LEFT JOIN dv {k}_d ON {k}_d.toks = j.{k}" for k in vectors)
    zero = "list_transform(range(10), lambda i: 0.0::DOUBLE)"
    return fx.with_views("pairs", "descriptions", "attributes") + f""",
attrs AS ({attrs}),
j AS (SELECT p.id, {tok("p.search_term")} AS search, {tok("p.product_title")} AS title,
             coalesce({described}, {none}) AS description, coalesce({tok("a.txt")}, {missing}) AS attributes,
             {S.term_length("p.search_term")} AS len
      FROM pairs p LEFT JOIN descriptions d ON p.product_uid = d.product_uid LEFT JOIN attrs a ON p.product_uid = a.product_uid),
texts AS (SELECT DISTINCT toks FROM ({" UNION ALL ".join(f"SELECT {k} AS toks FROM j" for k in vectors)})),
occ AS (SELECT toks, unnest(toks) AS w FROM texts),
hashed AS (SELECT w, CAST(concat('0x', substr(md5(w), 1, 8)) AS BIGINT) AS h FROM (SELECT DISTINCT w FROM occ)),
wv AS (SELECT w, CAST(embedding[1:10] AS DOUBLE[]) AS v FROM hashed JOIN embeddings
       ON vec_id = h % (SELECT count(*) FROM embeddings) WHERE h % 7 <> 0),
dims AS (SELECT toks, i, sum(v[i]) / len(toks) AS x FROM occ JOIN wv USING (w), (SELECT unnest(range(1, 11)) AS i) GROUP BY toks, i),
dv AS (SELECT toks, list(x ORDER BY i) AS v FROM dims GROUP BY toks),
k AS (SELECT j.*, {", ".join(f"coalesce({k}_d.v, {zero}) AS {k}_v" for k in vectors)} FROM j {joins})
SELECT id, {", ".join(feature(f) for f in fs.features)} FROM k"""


def table_word_vectors(spark, sf, tokens: DataFrame) -> DataFrame:
    """(word, vector) for the distinct words of ``tokens`` (token arrays): the first 10 components of the embedding
    that the word's md5 picks; words whose hash divides by 7 have none and count as unknown."""
    vectors = table(spark, sf, "embeddings").select("vec_id", F.slice("embedding", 1, 10).cast("array<double>").alias("vector"))
    n = max(1, vectors.count())
    h = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("long")
    words = tokens.select(F.explode(tokens.columns[0]).alias("word")).distinct().withColumn("h", h).where("h % 7 <> 0")
    return words.join(vectors, F.col("h") % n == F.col("vec_id")).select("word", "vector")


def _vector_query(name: str):
    def q(spark, sf):
        fs = FE.FEATURE_SETS[name]
        i = _inputs(spark, sf)
        tt = FE.prepare(fs, i.pairs, i.descriptions, i.attributes)
        columns = [(tt.pairs if FE.TOKEN_COLS[k] in tt.pairs.columns else tt.products)
                   .select(F.col(FE.TOKEN_COLS[k]).alias("t")) for k in fs.vector_inputs]
        tokens = columns[0]
        for c in columns[1:]:
            tokens = tokens.unionByName(c)
        words = materialize(table_word_vectors(spark, sf, tokens), "words")
        out = FE.FittedFeatures(fs, {k: words for k in fs.vector_inputs}).transform(tt.pairs, products=tt.products)
        real = [f for f in fs.features if FE.FEATURE_DEFS[f][0] in ("cos", "ed")]
        return out.select("id", *[F.round(f, 6).alias(f) if f in real else f for f in fs.features])
    q.__doc__ = f"V2-V7/D6: feature set {name} over document vectors, with word vectors from the embeddings table."
    return q


for _n in ("3", "6", "7", "8"):
    query(f"features_vec_{_n}", _vector_sql(_n))(_vector_query(_n))


_STUMP_VIEW = fx.with_views("pairs") + f""",
t AS (SELECT id, product_uid, relevance AS y, {S.word_match(S.tokenize("search_term"), S.tokenize("product_title"))} AS md,
             {S.term_length("search_term")} AS len FROM pairs)"""


def _stump_sql(prefix: str, source: str, features) -> str:
    """CTE ``<prefix>``: best squared-error split of ``source`` over the features (f, v, left and right mean)."""
    per = " UNION ALL ".join(f"SELECT '{f}' AS f, {f} AS v, count(*) AS n, sum(y) AS s FROM {source} GROUP BY {f}" for f in features)
    return f"""{prefix}_c AS ({per}),
{prefix}_r AS (SELECT f, v, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(n) OVER (PARTITION BY f) AS nn, sum(s) OVER (PARTITION BY f) AS ss
  FROM {prefix}_c WINDOW w AS (PARTITION BY f ORDER BY v)),
{prefix} AS (SELECT f, v, s / n AS lo, (ss - s) / (nn - n) AS hi FROM {prefix}_r WHERE n < nn
  ORDER BY s * s / n + (ss - s) * (ss - s) / (nn - n) DESC LIMIT 1)"""


def _stump_value(prefix: str) -> str:
    return f"CASE WHEN (CASE {prefix}.f WHEN 'md' THEN md ELSE len END) <= {prefix}.v THEN {prefix}.lo ELSE {prefix}.hi END"


def _match_table(spark, sf) -> DataFrame:
    return materialize(fx.pairs(spark, sf).select(
        "id", "product_uid", "relevance", word_match(tokenize("search_term"), tokenize("product_title")).alias("md"),
        term_length("search_term").alias("len")), "match")


def _stump():
    """A forest of one tree with one split over all rows and features; as many bins as the features have values."""
    return M.random_forest(1, 1).setBootstrap(False).setFeatureSubsetStrategy("all").setMaxBins(256)


@query("stump_predict", _STUMP_VIEW + f""",
train AS (SELECT * FROM t WHERE product_uid % 10 < 7),
{_stump_sql("b", "train", ("md", "len"))}
SELECT id, round({_stump_value("b")}, 6) AS prediction FROM t, b WHERE product_uid % 10 >= 7""")
def stump_predict(spark, sf):
    """M1/M3/M8 with a result SQL can state: a one-split tree through the forest, pipeline and scoring operators."""
    train, test = M.split_by_key(_match_table(spark, sf))
    model = M.fit_pipeline(train, ["md", "len"], _stump())
    return M.score(model, test).select("id", F.round("prediction", 6).alias("prediction"))


@query("elastic_net_predict", _STUMP_VIEW + """,
m AS (SELECT count(*) AS n, avg(md) AS mx, avg(y) AS my, stddev_samp(md) AS sx, stddev_samp(y) AS sy, corr(md, y) AS r
      FROM t WHERE product_uid % 10 < 7),
b AS (SELECT *, sign(r) * greatest(abs(r) * (n - 1) / n - 0.1 / sy * 0.8, 0) / ((n - 1) / n + 0.1 / sy * 0.2) * sy / sx AS slope FROM m)
SELECT id, round(my + slope * (md - mx), 4) AS prediction FROM t, b WHERE product_uid % 10 >= 7""")
def elastic_net_predict(spark, sf):
    """M2/M3/M8: elastic net with one feature, whose solution is a soft threshold on standardised data."""
    train, test = M.split_by_key(_match_table(spark, sf))
    net = M.linear_regression(500, 0.1, 0.8).setTol(1e-12)
    return M.score(M.fit_pipeline(train, ["md"], net), test).select("id", F.round("prediction", 4).alias("prediction"))


@query("cv_stumps", _STUMP_VIEW + """,
train AS (SELECT * FROM t WHERE product_uid % 10 < 7), test AS (SELECT * FROM t WHERE product_uid % 10 >= 7),
f0 AS (SELECT * FROM train WHERE id % 2 = 0), f1 AS (SELECT * FROM train WHERE id % 2 = 1),
""" + ",\n".join(_stump_sql(f"{f}{k}", source, (f,)) for f in ("md", "len") for k, source in (("a", "f1"), ("b", "f0"), ("c", "train"))) + """,
cv AS (""" + " UNION ALL ".join(f"""
  SELECT '{f}' AS features, ((SELECT sqrt(avg(pow(y - ({_stump_value(f + 'a')}), 2))) FROM f0, {f}a)
                           + (SELECT sqrt(avg(pow(y - ({_stump_value(f + 'b')}), 2))) FROM f1, {f}b)) / 2 AS cv_rmse,
         (SELECT sqrt(avg(pow(y - ({_stump_value(f + 'c')}), 2))) FROM test, {f}c) AS holdout""" for f in ("md", "len")) + """)
SELECT features, round(cv_rmse, 6) AS cv_rmse,
       CASE WHEN cv_rmse = (SELECT min(cv_rmse) FROM cv) THEN round(holdout, 6) END AS holdout_rmse FROM cv""")
def cv_stumps(spark, sf):
    """M5-M7: a grid of two feature lists in 2-fold cross-validation, average metrics, and the hold-out RMSE of the best."""
    train, test = M.split_by_key(_match_table(spark, sf))
    model = M.cross_validate(train.withColumn("fold", (F.col("id") % 2).cast("int")), depths=(1,), trees=(1,),
                             feature_lists=(("md",), ("len",)), estimator=_stump(), fold_col="fold")
    asm = model.getEstimator().getStages()[0]
    best = min(model.avgMetrics)
    rmse = EV.rmse(model.transform(test))
    rows = [(pm[asm.inputCols][0], round(float(m), 6), round(float(rmse), 6) if m == best else None)
            for pm, m in zip(model.getEstimatorParamMaps(), model.avgMetrics)]
    return spark.createDataFrame(rows, "features string, cv_rmse double, holdout_rmse double")


@query("rf_predict")
def rf_predict(spark, sf):
    """M1/M3/M8: 7-feature random forest, 20 trees x depth 5, fitted on the
    70 % of products, scoring the other 30 %."""
    tr, te = PL.split_inputs(_inputs(spark, sf))
    return PL.train_and_score(tr, te, "7", M.random_forest(20, 5)) \
        .predictions.select("id", "prediction")


@query("rf_predict_8")
def rf_predict_8(spark, sf):
    """M1: 8-feature random forest, 200 trees x depth 10."""
    tr, te = PL.split_inputs(_inputs(spark, sf))
    return PL.train_and_score(tr, te, "8", M.random_forest(200, 10)) \
        .predictions.select("id", "prediction")


@query("lr_predict")
def lr_predict(spark, sf):
    """M2: 7-feature elastic-net linear regression (maxIter 100, regParam
    0.3, elasticNetParam 0.8)."""
    tr, te = PL.split_inputs(_inputs(spark, sf))
    return PL.train_and_score(tr, te, "7", M.linear_regression()) \
        .predictions.select("id", "prediction")


@query("cv_tune")
def cv_tune(spark, sf):
    """M4-M7/V8: 12-map grid (depth {5,10} x trees {40,100,200} x two
    feature lists), 2-fold CV on 70 % of the pairs, best model scores the
    other 30 %."""
    t = PL.tune(_inputs(spark, sf))
    return t.predictions.select("id", "relevance", "prediction")


from . import words  # noqa: E402,F401 -- registers its queries here


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
