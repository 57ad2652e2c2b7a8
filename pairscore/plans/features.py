"""Feature sets for (search term, product) pairs.

The sets, as the relevance pipeline evolved:

  "3": cosines of the search-term vector with title, description and
       attribute vectors; literal-space tokens; attribute text of brand,
       color and material rows.
  "6": "3" plus the three Euclidean distances.
  "7": Tokenizer tokens, stop words removed from descriptions, brand-only
       attribute text; Euclid, cosine and word-match features.
  "8": "7" with the brand taken from the ``MFG Brand Name`` rows (join
       multiplicity kept, missing -> ``empty``), without the description
       cosine, plus the search-term length.
  "8s", "8cs": "8" on stems, and on corrected search words and stems: a map
       over the vocabulary rewrites every token before bags and vectors.

Plan shape (what runs where):

* Product-side work is done once per product, before any pair sees it: the
  description is tokenised, stop words removed and reduced to a bag of
  distinct tokens; the attribute text is built and tokenised.
* Pairs are left-joined to the product tables on ``product_uid`` by shuffles
  and sort-merge: their arrays are larger than the planner believes, and a
  broadcast would pass them through the driver.
  Products holding a large share of the pairs are split over salt buckets
  (``operators.skew``); the pairs are salted once and both joins run on
  (product, bucket).
* The word-match and length features are computed on the joined table,
  which is then written once to the shared checkpoint folder without the
  description bags; the Word2Vec fits (one per column) and the feature
  projection read it back column-pruned. Description vectors (sets 3, 6)
  are computed per product and joined.
* Every feature is a native expression (``functions``); nothing runs in a
  Python worker.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (euclidean, remove_stop_words, split_space, term_length,
                         tokenize, word_match, word_match_bag)
from ..functions.vectors import cosine_of, dot
from ..operators import catalog, rewrite, skew, spelling
from ..operators.embed import W2VParams, attach_means, document_vectors, fit_word2vec, text_means, word_vectors
from ..operators.encode import text_key
from ..session import materialize



def _empty_tokens():
    return F.array().cast("array<string>")


def _empty_bag():
    return F.array().cast("array<struct<t:string,n:int>>")


# The names users see. feature column -> (kind, left, right); cos/ed over vectors, md over tokens
FEATURE_DEFS = {
    "searchAndTitle": ("cos", "search", "title"),
    "searchAndDescription": ("cos", "search", "description"),
    "searchAndAttributes": ("cos", "search", "attributes"),
    "searchAndTitleED": ("ed", "search", "title"),
    "searchAndDescriptionED": ("ed", "search", "description"),
    "searchAndAttributesED": ("ed", "search", "attributes"),
    "searchAndTitleMD": ("md", "search", "title"),
    "searchAndAttributesMD": ("md", "search", "attributes"),
    "searchAndDescriptionMD": ("md", "search", "description"),
    "search_term_length": ("len", "search", None),
}

# Feature lists and their order, per feature set.
FEATURES_3 = ("searchAndTitle", "searchAndDescription", "searchAndAttributes")
FEATURES_6 = FEATURES_3 + ("searchAndTitleED", "searchAndDescriptionED", "searchAndAttributesED")
FEATURES_7 = ("searchAndTitleED", "searchAndTitleMD", "searchAndAttributesED", "searchAndTitle",
              "searchAndAttributes", "searchAndAttributesMD", "searchAndDescriptionMD")
FEATURES_8 = ("searchAndTitleMD", "searchAndAttributesMD", "searchAndDescriptionMD",
              "search_term_length", "searchAndTitleED", "searchAndAttributesED",
              "searchAndTitle", "searchAndAttributes")
# the two alternative inputs of the tuning grid
CV_FEATURES_1 = ("searchAndTitleMD", "searchAndAttributesMD", "searchAndDescriptionMD",
                 "search_term_length")
CV_FEATURES_2 = ("searchAndTitleMD", "searchAndTitleED", "searchAndAttributesED",
                 "searchAndTitle", "searchAndAttributes")

# Token column names.
TOKEN_COLS = {"search": "search_term_", "title": "product_title_",
              "description": "product_description_", "attributes": "product_attributes_"}
VECTOR_COLS = {k: f"{k}_vec" for k in TOKEN_COLS}


@dataclass(frozen=True)
class FeatureSet:
    name: str
    features: tuple[str, ...]
    tokenizer: str = "tokenize"               # "tokenize" | "split_space"
    stop_words_on_description: bool = True
    attribute_source: str = "brand_rows"      # "brand_rows" | "text"
    attribute_names: tuple[str, ...] | None = None
    dedupe_brand: bool = False
    missing_token: str | None = None          # None: missing text -> no tokens
    split_hot_products: bool = True           # salt products with a large share of pairs
    shared_space: bool = False                # one embedding over all columns instead of one per column
    rewrite: tuple[str, ...] = ()             # steps over the vocabulary, in order: "correct" | "stem"
    w2v: W2VParams = field(default_factory=W2VParams)

    @property
    def vector_inputs(self) -> tuple[str, ...]:
        used = {FEATURE_DEFS[f][i] for f in self.features if FEATURE_DEFS[f][0] in ("cos", "ed")
                for i in (1, 2)}
        return tuple(k for k in TOKEN_COLS if k in used)

    @property
    def needs_description_bag(self) -> bool:
        return "searchAndDescriptionMD" in self.features


FEATURE_SETS = {
    "3": FeatureSet("3", FEATURES_3, tokenizer="split_space", stop_words_on_description=False,
                    attribute_source="text", attribute_names=("brand", "color", "material")),
    "6": FeatureSet("6", FEATURES_6, tokenizer="split_space", stop_words_on_description=False,
                    attribute_source="text", attribute_names=("brand", "color", "material")),
    "7": FeatureSet("7", FEATURES_7, attribute_source="text", attribute_names=("brand",)),
    "8": FeatureSet("8", FEATURES_8),
    "8s": FeatureSet("8s", FEATURES_8, rewrite=("stem",)),
    "8cs": FeatureSet("8cs", FEATURES_8, rewrite=("correct", "stem")),
}


def feature_set(name: str, **overrides) -> FeatureSet:
    fs = FEATURE_SETS[name]
    return replace(fs, **overrides) if overrides else fs


def _tok(fs: FeatureSet, c):
    return split_space(c) if fs.tokenizer == "split_space" else tokenize(c)


def _description_tokens(fs: FeatureSet):
    d_tok = _tok(fs, "product_description")
    return remove_stop_words(d_tok) if fs.stop_words_on_description else d_tok


def _missing_description(fs: FeatureSet):
    return (_tok(fs, F.lit(fs.missing_token)) if fs.missing_token is not None
            else _empty_tokens())


def _missing_bag(fs: FeatureSet):
    if fs.missing_token is None:
        return _empty_bag()
    return F.transform(_missing_description(fs), lambda t: F.struct(F.lower(t).alias("t"), F.lit(1).alias("n")))


def one_description(descriptions: DataFrame) -> DataFrame:
    """One row per product: of several descriptions the smallest text counts, for every feature alike."""
    return descriptions.groupBy("product_uid").agg(F.min("product_description").alias("product_description"))


def word_changes(fs: FeatureSet, pairs: DataFrame, descriptions: DataFrame, attributes: DataFrame) -> DataFrame | None:
    """The map (word, words) of ``fs.rewrite`` over the vocabulary of all four texts, or None without steps. Corrections are
    towards the words of the titles; each step works on what the one before it leaves."""
    if not fs.rewrite:
        return None
    desc, attrs = product_tables(replace(fs, features=FEATURES_3, rewrite=()), descriptions, attributes)
    tokens = pairs.select(_tok(fs, "search_term").alias("s"), _tok(fs, "product_title").alias("t"))
    columns = [(tokens, "s"), (tokens, "t"), (desc, TOKEN_COLS["description"]), (attrs, TOKEN_COLS["attributes"])]
    words = materialize(rewrite.words_of(*columns), "vocabulary")
    change = None
    for step in fs.rewrite:
        if step == "stem":
            made = rewrite.stem_map(words)
        elif step == "correct":
            titles = pairs.select("product_uid", "product_title").distinct().select(_tok(fs, "product_title").alias("t"))
            asked = rewrite.words_of((tokens, "s"))
            made = rewrite.correction_map(asked, spelling.vocabulary(titles, "t"))
        else:
            raise ValueError(f"no such step: {step}")
        change = made if change is None else rewrite.then(change, made)
    return materialize(change, "changes")


def _rewritten(df: DataFrame, column: str, change: DataFrame | None, salt_by=None) -> DataFrame:
    return df if change is None else rewrite.rewrite(df, column, change, salt_by=salt_by)


def product_tables(fs: FeatureSet, descriptions: DataFrame, attributes: DataFrame,
                   description_tokens: bool = True, change: DataFrame | None = None):
    """Per-product inputs: description side (tokens when a vector feature
    uses them and ``description_tokens``; the token bag when a word-match
    feature does; None when neither) and (product_uid, attribute tokens) --
    the latter may hold several rows per product for brand rows."""
    desc = one_description(descriptions).select("product_uid",
                               _description_tokens(fs).alias(TOKEN_COLS["description"]))
    desc = _rewritten(desc, TOKEN_COLS["description"], change)
    want_tokens = description_tokens and "description" in fs.vector_inputs
    if fs.needs_description_bag:
        bags = catalog.token_bags(desc, "product_uid", TOKEN_COLS["description"], "desc_bag")
        desc = desc.join(bags, "product_uid", "left") if want_tokens else bags
    elif not want_tokens:
        desc = None
    attrs = catalog.clean_attributes(attributes)
    if fs.attribute_source == "brand_rows":
        a = catalog.brand_rows(attrs)
        if fs.dedupe_brand:
            a = a.groupBy("product_uid").agg(F.min("product_attributes").alias("product_attributes"))
    else:
        a = catalog.attribute_text(attrs, list(fs.attribute_names or ()) or None)
    a = a.select("product_uid", _tok(fs, "product_attributes").alias(TOKEN_COLS["attributes"]))
    return desc, _rewritten(a, TOKEN_COLS["attributes"], change)


def token_table(fs: FeatureSet, pairs: DataFrame, descriptions: DataFrame,
                attributes: DataFrame, description_tokens: bool = True, change: DataFrame | None = None) -> DataFrame:
    """Pairs joined to their product tokens; one row per pair (per brand row
    for feature set "8", where a product's brand rows multiply its pairs).
    ``description_tokens=False`` leaves each pair's copy of the description
    tokens out (``description_table`` provides them per product)."""
    if change is None:
        change = word_changes(fs, pairs, descriptions, attributes)
    desc, attrs = product_tables(fs, descriptions, attributes, description_tokens, change)
    keep = [c for c in ("id", "product_uid", "relevance") if c in pairs.columns]
    p = pairs.select(*keep,
                     _tok(fs, "search_term").alias(TOKEN_COLS["search"]),
                     _tok(fs, "product_title").alias(TOKEN_COLS["title"]),
                     term_length("search_term").alias("search_term_length"))
    if change is not None:
        for k in ("search", "title"):
            p = _rewritten(p, TOKEN_COLS[k], change, ["id"] if "id" in pairs.columns else None)
        p = materialize(p, "rewritten")
    # salt once; both joins are then on (product_uid, _salt), and the second
    # reuses the first one's partitioning
    hot = skew.hot_keys(pairs, "product_uid") if fs.split_hot_products else None
    if hot is not None:
        p = skew.salt(p, "product_uid", hot, ["id"] if "id" in p.columns else None)
    j = skew.left_join(p, desc, "product_uid", hot, shuffled=True) if desc is not None else p
    j = skew.left_join(j, attrs, "product_uid", hot, shuffled=True)
    if hot is not None:
        j = j.drop(skew.SALT)
    if fs.attribute_source == "brand_rows":
        missing_attr = F.array(F.lit(catalog.EMPTY_BRAND))
    elif fs.missing_token is not None:
        missing_attr = _tok(fs, F.lit(fs.missing_token))
    else:
        missing_attr = _empty_tokens()
    missing_desc = _missing_description(fs)
    out = j.withColumn(TOKEN_COLS["attributes"],
                       F.coalesce(F.col(TOKEN_COLS["attributes"]), missing_attr))
    if TOKEN_COLS["description"] in out.columns:
        out = out.withColumn(TOKEN_COLS["description"],
                             F.coalesce(F.col(TOKEN_COLS["description"]), missing_desc))
    if "desc_bag" in out.columns:
        out = out.withColumn("desc_bag", F.coalesce(F.col("desc_bag"), _missing_bag(fs)))
    return out


def description_table(fs: FeatureSet, pairs: DataFrame, descriptions: DataFrame, change: DataFrame | None = None) -> DataFrame:
    """(product_uid, description tokens): one row per product of ``pairs``
    (missing description -> the missing-text tokens). Document vectors of
    the description are computed on this table, once per product, and only
    the vector is joined to the pairs."""
    products = pairs.select("product_uid").distinct()
    desc = one_description(descriptions).select(F.col("product_uid").alias("_uid"),
                               _description_tokens(fs).alias(TOKEN_COLS["description"]))
    col = TOKEN_COLS["description"]
    desc = _rewritten(desc, col, change)
    return (products.join(desc, products["product_uid"].eqNullSafe(desc["_uid"]), "left")
                    .select("product_uid",
                            F.coalesce(F.col(col), _missing_description(fs)).alias(col)))


@dataclass
class TokenTables:
    """Pair-level tokens (with the embedding-free features) and, when a
    description vector is used, the per-product description tokens."""
    pairs: DataFrame
    products: DataFrame | None = None


def prepare(fs: FeatureSet, pairs: DataFrame, descriptions: DataFrame, attributes: DataFrame,
            checkpoint: bool = True) -> TokenTables:
    change = word_changes(fs, pairs, descriptions, attributes)
    tokens = with_lexical(fs, token_table(fs, pairs, descriptions, attributes,
                                          description_tokens=False, change=change))
    products = (description_table(fs, pairs, descriptions, change)
                if "description" in fs.vector_inputs else None)
    if checkpoint:
        tokens = materialize(tokens, f"tokens{fs.name}")
        if products is not None:
            products = materialize(products, f"desc{fs.name}")
    return TokenTables(tokens, products)


def _by_product(tokens: DataFrame, per_product: DataFrame, how: str = "left") -> DataFrame:
    """Attach per-product columns to pair rows (NULL-safe on the key); products with a large share of the pairs
    are split over salt buckets."""
    key = F.coalesce(F.col("product_uid").cast("string"), F.lit("null")).alias("_key")
    r = per_product.select(key, *[c for c in per_product.columns if c != "product_uid"])
    left = tokens.select(*tokens.columns, key)
    hot = skew.hot_keys(left, "_key")
    if hot is not None:
        left = skew.salt(left, "_key", hot, ["id"] if "id" in tokens.columns else None)
    return skew.left_join(left, r, "_key", hot, how, shuffled=True).drop("_key", skew.SALT)


def _square(k: str) -> str:
    return f"{VECTOR_COLS[k]}_square"


def _with_square(vectors: DataFrame, k: str, size: int) -> DataFrame:
    return vectors.withColumn(_square(k), dot(VECTOR_COLS[k], VECTOR_COLS[k], size))


def _feature_column(name: str, has_bag: bool, size: int | None = None):
    kind, left, right = FEATURE_DEFS[name]
    if kind == "cos":
        # sums of squares come with the vectors
        return F.coalesce(cosine_of(dot(VECTOR_COLS[left], VECTOR_COLS[right], size), _square(left), _square(right)), F.lit(0.0))
    if kind == "ed":
        return F.coalesce(euclidean(VECTOR_COLS[left], VECTOR_COLS[right], size), F.lit(0.0))
    if kind == "md":
        if right == "description" and has_bag:
            return F.coalesce(word_match_bag(TOKEN_COLS[left], "desc_bag"), F.lit(0))
        return F.coalesce(word_match(TOKEN_COLS[left], TOKEN_COLS[right]), F.lit(0))
    return F.coalesce(F.col("search_term_length"), F.lit(0))


def lexical_features(fs: FeatureSet, tokens: DataFrame) -> DataFrame:
    """The features of ``fs`` that need no embedding (word match, term
    length) straight from a token table: id, attribute tokens, features."""
    names = [f for f in fs.features if FEATURE_DEFS[f][0] in ("md", "len")]
    has_bag = "desc_bag" in tokens.columns
    return tokens.select("id", TOKEN_COLS["attributes"],
                         *[_feature_column(f, has_bag).alias(f) for f in names])


def with_lexical(fs: FeatureSet, tokens: DataFrame) -> DataFrame:
    """Compute the embedding-free features on the token table and drop the
    inputs nothing else needs: the per-pair copy of the description bag,
    the description tokens unless a vector feature uses them, and the
    search-term length unless it is a feature of the set. What is
    materialised afterwards is then a few token arrays and numbers per pair,
    not each pair's copy of its product's description."""
    names = [f for f in fs.features if FEATURE_DEFS[f][0] in ("md", "len")]
    has_bag = "desc_bag" in tokens.columns
    out = tokens.withColumns({f: _feature_column(f, has_bag) for f in names})
    drop = ["desc_bag"]
    if "description" not in fs.vector_inputs:
        drop.append(TOKEN_COLS["description"])
    if "search_term_length" not in fs.features:
        drop.append("search_term_length")
    return out.drop(*[c for c in drop if c in out.columns])


@dataclass
class FittedFeatures:
    """Word vectors (word, vector) fitted on the training token table, by column."""
    feature_set: FeatureSet
    models: dict[str, DataFrame]

    def transform(self, tokens: DataFrame, refit: bool = False,
                  products: DataFrame | None = None) -> DataFrame:
        """Feature columns for a token table. ``refit`` fits fresh Word2Vec
        models on ``tokens`` itself (scoring as the original scripts did; the
        vectors then live in a different space than the training ones).
        Without per-pair description tokens, the description vectors are
        computed on ``products`` (``description_table``) and joined."""
        fs = self.feature_set
        models = fit_vectors(fs, tokens, products) if refit else self.models
        size, has_bag = fs.w2v.vector_size, "desc_bag" in tokens.columns
        # features already computed on the token table (with_lexical) are reused; then keys take the place of the
        # texts, so that the joins below move no token array
        out = tokens.withColumns({f: _feature_column(f, has_bag) for f in fs.features
                                  if FEATURE_DEFS[f][0] in ("md", "len") and f not in tokens.columns})
        per_pair = [k for k in fs.vector_inputs if TOKEN_COLS[k] in tokens.columns]
        keys = {k: f"_{k}_text" for k in per_pair}
        out = out.withColumns({keys[k]: text_key(F.col(TOKEN_COLS[k])) for k in per_pair})
        out = out.drop("desc_bag", *TOKEN_COLS.values())
        for k in fs.vector_inputs:
            if k not in keys:
                if products is None:
                    raise ValueError(f"no {TOKEN_COLS[k]} tokens and no per-product table")
                vec = document_vectors(products, TOKEN_COLS[k], models[k], size, VECTOR_COLS[k])
                out = _by_product(out, _with_square(vec.select("product_uid", VECTOR_COLS[k]), k, size))
        # every column's means come from the token table itself, not from what the columns before it were joined to
        for k in per_pair:
            texts = tokens.select(TOKEN_COLS[k], text_key(F.col(TOKEN_COLS[k])).alias(keys[k]))
            means = text_means(texts, TOKEN_COLS[k], keys[k], models[k], size, VECTOR_COLS[k])
            out = attach_means(out, _with_square(means, k, size), keys[k], size, VECTOR_COLS[k])
            out = out.withColumn(_square(k), F.coalesce(_square(k), F.lit(0.0)))
        feats = [(F.col(f) if f in out.columns else _feature_column(f, False, size)).alias(f) for f in fs.features]
        keep = [c for c in ("id", "product_uid", "relevance") if c in out.columns]
        return out.select(*keep, *feats)


def fit_vectors(fs: FeatureSet, tokens: DataFrame,
                products: DataFrame | None = None) -> dict[str, DataFrame]:
    """Word vectors per vector input, each trained on that column of the pair
    table (one sentence per pair), or with ``shared_space`` all trained
    together, so that the two sides of a cosine share a space. A column held
    per product is expanded to the pairs by a join inside the fit's input,
    not stored."""
    models, together = {}, None
    rows = tokens.count()   # every column has one sentence per row
    for k in fs.vector_inputs:
        src = tokens
        if TOKEN_COLS[k] not in tokens.columns:
            src = _by_product(tokens.select("product_uid"), products)
        if fs.shared_space:
            sentences = src.select(F.col(TOKEN_COLS[k]).alias("_sentence"))
            together = sentences if together is None else together.unionByName(sentences)
        else:
            models[k] = word_vectors(fit_word2vec(src, TOKEN_COLS[k], VECTOR_COLS[k], fs.w2v, rows))
    if together is not None:
        shared = word_vectors(fit_word2vec(together, "_sentence", "_vector", fs.w2v, rows * len(fs.vector_inputs)))
        models = {k: shared for k in fs.vector_inputs}
    return models


def fit_features(fs: FeatureSet, train_tokens: DataFrame,
                 products: DataFrame | None = None) -> FittedFeatures:
    return FittedFeatures(fs, fit_vectors(fs, train_tokens, products))


def build(fs: FeatureSet | str, pairs: DataFrame, descriptions: DataFrame,
          attributes: DataFrame, fitted: FittedFeatures | None = None,
          checkpoint: bool = True) -> tuple[DataFrame, FittedFeatures]:
    """Token table -> (optionally) fit Word2Vec -> feature table.

    Returns the feature table (id, product_uid, [relevance], features...) and
    the fitted vectors, to reuse on a scoring set."""
    fs = FEATURE_SETS[fs] if isinstance(fs, str) else fs
    tt = prepare(fs, pairs, descriptions, attributes, checkpoint)
    fitted = fitted or fit_features(fs, tt.pairs, tt.products)
    return fitted.transform(tt.pairs, products=tt.products), fitted


def assembler(features, output_col: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output_col)


def assemble(df: DataFrame, features, output_col: str = "features") -> DataFrame:
    return assembler(features, output_col).transform(df)
