"""Rewriting of tokens by a map over the vocabulary: stems, corrections, synonyms.

A map has one row for each word that changes, (word, words): the tokens that stand in its place. It is worked out once per
distinct word and applied to every text by a join, before bags and vectors are built. Texts are keyed by hash
(``operators.encode``), so equal texts are rewritten once and no join carries a token array; frequent words, and texts that
many rows share, are split over salt buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import skew, spelling, stemming
from .encode import text_key


def words_of(*columns: tuple[DataFrame, str]) -> DataFrame:
    """(word): the distinct tokens of the given (frame, token column) pairs."""
    out = None
    for df, c in columns:
        part = df.select(F.explode(c).alias("word"))
        out = part if out is None else out.unionByName(part)
    return out.where(F.col("word").isNotNull()).distinct()


def stem_map(words: DataFrame) -> DataFrame:
    """(word, words) for the words that stemming changes. The stems are written first: a filter on them would otherwise be
    pushed below the stemmer's long expressions, which multiplies them."""
    stems = materialize(stemming.stem_vocabulary(words), "stems")
    return stems.where("stem <> word").select("word", F.array("stem").alias("words"))


def correction_map(words: DataFrame, vocabulary: DataFrame, max_distance: int = 2) -> DataFrame:
    """(word, words) for the words that are not in ``vocabulary`` (word, freq) and have a correction there."""
    fixes = spelling.corrections(words, vocabulary, max_distance)
    return fixes.where("correction is not null").select("word", F.array("correction").alias("words"))


def then(first: DataFrame, second: DataFrame) -> DataFrame:
    """The map that applies ``first`` and then ``second`` to what came out."""
    parts = first.select("word", F.posexplode("words").alias("pos", "mid"))
    onward = second.select(F.col("word").alias("mid"), F.col("words").alias("next"))
    both = (parts.join(onward, "mid", "left").select("word", "pos", F.coalesce("next", F.array("mid")).alias("w"))
            .groupBy("word").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "w"))), lambda s: s["w"])).alias("words")))
    return both.unionByName(second.join(first.select("word"), "word", "left_anti"))


def rewrite(df: DataFrame, tokens: str, change: DataFrame, out: str | None = None, salt_by: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the token array ``tokens`` rewritten (into ``out``) by ``change`` (word, words): each token of the map is
    replaced by its words, in place; others stay. NULL arrays stay NULL and empty ones empty."""
    out = out or tokens
    keyed = df.withColumn("_text", text_key(F.col(tokens)))
    # one row for each place of each distinct text
    places = (keyed.select("_text", F.posexplode(tokens).alias("pos", "word")).groupBy("_text", "pos").agg(F.first("word").alias("word")))
    places = materialize(places, "places")
    changed = skew.split_left_join(places, change.select("word", "words"), "word", ["_text", "pos"])
    texts = changed.groupBy("_text").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("words", F.array("word")).alias("w")))), lambda s: s["w"])).alias("_new"))
    back = skew.split_left_join(keyed, texts, "_text", salt_by)
    return back.withColumn(out, F.when(F.col(tokens).isNotNull(), F.coalesce("_new", tokens))).drop("_text", "_new")
