"""Synonyms from word vectors: nearest neighbours by cosine over the whole vocabulary.

Words with equal vectors are one group. Each group gets ``bands`` codes of ``bits`` signs: the signs of its vector's products
with fixed planes of +1 and -1. Groups that share a code in some band are compared exactly; so two groups at an angle t
meet with probability 1 - (1 - p^bits)^bands, p = 1 - t / pi. ``bits`` follows the number of words, so that a code holds
about ``PER_CODE`` of them by chance, and ``bands`` is the least number that finds a pair at ``min_similarity`` with
probability ``RECALL``; closer pairs are found more often. What meets is compared and ranked without a cap; codes that very
many groups share are split over salt buckets.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cosine
from ..session import materialize
from . import rewrite, skew

PER_CODE = 16
RECALL = 0.98
MOST_BITS = 20


def shape(n_words: int, min_similarity: float) -> tuple[int, int]:
    """(bits, bands) for a vocabulary of ``n_words``."""
    bits = min(MOST_BITS, max(4, math.ceil(math.log2(max(1, n_words) / PER_CODE))))
    together = (1 - math.acos(min_similarity) / math.pi) ** bits
    return bits, 1 if together >= 1 else math.ceil(math.log(1 - RECALL) / math.log(1 - together))


def plane_sign(plane: int, component: int) -> int:
    """+1 or -1, from the first digit of an md5."""
    return 1 if hashlib.md5(f"{plane}:{component}".encode()).hexdigest()[0] < "8" else -1


def codes(vector: Column, size: int, bits: int, bands: int) -> Column:
    """array<bigint>: a code of ``bits`` signs for each band."""
    planes = F.from_json(F.lit(json.dumps([[plane_sign(j, i) for i in range(size)] for j in range(bits * bands)])), "array<array<int>>")

    def sign(j):
        product = F.aggregate(F.zip_with(F.element_at(planes, j + 1), vector, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        return F.when(product > 0, 1).otherwise(0)
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda band: F.aggregate(
        F.sequence(F.lit(0), F.lit(bits - 1)), F.lit(0).cast("bigint"), lambda code, t: code * 2 + sign(band * bits + t)))


def synonyms(words: DataFrame, k: int = 3, min_similarity: float = 0.8) -> DataFrame:
    """(word, rank, synonym, similarity): for each word of ``words`` (word, vector) up to ``k`` other words at a cosine of
    ``min_similarity`` or more, nearest first; similarities are rounded to 6 places and ties go to the first word in
    alphabetical order. NULL words, and vectors that are NULL, zero or of another length than most, have no synonyms. Of
    rows that repeat a word the smallest vector counts."""
    words = words.where(F.col("word").isNotNull() & F.exists("vector", lambda x: x != 0))
    words = words.groupBy("word").agg(F.min("vector").alias("vector"))
    words = materialize(words.withColumn("_group", F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), "vector").alias("b"))), "words")
    common = words.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return words.select("word", F.lit(0).alias("rank"), F.col("word").alias("synonym"), F.lit(0.0).alias("similarity")).limit(0)
    words = words.where(F.size("vector") == common["size"])
    groups = materialize(words.groupBy("_group").agg(F.first("vector").alias("vector")), "groups")
    bits, bands = shape(common["n"], min_similarity)
    coded = materialize(groups.select("_group", F.posexplode(codes(F.col("vector"), common["size"], bits, bands)).alias("band", "code"))
                        .select("_group", F.struct("band", "code").alias("at")), "codes")
    other = coded.select(F.col("_group").alias("_other"), "at")
    met = (skew.split_left_join(coded, other, "at", ["_group"], how="inner").where("_group < _other").select("_group", "_other").distinct())
    near = groups.select(F.col("_group").alias("_other"), F.col("vector").alias("w"))
    close = (met.join(groups, "_group").join(near, "_other")
             .select("_group", "_other", F.round(cosine("vector", "w"), 6).alias("similarity"), cosine("vector", "w").alias("exact"))
             .where(F.col("exact") >= min_similarity).select("_group", "_other", "similarity"))
    both = close.unionByName(close.select(F.col("_other").alias("_group"), F.col("_group").alias("_other"), "similarity"))
    both = materialize(both.unionByName(groups.select("_group", F.col("_group").alias("_other"), F.lit(1.0).alias("similarity"))), "close")
    # of each group its first k + 1 words can be among the k best of any word
    first = Window.partitionBy("_group").orderBy("word")
    heads = (words.select("_group", "word").withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
             .select(F.col("_group").alias("_other"), F.col("word").alias("synonym")))
    order = Window.partitionBy("_group").orderBy(F.desc("similarity"), "synonym")
    best = (both.join(heads, "_other").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
            .groupBy("_group").agg(F.array_sort(F.collect_list(F.struct("n", "synonym", "similarity"))).alias("best")))
    found = skew.split_left_join(words.select("word", "_group"), best, "_group", ["word"], how="inner")
    own = F.slice(F.filter("best", lambda b: b["synonym"] != F.col("word")), 1, k)
    return (found.select("word", F.posexplode(own).alias("at", "s"))
            .select("word", (F.col("at") + 1).alias("rank"), "s.synonym", "s.similarity"))


def expand(df: DataFrame, tokens: str, found: DataFrame, out: str, salt_by=None) -> DataFrame:
    """``df`` with ``out``: each token of ``tokens`` followed by its synonyms (``synonyms``) in order, each word once."""
    change = found.groupBy("word").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "synonym"))), lambda s: s["synonym"]).alias("s"))
    change = change.select("word", F.concat(F.array("word"), "s").alias("words"))
    wide = rewrite.rewrite(df, tokens, change, out, salt_by)
    return wide.withColumn(out, F.array_distinct(out))
