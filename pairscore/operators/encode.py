"""Hash keys for token arrays and words, so that joins and aggregates carry numbers and not texts.

A text (token array) is keyed by 128 bits of hash and its length, a word by 128 bits of hash. Both are computed in the
projection; no pass over the vocabulary assigns them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_key(tokens: Column) -> Column:
    """struct(a, b, n): equal for equal token arrays; NULL counts as an empty array."""
    t = F.coalesce(tokens, F.array().cast("array<string>"))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"), F.size(t).alias("n"))


def word_key(word: Column) -> Column:
    """struct(a, b): equal for equal words."""
    return F.struct(F.xxhash64(word).alias("a"), F.xxhash64(F.lit(1), word).alias("b"))
