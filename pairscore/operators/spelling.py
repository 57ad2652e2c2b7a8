"""Typo correction of search words against the catalogue vocabulary.

A search word that is not in the vocabulary is replaced by the vocabulary
word at the smallest edit distance, up to ``max_distance``; ties go to the
more frequent word, then to the alphabetically first.

Candidates are found exactly without comparing every search word with every
vocabulary word, by the pigeonhole principle: cut a vocabulary word of
length ``l`` into ``k + 1`` fixed segments. At most ``k`` edits touch at most
``k`` segments, so a word within distance ``k`` contains one segment
unchanged, shifted by at most ``k`` positions (each shift needs an insertion
or deletion before it). The vocabulary is therefore keyed by (length,
segment number, segment text) -- ``k + 1`` rows per word -- and each search
word probes, for every length within ``k`` of its own, every segment at
every shift up to ``k`` -- at most ``(2k+1)^2 (k+1)`` keys, whatever the word
length. The equi-join on these keys yields a superset of the true matches,
each verified with the real ``levenshtein`` (bounded by ``k``). No pair of
words further than ``k`` apart can be missed and no cross product is formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import skew


def _segment(length: Column, k: int, i) -> tuple[Column, Column]:
    """(0-based start, length) of segment ``i`` (int or Column) of ``k + 1``
    for a word of ``length``: the first segments get ``length div (k+1)``
    characters, the last ``length mod (k+1)`` get one more."""
    n = k + 1
    i = F.lit(i) if isinstance(i, int) else i
    base = F.floor(length / n).cast("int")
    longer_from = n - F.pmod(length, F.lit(n))
    start = base * i + F.greatest(F.lit(0), i - longer_from)
    seg_len = base + F.when(i >= longer_from, 1).otherwise(0)
    return start, seg_len


def segment_keys(word, k: int = 2) -> Column:
    """array<struct<l, i, seg>>: the ``k + 1`` segments of the word."""
    w = F.col(word) if isinstance(word, str) else word
    length = F.length(w)
    out = []
    for i in range(k + 1):
        start, seg_len = _segment(length, k, i)
        out.append(F.struct(length.alias("l"), F.lit(i).alias("i"),
                            F.substr(w, start + 1, seg_len).alias("seg")))
    return F.array(*out)


def probe_keys(word, k: int = 2) -> Column:
    """array<struct<l, i, seg>>: every (length, segment, substring) under
    which a vocabulary word within distance ``k`` is indexed. Written as
    nested higher-order functions over (length offset, segment, shift), so
    the expression stays small whatever ``k``."""
    w = F.col(word) if isinstance(word, str) else word
    lr = F.length(w)

    def per_length(dl):
        length = lr + dl

        def per_segment(i):
            start, seg_len = _segment(length, k, i)

            def at_shift(shift):
                pos = start + shift
                valid = (length >= 1) & (pos >= 0) & (pos + seg_len <= lr)
                return F.when(valid, F.struct(length.alias("l"), i.alias("i"),
                                              F.substr(w, pos + 1, seg_len).alias("seg")))
            return F.transform(F.sequence(F.lit(-k), F.lit(k)), at_shift)
        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(k)), per_segment))
    probes = F.flatten(F.transform(F.sequence(F.lit(-k), F.lit(k)), per_length))
    return F.array_distinct(F.filter(probes, lambda x: x.isNotNull()))


def vocabulary(tokens: DataFrame, col: str) -> DataFrame:
    """(word, freq): how often each non-empty token occurs in ``col``."""
    return (tokens.select(F.explode(col).alias("word"))
                  .where(F.col("word") != "")
                  .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))


def corrections(words: DataFrame, vocab: DataFrame, max_distance: int = 2,
                min_length: int = 1) -> DataFrame:
    """(word, correction, distance) for each distinct ``word`` of ``words``
    that is at least ``min_length`` long and not in ``vocab``; correction and
    distance are NULL when no vocabulary word is within ``max_distance``."""
    # both word lists are small (distinct words) and each is read more than
    # once below: write them once instead of re-deriving them per read
    vocab = materialize(vocab.select("word", "freq"), "vocab")
    oov = materialize(words.select("word").where(F.length("word") >= min_length).distinct()
                           .join(vocab.select("word"), "word", "left_anti"), "oov")
    k = max_distance
    qv = oov.select("word", F.explode(probe_keys("word", k)).alias("key"))
    vv = vocab.select(F.col("word").alias("cand"), "freq",
                      F.explode(segment_keys("word", k)).alias("key"))
    # a segment shared by very many probes (degenerate vocabularies) is split
    # over salt buckets like a hot product (operators.skew)
    hot = skew.hot_keys(qv, "key")
    joined = (qv.join(vv, "key") if hot is None else
              skew.left_join(skew.salt(qv, "key", hot, ["word", "key"]), vv, "key", hot, "inner"))
    cand = (joined.select("word", "cand", "freq",
                          F.levenshtein("word", "cand", k).alias("dist"))
                  .where(F.col("dist") >= 0))
    # best candidate per word: smallest (distance, -frequency, word); min of a
    # struct is a partial (map-side) aggregate, no window sort
    best = cand.groupBy("word").agg(
        F.min(F.struct("dist", (-F.col("freq")).alias("nfreq"), "cand")).alias("b"))
    return (oov.join(best, "word", "left")
               .select("word", F.col("b.cand").alias("correction"),
                       F.col("b.dist").alias("distance")))


def correct_tokens(df: DataFrame, key: str, tokens: str, fixes: DataFrame,
                   out_col: str) -> DataFrame:
    """Replace each token that has a correction, keeping token order: the
    tokens are exploded with their position, left-joined to the corrections
    and collected back per key in position order (one key's own tokens). Hot
    words are split over salt buckets."""
    ex = df.select(key, F.posexplode(tokens).alias("pos", "word"))
    fixed = (skew.split_left_join(ex, fixes.select("word", "correction"), "word", [key, "pos"])
               .select(key, "pos", F.coalesce("correction", "word").alias("w")))
    back = fixed.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "w"))),
                    lambda s: s["w"]).alias(out_col))
    return df.join(back, key, "left").withColumn(
        out_col, F.coalesce(F.col(out_col), F.col(tokens)))
