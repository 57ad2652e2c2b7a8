"""Word2Vec document vectors (Spark ML) and their use as feature inputs.

The fit is Spark ML's: it trains on ``num_partitions`` partitions of the
sentences, or on more where each would hold more than ``partition_rows``, and
keeps vocabulary x vectorSize floats on the driver, a limit of that library;
``min_count`` bounds it on large corpora. Vectors depend on the number of
partitions, so it follows the input alone and is not taken from the cluster.
Applying the vectors is a join of (word, vector) rows on hash keys, without a
broadcast of the vocabulary and without moving a token array.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .encode import text_key, word_key


@dataclass(frozen=True)
class W2VParams:
    vector_size: int = 10
    min_count: int = 0
    seed: int = 42
    num_partitions: int = 8   # at least; vectors depend on it, so it does not follow the cluster
    partition_rows: int = 250_000   # sentences in a partition, at most
    max_iter: int = 1
    window_size: int = 5
    max_sentence_length: int = 1000


def fit_word2vec(df: DataFrame, input_col: str, output_col: str,
                 params: W2VParams = W2VParams(), rows: int | None = None) -> Word2VecModel:
    """``rows``: the number of sentences, where the caller knows it."""
    rows = df.count() if rows is None else rows
    partitions = max(params.num_partitions, -(-rows // params.partition_rows))
    w2v = Word2Vec(vectorSize=params.vector_size, minCount=params.min_count,
                   seed=params.seed, numPartitions=partitions, maxIter=params.max_iter,
                   windowSize=params.window_size,
                   maxSentenceLength=params.max_sentence_length,
                   inputCol=input_col, outputCol=output_col)
    # a NULL sentence makes the fit throw; callers pass arrays, empty if absent
    return w2v.fit(df.select(input_col))


def word_vectors(model: Word2VecModel) -> DataFrame:
    """(word, vector) of a fitted model, as a table in the shared folder."""
    return materialize(model.getVectors().select("word", vector_to_array("vector").alias("vector")), "words")


def text_means(keyed: DataFrame, tokens: str, key: str, words: DataFrame, size: int, out: str) -> DataFrame:
    """(key, out), written: the mean of the word vectors of each distinct text of ``keyed``, whose ``key`` is the
    ``text_key`` of ``tokens``. Texts without tokens have no row.

    Texts and words travel as hash keys (``encode``): one row of two keys and a count for each distinct word of a text,
    combined before the shuffle, so the bytes shuffled are linear in the tokens however long a text is. Rows with equal
    tokens share a key, and their counts add up in numerator and denominator alike. Nothing is broadcast by hand. The means
    are written, so that both sides of each join are plain shuffles, which AQE splits where a word or a text is hot."""
    counted = (keyed.select(F.col(key).alias("_text"), F.explode(F.transform(tokens, word_key)).alias("_word"))
               .groupBy("_text", "_word").agg(F.count(F.lit(1)).alias("_n")))
    vectors = words.select(word_key(F.col("word")).alias("_word"), F.col("vector").alias("_v"))
    rows = counted.join(vectors, "_word", "left")
    sums = rows.groupBy("_text").agg(*[F.sum(F.col("_n") * F.coalesce(F.get("_v", F.lit(i)), F.lit(0.0))).alias(f"_s{i}")
                                       for i in range(size)], F.sum("_n").alias("_all"))
    return materialize(sums.select(F.col("_text").alias(key), F.array(*[F.col(f"_s{i}") / F.col("_all") for i in range(size)]).alias(out)), "means")


def attach_means(keyed: DataFrame, means: DataFrame, key: str, size: int, out: str) -> DataFrame:
    """``keyed`` with ``out`` of its text from ``means``, without ``key``; a text without tokens gets the zero vector."""
    zero = F.array(*[F.lit(0.0)] * size)
    return keyed.drop(out).join(means, key, "left").drop(key).withColumn(out, F.coalesce(out, zero))


def document_vectors(df: DataFrame, tokens: str, words: DataFrame, size: int, out: str) -> DataFrame:
    """``df`` with ``out``: the mean of the word vectors of each row's tokens as ``array<double>``. Unknown words count
    in the denominator; a row without tokens gets the zero vector."""
    keyed = df.withColumn("_text", text_key(F.col(tokens)))
    return attach_means(keyed, text_means(keyed, tokens, "_text", words, size, out), "_text", size, out)
