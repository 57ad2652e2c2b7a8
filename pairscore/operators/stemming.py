"""Stemming of token arrays as a Spark job.

``stem_vocabulary`` stems a table of distinct words by built-in expressions
(``functions.porter``). ``stem_tokens`` stems whole arrays where they stand:
each task takes its rows as Arrow batches, reduces a batch to its distinct
words, stems each of them once and puts the stems in the words' places. No
word is shuffled, so frequent words and large vocabularies cost no more; only
finished arrays move, to be grouped by their keys.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.porter import stem, stem_words

# executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[stem.__module__])

#: Words whose stems a task keeps from batch to batch, and the length of the longest of them: a bound of its memory.
KEPT_WORDS, KEPT_LENGTH = 1 << 17, 64


def stem_vocabulary(words: DataFrame, col: str = "word") -> DataFrame:
    """(word, stem) for the distinct values of ``col``."""
    vocab = words.select(F.col(col).alias("word")).where(F.col("word").isNotNull()).distinct()
    return stem_words(vocab, "word", "stem")


def _stems(tokens: str):
    """The arrays of ``tokens`` with every word replaced by its stem."""
    longest, kept = KEPT_LENGTH, KEPT_WORDS

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = lru_cache(kept)(stem)
        for arrays in batches:
            words = arrays.flatten().dictionary_encode()
            stems = pa.array([known(w) if len(w) <= longest else stem(w) for w in words.dictionary.to_pylist()], pa.string())
            sizes = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.ListArray.from_arrays(ends, stems.take(words.indices), mask=arrays.is_null())

    return F.arrow_udf(work, T.ArrayType(T.StringType()))(tokens)


def stem_tokens(df: DataFrame, key: str, tokens: str, out_col: str) -> DataFrame:
    """(key, out_col): ``tokens`` with every word replaced by its stem, order
    and duplicates kept; an empty array stays empty and NULL stays NULL.
    ``key`` must identify rows: arrays that share a key are merged by position,
    and one that is NULL makes the whole NULL."""
    rows = (df.select(key, _stems(tokens).alias("_stems")).groupBy(key)
              .agg(F.bool_or(F.col("_stems").isNull()).alias("_null"), F.collect_list("_stems").alias("_rows")))
    places = F.flatten(F.transform("_rows", lambda r: F.transform(r, lambda s, i: F.struct(i.alias("pos"), s.alias("stem")))))
    merged = F.transform(F.array_sort(places), lambda s: s["stem"])
    return rows.select(key, F.when(~F.col("_null"), F.when(F.size("_rows") == 1, F.get("_rows", F.lit(0)))
                                                     .otherwise(merged)).alias(out_col))
