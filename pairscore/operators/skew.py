"""Left joins of a large pair table onto per-product rows when one product
may hold a large share of the pairs.

AQE's skew-join split only fires when both join inputs are plain shuffle
stages; the product side here is aggregated (token bags, attribute text)
above its shuffle, so a product with a third of all pairs would otherwise
land in one task. The hot products are therefore split explicitly:

* ``hot_keys``: the keys holding more than half a partition's fair share of
  rows. One pass builds a mergeable heavy-hitter sketch of the key hashes and
  the row count; its size follows the number of partitions, not of keys. Only
  the candidates it names, if any, are counted exactly in a second pass. The
  hot keys' counts add up to at most the total, so there are fewer than
  ``2 * partitions`` of them: the table is broadcast with a proven size bound.
  Each hot key gets one salt bucket per eighth of a partition's share, so its
  pairs spread evenly over as many tasks as its size needs.
  Without hot keys the join stays exactly as it was.
* ``salt``: each pair of a hot product gets a bucket from a hash of its own
  columns (deterministic, so a retried task sends rows to the same place);
  other pairs get bucket 0.
* ``left_join``: the right-side rows of a hot product are repeated once per
  bucket (a product has one description and a few attribute rows, so this
  is small: the buckets of all hot keys add up to at most total / bucket +
  hot keys < 10 * partitions), and the join is on (key, bucket). Every pair still meets every
  right row of its product exactly once: results are those of the plain
  join. NULL keys are treated as a key too (all NULL-key pairs would
  otherwise hash to one partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "_salt"
_N = "_n_salts"
_K = "_hot_key"


#: Keys that ``approx_top_k`` tracks at most; its error is 3.5 / tracked of all rows.
MOST_TRACKED = 1 << 19


def _candidates(df: DataFrame, key: str, p: int) -> tuple[int, list[int] | None]:
    """(rows, hashes of keys that can hold more than half a partition's share), from one pass; None where there are
    more partitions than the sketch can serve.

    The sketch names every key that holds more than twice its error of all rows, and its estimates are not too small. It
    tracks 32 p keys or more, so that is any key above 7 / (32 p) of the rows, and the share asked for is 1 / (2 p)."""
    tracked = max(1024, 1 << (32 * p - 1).bit_length())
    if tracked > MOST_TRACKED:
        return df.count(), None
    seen = df.agg(F.expr(f"approx_top_k(xxhash64(`{key}`), {min(4 * p, tracked)}, {tracked})"), F.count(F.lit(1))).first()
    share = max(1, seen[1] // (2 * p))
    return seen[1], [r["item"] for r in seen[0] or () if r["count"] > share]


def hot_keys(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame | None:
    """(key, n_salts) for the keys of ``df`` above half a partition's share,
    or None when there are none (the joins then stay plain)."""
    p = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, hashes = _candidates(df, key, p)
    if hashes is not None and not hashes:
        return None
    rows = df if hashes is None else df.where(F.xxhash64(key).isin(hashes))
    return _hot(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_c")), key, "_c", total, p)


def hot_from_counts(counts: DataFrame, key: str, count_col: str,
                    partitions: int | None = None) -> DataFrame | None:
    """Hot keys from a per-key count table: their sum, then the keys above
    half a partition's share."""
    p = partitions or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(count_col)).first()[0] or 0
    return _hot(counts, key, count_col, total, p)


def _hot(counts: DataFrame, key: str, count_col: str, total: int, p: int) -> DataFrame | None:
    """The keys of ``counts`` above half a partition's share of ``total``, with their buckets; only those reach the
    driver, fewer than ``2 * p`` rows by the bound above."""
    share = max(1, total // (2 * p))
    # buckets of about an eighth of a partition's share: hashing many small
    # buckets onto the partitions spreads them evenly
    bucket = max(1, total // (8 * p))
    rows = (counts.where(F.col(count_col) > share)
                  .select(key, F.ceil(F.col(count_col) / F.lit(bucket)).cast("int"))
                  .collect())
    if not rows:
        return None
    schema = T.StructType([T.StructField(_K, counts.schema[key].dataType),
                           T.StructField(_N, T.IntegerType())])
    return counts.sparkSession.createDataFrame([tuple(r) for r in rows], schema)


def _with_hot(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    h = F.broadcast(hot)
    return df.join(h, df[key].eqNullSafe(h[_K]), "left").drop(_K)


def salt(df: DataFrame, key: str, hot: DataFrame,
         salt_by: Sequence[str] | None = None) -> DataFrame:
    """Add the bucket column ``_salt`` to the large side."""
    cols = list(salt_by or df.columns)
    bucket = F.when(F.col(_N).isNotNull(), F.pmod(F.xxhash64(*cols), F.col(_N))).otherwise(0)
    return _with_hot(df, key, hot).withColumn(SALT, bucket.cast("int")).drop(_N)


def replicate(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Repeat each row of a hot key once per bucket (``_salt`` = 0..n-1)."""
    buckets = F.when(F.col(_N).isNotNull(), F.sequence(F.lit(0), F.col(_N) - 1)) \
               .otherwise(F.array(F.lit(0)))
    return _with_hot(df, key, hot).withColumn(SALT, F.explode(buckets)).drop(_N)


def left_join(salted: DataFrame, right: DataFrame, key: str, hot: DataFrame | None,
              how: str = "left", shuffled: bool = False) -> DataFrame:
    """``salted`` LEFT (or ``how``) JOIN ``right`` on ``key``; with ``hot``
    the left side must carry ``_salt`` (see ``salt``) and keeps it.
    ``shuffled``: no broadcast of ``right``. It is for arrays that the query
    makes per product: Spark estimates them by their files' bytes and one
    element an array, far below what a broadcast holds on the driver, and
    does not take such a plan back once it sees the rows."""
    right = right if hot is None else replicate(right, key, hot)
    right = right.hint("merge") if shuffled else right
    return salted.join(right, key if hot is None else [key, SALT], how)


def split_left_join(left: DataFrame, right: DataFrame, key: str,
                    salt_by: Sequence[str] | None = None,
                    partitions: int | None = None, how: str = "left", shuffled: bool = False) -> DataFrame:
    """One left (or ``how``) join with hot keys split: same rows as ``left.join(right, key, how)``."""
    hot = hot_keys(left, key, partitions)
    if hot is None:
        return left_join(left, right, key, None, how, shuffled)
    return left_join(salt(left, key, hot, salt_by), right, key, hot, how, shuffled).drop(SALT)
