"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Source s with n_s rows and target weight w_s gets the mean repetition rate total * w_s / (sum of weights) / n_s. A
uniform number in [0, 1) from a hash of seed and key is put through the inverse of the Poisson distribution with that
mean; the row is exploded by the count, and the copies are dealt and sorted by a hash: a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rate tables up to this many sources are broadcast (at most about 1.5 kB each); larger ones are joined by salted key.
BROADCAST_SOURCES = 10_000
SALTS = 64
#: Larger rates are a sum of this many at most, each drawn by itself, so that exp(-rate) stays in range.
RATE_PART = 64.0


def uniform(*parts: Column) -> Column:
    """Uniform in [0, 1) with 52 bits, from the md5 of the parts joined by colons."""
    digits = F.substring(F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """[P(X <= 0), P(X <= 1), ...] as far as double precision tells them from 1."""
    top = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))
    step = lambda a, k: F.struct(
        (a["p"] * rate / k).alias("p"),
        F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * rate / k)).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), top), start, step, lambda a: a["cdf"])


def source_rates(docs: DataFrame, weights: DataFrame | None, total: int | None, power: float, source: str) -> DataFrame:
    """(source, rate, parts, cdf); a null source is a source of its own."""
    counts = docs.groupBy(F.col(source).alias("_s")).agg(F.count("*").alias("_n"))
    if weights is None:
        counts = counts.withColumn("_w", F.pow("_n", F.lit(power)))
    else:
        w = weights.select(F.col("source").alias("_ws"), F.greatest(F.col("weight").cast("double"), F.lit(0.0)).alias("_w"))
        counts = (counts.join(w.groupBy("_ws").agg(F.sum("_w").alias("_w")), F.col("_s").eqNullSafe(F.col("_ws")), "left")
                  .select("_s", "_n", F.coalesce("_w", F.lit(0.0)).alias("_w")))
    sums = counts.agg(F.sum("_w").alias("w"), F.sum("_n").alias("n")).first()
    goal = (sums["n"] or 0) if total is None else total
    rate = F.lit(float(goal)) * F.col("_w") / F.lit(float(sums["w"])) / F.col("_n") if sums["w"] else F.lit(0.0)
    return (counts.withColumn("_rate", rate)
            .withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("_rate") / RATE_PART).cast("int")))
            .withColumn("_cdf", poisson_cdf(F.col("_rate") / F.col("_parts"))).select("_s", "_rate", "_parts", "_cdf"))


def replicate(docs: DataFrame, weights: DataFrame | None = None, total: int | None = None, power: float = 0.5,
              seed: int = 17, key: str = "doc_id", source: str = "source") -> DataFrame:
    """``docs``, each row as often as its Poisson count says, with ``replica`` (from 1) and ``shuffle_key``; rows are
    dealt over the partitions by shuffle_key and sorted by it.

    ``weights`` (source, weight): relative target shares; a source that is missing, or has a null or negative weight,
    gets 0 and weights of one source add up. Without ``weights`` the share of a source is its row count to ``power``.
    ``total`` rows are expected in all (default: as many as there are).

    A null source is a source of its own and a null key hashes as 'null'. Rows that tie in the key get the same count,
    and each of them is repeated. Empty and long texts are carried as they are; an empty table stays empty. Columns of
    ``docs`` named replica or shuffle_key are replaced; all others are kept."""
    kept = [c for c in docs.columns if c not in ("replica", "shuffle_key")]
    docs = docs.select(*kept)
    rates = source_rates(docs, weights, total, power, source)
    if rates.count() <= BROADCAST_SOURCES:
        rows = docs.join(F.broadcast(rates), F.col(source).eqNullSafe(F.col("_s")))
    else:
        salted = rates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = (docs.withColumn("_d", F.pmod(F.xxhash64(key), F.lit(SALTS)))
                .join(salted, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_d") == F.col("_salt"))))
    draw = lambda j: F.size(F.filter("_cdf", lambda c: c <= uniform(F.lit(seed), j, F.col(key))))
    one = F.size(F.filter("_cdf", lambda c: c <= F.col("_u")))
    more = F.aggregate(F.sequence(F.lit(2), F.col("_parts")), F.lit(0), lambda n, j: n + draw(j))
    count = F.when(F.col("_parts") > 1, one + more).otherwise(one)
    rows = (rows.withColumn("_u", uniform(F.lit(seed), F.lit(1), F.col(key))).withColumn("_count", count)
            .where("_count > 0").withColumn("replica", F.explode(F.sequence(F.lit(1), F.col("_count")))))
    name = F.concat_ws(":", F.lit(seed), F.lit("shuffle"), F.col("replica"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return (rows.select(*kept, "replica", F.md5(name).alias("shuffle_key"))
            .repartition("shuffle_key").sortWithinPartitions("shuffle_key"))


#: DuckDB SQL of replicate() with its default arguments, over the rows of a relation ``docs_in``; rates up to RATE_PART.
SQL = """
counts AS (SELECT source AS s, count(*) AS n, pow(count(*), 0.5) AS w FROM docs_in GROUP BY source),
rates AS (SELECT s, (SELECT sum(n) FROM counts) * w / (SELECT sum(w) FROM counts) / n AS rate FROM counts),
terms AS (SELECT s, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
          FROM rates, (SELECT unnest(generate_series(0, 200)) AS k) WHERE k <= ceil(rate + 10 * sqrt(rate) + 20)),
cdf AS (SELECT s, k, sum(p) OVER (PARTITION BY s ORDER BY k) AS c FROM terms),
drawn AS (SELECT d.*, CAST(concat('0x', substr(md5(concat('17:1:', coalesce(CAST(doc_id AS VARCHAR), 'null'))), 1, 13)) AS BIGINT)
                 / 4503599627370496.0 AS u FROM docs_in d),
times AS (SELECT d.*, (SELECT count(*) FROM cdf WHERE cdf.s IS NOT DISTINCT FROM d.source AND c <= u) AS times FROM drawn d)
SELECT doc_id, text, lang, source, n_chars, CAST(replica AS INTEGER) AS replica,
       md5(concat('17:shuffle:', replica, ':', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS shuffle_key
FROM (SELECT *, unnest(generate_series(1, times)) AS replica FROM times)
"""
