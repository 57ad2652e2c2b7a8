"""Attributes from free text: multi-word dictionary matching as a join.

The dictionary holds attribute values as token lists. Values are indexed by length and hash; every text offers the hashes of
its token runs of those lengths, and runs that meet a value are matches. The longest match wins: a match within a longer one
is dropped. A text offers as many runs as it has tokens for each length that occurs in the dictionary, whatever the number of
values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import skew
from .encode import text_key


def dictionary(attributes: DataFrame, tokens: Column) -> DataFrame:
    """(name, value, run): the distinct (name, value) rows with the key of their tokens; values without tokens, and NULL names
    or values, are left out."""
    rows = attributes.where("name is not null and value is not null").select("name", "value").distinct()
    return rows.withColumn("_t", tokens).where(F.size("_t") > 0).select("name", "value", text_key(F.col("_t")).alias("run"))


def _runs(tokens: Column, lengths: list[int]) -> Column:
    """array<struct<start, run>>: the runs of the given lengths and their 0-based places."""
    def of_length(n):
        places = F.when(F.size(tokens) >= n, F.sequence(F.lit(0), F.size(tokens) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(i.alias("start"), text_key(F.slice(tokens, i + 1, F.lit(n))).alias("run")))
    return F.flatten(F.array(*[of_length(n) for n in lengths]))


def extract(texts: DataFrame, key: str, tokens: str, values: DataFrame) -> DataFrame:
    """(key, start, n_tokens, name, value): the dictionary entries of ``values`` (name, value, run) found in the token arrays of
    ``texts`` (key, tokens), without those inside a longer match. A value that stands at several places gives a row for each;
    a value of several names gives a row for each name. NULL and empty arrays, and an empty dictionary, give no rows. ``key``
    must identify texts."""
    values = materialize(values, "dictionary")
    # at most one number for each length that occurs
    lengths = sorted(r[0] for r in values.select("run.n").distinct().collect())
    if not lengths:
        return texts.select(key, F.lit(0).alias("start"), F.lit(0).alias("n_tokens"), F.lit("").alias("name"), F.lit("").alias("value")).limit(0)
    runs = texts.select(key, F.explode(_runs(F.col(tokens), lengths)).alias("r")).select(key, "r.start", "r.run")
    # most runs are no value: those go before anything is written, against the distinct values alone
    hits = materialize(runs.join(values.select("run").distinct(), "run", "left_semi").select(key, "start", "run"), "runs")
    spans = hits.select(key, "start", F.col("run.n").alias("n_tokens"), "run")
    # in this order a span within an earlier one ends no later than the furthest end so far
    order = Window.partitionBy(key).orderBy("start", F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n_tokens")
    outer = spans.withColumn("reach", F.max(end).over(order)).where(F.col("reach").isNull() | (F.col("reach") < end))
    return (skew.split_left_join(outer.drop("reach"), values, "run", [key, "start"], how="inner")
            .select(key, "start", "n_tokens", "name", "value"))
