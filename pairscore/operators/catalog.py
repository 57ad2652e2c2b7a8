"""Catalog operators: cleaning the attribute table, per-product attribute text,
and the left joins that attach product data to (search term, product) pairs.

All of these are plain DataFrame plans. The joins are left outer equi-joins
on ``product_uid`` with no hints: the optimizer broadcasts a side only when
its estimated (or, with AQE, measured) size is under the broadcast threshold
and falls back to a sort-merge join otherwise. Products holding a large share
of the pairs are split over several tasks by ``operators.skew``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import skew

BRAND_NAME = "MFG Brand Name"
MISSING_TOKEN = "nan"
EMPTY_BRAND = "empty"


def clean_attributes(attrs: DataFrame, missing_token: str | None = MISSING_TOKEN) -> DataFrame:
    """Drop rows where every column is NULL, normalise the key to a long and
    the value to a string; a NULL value becomes ``missing_token`` (the text a
    float NaN turns into), or stays NULL when ``missing_token`` is None."""
    value = F.col("value").cast("string")
    if missing_token is not None:
        value = F.coalesce(value, F.lit(missing_token))
    return (attrs.dropna(how="all")
                 .select(F.col("product_uid").cast("long").alias("product_uid"),
                         F.col("name").cast("string").alias("name"),
                         value.alias("value")))


def brand_rows(attrs: DataFrame, name: str = BRAND_NAME) -> DataFrame:
    """(product_uid, product_attributes) for attribute rows named exactly
    ``name`` (case-sensitive). A product may have several such rows."""
    return (attrs.where(F.col("name") == name)
                 .select("product_uid", F.col("value").alias("product_attributes")))


def _name_filter(names: Sequence[str] | None):
    if not names:
        return None
    low = F.lower(F.col("name"))
    cond = None
    for n in names:
        c = low.contains(n.lower())
        cond = c if cond is None else (cond | c)
    return cond


def attribute_text(attrs: DataFrame, names: Sequence[str] | None = None,
                   out_col: str = "product_attributes", order_by: str | None = None) -> DataFrame:
    """One row per product: its attribute values joined by single spaces,
    ordered by (name, value), or by the column ``order_by``, such as the place
    in the source files (``tables.table_in_file_order``). ``names`` keeps only rows whose name contains
    one of the given words (case-insensitive): ``["brand"]`` is the brand-only
    text, ``["brand", "color", "material"]`` the documented three; None keeps
    every row.

    The filter runs before the aggregate (pushed into the scan when the
    source supports it); ``collect_list`` is partially aggregated map-side and
    holds one product's values. Rows without a product are left out: no join
    can match them, and they would all form one group."""
    cond = _name_filter(names)
    src = attrs.where(F.col("product_uid").isNotNull())
    src = src.where(cond) if cond is not None else src
    text = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(*([order_by] if order_by else []), "name", "value"))),
                    lambda s: s["value"]), " ")
    return src.groupBy("product_uid").agg(text.alias(out_col))


def _join(pairs: DataFrame, right: DataFrame, split_hot: bool, shuffled: bool = False) -> DataFrame:
    if not split_hot:
        return skew.left_join(pairs, right, "product_uid", None, shuffled=shuffled)
    salt_by = ["id"] if "id" in pairs.columns else None
    return skew.split_left_join(pairs, right, "product_uid", salt_by, shuffled=shuffled)


def attach_description(pairs: DataFrame, descriptions: DataFrame,
                       split_hot: bool = True, shuffled: bool = False) -> DataFrame:
    """pairs LEFT JOIN descriptions USING (product_uid); with ``split_hot`` a
    product holding a large share of the pairs is spread over several tasks
    (``operators.skew``), with the same result; ``shuffled`` as there."""
    return _join(pairs, descriptions, split_hot, shuffled)


def attach_brand(pairs: DataFrame, brands: DataFrame, fill: str | None = EMPTY_BRAND,
                 dedupe: bool = False, split_hot: bool = True) -> DataFrame:
    """pairs LEFT JOIN brand rows; a pair whose product has two brand rows
    appears twice (join multiplicity kept) unless ``dedupe``, which keeps the
    smallest brand value per product. NULL brand becomes ``fill``."""
    if dedupe:
        brands = brands.groupBy("product_uid").agg(
            F.min("product_attributes").alias("product_attributes"))
    out = _join(pairs, brands, split_hot)
    if fill is not None:
        out = out.withColumn("product_attributes",
                             F.coalesce(F.col("product_attributes"), F.lit(fill)))
    return out


def token_bags(df: DataFrame, key: str, tokens: str, out_col: str) -> DataFrame:
    """(key, bag) with bag = array<struct<t, n>>: the distinct lowercased
    tokens of each key and their counts, sorted by token.

    The rows are hash-partitioned by ``key`` once; both aggregates then run
    inside that partitioning (no second exchange), and the (key, token)
    count is combined map-side, so a token repeated many times in one text
    never travels as many rows. Rows with NULL or empty token arrays produce
    no bag (callers coalesce to an empty array after their left join)."""
    exploded = (df.select(key, tokens).repartition(key)
                  .select(key, F.explode(F.col(tokens)).alias("t"))
                  .select(key, F.lower("t").alias("t")))
    counts = exploded.groupBy(key, "t").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return counts.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("t", "n"))).alias(out_col))


def _snake(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name.strip().lower())


def attribute_pivot(attrs: DataFrame, names: Sequence[str], sep: str = " ") -> DataFrame:
    """Entity-attribute-value rows to one wide row per product: one column
    per attribute name in ``names`` (snake_case), holding that product's
    values for the name sorted and joined by ``sep``; NULL when it has none.

    The pivot values are given, so Spark plans a single aggregate (no extra
    job to find the distinct names), partially aggregated before the shuffle
    on ``product_uid``; rows of other names, and rows without a product, are
    filtered out at the scan."""
    vals = F.array_join(F.array_sort(F.collect_list("value")), sep)
    wide = (attrs.where(F.col("product_uid").isNotNull() & F.col("name").isin(*names))
                 .groupBy("product_uid").pivot("name", list(names))
                 .agg(F.when(F.count("value") > 0, vals)))
    return wide.select("product_uid", *[F.col(f"`{n}`").alias(_snake(n)) for n in names])
