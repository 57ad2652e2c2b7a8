"""The four input views of the relevance problem, derived from the provided tables.

The relevance pipeline reads train/test pairs, product descriptions and an
entity-attribute-value table of product attributes. Those files are not
available here, so these views build the same shapes from the provided
parquet tables (see FIXTURES.md). Each is written twice: as DataFrame calls
for the Spark side and as SQL text for the DuckDB oracle. The two must agree
row for row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, product_uid, product_title, search_term, relevance): one row per
    distinct (order, line number)."""
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey", "l_linenumber")
          .agg(F.min("l_partkey").alias("product_uid"),
               F.min("l_discount").alias("disc")))
    part = table(spark, sf_dir, "part")
    p = part.select(F.col("p_partkey").alias("p_key"), F.col("p_name").alias("product_title"))
    q = part.select(F.col("p_partkey").alias("q_key"), F.col("p_name").alias("q_name"),
                    F.col("p_type").alias("q_type"))
    ln = F.col("l_linenumber")
    search = (F.when(ln % 5 == 0, F.split_part(F.col("q_name"), F.lit(" "), F.lit(1)))
              .when(ln % 5 == 1, F.concat(F.col("q_name"), F.lit(" "), F.col("q_type")))
              .otherwise(F.col("q_name")))
    relevance = (F.lit(1) + F.when(ln % 3 == 0, 1).otherwise(0)
                 + F.round(F.col("disc") * 10, 2))
    return (li.join(p, F.col("p_key") == F.col("product_uid"))
              .join(q, F.col("q_key") == F.col("product_uid") + (ln % 3))
              .select((F.col("l_orderkey") * 10 + ln).alias("id"),
                      "product_uid", "product_title",
                      search.alias("search_term"),
                      relevance.cast("double").alias("relevance")))


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_uid, product_description); every 7th product has none."""
    part = table(spark, sf_dir, "part")
    text = F.concat(F.lit("The "), F.col("p_name"), F.lit(" is a "), F.col("p_type"),
                    F.lit(" item of size "), F.col("p_size").cast("string"),
                    F.lit(" and it was made by "), F.col("p_brand"))
    return (part.where(F.col("p_partkey") % 7 != 0)
                .select(F.col("p_partkey").alias("product_uid"),
                        text.alias("product_description")))


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EAV (product_uid, name, value): some products lack a brand row, some
    have two."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").alias("product_uid")

    def rows(cond, name, value):
        src = part.where(cond) if cond is not None else part
        return src.select(key, F.lit(name).alias("name"), value.alias("value"))

    has_brand = F.col("p_size") % 3 != 0
    parts = [
        rows(has_brand, "MFG Brand Name", F.col("p_brand")),
        rows(has_brand & (F.col("p_partkey") % 50 == 1), "MFG Brand Name",
             F.concat(F.col("p_brand"), F.lit(" Pro"))),
        rows(None, "Material", F.col("p_type")),
        rows(None, "Color Family", F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))),
        rows(None, "Size", F.col("p_size").cast("string")),
    ]
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


def doc_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, product_uid, search_term, relevance): each labelled document with the whole text of a benchmark item;
    the items are dealt out evenly (doc_id modulo their number, items in order of their ids)."""
    labels = table(spark, sf_dir, "labels")
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("search_term"))
    n = max(1, bench.count())
    return (labels.join(bench, F.col("item_id") == F.col("doc_id") % n)
                  .select(F.col("doc_id").alias("id"), F.col("doc_id").alias("product_uid"), "search_term",
                          (F.lit(1) + F.col("quality") + (F.lit(1) - F.col("toxic")))
                          .cast("double").alias("relevance")))


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs over real-length multilingual text: the title and the description are a whole document, the search term
    a whole benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (doc_terms(spark, sf_dir).join(docs, F.col("product_uid") == F.col("doc_id"))
            .select("id", "product_uid", F.col("text").alias("product_title"), "search_term",
                    F.col("text").alias("product_description"), F.col("source").alias("product_attributes"), "relevance"))


# SQL text of the same views, for the DuckDB oracle (leading CTEs).
SQL = {
    "pairs": """
pairs AS (
  WITH li AS (
    SELECT l_orderkey, l_linenumber, min(l_partkey) AS product_uid, min(l_discount) AS disc
    FROM lineitem GROUP BY l_orderkey, l_linenumber
  )
  SELECT l_orderkey * 10 + l_linenumber AS id,
         li.product_uid AS product_uid,
         p.p_name AS product_title,
         CASE l_linenumber % 5 WHEN 0 THEN split_part(q.p_name, ' ', 1)
                               WHEN 1 THEN concat(q.p_name, ' ', q.p_type)
                               ELSE q.p_name END AS search_term,
         CAST(1 + CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END + round(disc * 10, 2) AS DOUBLE) AS relevance
  FROM li
  JOIN part p ON p.p_partkey = li.product_uid
  JOIN part q ON q.p_partkey = li.product_uid + (l_linenumber % 3)
)""",
    "descriptions": """
descriptions AS (
  SELECT p_partkey AS product_uid,
         concat('The ', p_name, ' is a ', p_type, ' item of size ', CAST(p_size AS VARCHAR(10)),
                ' and it was made by ', p_brand) AS product_description
  FROM part WHERE p_partkey % 7 <> 0
)""",
    "attributes": """
attributes AS (
  SELECT p_partkey AS product_uid, 'MFG Brand Name' AS name, p_brand AS value FROM part WHERE p_size % 3 <> 0
  UNION ALL
  SELECT p_partkey, 'MFG Brand Name', concat(p_brand, ' Pro') FROM part WHERE p_size % 3 <> 0 AND p_partkey % 50 = 1
  UNION ALL
  SELECT p_partkey, 'Material', p_type FROM part
  UNION ALL
  SELECT p_partkey, 'Color Family', split_part(p_name, ' ', 1) FROM part
  UNION ALL
  SELECT p_partkey, 'Size', CAST(p_size AS VARCHAR(10)) FROM part
)""",
    "doc_pairs": """
doc_pairs AS (
  SELECT l.doc_id AS id, d.doc_id AS product_uid,
         d.text AS product_title,
         b.text AS search_term,
         d.text AS product_description, d.source AS product_attributes,
         CAST(1 + l.quality + (1 - l.toxic) AS DOUBLE) AS relevance
  FROM labels l
  JOIN documents d ON d.doc_id = l.doc_id
  JOIN benchmark b ON b.item_id = l.doc_id % (SELECT count(*) FROM benchmark)
)""",
}


def with_views(*names: str) -> str:
    """``WITH`` prefix defining the named views, in dependency-free order."""
    return "WITH " + ",".join(SQL[n] for n in names) + "\n"
