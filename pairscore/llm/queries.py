"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairscore.sources.tables import table

from . import (bilinear, decontaminate, language, minhash, mixing, negatives, neighbours, pii, prefixes, quality, substring,
               urlfilter, warc)


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0).drop("path", "offset")


def op2_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op3_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents"))


def op4_block_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=50).drop("kept")


def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(urlfilter.table_captures(pages), urlfilter.table_entries(pages))


def op8_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op10_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear.score(table(spark, sf_dir, "documents"), bilinear.held_out_by_id())


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.node_table(prefixes.prefix_trie(table(spark, sf_dir, "conversations")))


def op13_gnat_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec, label = F.col("vec_id"), F.col("label")
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), vec % 100 == 0,
                                    F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label))


def warc_salvage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reader of operator 1 over damaged archives: one page in 37 and every page of one run of ids in 50 is damaged."""
    page = F.col("page_id")
    return warc.salvage_report(table(spark, sf_dir, "pages"), (page % 37 == 5) | ((page / 20).cast("long") % 50 == 7))


def page_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over ``pages``: markup language from the html tag, address suffix and host from the url."""
    url, html = F.col("url"), F.col("html")
    host = urlfilter.url_host(url)
    pages = table(spark, sf_dir, "pages").select(
        "page_id", language.page_text(html).alias("text"), host.alias("host"), language.page_language(html).alias("declared"))
    return language.identify(pages, key="page_id", declared="declared", host="host",
                             suffix=F.substring_index("host", ".", -1))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_salvage": op1_warc_salvage,
    "op2_hyperminhash": op2_hyperminhash,
    "op3_poisson_mix": op3_poisson_mix,
    "op4_block_matrix": op4_block_matrix,
    "op5_spaced_seeds": op5_spaced_seeds,
    "op6_debruijn": op6_debruijn,
    "op7_url_lists": op7_url_lists,
    "op8_quality_bayes": op8_quality_bayes,
    "op9_bilstm_crf": op9_bilstm_crf,
    "op10_language_fusion": op10_language_fusion,
    "op11_log_bilinear": op11_log_bilinear,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_gnat_negatives": op13_gnat_negatives,
    "warc_salvage_report": warc_salvage_report,
    "page_language_fusion": page_language_fusion,
    "pipeline": corpus_pipeline.run,
}

# The 160 bits of a digest in groups of 20 make 4 letters each.
_OP1 = """
WITH d AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
     g AS (SELECT p, max(page_id) AS top FROM d GROUP BY p)
SELECT page_id, CAST(octet_length(encode(d.p)) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
         ((CAST(concat('0x', substr(sha1(d.p), CAST(1 + 5 * (i // 4) AS INTEGER), 5)) AS BIGINT)
           >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM d JOIN g ON d.p = g.p
"""

_WARC_REPORT = f"""
WITH written AS ({_OP1})
SELECT page_id, CASE WHEN hit THEN 'gap' ELSE 'recovered' END AS fate, CASE WHEN NOT hit THEN payload_digest END AS payload_digest
FROM (SELECT *, page_id % 37 = 5 OR (page_id // 20) % 50 = 7 AS hit FROM written)
"""

_OP4 = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: abs(x)), 'sum') > 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id AS vec_id, list_cosine_similarity(q.e, r.e) AS score
      FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM n WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op1_warc_salvage": _OP1,
    "op3_poisson_mix": "WITH docs_in AS (SELECT * FROM documents)," + mixing.SQL,
    "op4_block_matrix": _OP4,
    "op7_url_lists": urlfilter.SQL,
    "warc_salvage_report": _WARC_REPORT,
    "op12_prefix_trie": prefixes.SQL,
    "op13_gnat_negatives": negatives.SQL,
}
