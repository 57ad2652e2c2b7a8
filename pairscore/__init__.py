"""pairscore: Spark-native relevance features and models for (search term, product) pairs.

Layout:
  sources/    scans, sinks and the fixture views over the provided tables
  functions/  Column-level functions (tokenising, word match, vector math)
  operators/  DataFrame-level operators (catalog cleaning/joins, embeddings, stemming)
  plans/      end-to-end feature sets, models, evaluation and the query catalogue
"""

__all__ = ["session"]
