"""Parquet scans of the provided tables.

Only ``spark.read.parquet`` is used; Catalyst prunes columns and pushes
filters into the scan, so callers select what they need and nothing more.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def table_in_file_order(spark: SparkSession, sf_dir: str, name: str, position: str = "position") -> DataFrame:
    """The table with ``position``: a struct (file, row) that sorts its rows in the order they stand in the files."""
    here = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return table(spark, sf_dir, name).withColumn(position, here)
