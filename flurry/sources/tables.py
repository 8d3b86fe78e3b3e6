"""Named parquet tables of a data folder (one parquet path per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy scan of ``<data_dir>/<name>.parquet``; Catalyst prunes columns and
    pushes filters into it, so callers select only what they use."""
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))
