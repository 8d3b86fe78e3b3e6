"""JSON records in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_json_records(df: DataFrame, exclude: list[str] | None = None, alias: str = "json") -> DataFrame:
    """One JSON object per row, built JVM-side (``to_json(struct(*))``)."""
    cols = [c for c in df.columns if c not in set(exclude or [])]
    return df.select(F.to_json(F.struct(*cols)).alias(alias))


def from_json_records(df: DataFrame, schema: T.StructType, col: str = "json") -> DataFrame:
    """Parse a JSON string column to typed columns; unknown keys are ignored,
    missing keys come out null (then filled by ``with_defaults``)."""
    return df.select(F.from_json(F.col(col), schema).alias("_r")).select("_r.*")
