"""File scans and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             sep: str = ",", null_value: str | None = "NA", header: bool = True) -> DataFrame:
    """Typed CSV scan (S1); with ``schema=None`` an inferred scan.

    With a schema there is no inference pass over the data. Null rules of
    Spark's reader: ``NA`` (the null marker) and unquoted empty become null,
    quoted ``""`` stays an empty string, a single space stays in a string
    column and becomes null in a double column (unparseable).
    """
    r = spark.read.option("header", header).option("sep", sep)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if schema is not None:
        # PERMISSIVE: unparseable numbers become null instead of failing.
        return r.schema(schema).option("mode", "PERMISSIVE").csv(path)
    return r.option("inferSchema", True).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_csv(df: DataFrame, path: str, single: bool = False, mode: str = "overwrite") -> None:
    """CSV export (S6). ``single=True`` writes one file through one task and
    is only meant for small results; the default keeps the write parallel."""
    out = df.coalesce(1) if single else df
    out.write.mode(mode).option("header", True).csv(path)


def read_binary(spark: SparkSession, directory: str, contains: str = ".jpg",
                recursive: bool = True) -> DataFrame:
    """Binary files whose name contains ``contains``.

    The match is a substring test on the file name (``a.jpg.bak`` matches),
    which a suffix glob would not give. The glob narrows the listing first,
    the filter applies the exact rule; content is read lazily per file.
    """
    from pyspark.sql import functions as F

    df = (spark.read.format("binaryFile")
          .option("pathGlobFilter", f"*{contains}*")
          .option("recursiveFileLookup", recursive)
          .load(directory))
    name = F.element_at(F.split("path", "/"), -1)
    return df.where(F.instr(name, contains) > 0)
