"""Catalog tables: scan by name, create-if-absent, append, inspect."""

from __future__ import annotations

import logging

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flurry.sources.files import read_csv

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by (qualified) name (S3)."""
    return spark.table(name)


def read_table_or_csv(spark: SparkSession, table: str, path: str,
                      schema: T.StructType | None, use_table: bool = True,
                      skip_broken: bool = False) -> DataFrame:
    """Source switch (S4): the catalog table when asked for and present,
    otherwise the typed CSV at ``path``. A table that exists but cannot be
    resolved (missing files, bad metadata) raises; with ``skip_broken`` it is
    logged and the CSV is read."""
    if use_table and spark.catalog.tableExists(table):
        try:
            df = spark.table(table)
            df.schema  # resolve now, so a broken table fails here
            return df
        except PySparkException as e:
            if not skip_broken:
                raise
            log.warning("table %s cannot be read, using %s: %s", table, path, e)
    return read_csv(spark, path, schema=schema)


def save_table_if_absent(df: DataFrame, name: str, partition_by: list[str] | None = None) -> bool:
    """Create a parquet catalog table unless it exists (S5). Returns True when
    written. A conflicting warehouse folder is not removed: the write fails."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        return False
    w = df.write.format("parquet").mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return True


def save_once(df: DataFrame, name: str) -> None:
    """Write once, skip silently when the table is already there."""
    df.write.format("parquet").mode("ignore").saveAsTable(name)


def append_metrics(df: DataFrame, name: str, round_to: int | None = 2,
                   partition_by: list[str] | None = None) -> None:
    """Append metric rows to a table (S12), doubles rounded as the experiment
    log does (2 dp by default)."""
    if round_to is not None:
        df = df.select(*[
            F.round(F.col(f.name), round_to).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ])
    w = df.write.format("parquet").mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog inspection as a DataFrame (S8): ``DESCRIBE TABLE EXTENDED``."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Table names of a database as a DataFrame."""
    rows = [(t.name, t.database, t.tableType, t.isTemporary)
            for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(
        rows, "name string, database string, tableType string, isTemporary boolean")
