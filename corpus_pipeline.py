"""Corpus preparation: quality rules, line dedup, near-duplicate removal,
benchmark decontamination and best-fit packing, each stage a Spark job whose
result is written as Parquet and read by the next.

Every stage but the last takes and returns the columns of ``documents``
(extra columns pass through untouched, whatever their names); a null or empty
text is a document without words. ``n_chars`` follows the text.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flurry.llm.decontam import contaminated_ids, spaced_seed_overlaps
from flurry.llm.jaccard import near_duplicate_groups
from flurry.llm.lines import dedup_lines
from flurry.llm.packing import pack_documents
from flurry.llm.quality import repetition_coverage
from flurry.session import scratch_path, ship_package

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ORACLE_SQL = None  # hashing, tokenization and packing are not expressible in SQL


def _wrap(docs: DataFrame) -> DataFrame:
    """doc_id, text and everything else in one struct (no name can clash)."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(True).alias("__row")).alias("__rest"))


def _unwrap(df: DataFrame, like: DataFrame) -> DataFrame:
    cols = []
    for c in like.columns:
        if c in ("doc_id", "text"):
            cols.append(F.col(c))
        elif c == "n_chars":
            kind = like.schema[c].dataType
            cols.append(F.length(F.coalesce("text", F.lit(""))).cast(kind).alias(c))
        else:
            cols.append(F.col(f"__rest.`{c}`").alias(c))
    return df.select(*cols)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules accept."""
    ship_package(spark)
    got = repetition_coverage(_wrap(docs), carry=("doc_id", "text", "__rest"))
    return _unwrap(got.filter("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds."""
    ship_package(spark)
    return _unwrap(dedup_lines(_wrap(docs)), docs)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__key``, a 64-bit hash of id and text: rows with null or repeated ids are told apart by their texts."""
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.coalesce("text", F.lit("")))
    return _wrap(docs).withColumn("__key", key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of every near-duplicate group (null ids
    last; of rows with one id any one); of repeated rows (equal id and text)
    one. Every row is judged by its own text: other texts of its id stay."""
    ship_package(spark)
    rows = _keyed(docs)
    groups = near_duplicate_groups(rows.select(F.col("__key").alias("doc_id"), "text"))
    ids = rows.groupBy("__key").agg(F.min("doc_id").alias("id"))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "__key")
    kept = (groups.select(F.col("doc_id").alias("__key"), "component_id").distinct().join(ids, "__key")
            .groupBy("component_id").agg(F.min(order).alias("k")).select("k.__key"))
    # repeated rows are merged before they are shuffled: a text repeated often is one row a task
    return _unwrap(rows.dropDuplicates(["__key"]).join(kept, "__key", "left_semi"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item, each row judged by its own text."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _keyed(docs)
    bad = contaminated_ids(spaced_seed_overlaps(rows.select(F.col("__key").alias("doc_id"), "text"), benchmark))
    return _unwrap(rows.join(bad.withColumnRenamed("doc_id", "__key"), "__key", "left_anti"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and offset."""
    ship_package(spark)
    return pack_documents(docs, TOKENIZER)


STAGES = [("quality rules", quality), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below the shared folder and reread."""
    base = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
