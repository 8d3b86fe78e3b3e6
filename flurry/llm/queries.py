"""Registered queries of the training-data operators."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flurry.llm.chat import canonical_turns, format_chat, read_back, records_of_rows
from flurry.llm.decontam import spaced_seed_overlaps
from flurry.llm.jaccard import near_duplicate_groups
from flurry.llm.lines import dedup_lines
from flurry.llm.mixing import MIX_SQL, mix_sources
from flurry.llm.negatives import NEGATIVES_SQL, mine_hard_negatives
from flurry.llm.packing import pack_documents
from flurry.llm.pii import KINDS as PII_KINDS
from flurry.llm.pii import find_personal_data
from flurry.llm.quality import repetition_coverage
from flurry.llm.repeats import remove_repeats
from flurry.llm.secrets import KINDS as SECRET_KINDS
from flurry.llm.secrets import find_secrets
from flurry.llm.toxicity import fit_toxicity, score_toxicity
from flurry.llm.whitening import quantised, whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified overlaps of documents with benchmark items: doc_id, item_id and the overlap."""
    return spaced_seed_overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = remove_repeats(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = repetition_coverage(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "dup_line_chars", "chars_5", "chars_7", "chars_10")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
    labels = (_table(spark, sf_dir, "labels").filter(~held_out).groupBy("doc_id").agg(F.max("toxic").alias("label")))
    # the query's fold, before any text is read
    model = fit_toxicity(docs.filter(~held_out), labels=labels)
    got = score_toxicity(docs, model)
    return got.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
                                  F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    got = read_back(format_chat(canonical_turns(records_of_rows(rows.union(probe)))))
    turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
                      F.length("learned").cast("long").alias("loss_chars"),
                      F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "layout")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = find_personal_data(_table(spark, sf_dir, "documents"))
    order = F.array(*[F.lit(k) for k in PII_KINDS])
    both = F.concat("base", F.transform("added", lambda x: F.struct(x["kind"], x["start"], x["end"])))
    keyed = F.array_sort(F.transform(both, lambda x: F.struct(F.array_position(order, x["kind"]).alias("k"), x["start"].alias("start"),
                                                               x["end"].alias("end"), x["kind"].alias("kind"))))
    got = got.withColumn("every", keyed)
    return got.select("doc_id", *[_count("base", k) for k in PII_KINDS],
                      F.sha2(_spans("base").cast("binary"), 256).alias("base_sha256"), _spans("every").alias("spans"),
                      F.size("added").cast("long").alias("n_added"))


def _spans(col: str) -> Column:
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _count(col: str, kind: str) -> Column:
    return F.size(F.filter(col, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = find_secrets(_table(spark, sf_dir, "documents"))
    order = F.array(*[F.lit(k) for k in SECRET_KINDS])
    both = F.concat("base", F.transform("added", lambda x: F.struct(x["kind"], x["start"], x["end"])))
    keyed = F.array_sort(F.transform(both, lambda x: F.struct(x["start"], F.array_position(order, x["kind"]).alias("k"),
                                                               x["end"], x["kind"])))
    got = got.withColumn("every", keyed)
    n = [_count("base", k) for k in SECRET_KINDS]
    return got.select("doc_id", *n, F.sha2(_spans("base").cast("binary"), 256).alias("base_sha256"),
                      _spans("every").alias("spans"), F.size("added").cast("long").alias("n_added"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(_table(spark, sf_dir, "embeddings").filter("label is not null"), "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.select("vec_id", moved.alias("label"), "x"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_packing, op3_repeats, op4_quality, op5_jaccard, op6_line_dedup,
                                 op7_toxicity, op8_chat, op9_personal_data, op10_secrets, op11_hard_negatives,
                                 op12_mixing, op13_whitening)}

ORACLE = {"op11_hard_negatives": NEGATIVES_SQL, "op12_mixing": MIX_SQL}
