"""The corpus pipeline: stages keep the columns of documents and their decisions take effect."""

import random

import corpus_pipeline as C
from pyspark.sql import functions as F
from tests.llm import brute


def test_pipeline_end_to_end(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    extra = docs.withColumn("n_lines", F.lit(3)).withColumn("component", F.lit("x"))
    now, rows = extra, {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    for k, (name, stage) in enumerate(C.STAGES):
        before = {r[0]: r[1] for r in now.select("doc_id", "text").collect()}
        out = stage(spark, now, small_dir)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(C.STAGES) - 1:
            assert out.columns == extra.columns
            after = {r[0]: r[1] for r in out.select("doc_id", "text").collect()}
            assert set(after) <= set(before)
            if name == "line dedup":
                want = {d: s for d, _, _, s in brute.lines(sorted(before.items()))}
                assert {d: brute.sha(t) for d, t in after.items()} == want
            if name == "n-gram Jaccard join":
                assert set(after) == {c for _, _, c in brute.jaccard(sorted(before.items()))}
        else:
            assert {r[0] for r in out.select("doc_id").collect()} == set(before)
        now = out
    assert len(rows) >= 200
    assert C.run(spark, small_dir).count() == now.count()


def test_stages_on_an_empty_table(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, docs, small_dir).count() == 0


def test_rows_with_null_or_repeated_ids_are_judged_by_their_texts(spark, small_dir):
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (None, a + " end"), (None, b), (None, b), (2, a), (2, c), (2, c), (None, None), (3, d), (3, "another " + d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = [tuple(r) for r in C.near_duplicates(spark, docs, small_dir).select("doc_id", "text").collect()]
    first = next(t for i, t in got if i == 3)
    assert sorted(got, key=str) == sorted([(1, a), (None, b), (2, c), (None, None), (3, first)], key=str)
    item = max((r[0] for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").select("text").collect()), key=len)
    rows = [(None, "so " + item), (None, b), (2, item), (2, c), (3, d), (3, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = [tuple(r) for r in C.decontamination(spark, docs, small_dir).select("doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted([(None, b), (2, c), (3, d), (3, d)], key=str)
