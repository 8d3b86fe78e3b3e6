"""Streaming operators run with availableNow and agree with the batch operators."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_stream_count_batches_equal_batch(spark):
    from flurry.plans.registry import QUERIES
    b = QUERIES["batch_accuracy"](spark, SF_SMALL)
    s = QUERIES["stream_count_batches"](spark, SF_SMALL)
    cols = ["batch", "n", "start_us", "end_us", "accuracy"]
    assert sorted(map(tuple, b.select(*cols).collect())) == sorted(map(tuple, s.select(*cols).collect()))


def test_stream_late_truth_equals_batch(spark):
    from flurry.plans.registry import QUERIES
    lt = QUERIES["stream_late_truth"](spark, SF_SMALL)
    bt = QUERIES["predictions_with_truth"](spark, SF_SMALL)
    j = lt.join(bt.select("uuid", F.col("final_label").alias("fb")), "uuid")
    assert j.count() == lt.count() == bt.count()
    assert j.where(F.col("final_label") != F.col("fb")).count() == 0


def test_late_truth_dropped_and_missing(spark):
    """Truth later than the bound is dropped; a prediction without truth
    comes out with null truth once the watermark has passed."""
    import os
    import uuid

    from flurry import streaming as stm
    from flurry.session import checkpoint_dir
    root = os.path.join(checkpoint_dir(spark), f"t-{uuid.uuid4().hex}")
    pred = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 01:00:00"), (3, "2024-01-01 02:00:00"),
         (4, "2024-01-03 00:00:00")], "uuid long, ts string").select("uuid", F.col("ts").cast("timestamp"))
    truth = spark.createDataFrame(
        [(1, True, "2024-01-01 03:00:00"),    # in time
         (2, True, "2024-01-01 09:00:00"),    # after ts + 6h: dropped
         (4, False, "2024-01-03 01:00:00")],
        "uuid long, final_label boolean, truth_ts string").select(
        "uuid", "final_label", F.col("truth_ts").cast("timestamp"))
    pred.write.parquet(os.path.join(root, "p"))
    truth.write.parquet(os.path.join(root, "t"))
    ps = spark.readStream.schema(pred.schema).parquet(os.path.join(root, "p"))
    ts = spark.readStream.schema(truth.schema).parquet(os.path.join(root, "t"))
    j = stm.stream_attach_truth(ps, ts, "uuid", "ts", "truth_ts", "6 hours", "1 hour")
    out = stm.run_to_parquet(j, root=os.path.join(root, "o"))
    got = sorted((r.uuid, r.final_label) for r in spark.read.parquet(out).collect())
    # 2: truth after ts + 6 h is dropped; 3: never has truth -- both come out
    # with null truth once the watermark (from the 01-03 rows) has passed
    assert got == [(1, True), (2, None), (3, None), (4, False)]


def test_count_batches_retry_is_idempotent(spark):
    """Replaying a micro-batch id (as after a failure) rewrites the same
    output; the batches over all micro-batches equal the batch operator."""
    import os
    import uuid

    from flurry.operators import monitor
    from flurry.session import checkpoint_dir
    from flurry.streaming.monitor import count_batches_fn
    root = os.path.join(checkpoint_dir(spark), f"cb-{uuid.uuid4().hex}")
    rows = spark.range(430).select(F.col("id").alias("uuid"), F.timestamp_seconds(F.col("id") * 60).alias("ts"),
                                   (F.col("id") % 3 == 0).alias("final_label"),
                                   (F.col("id") % 2 == 0).alias("prediction"))
    first, second = rows.where(F.col("uuid") < 170), rows.where(F.col("uuid") >= 170)
    fn = count_batches_fn([], ["ts", "uuid"], "ts", 100, os.path.join(root, "out"), os.path.join(root, "state"))
    fn(first, 0)
    fn(second, 1)
    before = sorted(map(tuple, spark.read.parquet(os.path.join(root, "out")).drop("batch_id").collect()))
    fn(second, 1)   # replay
    after = sorted(map(tuple, spark.read.parquet(os.path.join(root, "out")).drop("batch_id").collect()))
    assert before == after and len(after) == 4
    ref = monitor.batch_accuracy(rows, size=100).select("batch", "n", "start_us", "end_us", "accuracy")
    assert after == sorted(map(tuple, ref.collect()))
