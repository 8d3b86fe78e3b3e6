"""Structured Streaming forms of scoring and late-truth monitoring.

L8  ``stream_score``          stateless: model.transform on a stream
L9  ``stream_attach_truth``   stream-stream left outer join on uuid, both
                              sides watermarked, truth time bounded to
                              [ts, ts + delay]; a prediction without truth
                              is emitted (with null truth) once the
                              watermark passes ts + delay; truth later than
                              that is dropped
L10 ``stream_window_accuracy``  accuracy per tumbling event-time window
    ``start_count_batches``     exact batches of N predictions per key, by
                              ``foreachBatch`` with the distributed
                              ``positions`` numbering (see below)

Timestamps: ``withWatermark`` needs TIMESTAMP, so TIMESTAMP_NTZ columns are
cast first (``as_event_time``).
"""

from __future__ import annotations

import os
import uuid as _uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flurry.functions.scalar import epoch_micros
from flurry.operators.keys import join_on_keys
from flurry.operators.models import without_summary
from flurry.operators.windows import positions
from flurry.session import checkpoint_dir


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for stateful streams whose shuffle partitions (the number of
    state stores, fixed in the stream checkpoint at first start) follow the
    cluster: ``defaultParallelism`` cores unless given. It shares the
    SparkContext; only SQL settings differ. Batch queries leave partition
    sizing to AQE, which does not apply to stateful streaming operators."""
    s = spark.newSession()
    n = partitions or max(2, spark.sparkContext.defaultParallelism)
    s.conf.set("spark.sql.shuffle.partitions", str(n))
    return s


def replay(spark: SparkSession, data_dir: str, name: str, schema: T.StructType | None = None,
           max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files of table ``name`` in ``data_dir``."""
    if schema is None:
        schema = spark.read.parquet(os.path.join(data_dir, f"{name}.parquet")).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet*")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(data_dir)


def as_event_time(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Event time as TIMESTAMP so the column can carry a watermark.

    A TIMESTAMP_NTZ wall clock becomes the instant with the same digits in
    UTC, whatever the session time zone, so tumbling windows (aligned to
    the epoch) are wall-clock days and ``instant_micros`` gives back the
    wall clock's epoch microseconds."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.TimestampNTZType):
        return df.withColumn(out or col, F.timestamp_micros(epoch_micros(col)))
    if isinstance(dt, T.TimestampType):
        return df if out is None else df.withColumn(out, F.col(col))
    return df.withColumn(out or col, F.col(col).cast("timestamp"))


def instant_micros(c) -> "F.Column":
    """Epoch microseconds of a TIMESTAMP instant (session-zone free)."""
    return F.unix_micros(F.col(c) if isinstance(c, str) else c)


def stream_score(stream: DataFrame, model, keep: list[str], out: str = "probability_1") -> DataFrame:
    """Score each arriving row (L8): ``keep`` columns + P(class 1) +
    prediction. Stateless, so any output mode and trigger works."""
    s = without_summary(model).transform(stream)
    return s.select(*keep, vector_to_array(F.col("probability"))[1].alias(out), "prediction")


def stream_attach_truth(predictions: DataFrame, truth: DataFrame, key: str = "uuid", ts: str = "ts",
                        truth_ts: str = "truth_ts", delay: str = "6 hours",
                        watermark: str = "1 hour") -> DataFrame:
    """Late truth for a prediction stream (L9), one-to-one on ``key``."""
    p = predictions.withWatermark(ts, watermark).alias("p")
    t = truth.withColumnRenamed(key, "_tkey").withWatermark(truth_ts, watermark).alias("t")
    cond = F.expr(f"p.{key} = t._tkey AND t.{truth_ts} >= p.{ts} AND t.{truth_ts} <= p.{ts} + INTERVAL {delay}")
    j = p.join(t, cond, "leftOuter")
    return j.select("p.*", *[F.col(f"t.{c}") for c in truth.columns if c not in (key,)])


def stream_window_accuracy(log: DataFrame, ts: str = "ts", window: str = "1 day",
                           watermark: str | None = "1 hour", truth_col: str = "final_label",
                           pred_col: str = "prediction") -> DataFrame:
    """Accuracy per tumbling event-time window (L10), append mode: a window
    is emitted once the watermark passes its end. ``watermark=None`` keeps
    the watermark the input already carries (e.g. after the L9 join)."""
    correct = (F.col(truth_col) == F.col(pred_col)).cast("double")
    src = log.where(F.col(truth_col).isNotNull())
    if watermark is not None:
        src = src.withWatermark(ts, watermark)
    return (src
            .groupBy(F.window(ts, window).alias("window"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(correct).alias("accuracy"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "n", "accuracy"))


# --- exact count batches over a stream ---------------------------------------------------

def _versions(spark: SparkSession, path: str) -> list[int]:
    """Version numbers N of the ``v=N`` folders under ``path`` (Hadoop
    FileSystem listing, so it works on any shared file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            fs_ok = fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
            if fs_ok:
                out.append(int(name[2:]))
    return sorted(out)


def _read_version(spark: SparkSession, path: str, before: int):
    vs = [v for v in _versions(spark, path) if v < before]
    return spark.read.parquet(os.path.join(path, f"v={vs[-1]}")) if vs else None


def count_batches_fn(keys: list[str], order: list[str], ts: str, size: int, out_path: str, state_path: str,
                     truth_col: str = "final_label", pred_col: str = "prediction"):
    """foreachBatch body for exact batches of ``size`` predictions per key.

    Per micro-batch: rows carried over from earlier batches (fewer than
    ``size`` per key) are unioned with the new rows and numbered per key with
    ``positions`` (range-partitioned, so one busy key is spread over many
    tasks); every complete batch is aggregated and written under
    ``out_path/batch_id=<id>``; the remainder and the per-key batch counter
    are written as state version ``v=<id>``. A batch only reads versions
    older than its id and overwrites everything it writes, so a retried
    batch gives the same output (exactly once).
    """
    ks = list(keys) or ["_all"]
    carry_cols = list(dict.fromkeys(ks + order + [ts, truth_col, pred_col]))
    pend_path, cnt_path = os.path.join(state_path, "pending"), os.path.join(state_path, "counters")

    def _micros(c):
        # stream event time is an instant; a static (NTZ) input is a wall clock
        return instant_micros(c) if event_is_instant else epoch_micros(c)

    event_is_instant = True

    def process(batch_df: DataFrame, batch_id: int) -> None:
        nonlocal event_is_instant
        event_is_instant = isinstance(batch_df.schema[ts].dataType, T.TimestampType)
        spark = batch_df.sparkSession
        rows = batch_df if keys else batch_df.withColumn("_all", F.lit(0))
        rows = rows.select(*carry_cols)
        pend = _read_version(spark, pend_path, batch_id)
        if pend is not None:
            rows = pend.select(*carry_cols).unionByName(rows)
        pos = positions(rows, ks, order, "_pos").persist()
        per_key = pos.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
        pos_n = join_on_keys(pos, per_key, ks)
        full = F.floor(F.col("_n") / size) * size
        correct = (F.col(truth_col) == F.col(pred_col)).cast("double")
        batches = (pos_n.where(F.col("_pos") < full)
                   .groupBy(*ks, F.floor(F.col("_pos") / size).cast("long").alias("_b"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min(_micros(ts)).alias("start_us"),
                        F.max(_micros(ts)).alias("end_us"), F.avg(correct).alias("accuracy")))
        done = _read_version(spark, cnt_path, batch_id)
        if done is not None:
            batches = join_on_keys(batches, done, ks, how="left")
        else:
            batches = batches.withColumn("_done", F.lit(0).cast("long"))
        batches = batches.withColumn("batch", (F.coalesce(F.col("_done"), F.lit(0)) + F.col("_b")).cast("long"))
        (batches.select(*keys, "batch", "n", "start_us", "end_us", "accuracy")
         .write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}")))
        (pos_n.where(F.col("_pos") >= full).select(*carry_cols)
         .write.mode("overwrite").parquet(os.path.join(pend_path, f"v={batch_id}")))
        add = per_key.select(*ks, F.floor(F.col("_n") / size).cast("long").alias("_add"))
        if done is not None:
            add = join_on_keys(add, done, ks, how="full").select(
                *ks, (F.coalesce("_add", F.lit(0)) + F.coalesce("_done", F.lit(0))).alias("_done"))
        else:
            add = add.select(*ks, F.col("_add").alias("_done"))
        add.write.mode("overwrite").parquet(os.path.join(cnt_path, f"v={batch_id}"))
        pos.unpersist()

    return process


def start_count_batches(log: DataFrame, keys: list[str], order: list[str], ts: str = "ts", size: int = 100,
                        root: str | None = None, trigger: dict | None = None,
                        truth_col: str = "final_label", pred_col: str = "prediction"):
    """Start the count-batch stream (L10). Returns (query, output path);
    read results with ``spark.read.parquet(output path)``. ``root`` defaults
    to a fresh folder under the shared checkpoint folder."""
    spark = log.sparkSession
    root = root or os.path.join(checkpoint_dir(spark), f"count-batches-{_uuid.uuid4().hex}")
    out, state, ckpt = (os.path.join(root, p) for p in ("out", "state", "checkpoint"))
    fn = count_batches_fn(keys, order, ts, size, out, state, truth_col, pred_col)
    w = log.writeStream.foreachBatch(fn).option("checkpointLocation", ckpt)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(), out


def run_to_parquet(stream: DataFrame, mode: str = "append", root: str | None = None,
                   trigger: dict | None = None) -> str:
    """Run a streaming query to completion (default ``availableNow``) into a
    parquet folder under the shared checkpoint folder; returns the path."""
    spark = stream.sparkSession
    root = root or os.path.join(checkpoint_dir(spark), f"stream-{_uuid.uuid4().hex}")
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "checkpoint")
    q = (stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", ckpt)
         .trigger(**(trigger or {"availableNow": True})).start(out))
    q.awaitTermination()
    return out
