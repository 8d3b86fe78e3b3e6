"""Model monitoring in batch.

A prediction log is a table ``(uuid, ts, ..., probability, prediction)``;
truth arrives later keyed by uuid. Accuracy is reported per fixed-count
batch of predictions in time order, complete batches only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.functions.scalar import duration_micros, epoch_micros, subsecond_nanos
from flurry.functions.structs import flatten
from flurry.operators.joins import attach_ground_truth
from flurry.operators.windows import positions, with_position


def batch_accuracy(log: DataFrame, truth_col: str = "final_label", pred_col: str = "prediction",
                   keys: list[str] | None = None, order: list[str] | None = None,
                   ts: str = "ts", size: int = 100) -> DataFrame:
    """Accuracy per batch of ``size`` consecutive predictions.

    ``(keys..., batch, start_us, end_us, n, accuracy)``: start/end are the
    first and last record's time (epoch micros), the trailing partial batch
    is dropped. Numbering uses ``positions`` so a busy deployment is not
    numbered in one task.
    """
    keys = list(keys or [])
    order = list(order or [ts, "uuid"])
    pos = positions(log, keys, order, "_pos")
    correct = (F.col(truth_col) == F.col(pred_col)).cast("double")
    agg = pos.groupBy(*keys, F.floor(F.col("_pos") / size).cast("long").alias("batch")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(epoch_micros(ts)).alias("start_us"),
        F.max(epoch_micros(ts)).alias("end_us"),
        F.avg(correct).alias("accuracy"))
    return agg.where(F.col("n") == size)


DAY_MS = 86_400_000


def write_metrics(log: DataFrame, path: str, mode: str = "append") -> None:
    """Store a metric log partitioned by ``day`` (days since 1970 of the start time), so a time range reads its days only."""
    day = F.floor(F.col("startTimeStampMs") / DAY_MS).cast("int")
    log.withColumn("day", day).write.mode(mode).partitionBy("day").parquet(path)


def read_metrics(log: DataFrame, model: str | None = None, deployment: str | None = None,
                 start_ms: int = 0, end_ms: int | None = None) -> DataFrame:
    """Metric rows of one model / deployment in [start_ms, end_ms] (L4). The
    filters reach the scan; a log with a ``day`` column (``write_metrics``) is
    pruned to the days of the range (a record ends no earlier than it starts)."""
    cond = F.col("startTimeStampMs") >= F.lit(start_ms)
    if end_ms is not None:
        cond = cond & (F.col("endTimeStampMs") <= F.lit(end_ms))
    if "day" in log.columns:
        cond = cond & (F.col("day") >= F.lit(start_ms // DAY_MS))
        if end_ms is not None:
            cond = cond & (F.col("day") <= F.lit(end_ms // DAY_MS))
    if model is not None:
        cond = cond & (F.col("model_crn") == F.lit(model))
    if deployment is not None:
        cond = cond & (F.col("model_deployment_crn") == F.lit(deployment))
    return log.where(cond)


def flatten_metrics(log: DataFrame) -> DataFrame:
    """Nested metric records -> dotted columns."""
    return flatten(log)


def with_processing_time(df: DataFrame, start: str, end: str) -> DataFrame:
    """True duration in microseconds, plus the sub-second-only value that a
    ``.microseconds * 1000`` on a timedelta gives (L6)."""
    return df.withColumn("duration_us", duration_micros(start, end)).withColumn(
        "subsecond_ns", subsecond_nanos(start, end))


def metric_series(log: DataFrame, value: str, ts: str = "ts", keys: list[str] | None = None,
                  tiebreak: str = "uuid") -> DataFrame:
    """(keys..., pos, value) of one metric in time order, rows where it is
    null dropped, pos 1-based (L7)."""
    keys = list(keys or [])
    # a flattened name like "metrics.probability" is a column, not a path
    ref = F.col(f"`{value}`") if value in log.columns else F.col(value)
    d = log.select(*keys, ts, tiebreak, ref.alias("value")).where(F.col("value").isNotNull())
    return with_position(d, keys, [ts, tiebreak], "pos").select(*keys, "pos", "value")


def monitoring_report(predictions: DataFrame, truth: DataFrame, size: int = 100,
                      keys: list[str] | None = None) -> DataFrame:
    """L2 + L3: attach late truth, then accuracy per complete batch."""
    log = attach_ground_truth(predictions, truth, "uuid")
    return batch_accuracy(log.where(F.col("final_label").isNotNull()), keys=keys, size=size)
