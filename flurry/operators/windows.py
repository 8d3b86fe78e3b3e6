"""Positions, batches, running sums and latest-per-key.

Ordered numbering inside a key is the one thing a plain window does badly at
scale: ``row_number().over(partitionBy(key))`` sends every row of a key to one
task, so a key that holds a third of the data becomes a third of the job on
one core. ``positions`` instead range-partitions on (key, order), so a hot
key is cut across many tasks, and sorts each partition. There
``monotonically_increasing_id`` numbers the rows (partition in the high bits,
row in the low ones); one row per (partition, key) holds the number its run
starts at and how many rows the key has in earlier partitions. Everything
stays in the JVM, so payload columns keep their types and values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flurry.operators.keys import join_on_keys
from flurry.session import cut_lineage


def _order_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def positions(df: DataFrame, keys: list[str], order: list, name: str = "pos",
              sum_cols: list[str] | None = None, num_partitions: int | None = None,
              totals: bool = False) -> DataFrame:
    """0-based position of each row inside its key, in ``order`` (W1 core).

    With ``sum_cols`` also adds ``<c>_running``: the running sum of ``c`` up
    to and including the row (W5 frame: unbounded preceding to current row;
    nulls add nothing), and with ``totals`` ``<c>_total``, the sum over the
    whole key. ``order`` must make rows unique inside a key for a
    deterministic result. Only pass the columns that are needed: the numbered
    rows are written once to the shared checkpoint folder.
    """
    sum_cols = list(sum_cols or [])
    part_cols = [F.col(k) for k in keys] + [_order_col(c) for c in order]
    ranged = (df.repartitionByRange(num_partitions, *part_cols) if num_partitions
              else df.repartitionByRange(*part_cols))
    local = ranged.sortWithinPartitions(*part_cols).withColumn("_mid", F.monotonically_increasing_id())
    # Both the run table and the final rows read these numbers: they must be
    # fixed data, or a recomputed range shuffle could number rows differently.
    local = cut_lineage(local).withColumn("_pid", F.shiftright("_mid", 33))

    amounts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in sum_cols]
    # one row per (partition, key), combined map-side: a key's rows of one
    # partition are one run of consecutive numbers
    runs = local.groupBy("_pid", *keys).agg(
        F.min("_mid").alias("_start"), F.count(F.lit(1)).alias("_n"),
        *[F.sum(a).alias(f"_s_{c}") for c, a in zip(sum_cols, amounts)])
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_pid", *keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start")).alias("_shift"),
        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0.0)).alias(f"_soff_{c}") for c in sum_cols],
        *[F.sum(f"_s_{c}").over(Window.partitionBy(*keys)).alias(f"{c}_total") for c in sum_cols if totals])
    if sum_cols:
        upto = (Window.partitionBy("_pid", *keys).orderBy("_mid")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        local = local.select("*", *[F.sum(a).over(upto).alias(f"_cum_{c}") for c, a in zip(sum_cols, amounts)])
    # (partition, key) is the join key: a hot key is spread over its partitions
    joined = join_on_keys(local, runs, keys, ["_pid"])
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_mid") + F.col("_shift")).alias(name),
        *[(F.col(f"_cum_{c}") + F.col(f"_soff_{c}")).alias(f"{c}_running") for c in sum_cols],
        *[F.col(f"{c}_total") for c in sum_cols if totals])


def with_position(df: DataFrame, keys: list[str], order: list, name: str = "pos",
                  one_based: bool = True) -> DataFrame:
    """Position in an ordered series per key (W1), 1-based by default."""
    out = positions(df, keys, order, name)
    return out.withColumn(name, F.col(name) + 1) if one_based else out


def with_batch(df: DataFrame, keys: list[str], order: list, size: int = 100,
               complete_only: bool = True, name: str = "batch") -> DataFrame:
    """Fixed-count batch id per key (W2): rows 0..size-1 are batch 0, etc.

    With ``complete_only`` the trailing partial batch of each key is dropped
    (a batch is emitted only when its last row arrives).
    """
    pos = positions(df, keys, order, "_pos")
    pos = pos.withColumn(name, F.floor(F.col("_pos") / size).cast("long"))
    if complete_only:
        full = (pos.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("_bn"))
                .where(F.col("_bn") == size).drop("_bn"))
        pos = join_on_keys(pos, full, keys, [name], "left_semi")
    return pos


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest row per key (W4) as one aggregation: ``max_by(struct(row),
    struct(order))``. Partial aggregation runs map-side, so a hot key is
    reduced before the shuffle. Ties on ``order``: one of the tied rows."""
    value_cols = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in value_cols]), ordering).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in value_cols])


def version_key(v) -> Column:
    """'2.10.1' -> [2, 10, 1] so versions compare element-wise (2.10 > 2.9)."""
    c = F.col(v) if isinstance(v, str) else v
    return F.transform(F.split(c, r"\."), lambda x: x.try_cast("int"))


def running_sums(df: DataFrame, order: list, sum_cols: list[str],
                 num_partitions: int | None = None) -> DataFrame:
    """Global running sums in ``order`` without a one-partition window."""
    return positions(df, [], order, "_rank", sum_cols=sum_cols, num_partitions=num_partitions)
