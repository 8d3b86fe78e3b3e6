"""Joins (J1-J4, J7, J8).

Strategy is left to Catalyst and AQE (broadcast when a side is small by
statistics, sort-merge otherwise, skewed partitions split at run time).
Explicit broadcast hints appear only where a side is bounded by
construction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.operators.windows import latest_per_key, version_key


def attach(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str],
           how: str = "left") -> DataFrame:
    """Equi-join on differently named keys (J1 with ``how='outer'``, J2 with
    ``how='left'``). A full outer join followed by a not-null filter on a
    left column is rewritten by Catalyst to a left join; write ``'left'``."""
    cond = reduce(lambda a, b: a & b, [left[lk] == right[rk] for lk, rk in zip(left_keys, right_keys)])
    return left.join(right, cond, how)


def attach_ground_truth(log: DataFrame, truth: DataFrame, key: str = "uuid",
                        truth_ts: str | None = None, value_cols: list[str] | None = None) -> DataFrame:
    """Attach late truth to a prediction log by key.

    Truth may arrive more than once for a key: the latest (by ``truth_ts``)
    wins. It is reduced to one row per key with a map-side ``max_by`` first,
    so the join is one-to-one and a key with many truth updates is not a hot
    join key.
    """
    vals = value_cols or [c for c in truth.columns if c not in (key, truth_ts)]
    t = latest_per_key(truth.select(key, *vals, *([truth_ts] if truth_ts else [])), [key],
                       [truth_ts]) if truth_ts else truth.select(key, *vals).dropDuplicates([key])
    return log.join(t, key, "left")


def feature_card(stats: DataFrame, domains: DataFrame, values: DataFrame,
                 weights: DataFrame) -> DataFrame:
    """Per feature of one or more scored rows (J4): value, explanation weight
    (0 when missing), mean/min/max for numeric features and the class list
    for categorical ones.

    stats   (feature, median, mean, min, max, std)
    domains (feature, idx, value)
    values  (id, feature, value)      long form of the row data
    weights (id, feature, weight)     long form of the explanation map
    """
    classes = domains.groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "value"))), lambda s: s["value"])
        .alias("classes"))
    card = (values.join(weights, ["id", "feature"], "left")
            .join(stats.select("feature", "mean", "min", "max"), "feature", "left")
            .join(classes, "feature", "left"))
    return card.select("id", "feature", "value", F.coalesce("weight", F.lit(0.0)).alias("weight"),
                       "mean", "min", "max", "classes")


def attach_pair(pairs: DataFrame, items: DataFrame, left_idx: str = "index",
                right_idx: str = "similar_index", item_key: str = "vec_id",
                item_cols: list[str] | None = None) -> DataFrame:
    """Join item attributes onto both ends of a pair table."""
    cols = item_cols or [c for c in items.columns if c != item_key]
    a = items.select(F.col(item_key).alias(left_idx), *[F.col(c).alias(f"{c}") for c in cols])
    b = items.select(F.col(item_key).alias(right_idx), *[F.col(c).alias(f"similar_{c}") for c in cols])
    return pairs.join(a, left_idx, "left").join(b, right_idx, "left")


def latest_deployment(models: DataFrame, builds: DataFrame, deployments: DataFrame,
                      name: str | None = None) -> DataFrame:
    """Registry chain model -> latest build -> latest deployment.

    models(id, name, crn, ...), builds(id, model_id, created),
    deployments(id, build_id, crn, created). For each model name: the first
    model (lowest id) with that name, its last build, that build's last
    deployment. ``name`` restricts to one model.
    """
    m = models.where(F.col("name") == name) if name is not None else models
    first_model = m.groupBy("name").agg(F.min_by(F.struct(*m.columns), F.col("id")).alias("m")).select("m.*")
    last_build = latest_per_key(builds.select("model_id", F.col("id").alias("build_id"), "created"),
                                ["model_id"], ["created", "build_id"])
    last_dep = latest_per_key(deployments.select("build_id", F.col("id").alias("deployment_id"),
                                                 F.col("crn").alias("deployment_crn"),
                                                 F.col("created").alias("deployed")),
                              ["build_id"], ["deployed", "deployment_id"])
    return (first_model.select(F.col("id").alias("model_id"), "name", F.col("crn").alias("model_crn"))
            .join(last_build.select("model_id", "build_id"), "model_id", "left")
            .join(last_dep.select("build_id", "deployment_id", "deployment_crn"), "build_id", "left"))


def latest_version(runtimes: DataFrame, version_col: str = "full_version") -> DataFrame:
    """Row with the highest dotted version (W4 ordering, element-wise)."""
    return runtimes.orderBy(version_key(version_col).desc()).limit(1)
