"""Model artefacts: a fitted pipeline plus the side tables it needs.

Layout under one folder (any Hadoop file system, e.g. the shared
checkpoint or warehouse folder):

    <dir>/model/          PipelineModel (Spark ML persistence)
    <dir>/tables/<name>/  parquet side tables (defaults, domains, stats ...)
    <dir>/explainer/      one-row parquet holding the explainer summaries

Everything is written by Spark writers, so nothing is pickled and nothing
depends on the Python version that trained the model.
"""

from __future__ import annotations

import json
import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_model(model: PipelineModel, path: str, tables: dict[str, DataFrame] | None = None,
               stats=None) -> None:
    model.write().overwrite().save(os.path.join(path, "model"))
    for name, df in (tables or {}).items():
        df.write.mode("overwrite").parquet(os.path.join(path, "tables", name))
    if stats is not None:
        spark = SparkSession.getActiveSession()
        payload = json.dumps({"categorical": stats.categorical, "numeric": stats.numeric,
                              "classes": stats.classes, "quartiles": stats.quartiles, "bins": stats.bins})
        spark.createDataFrame([(payload,)], "stats string").write.mode("overwrite").parquet(
            os.path.join(path, "explainer"))


def load_model(spark: SparkSession, path: str, tables: list[str] | None = None):
    """(PipelineModel, {name: DataFrame}, TrainingStats or None)."""
    from flurry.operators.explain import TrainingStats
    model = PipelineModel.load(os.path.join(path, "model"))
    side = {t: spark.read.parquet(os.path.join(path, "tables", t)) for t in (tables or [])}
    stats = None
    try:
        raw = spark.read.parquet(os.path.join(path, "explainer")).first()
    except Exception:  # saved without explainer summaries
        raw = None
    if raw is not None:
        d = json.loads(raw.stats)
        stats = TrainingStats(d["categorical"], d["numeric"],
                              {k: (v[0], v[1]) for k, v in d["classes"].items()},
                              d["quartiles"], {k: [tuple(b) for b in v] for k, v in d["bins"].items()})
    return model, side, stats
