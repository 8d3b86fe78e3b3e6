"""End-to-end flows that chain the operators the way the analysis scripts do.

Each takes DataFrames (or a CSV / table source) and returns a dict of lazy
DataFrames and fitted models; nothing is collected except model metadata.

churn_workflow       typed scan -> clean -> recode -> split -> CV logistic
                     -> report / ROC / AUC -> scores -> explanations
                     [-> saved model with side tables]
team_workflow        seasons + champions -> outer attach -> label -> per-game
                     scaling -> time split -> grid search with in-fold SMOTE
                     -> champion probability of the held-out season
monitoring_workflow  prediction log + late truth -> batch accuracy and
                     metric series
similarity_workflow  vectors -> most similar -> most unique + box numbers
crawl_workflow       pages -> filtered links -> linked pages -> images
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flurry.operators import clean, evaluate, explain, joins, models, monitor, pages, sampling, summary, vectors
from flurry.session import cut_lineage
from flurry.sources.catalog import read_table_or_csv
from flurry.sources.schemas import (CHURN_CATEGORICAL, CHURN_ID, CHURN_LABEL, CHURN_NUMERIC,
                                    CHURN_SCHEMA)


def churn_workflow(spark: SparkSession, csv_path: str, table: str | None = None, test: float = 0.25,
                   folds: int = 5, explain_samples: int = 5000, explain_features: int = 10,
                   save_to: str | None = None) -> dict:
    """The churn analysis over the telco table (CSV, or the catalog table
    when it exists). Blank fields (exactly one whitespace) make a row drop;
    SeniorCitizen 1/0 becomes Yes/No; label Churn = 'Yes'."""
    raw = read_table_or_csv(spark, table or "__none__", csv_path, CHURN_SCHEMA, use_table=table is not None)
    data = clean.drop_blank_rows(clean.recode(raw, {"SeniorCitizen": {1: "Yes", 0: "No"}}))
    data = cut_lineage(models.with_label(data, CHURN_LABEL))
    train, hold = sampling.train_test_split(data, CHURN_ID, test)
    model = models.fit_logistic_cv(train, CHURN_CATEGORICAL, CHURN_NUMERIC, id_col=CHURN_ID, folds=folds)
    scored_hold = models.score(hold, model, "probability_1")
    stats = explain.training_stats(train, CHURN_CATEGORICAL, CHURN_NUMERIC)
    out = {
        "model": model,
        "train_accuracy": evaluate.accuracy(model.transform(train), "label", "prediction"),
        "test_accuracy": evaluate.accuracy(scored_hold, "label", "prediction"),
        "report": evaluate.classification_report(
            scored_hold.select(F.col("label").cast("int").alias("label"),
                               F.col("prediction").cast("int").alias("prediction")), "label", "prediction"),
        "roc": evaluate.roc_curve(scored_hold, "label", "probability_1"),
        "auc": evaluate.auc(scored_hold, "label", "probability_1"),
        "scores": models.score(data, model, "probability_1", keep=[CHURN_ID, CHURN_LABEL]),
        "stats": stats,
    }
    if explain_samples:
        out["explanations"] = explain.explain_table(
            data.withColumnRenamed(CHURN_ID, "id"), model, stats, "id",
            n_samples=explain_samples, n_features=explain_features)
    if save_to:
        from flurry.sources.models import save_model
        save_model(model, save_to, {
            "defaults": summary.default_row(train, CHURN_CATEGORICAL, CHURN_NUMERIC),
            "domains": summary.category_domains(train, CHURN_CATEGORICAL),
            "stats": summary.describe_features(train, CHURN_NUMERIC)}, stats)
    return out


def team_workflow(seasons: DataFrame, champions: DataFrame, features: list[str], holdout_season: int,
                  name: str = "name", season: str = "season", games: str = "games_played",
                  grid: list[dict] | None = None, folds: int = 5, explain_samples: int = 1000,
                  explain_features: int = 5, few: str = "fewer") -> dict:
    """Team-season table -> champion probability of the held-out season.

    seasons: one row per team and season; champions: (Year, Champion).
    Counting stats are made per game (columns containing 'percentage' and
    the ids are left as they are); seasons before ``holdout_season`` train a
    scaled random forest with SMOTE inside each CV fold, chosen per score.
    One champion a season makes few positives: a fold with at most 5 takes all
    of them as neighbours, or is refused with ``few="raise"``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    j = joins.attach(seasons, champions, [name, season], ["Champion", "Year"], "left")
    j = clean.drop_null(j, [name]).withColumn("Champion", clean.presence_label(F.col("Champion")))
    j = clean.scale_by(j, games, exclude=[season, "Year"], exclude_containing=["percentage"])
    j = j.withColumn("uid", clean.concat_key([name, season]))
    j = cut_lineage(models.with_label(clean.with_row_id(j, ["uid"], "id"), "Champion"))
    past, future = sampling.split_before(j, season, holdout_season)
    prep = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features_raw"),
                            models.PopulationStandardScaler("features_raw", "features")]).fit(past)
    train = prep.transform(past).select("id", "label", "features")
    rf = models.forest(100, weight_col=None)
    est = models.SmoteThen(rf, "label", 1.0, ratio=0.25, k=5, id_col="id", few=few)
    grid = grid or [{rf.numTrees: n, est.ratio: r} for n in (10, 100) for r in (0.25, 0.5)]
    results, best = models.grid_search(est, grid, train, "label", "id", folds=folds)
    model = best["balanced_accuracy"][1]
    scored = models.score(prep.transform(future), model, "champion_probability", keep=["uid", *features])
    out = {"table": j, "grid": results, "models": best, "ranking":
           scored.orderBy(F.col("champion_probability").desc(), F.col("uid"))}
    if explain_samples:
        from pyspark.ml import PipelineModel
        full = PipelineModel(prep.stages + [model])
        st = explain.training_stats(past, [], features)
        out["explanations"] = explain.explain(future, full, st, "id", n_samples=explain_samples,
                                              n_features=explain_features)
    return out


def monitoring_workflow(predictions: DataFrame, truth: DataFrame, size: int = 100,
                        keys: list[str] | None = None, truth_ts: str | None = None) -> dict:
    """Prediction log + late truth -> accuracy per complete batch of
    ``size`` and the probability series in time order."""
    log = joins.attach_ground_truth(predictions, truth, "uuid", truth_ts)
    return {"log": log,
            "accuracy": monitor.batch_accuracy(log.where(F.col("final_label").isNotNull()), keys=keys, size=size),
            "probability_series": monitor.metric_series(log, "probability", keys=keys)}


def similarity_workflow(vectors_df: DataFrame, n: int = 3, id_col: str = "vec_id", vec: str = "embedding") -> dict:
    """Vectors -> most similar other item, the n most unique items and the
    box-plot numbers of the distances."""
    ms = cut_lineage(vectors.most_similar(vectors_df, id_col, vec))
    return {"most_similar": ms,
            "most_unique": ms.orderBy(F.col("L2").desc(), F.col("index").asc()).limit(n),
            "distance_box": summary.box_stats(ms, None, "L2")}


def crawl_workflow(pages_df: DataFrame, tokens: list[str], host: str | None = None) -> dict:
    """Crawled pages -> links with every token -> linked pages -> images on
    the host, with their download file names."""
    links = pages.filter_links(pages.resolve_links(pages.extract_links(pages_df)), tokens, "resolved")
    return {"links": links, "images": pages.two_hop_images(pages_df, tokens, host)}
