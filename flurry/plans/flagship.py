"""Flagship query: churn scoring of the customer feature table (F-A).

customer x orders -> feature table -> blank rows dropped -> label ->
hash split -> alphabetical index, one-hot, population-std scaling ->
5-fold cross-validated logistic regression on the training part ->
P(churn) for every customer, highest first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flurry.operators.clean import drop_blank_rows
from flurry.session import cut_lineage
from flurry.operators.models import fit_logistic_cv, score, with_label
from flurry.operators.sampling import train_test_split
from flurry.plans.derived import CUSTOMER_CATEGORICAL, CUSTOMER_NUMERIC, customer_features


def labelled_features(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned, labelled customer features, checkpointed: model fitting scans
    them many times, and the checkpoint (in the shared spark.checkpoint.dir)
    both cuts the lineage back to the order scan and survives executor loss."""
    cf = with_label(drop_blank_rows(customer_features(spark, d)), "Churn")
    cf = cf.withColumn("n_orders", F.col("n_orders").cast("double"))
    return cut_lineage(cf)


def churn_model(spark: SparkSession, d: str, folds: int = 5, cs: list[float] | None = None):
    """(fitted pipeline model, labelled feature table, train, test)."""
    cf = labelled_features(spark, d)
    train, test = train_test_split(cf, "id", 0.25)
    model = fit_logistic_cv(train, CUSTOMER_CATEGORICAL, CUSTOMER_NUMERIC, folds=folds, cs=cs)
    return model, cf, train, test


def churn_scores(spark: SparkSession, d: str) -> DataFrame:
    model, cf, _, _ = churn_model(spark, d)
    scored = score(cf, model, "probability", keep=["id", "Churn"])
    return scored.select("id", "Churn", "probability", (F.col("prediction") == 1.0).alias("predicted_churn")) \
        .orderBy(F.col("probability").desc(), F.col("id"))


def team_features(spark: SparkSession, d: str) -> DataFrame:
    """Per-game team table (F-B) with a numeric id and 0/1 label: the input
    of the oversampling, PCA and grid-search queries."""
    from flurry.operators.clean import concat_key, drop_null, presence_label, scale_by, with_row_id
    from flurry.operators.joins import attach
    from flurry.plans.derived import season_champions, supplier_seasons
    s = cut_lineage(supplier_seasons(spark, d))   # one lineitem x orders pass
    c = season_champions(s)
    j = drop_null(attach(s, c, ["name", "season"], ["Champion", "Year"], "left"), ["name"])
    j = j.select(concat_key(["name", "season"]).alias("uid"), "season", "games_played", *TEAM_STATS,
                 "discount_percentage", presence_label(F.col("Champion")).alias("Champion"))
    j = scale_by(j, "games_played", exclude=["season", "Champion"], exclude_containing=["percentage"])
    j = with_row_id(j, ["uid"], "id")
    return cut_lineage(with_label(j, "Champion"))


TEAM_STATS = ["quantity", "extendedprice", "discount", "tax", "revenue"]
TEAM_FEATURES = TEAM_STATS + ["discount_percentage"]
