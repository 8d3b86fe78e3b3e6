"""End-to-end flows on a hand-made churn CSV and on driver-derived tables."""

import os
import random
import uuid

from pyspark.sql import functions as F

from flurry.plans import derived, workflows
from flurry.session import checkpoint_dir
from flurry.sources.schemas import CHURN_SCHEMA
from tests.conftest import SF_SMALL

YES_NO = ["Yes", "No"]


def _churn_csv(spark, n=160):
    """Telco-shaped rows; churn depends on contract and tenure, plus the
    FIXTURES edge cases (NA, blank TotalCharges, '1'/'0' seniors)."""
    rng = random.Random(5)
    lines = [",".join(f.name for f in CHURN_SCHEMA.fields)]
    for i in range(n):
        contract = rng.choice(["Month-to-month", "One year", "Two year"])
        tenure = rng.randint(1, 72)
        churn = "Yes" if (contract == "Month-to-month" and tenure < 24) or rng.random() < 0.1 else "No"
        total = f"{tenure * 50.5:.2f}"
        if i == 3:
            total = "NA"
        if i == 4:
            total = " "
        vals = [f"{i:04d}-ABCDE", rng.choice(["Male", "Female"]), rng.choice(["0", "1"]), rng.choice(YES_NO),
                rng.choice(YES_NO), str(tenure), rng.choice(YES_NO), rng.choice(["No", "Yes", "No phone service"]),
                rng.choice(["DSL", "Fiber optic", "No"]), rng.choice(YES_NO), rng.choice(YES_NO), rng.choice(YES_NO),
                rng.choice(YES_NO), rng.choice(YES_NO), rng.choice(YES_NO), contract, rng.choice(YES_NO),
                rng.choice(["Electronic check", "Mailed check"]), f"{rng.uniform(20, 110):.2f}", total, churn]
        lines.append(",".join(vals))
    d = os.path.join(checkpoint_dir(spark), f"churn-{uuid.uuid4().hex}")
    os.makedirs(d)
    with open(os.path.join(d, "churn.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


def test_churn_workflow_end_to_end(spark):
    src = _churn_csv(spark)
    save = os.path.join(checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    out = workflows.churn_workflow(spark, src, folds=3, explain_samples=200, explain_features=5, save_to=save)
    assert out["scores"].count() == 158                     # NA and blank TotalCharges rows dropped
    assert out["auc"].first().auc > 0.7
    assert {r.cls for r in out["report"].collect()} >= {"0", "1", "accuracy", "macro avg", "weighted avg"}
    ex = out["explanations"].collect()
    assert len(ex) == 158 and all(len(r.explanation) == 5 for r in ex)
    assert isinstance(ex[0]["id"], str)
    from flurry.sources.models import load_model
    m, side, st = load_model(spark, save, ["defaults", "domains", "stats"])
    assert side["defaults"].count() == 1 and st.features == out["stats"].features


def test_team_workflow_ranks_holdout(spark):
    seasons = derived.supplier_seasons(spark, SF_SMALL)
    champs = derived.season_champions(derived.supplier_seasons(spark, SF_SMALL))
    last = seasons.agg(F.max("season")).first()[0]
    feats = ["quantity", "extendedprice", "discount", "tax", "revenue", "discount_percentage"]
    from flurry.operators import models
    rf = models.forest(10)
    out = workflows.team_workflow(seasons, champs, feats, last, grid=None, folds=3, explain_samples=100)
    n_last = seasons.where(F.col("season") == last).count()
    rank = out["ranking"].collect()
    assert len(rank) == n_last and all(0 <= r.champion_probability <= 1 for r in rank)
    assert out["grid"].count() == 4
    assert out["explanations"].count() == n_last


def test_monitoring_similarity_crawl(spark):
    mon = workflows.monitoring_workflow(derived.predictions(spark, SF_SMALL), derived.ground_truth(spark, SF_SMALL))
    from flurry.plans.registry import QUERIES
    ref = QUERIES["batch_accuracy"](spark, SF_SMALL)
    assert mon["accuracy"].count() == ref.count()
    sim = workflows.similarity_workflow(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    assert sim["most_unique"].count() == 3 and sim["distance_box"].count() == 1
    from tests.test_operators import PAGES
    crawl = workflows.crawl_workflow(spark.createDataFrame(PAGES, "page_id long, url string, html string"),
                                     ["http", "html", "Desktop"], "site.example")
    assert crawl["images"].count() == 1
