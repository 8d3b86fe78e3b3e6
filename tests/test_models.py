"""Model operators checked against closed-form or recomputed numbers."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flurry.operators import encode, explain, models
from flurry.session import cut_lineage


def test_population_scaler_matches_numpy(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 3)) * [1, 5, 0] + [0, 2, 7]  # third column constant
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double")
    p = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="raw"),
                         models.PopulationStandardScaler("raw", "z")]).fit(df)
    Z = np.array([r.z for r in p.transform(df).select(vector_to_array("z").alias("z")).collect()])
    exp = (X - X.mean(0)) / np.where(X.std(0) > 0, X.std(0), 1)
    exp[:, 2] = 0.0
    assert np.allclose(Z, exp, atol=1e-9)


def test_standardize_dataframe_form(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)], "x double, k double")
    out = [(r.x, r.k) for r in encode.standardize(df, ["x", "k"]).collect()]
    s = math.sqrt(2 / 3)
    assert np.allclose(out, [(-1 / s, 0.0), (0.0, 0.0), (1 / s, 0.0)])


def test_encode_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("b",)], "s string")
    assert [r.s for r in encode.encode_categories(df, ["s"]).collect()] == [1, 0, 1, 2, 1]


def _pts(spark, n_min=12, n_maj=60):
    rng = np.random.default_rng(4)
    rows = [(i, 1.0, rng.normal(size=3).tolist()) for i in range(n_min)]
    rows += [(100 + i, 0.0, (rng.normal(size=3) + 5).tolist()) for i in range(n_maj)]
    return spark.createDataFrame(rows, "id long, label double, features array<double>"), rows


def test_smote_points_on_minority_segments(spark):
    df, rows = _pts(spark)
    out = models.smote(df, "label", 1.0, ratio=0.5, k=3, seed=7, id_col="id", vec="features")
    syn = [r for r in out.collect() if r.synthetic]
    assert len(syn) == int(0.5 * 60) - 12
    mins = np.array([r[2] for r in rows if r[1] == 1.0])
    for r in syn:
        x = np.array(r.features)
        # x lies on a segment between two minority points
        best = min(np.linalg.norm(np.cross(x - a, b - a)) / max(np.linalg.norm(b - a), 1e-12)
                   + max(0.0, np.dot(x - a, b - a) / np.dot(b - a, b - a) - 1)
                   + max(0.0, -np.dot(x - a, b - a) / np.dot(b - a, b - a))
                   for i, a in enumerate(mins) for j, b in enumerate(mins) if i != j)
        assert best < 1e-6
    again = models.smote(df, "label", 1.0, ratio=0.5, k=3, seed=7, id_col="id", vec="features")
    assert sorted(map(tuple, (r.features for r in again.collect() if r.synthetic))) == \
        sorted(map(tuple, (r.features for r in syn)))


def test_smote_then_fits_inner_only(spark):
    df, _ = _pts(spark)
    from pyspark.ml.functions import array_to_vector
    d = df.select("id", "label", array_to_vector("features").alias("features"))
    lr = LogisticRegression(maxIter=20)
    est = models.SmoteThen(lr, "label", 1.0, ratio=1.0, k=3, id_col="id")
    m = est.fit(d, {est.ratio: 0.5, lr.maxIter: 5})
    assert m.transform(d).count() == d.count()  # predictions untouched by sampling


def test_grid_search_scores_every_setting(spark):
    df, _ = _pts(spark, 20, 80)
    from pyspark.ml.functions import array_to_vector
    d = df.select("id", "label", array_to_vector("features").alias("features"))
    lr = LogisticRegression(maxIter=10)
    grid = [{lr.regParam: r} for r in (0.0, 0.1)]
    res, best = models.grid_search(lr, grid, d, "label", "id", folds=3, parallelism=2)
    rows = res.collect()
    assert len(rows) == 2 and all(0 <= r.balanced_accuracy <= 1 for r in rows)
    assert set(best) == {"precision", "recall", "f1", "balanced_accuracy"}


def test_rbf_features_approximate_kernel(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(40, 4))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(X)], "i long, f array<double>")
    from pyspark.ml.functions import array_to_vector
    df = df.select("i", array_to_vector("f").alias("features"))
    z = models.RandomFourierFeatures("features", "z", gamma=0.2, dim=4000, seed=1).transform(df)
    Z = np.array([r.z for r in z.orderBy("i").select(vector_to_array("z").alias("z")).collect()])
    K = np.exp(-0.2 * ((X[:, None] - X[None]) ** 2).sum(-1))
    assert np.abs(Z @ Z.T - K).mean() < 0.03


def test_explanations_recover_known_linear_model(spark):
    """Rows are scored by a fixed logistic model with a strong positive weight on
    category 'hot' and a strong negative weight on large x; the explanation
    must give those features the largest weights with those signs."""
    rng = np.random.default_rng(9)
    n = 400
    rows = [(i, str(rng.choice(["hot", "cold", "mild"])), float(rng.normal()), float(rng.normal()))
            for i in range(n)]
    df = spark.createDataFrame(rows, "id long, cat string, x double, noise double")
    df = df.withColumn("label", ((F.col("cat") == "hot").cast("double") * 3 - F.col("x") * 2 > 0.5).cast("double"))
    model = models.fit_classifier(df, ["cat"], ["x", "noise"], LogisticRegression(maxIter=50))
    st = explain.training_stats(df, ["cat"], ["x", "noise"])
    ex = explain.explain(df.where(F.col("id") < 20), model, st, n_samples=800, n_features=3).collect()
    for r in ex:
        e = r.explanation
        assert abs(e["noise"]) < max(abs(e["cat"]), abs(e["x"]))
    hot = [r for r in ex if rows[r.id][1] == "hot"]
    assert all(r.explanation["cat"] > 0 for r in hot)


def test_smote_lsh_neighbours_equal_exact_count(spark):
    df, _ = _pts(spark)
    ex = models.smote(df, "label", 1.0, ratio=0.5, k=3, seed=7, id_col="id", vec="features")
    ap = models.smote(df, "label", 1.0, ratio=0.5, k=3, seed=7, id_col="id", vec="features",
                      neighbours="lsh", lsh={"threshold": 0.5, "bucket_length": 0.5})
    assert ap.where("synthetic").count() == ex.where("synthetic").count() == int(0.5 * 60) - 12


def test_svm_probability_and_poly(spark):
    df, _ = _pts(spark, 30, 60)
    from pyspark.ml.functions import array_to_vector
    d = df.select("id", "label", array_to_vector("features").alias("features"))
    m = Pipeline(stages=models.svm_with_probability(1.0, 90)).fit(d)
    p = [r.p for r in m.transform(d).select(vector_to_array("probability")[1].alias("p")).collect()]
    assert all(0.0 <= x <= 1.0 for x in p) and max(p) > 0.9 and min(p) < 0.1
    poly = models.polynomial_stage(2, "features", "poly").transform(d).first().poly
    assert poly.size == 9  # 3 linear + 6 quadratic terms


def test_logistic_cv_picks_and_refits(spark):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(600):
        c = str(rng.choice(["a", "b", "c"]))
        x = float(rng.normal())
        y = 1.0 if (x + (1.5 if c == "a" else -0.5) + rng.normal() * 0.3) > 0 else 0.0
        rows.append((i, c, x, y))
    df = spark.createDataFrame(rows, "id long, c string, x double, label double")
    m = models.fit_logistic_cv(df, ["c"], ["x"], folds=5, cs=[1e-4, 1.0, 100.0], parallelism=4)
    acc = models._fold_metrics(m.transform(df), "label")["accuracy"]
    assert acc > 0.85
    lr = m.stages[-1]
    assert lr.getRegParam() in (1.0 / (1.0 * 600), 1.0 / (100.0 * 600))  # the weak-penalty Cs win


def _churners(spark, n=240):
    rows = [(i, "abc"[i % 3], float((i * 7) % 31), float((i * 11) % 17), 1.0 if (i * 7) % 31 + (i * 13) % 9 > 18 else 0.0)
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, c string, x double, y double, label double")


def test_logistic_cv_scores_all_models_of_a_fold_in_one_pass(spark, monkeypatch):
    df, seen = _churners(spark).coalesce(1), []
    kind = type(df)
    first = kind.first
    monkeypatch.setattr(kind, "first", lambda self: (seen.append(1), first(self))[1])
    cs = [1e-4, 1.0]
    best = models.fit_logistic_cv(df, ["c"], ["x", "y"], folds=3, cs=cs)
    assert len(seen) == 3
    monkeypatch.undo()
    prep = Pipeline(stages=models.feature_stages(["c"], ["x", "y"])).fit(df)
    data = models.with_stratified_fold(prep.transform(df), "id", "label", 3)
    mean = {}
    for c in cs:
        acc = []
        for f in range(3):
            part = data.where(F.col("fold") != f)
            m = LogisticRegression(maxIter=100, tol=1e-4, standardization=False, regParam=1.0 / (c * part.count())).fit(part)
            acc.append(models._fold_metrics(models.without_summary(m).transform(data.where(F.col("fold") == f)), "label")["accuracy"])
        mean[c] = sum(acc) / 3
    want = max(mean, key=lambda c: (round(mean[c], 12), -c))
    assert best.stages[-1].getRegParam() == pytest.approx(1.0 / (want * 240))


def test_model_comparison_encodes_rows_once_with_the_results_of_separate_fits(spark, monkeypatch):
    svm = models.LinearSVC   # few rounds keep the test short
    monkeypatch.setattr(models, "LinearSVC", lambda **k: svm(**{**k, "maxIter": 3}))
    df = cut_lineage(_churners(spark).coalesce(1))
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    cat, num, n = ["c"], ["x", "y"], 180
    model = models.fit_logistic_cv(train, cat, num, folds=2, cs=[1.0])
    indexed, fit = [], encode.StringIndexer._fit
    monkeypatch.setattr(encode.StringIndexer, "_fit", lambda self, d: (indexed.append(1), fit(self, d))[1])
    got = models.compare_classifiers(model, train, test, cat, num, trees=5, rounds=3, landmarks=20).collect()
    assert not indexed
    stages = models.feature_stages(cat, num, out="features_in")
    want = models.compare({
        "logistic": model,
        "forest": models.fit_classifier(train, cat, num, models.forest(5), one_hot=False),
        "boosted_trees": models.fit_classifier(train, cat, num, models.boosted_trees(0.1, 3), one_hot=False),
        "linear_svm": models.fit_classifier(train, cat, num, models.linear_svm(1.0, n)),
        "rbf_svm": Pipeline(stages=stages + [models.NystromFeatures("features_in", "features", landmarks=20)]
                            + models.svm_with_probability(1.0, n)).fit(train),
        "poly_svm": Pipeline(stages=stages + [models.polynomial_stage(2, "features_in", "features"),
                                              models.linear_svm(1.0, n)]).fit(train)}, train, test).collect()
    assert [tuple(r)[:2] for r in got] == [tuple(r)[:2] for r in want]
    for g, w in zip(got, want):
        assert tuple(g)[2:] == pytest.approx(tuple(w)[2:], abs=1e-9)


def test_encode_keeps_null_as_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "s string")
    assert [r.s for r in encode.encode_categories(df, ["s"]).collect()] == [1, None, 0]


def test_models_score_in_a_session_with_tagged_jobs(spark):
    """Tagging jobs makes the session unserializable; fitted models must not hold it."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from flurry.operators import explain as xp
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.addTag("limit")
    try:
        df = s.createDataFrame([(i, "ab"[i % 2], float(i % 7), float(i % 2)) for i in range(80)], "id long, c string, x double, label double")
        own = Pipeline(stages=models.feature_stages(["c"], ["x"]) + [LogisticRegression(maxIter=5)]).fit(df)   # a user's own fit
        assert models.score(df, own, keep=["id"]).count() == 80 and not own.stages[-1].hasSummary
        cv = models.fit_logistic_cv(df, ["c"], ["x"], folds=2, cs=[1.0], max_iter=5)
        assert len(models.score(df, cv, keep=["id"]).collect()) == 80
        svm = Pipeline(stages=models.feature_stages(["c"], ["x"]) + models.svm_with_probability(1.0, 80, max_iter=5)).fit(df)
        rf = models.fit_classifier(df, ["c"], ["x"], models.forest(3))
        assert models.compare({"svm": svm, "forest": rf}, df, df).count() == 4
        st = xp.training_stats(df, ["c"], ["x"])
        assert len(xp.explain_table(df, cv, st, n_samples=50, n_features=2).collect()) == 80
    finally:
        s.removeTag("limit")


def test_team_pipeline_samples_and_scales_at_fit_only(spark):
    """Nothing of the scored rows reaches the fit: scores of a row do not depend on the others, and the
    fitted scaler has the moments of the sampled training rows."""
    rng = np.random.default_rng(6)
    rows = [(i, float(i % 10 == 0), (rng.normal(size=6) * [1, 5, 9, 2, 3, 4] + (2 if i % 10 == 0 else 0)).tolist()) for i in range(200)]
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame(rows, "id long, label double, a array<double>").select("id", "label", array_to_vector("a").alias("features"))
    model = models.team_pipeline(n=225).fit(df)
    over = models.smote(df, "label", 1.0, ratio=0.25, k=5).select(vector_to_array("features").alias("a")).toPandas()["a"]
    assert np.allclose(model.stages[0].stages[0].mean.toArray(), np.stack(over.to_numpy()).mean(0))
    some = models.score(df.limit(20), model, keep=["id"]).toPandas().set_index("id")["probability_1"]
    every = models.score(df, model, keep=["id"]).toPandas().set_index("id")["probability_1"]
    assert np.allclose(some, every[some.index]) and every.between(0, 1).all()
    lab = df.toPandas().set_index("id")["label"]
    assert every[lab == 1].mean() > every[lab == 0].mean()


def test_smote_refuses_too_few_minority_rows(spark):
    import pytest
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame([(i, float(i < 4), [float(i), 1.0]) for i in range(40)], "id long, label double, a array<double>")
    df = df.select("id", "label", array_to_vector("a").alias("features"))
    with pytest.raises(ValueError, match="more than k = 5"):
        models.smote(df, "label", 1.0, ratio=0.5, k=5)
    assert models.smote(df, "label", 1.0, ratio=0.5, k=5, few="fewer").where("synthetic").count() == 14


def _linear_model(spark, n_num, seed=3):
    """(table with a class column and n_num numbers, model fitted on it, its stats)."""
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(120, n_num))
    names = [f"x{j}" for j in range(n_num)]
    rows = [(i, "abc"[i % 3], *map(float, X[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, c string, " + ", ".join(f"{x} double" for x in names))
    df = df.withColumn("label", ((F.col("x0") * 2 + (F.col("c") == "a").cast("int") - F.col("x1")) > 0.2).cast("double"))
    return df, models.fit_classifier(df, ["c"], names, LogisticRegression(maxIter=20)), explain.training_stats(df, ["c"], names)


def test_explanations_equal_a_plain_weighted_ridge(spark):
    df, model, st = _linear_model(spark, 3)
    feats, n = st.features, 300
    codes, values = explain.draw_samples(st, n, 42)
    ex = explain.explain(df, model, st, n_samples=n, n_features=10).withColumn("order", F.map_keys("explanation"))
    got = {r.id: r for r in ex.collect()}
    data = df.toPandas().set_index("id")
    pool = spark.createDataFrame([(s, *[values[c][s].item() if c != "c" else str(values[c][s]) for c in feats]) for s in range(n)],
                                 "s long, " + ", ".join(f"{c} {'string' if c == 'c' else 'double'}" for c in feats))
    p = models.score(pool, model, "p", keep=["s"]).toPandas().set_index("s")["p"].sort_index().to_numpy()
    own_p = models.score(df, model, "p", keep=["id"]).toPandas().set_index("id")["p"]
    assert len(got) == 120
    for rid in range(0, 120, 11):
        row = data.loc[rid]
        own = [st.classes["c"][0].index(row["c"])] + [sum(row[c] > q for q in st.quartiles[c]) for c in st.numeric]
        Z = (codes == np.array(own)).astype(float)
        Z[0] = 1
        y = p.copy()
        y[0] = own_p[rid]
        w = np.sqrt(np.exp(-((1 - Z) ** 2).sum(1) / (0.75 * 2) ** 2))   # width 0.75 * sqrt(4 features)
        A = np.column_stack([Z, np.ones(n)])
        beta = np.linalg.solve(A.T @ (A * w[:, None]) + np.diag([1.0] * 4 + [0.0]), A.T @ (w * y))
        r = got[rid]
        assert r.probability == pytest.approx(own_p[rid])
        assert [r.explanation[c] for c in feats] == pytest.approx(beta[:4].tolist(), abs=1e-9)
        assert r.intercept == pytest.approx(beta[4], abs=1e-9) and r.local_pred == pytest.approx(beta.sum(), abs=1e-9)
        res, dev = y - A @ beta, y - np.average(y, weights=w)
        assert r.score == pytest.approx(1 - (w @ res ** 2) / (w @ dev ** 2), abs=1e-9)
        assert r.order == sorted(r.explanation, key=lambda c: -abs(r.explanation[c]))


def test_explanations_of_many_features_repeated_ids_and_extra_columns(spark):
    df, model, st = _linear_model(spark, 70)
    twice = df.unionByName(df).withColumn("explanation", F.lit("mine")).withColumn("order", F.lit(1))
    got = explain.with_explanations(twice, model, st, n_samples=400, n_features=8)
    assert "order" in got.columns and got.columns.count("explanation") == 1
    rows = got.collect()
    assert len(rows) == 240 and all(len(r.explanation) == 8 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append(r.explanation)
    assert all(a == b for a, b in by.values())
    assert explain.explain(df.limit(0), model, st, n_samples=50).collect() == []


def test_what_if_and_log_of_dirty_requests(spark):
    df, model, st = _linear_model(spark, 2)
    wi = explain.what_if(df.where("id < 5"), model, st).collect()
    assert len(wi) == 5 * (3 + 3 + 3) and {r.feature for r in wi} == {"c", "x0", "x1"}
    base = {r.id: r.p for r in models.score(df, model, "p", keep=["id"]).collect()}
    assert all(r.base_probability == pytest.approx(base[r.id]) and r.delta == pytest.approx(r.probability - base[r.id]) for r in wi)
    own = {r.id: r.c for r in df.collect()}
    assert all(abs(r.delta) < 1e-12 for r in wi if r.feature == "c" and r.value == own[r.id])
    from flurry.operators.summary import default_row
    req = df.select("id", "c", F.when(F.col("id") == 1, "n/a").otherwise(F.col("x0").cast("string")).alias("x0"),
                    F.col("x1").cast("string").alias("x1"))
    log = explain.score_log(req, model, st, default_row(df, ["c"], ["x0", "x1"]), 100, schema=df.schema).collect()
    assert len({r.uuid for r in log}) == 120 and all(len(r.explanation) == 3 for r in log)
    assert all(r.probability == pytest.approx(base[r.id]) for r in log if r.id != 1)
    with pytest.raises(KeyError):
        explain.score_log(req.withColumn("unknown", F.lit(1)), model, schema=df.schema)


def test_nystrom_features_are_the_kernel_and_save_with_the_model(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(8)
    X = rng.normal(size=(50, 3)) * [1, 2, 4]
    y = (np.linalg.norm(X / [1, 2, 4], axis=1) > 1.5).astype(float)   # a ring: not linear
    rows = [(i, float(y[i]), X[i].tolist()) for i in range(50)]
    df = spark.createDataFrame(rows + [(100 + i, float(y[0]), X[0].tolist()) for i in range(60)], "id long, label double, a array<double>")
    df = df.select("id", "label", array_to_vector("a").alias("features"))
    every = np.vstack([X, np.repeat(X[:1], 60, axis=0)])

    def gram(m):
        z = m.transform(df).orderBy("id").select(vector_to_array(m.getOutputCol()).alias("z")).collect()
        Z = np.array([r.z for r in z])
        return Z @ Z.T

    for gamma, value in (("scale", 1 / (3 * every.var())), ("auto", 1 / 3), (0.05, 0.05)):
        m = models.NystromFeatures("features", "z", gamma, landmarks=60).fit(df)
        K = np.exp(-value * ((every[:, None] - every[None]) ** 2).sum(-1))
        assert len(m.getOrDefault(m.landmarks)) == 50 and np.abs(gram(m) - K).max() < 1e-6   # copies are one landmark
    few = models.NystromFeatures("features", "z", 0.05, landmarks=25).fit(df)
    assert 1e-6 < np.abs(gram(few) - K).max() and np.abs(gram(few) - K).mean() < 0.1
    svm = Pipeline(stages=[models.NystromFeatures("features", "kernel", "auto")] + models.svm_with_probability(10.0, 110, features="kernel")).fit(df)
    assert models._fold_metrics(svm.transform(df), "label")["accuracy"] > 0.9
    team = models.team_pipeline(n=110, components=3, k=3).fit(df)
    for name, m in (("svm", svm), ("team", team)):
        path = str(tmp_path / name)
        m.write().overwrite().save(path)
        again = PipelineModel.load(path)
        a = models.score(df, m, "p", keep=["id"]).orderBy("id").collect()
        assert a == models.score(df, again, "p", keep=["id"]).orderBy("id").collect()
    for bad in (dict(gamma="wide"), dict(gamma=0), dict(landmarks=0)):
        with pytest.raises(ValueError):
            models.NystromFeatures(**bad)
    with pytest.raises(ValueError, match="no rows"):
        models.NystromFeatures("features", "z").fit(df.limit(0))


def test_fits_on_all_features_are_the_row_by_row_fits():
    from flurry.operators import explain as xp
    rng = np.random.default_rng(9)
    Z, y, w = rng.integers(0, 2, size=(2, 60, 4)).astype(float), rng.uniform(size=60), rng.uniform(size=60)
    m = [xp._moments(z, y, w) for z in Z]
    of, p = rng.integers(0, 2, size=30), rng.uniform(size=30)
    got = xp._fit_all([xp._affine(x) for x in m], of, p, ["order", "weights", "intercept", "score", "local_pred"])
    for i in range(30):
        coef, icpt, r2 = xp._solve(xp._gram(m[of[i]], p[i]), [0, 1, 2, 3], xp.RIDGE_ALPHA)
        rank = np.argsort(-np.abs(coef), kind="stable")
        assert list(got["order"][i]) == list(rank) and np.allclose(got["weights"][i], coef[rank], atol=1e-12)
        assert np.allclose([got["intercept"][i], got["score"][i], got["local_pred"][i]], [icpt, r2, icpt + coef.sum()], atol=1e-10)
