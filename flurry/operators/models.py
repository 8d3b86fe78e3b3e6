"""Models: pipelines, cross-validated fits, SMOTE, grid search, scoring.

Every fit is a distributed ``pyspark.ml`` fit; the driver only loops over
parameter settings and folds and reads back a handful of metric numbers.
Folds come from key hashes within each label
(``sampling.with_stratified_fold``), so they are the same on every run and
cluster size.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flurry.operators.encode import indexer_stages, one_hot_stage
from flurry.operators.sampling import with_stratified_fold
from flurry.operators.vectors import knn
from flurry.operators.windows import positions

# --- scaling -------------------------------------------------------------------


class PopulationStandardScaler(Estimator, HasInputCol, HasOutputCol):
    """(x - mean) / population std per vector element (M3 inside a pipeline).

    Spark's ``StandardScaler`` divides by the sample std; multiplying its
    output by sqrt(n / (n - 1)) gives the population form. Zero-variance
    elements stay 0. The fitted model is a plain ``PipelineModel`` of
    built-in stages, so it saves and loads without this class.
    """

    def __init__(self, inputCol: str = "features_raw", outputCol: str = "features"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _fit(self, df: DataFrame) -> PipelineModel:
        tmp = self.getOutputCol() + "_sample_std"
        ss = StandardScaler(inputCol=self.getInputCol(), outputCol=tmp, withMean=True,
                            withStd=True).fit(df)
        n = df.count()
        f = math.sqrt(n / (n - 1)) if n > 1 else 1.0
        ep = ElementwiseProduct(inputCol=tmp, outputCol=self.getOutputCol(),
                                scalingVec=DenseVector([f] * len(ss.mean)))
        return PipelineModel([ss, ep])


def feature_stages(categorical: list[str], numeric: list[str], out: str = "features",
                   scale: bool = True, one_hot: bool = True) -> list:
    """Alphabetical index -> one-hot (all classes) -> assemble (encoded
    first, numeric after) -> population-std scaling of every element."""
    stages = indexer_stages(categorical)
    if one_hot:
        stages.append(one_hot_stage(categorical))
        cols = [c + "_oh" for c in categorical] + numeric
    else:
        cols = [c + "_idx" for c in categorical] + numeric
    raw = out + "_raw" if scale else out
    stages.append(VectorAssembler(inputCols=cols, outputCol=raw, handleInvalid="error"))
    if scale:
        stages.append(PopulationStandardScaler(raw, out))
    return stages


def with_label(df: DataFrame, label: str, positive="Yes", out: str = "label") -> DataFrame:
    """0/1 double label, positive class = 1 (sorted class order: 'No' < 'Yes')."""
    return df.withColumn(out, (F.col(label) == F.lit(positive)).cast("double"))


# --- fitted models without their training summary ----------------------------------


def without_summary(model):
    """The fitted model (stage by stage for a pipeline) without its training summary.

    In Spark 4.1 the summary of a binary classifier holds the SparkSession, and
    the session cannot be serialized once jobs have been tagged in it
    (``spark.addTag``, as time limits do). Scoring ships the model to the
    executors, so every later ``transform`` would fail. Only the metrics of the
    fit on its own training rows go; the model is the same.
    """
    if isinstance(model, PipelineModel):
        for stage in model.stages:
            without_summary(stage)
    elif getattr(model, "hasSummary", False) and hasattr(model, "_java_obj"):
        empty = SparkSession.active().sparkContext._jvm.scala.Option.empty()
        model._java_obj.setSummary(empty)
    return model


class WithoutSummary(Estimator):
    """Fits the inner estimator and drops the summary at once: for a stage whose
    output a later stage of the same pipeline is fitted on."""

    def __init__(self, inner: Estimator):
        super().__init__()
        self.inner = inner

    def copy(self, extra=None):
        return WithoutSummary(self.inner.copy(extra))

    def _fit(self, df: DataFrame) -> Model:
        return without_summary(self.inner.fit(df))


# --- logistic regression with CV (M4) --------------------------------------------


def c_grid(n_values: int = 10, lo: float = -4, hi: float = 4) -> list[float]:
    """Inverse-regularisation values C, log-spaced from 1e-4 to 1e4."""
    return [float(c) for c in np.logspace(lo, hi, n_values)]


def fit_logistic_cv(train: DataFrame, categorical: list[str], numeric: list[str],
                    label: str = "label", id_col: str = "id", folds: int = 5,
                    cs: list[float] | None = None, max_iter: int = 100, tol: float = 1e-4,
                    parallelism: int = 8, persist: bool = True) -> PipelineModel:
    """Encode + scale + logistic regression whose C is chosen by mean fold
    accuracy, then refit on all training rows (M4).

    sklearn's C weighs the summed loss; Spark's ``regParam`` the mean loss,
    so a fit on m rows uses ``regParam = 1 / (C · m)``: each fold fit with its
    own training-row count, the final refit with all rows. L2 only; no
    internal standardisation since the features are already scaled;
    ``tol`` 1e-4 and 100 iterations as in the reference's fit. Fold fits run
    concurrently from a thread pool; each one is a distributed fit. The
    models of a fold then score its rows together, in one pass.
    """
    prep = Pipeline(stages=feature_stages(categorical, numeric)).fit(train)
    data = with_stratified_fold(prep.transform(train).select(id_col, "features", label), id_col, label, folds)
    if persist:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r["fold"]: r["n"] for r in data.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    grid = cs or c_grid()

    def lr(reg: float) -> LogisticRegression:
        return LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, tol=tol,
                                  standardization=False, elasticNetParam=0.0, regParam=reg)

    def run(job):
        ci, f = job
        m = n - sizes.get(f, 0)
        return without_summary(lr(1.0 / (grid[ci] * m)).fit(data.where(F.col("fold") != f)))

    def score_fold(f):
        pred, names = data.where(F.col("fold") == f), []
        for ci in range(len(grid)):
            names.append(f"prediction_{ci}")
            m = fitted[ci, f].copy().setRawPredictionCol(f"raw_{ci}").setProbabilityCol("")
            pred = m.setPredictionCol(names[-1]).transform(pred)
        return [(ci, m["accuracy"]) for ci, m in enumerate(_fold_metrics_of(pred, label, names))]

    jobs = [(ci, f) for ci in range(len(grid)) for f in range(folds) if sizes.get(f)]
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(jobs)))) as pool:
        fitted = dict(zip(jobs, pool.map(run, jobs)))
        scores = [x for fold in pool.map(score_fold, [f for f in range(folds) if sizes.get(f)]) for x in fold]
    mean = {ci: float(np.mean([a for c, a in scores if c == ci])) for ci in range(len(grid))}
    best_c = grid[max(mean, key=lambda ci: (mean[ci], -ci))]   # ties: the smaller C
    best = without_summary(lr(1.0 / (best_c * n)).fit(data))
    if persist:
        data.unpersist()
    return PipelineModel(prep.stages + [best])


def fit_classifier(train: DataFrame, categorical: list[str], numeric: list[str], classifier,
                   scale: bool = True, one_hot: bool = True) -> PipelineModel:
    """Encode (+ scale) + any Spark classifier, fitted once (M5, M6, M8)."""
    return without_summary(Pipeline(stages=feature_stages(categorical, numeric, scale=scale, one_hot=one_hot)
                                    + [classifier]).fit(train))


def forest(num_trees: int = 100, impurity: str = "gini", max_features: str | None = "sqrt",
           weight_col: str | None = None, seed: int = 42, label: str = "label") -> RandomForestClassifier:
    """Random forest (M5). max_features None -> 'all'; 'log_loss' -> 'entropy'."""
    imp = "entropy" if impurity in ("entropy", "log_loss") else "gini"
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, impurity=imp,
                                featureSubsetStrategy=max_features or "all", seed=seed)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def boosted_trees(step_size: float = 0.1, max_iter: int = 100, seed: int = 42,
                  label: str = "label", weight_col: str | None = None) -> GBTClassifier:
    """Gradient-boosted trees (M6); Spark accepts step sizes in (0, 1] only."""
    if not 0 < step_size <= 1:
        raise ValueError("stepSize must be in (0, 1]")
    g = GBTClassifier(featuresCol="features", labelCol=label, stepSize=step_size, maxIter=max_iter, seed=seed)
    if weight_col:
        g.setWeightCol(weight_col)
    return g


def linear_svm(c: float, n: int, weight_col: str | None = None, label: str = "label",
               features: str = "features", max_iter: int = 100) -> LinearSVC:
    """Linear SVM (M8) with sklearn's C: regParam = 1 / (C · n)."""
    s = LinearSVC(featuresCol=features, labelCol=label, regParam=1.0 / (c * n), maxIter=max_iter,
                  standardization=False)
    if weight_col:
        s.setWeightCol(weight_col)
    return s


def svm_with_probability(c: float, n: int, weight_col: str | None = None, label: str = "label",
                         features: str = "features", max_iter: int = 100) -> list:
    """Linear SVM whose margin is turned into a probability by a logistic
    fit on the margin (Platt, 1999), for SVMs asked to give probabilities
    (M9). Stages: SVM (margin in ``svm_raw``) -> margin slice -> logistic
    regression producing ``probability`` and ``prediction``."""
    from pyspark.ml.feature import VectorSlicer
    svm = linear_svm(c, n, weight_col, label, features, max_iter)
    svm.setPredictionCol("svm_prediction").setRawPredictionCol("svm_raw")
    return [WithoutSummary(svm), VectorSlicer(inputCol="svm_raw", outputCol="svm_margin", indices=[1]),
            WithoutSummary(LogisticRegression(featuresCol="svm_margin", labelCol=label, maxIter=max_iter))]


def polynomial_stage(degree: int, input_col: str = "features", output_col: str = "poly"):
    """Explicit polynomial features of the given degree: a linear SVM on
    them is a polynomial-kernel SVM (M9, poly kernel)."""
    from pyspark.ml.feature import PolynomialExpansion
    return PolynomialExpansion(degree=degree, inputCol=input_col, outputCol=output_col)


def pca_stage(k: int, input_col: str = "features", output_col: str = "pca") -> PCA:
    """PCA to k components (M10). Spark does not centre: scale first."""
    return PCA(k=k, inputCol=input_col, outputCol=output_col)


# --- RBF kernel approximation (M9) ---------------------------------------------------


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """z(x) = sqrt(2/D) · cos(W x + b), W ~ N(0, 2γ), b ~ U[0, 2π) (Rahimi &
    Recht, 2007): a linear model on z approximates an RBF-kernel SVM. W is
    D x d, regenerated from the seed on each worker (d read from the data),
    so it is sized by parameters, not by the data, and never shipped.
    Computed in Arrow batches with one numpy matrix product per batch."""

    gamma = Param(Params._dummy(), "gamma", "RBF gamma", TypeConverters.toFloat)
    dim = Param(Params._dummy(), "dim", "number of random features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    def __init__(self, inputCol="features", outputCol="rff", gamma=0.1, dim=200, seed=42):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, gamma=gamma, dim=dim, seed=seed)

    def _transform(self, df: DataFrame) -> DataFrame:
        D, gamma, seed = self.getOrDefault(self.dim), self.getOrDefault(self.gamma), self.getOrDefault(self.seed)
        scale = math.sqrt(2.0 / D)
        cache: dict = {}

        def weights(d):
            if d not in cache:
                rng = np.random.default_rng(seed)
                cache[d] = (rng.normal(0.0, math.sqrt(2.0 * gamma), size=(D, d)),
                            rng.uniform(0.0, 2.0 * math.pi, size=D))
            return cache[d]

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def rff(x: pd.Series) -> pd.Series:
            if len(x) == 0:
                return pd.Series([], dtype=object)
            X = np.stack(x.to_numpy())
            W, b = weights(X.shape[1])
            return pd.Series(list(scale * np.cos(X @ W.T + b)))

        arr = vector_to_array(F.col(self.getInputCol()))
        return df.withColumn(self.getOutputCol(), array_to_vector(rff(arr)))


class NystromModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """z(x) = k(x, L) · K(L, L)^(-1/2) for landmarks L and the RBF kernel k: z·z' is
    the kernel itself between landmarks. Landmarks and gamma are params, so
    the model saves and loads with its pipeline."""

    gamma = Param(Params._dummy(), "gamma", "RBF gamma", TypeConverters.toFloat)
    landmarks = Param(Params._dummy(), "landmarks", "one vector a landmark", TypeConverters.toList)

    def __init__(self, inputCol="features", outputCol="kernel", gamma=1.0, landmarks=()):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, gamma=gamma, landmarks=list(landmarks))

    def _transform(self, df: DataFrame) -> DataFrame:
        gamma, land = self.getOrDefault(self.gamma), np.asarray(self.getOrDefault(self.landmarks), dtype=float)
        root: list = []

        def kernel(X):
            d2 = (X * X).sum(1)[:, None] + (land * land).sum(1)[None, :] - 2.0 * X @ land.T
            return np.exp(-gamma * np.maximum(d2, 0.0))

        def half():
            if not root:   # once a worker
                e, U = np.linalg.eigh(kernel(land))
                # directions at rounding level carry no kernel
                root.append(U * np.where(e > 1e-12 * e[-1], 1.0 / np.sqrt(np.maximum(e, 1e-300)), 0.0))
            return root[0]

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def features(x: pd.Series) -> pd.Series:
            if len(x) == 0:
                return pd.Series([], dtype=object)
            return pd.Series(list(kernel(np.stack(x.to_numpy())) @ half()))

        arr = vector_to_array(F.col(self.getInputCol()))
        return df.withColumn(self.getOutputCol(), array_to_vector(features(arr)))


class NystromFeatures(Estimator, HasInputCol, HasOutputCol):
    """RBF kernel features from landmark rows (Williams & Seeger, 2001): a linear
    SVM on them is a kernel SVM, exact once every distinct row is a landmark.

    ``gamma``: a number, ``"scale"`` (1 / (features · variance of all entries)) or
    ``"auto"`` (1 / features). The landmarks are the ``landmarks`` distinct rows
    with the smallest seeded hashes: a bounded sample that does not depend
    on partitioning or on how often a row is repeated."""

    def __init__(self, inputCol="features", outputCol="kernel", gamma="scale", landmarks=200, seed=42):
        super().__init__()
        if not (gamma in ("scale", "auto") or isinstance(gamma, (int, float)) and gamma > 0):
            raise ValueError(f"gamma must be 'scale', 'auto' or a positive number, not {gamma!r}")
        if landmarks < 1:
            raise ValueError("at least one landmark")
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.gamma, self.landmarks, self.seed = gamma, landmarks, seed

    def _fit(self, df: DataFrame) -> NystromModel:
        rows = df.select(vector_to_array(F.col(self.getInputCol())).alias("a")).where(F.col("a").isNotNull())
        rows = rows.withColumn("h", F.xxhash64("a", F.lit(self.seed)))
        land = [r["a"] for r in rows.dropDuplicates(["h"]).orderBy("h").limit(self.landmarks).collect()]
        if not land:
            raise ValueError("no rows to take landmarks from")
        gamma, d = self.gamma, len(land[0])
        if gamma == "scale":
            var = rows.select(F.explode("a").alias("x")).agg(F.var_pop("x")).first()[0]
            gamma = 1.0 / (d * var) if var > 0 else 1.0
        elif gamma == "auto":
            gamma = 1.0 / d
        return NystromModel(self.getInputCol(), self.getOutputCol(), float(gamma), land)


# --- SMOTE (M11) ----------------------------------------------------------------------


def _unit(*parts) -> "F.Column":
    """Deterministic uniform [0, 1) from a hash of the parts."""
    h = F.xxhash64(*parts)
    return (F.pmod(h, F.lit(1 << 52)).cast("double") / float(1 << 52))


def _minority_neighbours(pts: DataFrame, kk: int, neighbours: str, lsh: dict | None) -> DataFrame:
    """(_id, _r, _nb): the kk nearest other minority points of each point.

    ``exact``: blocked kNN. ``lsh``: random-projection LSH first; points with
    fewer than kk candidates found get their neighbours from the exact
    search, so every point ends with exactly kk (no row is lost)."""
    if neighbours == "exact":
        nn = knn(pts, pts, kk, "_id", "_id", "_arr", "_arr", exclude_self=True)
        return nn.select(F.col("q").alias("_id"), F.col("rank").alias("_r"), F.col("b").alias("_nb"))
    from flurry.operators.vectors import knn_approx
    opts = dict(threshold=None, bucket_length=1.0, num_hash_tables=4)
    opts.update(lsh or {})
    ap = knn_approx(pts, pts, kk, opts["threshold"], "_id", "_arr", opts["bucket_length"],
                    opts["num_hash_tables"], exclude_self=True)
    # a threshold may leave too few
    full = ap.groupBy("q").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") == kk).select("q")
    short = pts.join(full.withColumnRenamed("q", "_id"), "_id", "left_anti")
    exact = knn(short, pts, kk, "_id", "_id", "_arr", "_arr", exclude_self=True)
    good = ap.join(full, "q", "left_semi")
    both = good.select("q", "b", "rank").unionByName(exact.select("q", "b", "rank"))
    return both.select(F.col("q").alias("_id"), F.col("rank").alias("_r"), F.col("b").alias("_nb"))


def smote(df: DataFrame, label: str, minority, ratio: float = 1.0, k: int = 5, seed: int = 42,
          id_col: str = "id", vec: str = "features", neighbours: str = "exact",
          lsh: dict | None = None, few: str = "raise") -> DataFrame:
    """Synthetic minority rows x + u·(neighbour − x) (M11, Chawla et al. 2002).

    Adds int(ratio · n_majority) − n_minority rows, spread evenly over the
    minority rows (each gets floor or ceil of the share, in id order);
    the neighbour (one of the k nearest other minority rows) and the gap u
    come from a seeded hash, so the result is reproducible. ``vec`` may be a
    vector or an array column; output rows carry ``synthetic = true`` and a
    null ``id_col``. Neighbours come from the blocked exact kNN (no minority
    x minority pairs are materialised), or with ``neighbours="lsh"`` from
    LSH backed by the exact search where LSH finds too few.

    k or fewer minority rows are an error; with ``few="fewer"`` the neighbours
    are then all other minority rows.
    """
    is_vec = not isinstance(df.schema[vec].dataType, T.ArrayType)
    arr = vector_to_array(F.col(vec)) if is_vec else F.col(vec).cast("array<double>")
    base = df.withColumn("_arr", arr)
    mino = base.where(F.col(label) == F.lit(minority))
    n_min = mino.count()
    n_maj = base.where(F.col(label) != F.lit(minority)).count()
    n_new = int(ratio * n_maj) - n_min
    out = df.withColumn("synthetic", F.lit(False))
    if n_new <= 0:
        return out
    kk = min(k, n_min - 1) if few == "fewer" else k
    if n_min <= kk or kk < 1:
        raise ValueError(f"SMOTE needs more than k = {k} minority rows, found {n_min}")
    pts = mino.select(F.col(id_col).alias("_id"), "_arr")
    nn = _minority_neighbours(pts, kk, neighbours, lsh)
    numbered = positions(pts.select("_id"), [], ["_id"], "_pos")
    per, extra = divmod(n_new, n_min)
    reps = numbered.select("_id", (F.lit(per) + (F.col("_pos") < extra).cast("int")).alias("_n")).where(
        F.col("_n") > 0)
    draws = reps.select("_id", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_j"))
    draws = draws.withColumn("_r", (F.pmod(F.xxhash64("_id", "_j", F.lit(seed)), F.lit(kk)) + 1).cast("int"))
    draws = draws.withColumn("_u", _unit("_id", "_j", F.lit(seed + 1)))
    src = pts.withColumnRenamed("_arr", "_x")
    nbv = pts.select(F.col("_id").alias("_nb"), F.col("_arr").alias("_y"))
    syn = (draws.join(nn, ["_id", "_r"]).join(src, "_id").join(nbv, "_nb")
           .select("_id", "_j", F.zip_with("_x", "_y", lambda a, c: a + F.col("_u") * (c - a)).alias("_s")))
    syn_vec = array_to_vector(F.col("_s")) if is_vec else F.col("_s").cast(df.schema[vec].dataType)
    cols = []
    for f in df.schema.fields:
        if f.name == vec:
            cols.append(syn_vec.alias(vec))
        elif f.name == label:
            cols.append(F.lit(minority).cast(f.dataType).alias(label))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return out.unionByName(syn.select(*cols, F.lit(True).alias("synthetic")))


class SmoteThen(Estimator):
    """Oversample with SMOTE, then fit the inner estimator (fit only; the
    returned model is the inner model, so predictions are untouched). Used
    inside CV so sampling happens within each training fold; with a
    ``Pipeline`` as inner estimator its scaler and PCA see the sampled training
    fold only. ``ratio`` is a Param, so a grid can search it together with the
    inner estimator's params. ``weight_col`` names a column of balanced class
    weights, rows / (classes * rows of the class), added after the sampling."""

    ratio = Param(Params._dummy(), "ratio", "minority / majority after sampling", TypeConverters.toFloat)

    def __init__(self, inner: Estimator, label: str = "label", minority: float = 1.0,
                 ratio: float = 1.0, k: int = 5, seed: int = 42, id_col: str = "id",
                 vec: str = "features", weight_col: str | None = None, few: str = "raise"):
        super().__init__()
        self.inner, self.label, self.minority, self.few = inner, label, minority, few
        self.k, self.seed, self.id_col, self.vec, self.weight_col = k, seed, id_col, vec, weight_col
        self._set(ratio=ratio)

    def copy(self, extra=None):
        """Route grid values: ``ratio`` to this wrapper, the rest to the inner estimator."""
        extra = dict(extra or {})
        own = {p.name: v for p, v in extra.items() if p.parent == self.uid}
        rest = {p: v for p, v in extra.items() if p.parent != self.uid}
        return SmoteThen(self.inner.copy(rest), self.label, self.minority,
                         own.get("ratio", self.getOrDefault(self.ratio)), self.k, self.seed,
                         self.id_col, self.vec, self.weight_col, self.few)

    def _fit(self, df: DataFrame) -> Model:
        over = smote(df, self.label, self.minority, self.getOrDefault(self.ratio), self.k, self.seed,
                     self.id_col, self.vec, few=self.few).drop("synthetic")
        if self.weight_col:
            n = {r[0]: r["n"] for r in over.groupBy(self.label).agg(F.count(F.lit(1)).alias("n")).collect()}
            total = sum(n.values())
            weight = F.element_at(F.create_map(*[F.lit(x) for c in sorted(n) for x in (c, total / (len(n) * n[c]))]), F.col(self.label))
            over = over.withColumn(self.weight_col, weight)
        return without_summary(self.inner.fit(over))


def team_pipeline(features: str = "features", label: str = "label", n: int = 1000, components: int = 5, c: float = 1.0,
                  gamma: float = 0.001, ratio: float = 0.25, k: int = 5, seed: int = 42, dim: int = 200) -> SmoteThen:
    """The production team model: SMOTE (fit only) -> scaler -> PCA -> RBF support vector machine with
    balanced class weights and probabilities. ``n``: rows the SVM is fitted on (for its C)."""
    stages = [PopulationStandardScaler(features, "scaled"), pca_stage(components, "scaled", "pca"),
              RandomFourierFeatures("pca", "kernel", gamma=gamma, dim=dim, seed=seed),
              *svm_with_probability(c, n, "class_weight", label, "kernel")]
    return SmoteThen(Pipeline(stages=stages), label, 1.0, ratio, k, seed, "id", features, "class_weight")


# --- grid search with several scores (M12) ------------------------------------------------

_SCORES = ("accuracy", "precision", "recall", "f1", "balanced_accuracy")


def _fold_metrics(pred: DataFrame, label: str) -> dict:
    """All scores of one validation fold from one confusion aggregate."""
    return _fold_metrics_of(pred, label, ["prediction"])[0]


def _fold_metrics_of(pred: DataFrame, label: str, predictions: list[str]) -> list[dict]:
    """All scores of several prediction columns from one aggregate."""
    cells = (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))
    r = pred.agg(*[F.count_if((F.col(label) == y) & (F.col(p) == z)).alias(f"{c}_{i}")
                   for i, p in enumerate(predictions) for c, y, z in cells]).first()
    return [_scores(*[r[f"{c}_{i}"] for c, _, _ in cells]) for i in range(len(predictions))]


def _scores(tp: int, fp: int, fn: int, tn: int) -> dict:
    n = tp + fp + fn + tn
    prec = tp / (tp + fp) if tp + fp else 0.0
    rec = tp / (tp + fn) if tp + fn else 0.0
    spec = tn / (tn + fp) if tn + fp else 0.0
    f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
    present = [x for x, m in ((rec, tp + fn), (spec, tn + fp)) if m]
    return {"accuracy": (tp + tn) / n if n else 0.0, "precision": prec, "recall": rec, "f1": f1,
            "balanced_accuracy": sum(present) / len(present) if present else 0.0}


def grid_search(estimator: Estimator, grid: list[dict], data: DataFrame, label: str = "label",
                id_col: str = "id", folds: int = 5, scores=("precision", "recall", "f1", "balanced_accuracy"),
                parallelism: int = 4, refit: bool = True):
    """Fit each (parameter setting, fold) once, score it every way, pick the
    best setting per score and refit it on all rows (M12).

    ``estimator`` is any Estimator (a ``Pipeline`` or ``SmoteThen``); ``grid``
    a list of param maps. Returns (results DataFrame of mean scores per
    setting, {score: (best index, fitted model)}). Jobs for different
    settings run concurrently from a thread pool; each fit is distributed.
    """
    spark = data.sparkSession
    d = with_stratified_fold(data, id_col, label, folds).persist(StorageLevel.MEMORY_AND_DISK)

    def run(ix_pm):
        ix, pm = ix_pm
        per_fold = []
        for f in range(folds):
            m = without_summary(estimator.fit(d.where(F.col("fold") != f), pm))
            per_fold.append(_fold_metrics(m.transform(d.where(F.col("fold") == f)), label))
        return ix, {s: float(np.mean([x[s] for x in per_fold])) for s in _SCORES}

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = dict(pool.map(run, list(enumerate(grid))))
    rows = [(ix, str({p.name: v for p, v in grid[ix].items()}), *[results[ix][s] for s in _SCORES])
            for ix in sorted(results)]
    res_df = spark.createDataFrame(rows, "setting int, params string, " + ", ".join(f"{s} double" for s in _SCORES))
    best = {}
    for s in scores:
        ix = max(results, key=lambda i: (results[i][s], -i))
        best[s] = (ix, without_summary(estimator.fit(d, grid[ix])) if refit else None)
    d.unpersist()
    return res_df, best


# --- scoring and comparison (M13, M14) ---------------------------------------------------------


def score(df: DataFrame, model: Transformer, out: str = "probability_1", keep: list[str] | None = None) -> DataFrame:
    """P(class 1) per row (M13): ``vector_to_array(probability)[1]``."""
    scored = without_summary(model).transform(df)
    p = vector_to_array(F.col("probability"))[1].alias(out)
    cols = keep if keep is not None else df.columns
    return scored.select(*cols, p, F.col("prediction"))


def compare(models: dict, train: DataFrame, test: DataFrame, label: str = "label", parallelism: int = 4) -> DataFrame:
    """Train and test accuracy of several fitted models (M14), each scored in
    one pass a part; passes run concurrently from a thread pool."""
    def run(job):
        name, part, d = job
        met = _fold_metrics(models[name].transform(d), label)
        return (name, part, met["accuracy"], met["precision"], met["recall"], met["f1"], met["balanced_accuracy"])

    for m in models.values():
        without_summary(m)
    jobs = [(name, part, d) for name in models for part, d in (("train", train), ("test", test))]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(run, jobs))
    return train.sparkSession.createDataFrame(
        rows, "model string, part string, accuracy double, precision double, recall double, f1 double, "
              "balanced_accuracy double")


def compare_classifiers(logistic: PipelineModel, train: DataFrame, test: DataFrame, categorical: list[str],
                        numeric: list[str], label: str = "label", trees: int = 100, rounds: int = 100,
                        landmarks: int = 200, parallelism: int = 2) -> DataFrame:
    """The fitted logistic pipeline beside a forest, boosted trees and linear,
    RBF and polynomial SVMs, fitted on the same training rows and compared (M14).

    Rows are encoded once for all fits and scores, by the logistic pipeline's
    own fitted stages; trees split on class codes, as the reference encodes
    them. Kernel features, the only ones made in Python, are kept while the SVM
    and its probabilities are fitted and the training rows scored. Fits run
    ``parallelism`` at a time, as a fit of many rounds leaves cores idle.
    """
    one_hot = PipelineModel(logistic.stages[:-1])
    codes = Pipeline(stages=[VectorAssembler(inputCols=[c + "_idx" for c in categorical] + numeric,
                                             outputCol="codes_raw", handleInvalid="error"),
                             PopulationStandardScaler("codes_raw", "codes")])
    codes = codes.fit(one_hot.transform(train))

    def encoded(df):
        return codes.transform(one_hot.transform(df)).select(label, "features", "codes").persist(
            StorageLevel.MEMORY_AND_DISK)

    tr, te = encoded(train), encoded(test)
    n = tr.count()

    def fit(*stages):
        return without_summary(Pipeline(stages=list(stages)).fit(tr))

    def rbf():
        kernel = NystromFeatures("features", "kernel", gamma="scale", landmarks=landmarks).fit(tr)
        ktr = kernel.transform(tr).select(label, "kernel").persist(StorageLevel.MEMORY_AND_DISK)
        svm = Pipeline(stages=svm_with_probability(1.0, n, label=label, features="kernel")).fit(ktr)
        out = compare({"rbf_svm": svm}, ktr, kernel.transform(te), label)
        ktr.unpersist()
        return out

    fits = {"boosted_trees": lambda: fit(boosted_trees(0.1, rounds, label=label).setFeaturesCol("codes")),
            "forest": lambda: fit(forest(trees, label=label).setFeaturesCol("codes")),
            "linear_svm": lambda: fit(linear_svm(1.0, n, label=label)),
            "poly_svm": lambda: fit(polynomial_stage(2, "features", "poly"),
                                    linear_svm(1.0, n, label=label, features="poly")),
            "rbf_svm": rbf}
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = dict(zip(fits, pool.map(lambda f: f(), fits.values())))
    first = {"logistic": logistic.stages[-1], **{k: done[k] for k in ("forest", "boosted_trees", "linear_svm")}}
    out = (compare(first, tr, te, label).union(done["rbf_svm"])
           .union(compare({"poly_svm": done["poly_svm"]}, tr, te, label)))
    tr.unpersist()
    te.unpersist()
    return out
