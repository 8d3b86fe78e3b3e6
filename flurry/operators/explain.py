"""Local linear explanations and what-if tables for whole tables.

Method: Ribeiro, Singh & Guestrin, "Why should I trust you?" (KDD 2016),
tabular variant. For each row, perturbation samples are drawn from the
training distribution: a categorical feature takes a class with its training
frequency; a numeric feature takes one of its quartile bins with the bin's
training frequency, then a value from a normal truncated to the bin. The
interpretable form of a sample is 1 where it agrees with the row (same class
or same bin), else 0; sample 0 is the row itself. Samples are weighted by
sqrt(exp(-d² / w²)) with d the Euclidean distance of the 0/1 vector to all
ones and w = 0.75·sqrt(#features). A ridge regression (alpha 1) of the
model's P(class 1) on the 0/1 features gives one weight per feature.
Feature choice: forward selection when at most 6 features are asked for,
otherwise the largest |weights| of a light ridge (alpha 0.01) on all.

The samples do not depend on the row they explain (only the 0/1 form and
sample 0 do), so one set is drawn from the seed, scored once by the model and
shared by all rows: its size is a parameter (samples x features). Plan: rows ->
``model.transform`` for their own probability -> Arrow batches of ridge fits,
one narrow pass without a shuffle; all other columns stay in the JVM. Rows of
the same classes and bins share their weighted sums, kept in a bounded cache.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flurry.functions.scalar import quantize
from flurry.operators.models import without_summary
from flurry.operators.summary import exact_quantiles, map_extent

# --- fixed values: settings of the tabular explanation method ----------------
# kernel width = 0.75 * sqrt(number of features); final ridge alpha 1; feature
# choice by a ridge with alpha 0.01 on all features, or by forward selection
# when at most 6 features are asked for; numeric features in quartile bins.
KERNEL_WIDTH_FACTOR = 0.75
RIDGE_ALPHA = 1.0
SELECTION_ALPHA = 0.01
FORWARD_SELECTION_MAX_FEATURES = 6
QUARTILES = (0.25, 0.5, 0.75)
# ---------------------------------------------------------------------------


@dataclass
class TrainingStats:
    """Small per-feature summaries of the training table (model metadata)."""
    categorical: list[str]
    numeric: list[str]
    classes: dict = field(default_factory=dict)    # feature -> (values, freqs)
    quartiles: dict = field(default_factory=dict)  # feature -> [q1, q2, q3]
    bins: dict = field(default_factory=dict)       # feature -> 4 x (freq, mean, std, lower edge, upper edge)

    @property
    def features(self) -> list[str]:
        return list(self.categorical) + list(self.numeric)


def training_stats(train: DataFrame, categorical: list[str], numeric: list[str]) -> TrainingStats:
    """Class frequencies, quartiles and per-quartile-bin moments, computed
    with distributed aggregations; only the summaries (a few numbers per
    feature and class) come back to the driver."""
    st = TrainingStats(list(categorical), list(numeric))
    if categorical:
        long = train.select(*[F.col(c).cast("string").alias(c) for c in categorical]).unpivot(
            [], categorical, "feature", "value").where(F.col("value").isNotNull())
        cnt = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).collect()
        for c in categorical:
            rows = sorted((r["value"], r["n"]) for r in cnt if r["feature"] == c)
            tot = float(sum(n for _, n in rows))
            st.classes[c] = ([v for v, _ in rows], [n / tot for _, n in rows])
    if numeric:
        long = train.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot(
            [], numeric, "feature", "value").where(F.col("value").isNotNull())
        qrows = exact_quantiles(long, ["feature"], "value", list(QUARTILES), ["q1", "q2", "q3"],
                                moments={"lo": "min", "hi": "max"}).collect()
        qs = {r["feature"]: [r["q1"], r["q2"], r["q3"]] for r in qrows}
        ext = {r["feature"]: (r["lo"], r["hi"]) for r in qrows}
        qcol = F.create_map(*[x for c in numeric for x in (F.lit(c), F.array(*[F.lit(float(q)) for q in qs[c]]))])
        q = F.element_at(qcol, F.col("feature"))
        # bin = number of quartiles strictly below the value (0..3)
        b = sum(((F.col("value") > q[i]).cast("int") for i in range(3)), F.lit(0))
        mom = long.groupBy("feature", b.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std")).collect()
        for c in numeric:
            st.quartiles[c] = [float(x) for x in qs[c]]
            # bin k spans [edge k, edge k+1] of (min, q1, q2, q3, max)
            edges = [float(ext[c][0])] + st.quartiles[c] + [float(ext[c][1])]
            rows = {r["bin"]: r for r in mom if r["feature"] == c}
            tot = float(sum(r["n"] for r in rows.values()))
            st.bins[c] = [(rows[i]["n"] / tot, rows[i]["mean"], rows[i]["std"] or 0.0, edges[i], edges[i + 1])
                          if i in rows else (0.0, 0.0, 0.0, edges[i], edges[i + 1]) for i in range(4)]
    return st


# --- numeric helpers (inside tasks) -------------------------------------------------

def _norm_cdf(x: np.ndarray) -> np.ndarray:
    """Standard normal CDF via erf (Abramowitz & Stegun 7.1.26, |err| < 1.5e-7)."""
    z = np.abs(x) / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.3275911 * z)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1.0 - poly * np.exp(-z * z)
    return 0.5 * (1.0 + np.sign(x) * erf)


def _norm_ppf(p: np.ndarray) -> np.ndarray:
    """Standard normal quantile (Acklam's rational approximation, rel. err < 1.2e-9)."""
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
    p = np.clip(p, 1e-300, 1 - 1e-16)
    x = np.empty_like(p)
    lo, hi = p < 0.02425, p > 1 - 0.02425
    mid = ~(lo | hi)
    q = np.sqrt(-2 * np.log(p[lo]))
    x[lo] = (((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / \
        ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    q = p[mid] - 0.5
    r = q * q
    x[mid] = (((((a[0] * r + a[1]) * r + a[2]) * r + a[3]) * r + a[4]) * r + a[5]) * q / \
        (((((b[0] * r + b[1]) * r + b[2]) * r + b[3]) * r + b[4]) * r + 1)
    q = np.sqrt(-2 * np.log(1 - p[hi]))
    x[hi] = -(((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / \
        ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    return x


def _truncnorm(rng, mean, std, lo, hi):
    """One draw per element of N(mean, std) truncated to [lo, hi], by
    inverse CDF; all arguments are arrays of the same length. Degenerate
    bins (no spread) give their single value."""
    ok = (std > 0) & (hi > lo)
    sd = np.where(ok, std, 1.0)
    a = _norm_cdf((lo - mean) / sd)
    b = _norm_cdf((hi - mean) / sd)
    u = rng.uniform(size=len(mean)) * (b - a) + a
    x = np.clip(mean + sd * _norm_ppf(u), lo, hi)
    return np.where(ok, x, np.where(hi <= lo, lo, mean))


def _moments(Z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple:
    """Weighted sums over samples: of 1, Z, y, Z'Z, Z'y and y²."""
    Zw = Z * w[:, None]
    return w.sum(), Zw.sum(axis=0), float(w @ y), Z.T @ Zw, Zw.T @ y, float(w @ (y * y))


def _gram(m: tuple, p: float) -> dict:
    """Weighted centred cross-products of the samples in ``m`` and the row itself
    (all ones, weight 1, probability ``p``): everything a ridge fit on any subset
    of the columns needs, so selection never revisits the samples."""
    sw, sx, sy, sxx, sxy, syy = m
    sw, sx, sy = sw + 1.0, sx + 1.0, sy + p
    xm, ym = sx / sw, sy / sw
    return {"G": sxx + 1.0 - sw * np.outer(xm, xm), "b": sxy + p - sw * xm * ym,
            "syy": max(syy + p * p - sw * ym * ym, 0.0), "xm": xm, "ym": ym}


def _solve(g: dict, cols: list[int], alpha: float):
    G = g["G"][np.ix_(cols, cols)] + alpha * np.eye(len(cols))
    b = g["b"][cols]
    try:
        coef = np.linalg.solve(G, b)
    except np.linalg.LinAlgError:   # singular without regularisation
        coef = np.linalg.lstsq(G, b, rcond=None)[0]
    # weighted residual sum of squares from the cross-products
    ss_res = g["syy"] - 2 * coef @ b + coef @ (g["G"][np.ix_(cols, cols)] @ coef)
    r2 = 1.0 - ss_res / g["syy"] if g["syy"] > 0 else 0.0
    icpt = g["ym"] - g["xm"][cols] @ coef
    return coef, float(icpt), float(r2)


def _select(g: dict, n_f: int, k: int, method: str):
    if method == "auto":
        method = "forward_selection" if k <= FORWARD_SELECTION_MAX_FEATURES else "highest_weights"
    if k >= n_f and method != "forward_selection":
        return list(range(n_f))
    if method == "highest_weights":
        coef, _, _ = _solve(g, list(range(n_f)), SELECTION_ALPHA)
        return [int(i) for i in np.argsort(-np.abs(coef), kind="stable")[:k]]
    used: list[int] = []
    for _ in range(min(k, n_f)):
        best, best_s = None, -np.inf
        for f in range(n_f):
            if f in used:
                continue
            s = _solve(g, used + [f], 0.0)[2]
            if s > best_s:
                best, best_s = f, s
        used.append(best)
    return used


def _affine(m: tuple) -> tuple:
    """The ridge fit on all columns as a function of the row's probability p:
    coefficients c0 + p·c1, right-hand side b0 + p·b1, then the means and sums they need."""
    sw, sx, sy, sxx, sxy, syy = m
    xm = (sx + 1.0) / (sw + 1.0)
    G = sxx + 1.0 - (sw + 1.0) * np.outer(xm, xm) + RIDGE_ALPHA * np.eye(len(xm))
    b0, b1 = sxy - xm * sy, 1.0 - xm
    c0, c1 = np.linalg.solve(G, np.stack([b0, b1], axis=1)).T
    return c0, c1, b0, b1, xm, sw + 1.0, sy, syy


def _fit_all(solved: list[tuple], of: np.ndarray, p: np.ndarray, names: list[str]) -> pd.DataFrame:
    """Fits of rows ``of`` the solved kinds with probabilities ``p``, all columns used."""
    c0, c1, b0, b1, xm, sw, sy, syy = (np.stack(x)[of] for x in zip(*solved))
    q = p[:, None]
    coef, b, ym = c0 + q * c1, b0 + q * b1, (sy + p) / sw
    ss = np.maximum(syy + p * p - sw * ym * ym, 0.0)
    # G·c = b - alpha·c
    res = ss - (coef * b).sum(1) - RIDGE_ALPHA * (coef * coef).sum(1)
    r2 = np.where(ss > 0, 1.0 - res / np.where(ss > 0, ss, 1.0), 0.0)
    icpt = ym - (xm * coef).sum(1)
    rank = np.argsort(-np.abs(coef), axis=1, kind="stable")
    cols = [list(rank.astype(np.int32)), list(np.take_along_axis(coef, rank, axis=1)), icpt, r2, icpt + coef.sum(1)]
    return pd.DataFrame(dict(zip(names, cols)))


# --- X1 ----------------------------------------------------------------------------

_CACHE_BYTES = 1 << 26   # weighted sums kept per task


def draw_samples(stats: TrainingStats, n_samples: int, seed: int) -> tuple[np.ndarray, dict]:
    """The perturbation samples: class or bin number of every sample and feature,
    and the values that the model scores."""
    rng = np.random.default_rng(seed)
    codes = np.empty((n_samples, len(stats.features)), dtype=np.int32)
    values = {}
    for j, c in enumerate(stats.features):
        if c in stats.classes:
            names, freq = stats.classes[c]
            codes[:, j] = rng.choice(len(names), size=n_samples, p=freq)
            values[c] = np.asarray(names, dtype=object)[codes[:, j]]
        else:
            p, mean, std, lo, hi = np.asarray(stats.bins[c], dtype=float).T
            codes[:, j] = b = rng.choice(4, size=n_samples, p=p / p.sum())
            values[c] = _truncnorm(rng, mean[b], std[b], lo[b], hi[b])
    return codes, values


def _score_samples(spark, model, stats: TrainingStats, values: dict) -> np.ndarray:
    """P(class 1) of every sample, in order."""
    n = len(next(iter(values.values())))
    schema = ", ".join(["_s long", *[f"`{c}` {'string' if c in stats.classes else 'double'}" for c in values]])
    pool = spark.createDataFrame(pd.DataFrame({"_s": np.arange(n), **values}), schema)
    out = np.empty(n)
    for r in model.transform(pool).select("_s", vector_to_array(F.col("probability"))[1].alias("p")).collect():
        out[r["_s"]] = r["p"]
    return out


def _fit_udf(stats: TrainingStats, codes: np.ndarray, drawn: np.ndarray, n_features: int, method: str,
             kernel_width: float | None):
    """Arrow function (row's probability, its features ...) -> weights of the
    chosen features, largest first, with their feature numbers, and the fit's numbers."""
    feats = stats.features
    n_f = len(feats)
    width = kernel_width or KERNEL_WIDTH_FACTOR * math.sqrt(n_f)
    by_distance = np.sqrt(np.exp(-np.arange(n_f + 1) / width ** 2))   # of d² = number of disagreements
    # sample 0 is the row itself
    codes, drawn = codes[1:], drawn[1:]
    index = {c: pd.Index(stats.classes[c][0]) for c in stats.classes}
    quart = {c: np.asarray(stats.quartiles[c], dtype=float) for c in stats.numeric}
    keep = max(16, _CACHE_BYTES // (8 * (n_f + 2) ** 2))
    # with every feature in the fit, rows of the same classes and bins differ in their own probability only
    every = n_features >= n_f and (method == "highest_weights" or method == "auto" and n_features > FORWARD_SELECTION_MAX_FEATURES)

    def own_codes(cols) -> np.ndarray:
        own = np.empty((len(cols[0]), n_f), dtype=np.int32)
        for j, c in enumerate(feats):
            if c in index:
                own[:, j] = index[c].get_indexer(cols[j])        # unseen class or null: -1, agrees with no sample
            else:
                v = cols[j].to_numpy(dtype=float)
                own[:, j] = np.where(np.isnan(v), -1, np.searchsorted(quart[c], v, side="left"))
        return own

    def run(batches):
        @lru_cache(maxsize=keep)
        def moments(own: tuple):
            Z = codes == np.asarray(own, dtype=np.int32)
            return _moments(Z.astype(float), drawn, by_distance[n_f - Z.sum(axis=1)])

        def one(own: tuple, p: float):
            g = _gram(moments(own), p)
            used = _select(g, n_f, min(n_features, n_f), method)
            coef, icpt, r2 = _solve(g, used, RIDGE_ALPHA)
            rank = np.argsort(-np.abs(coef), kind="stable")
            return [used[i] for i in rank], coef[rank].tolist(), icpt, r2, float(icpt + coef.sum())

        names = ["order", "weights", "intercept", "score", "local_pred"]
        solved = lru_cache(maxsize=keep)(lambda own: _affine(moments(own)))
        for p, *cols in batches:
            own = own_codes(cols)
            if every and len(own):
                kinds, of = np.unique(own, axis=0, return_inverse=True)
                yield _fit_all([solved(tuple(o)) for o in kinds.tolist()], of.reshape(-1), p.to_numpy(dtype=float), names)
            else:
                yield pd.DataFrame([one(tuple(o), float(x)) for o, x in zip(own.tolist(), p)], columns=names)

    out = "order array<int>, weights array<double>, intercept double, score double, local_pred double"
    from collections.abc import Iterator

    def typed(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        return run(batches)
    typed.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(typed, out)


def with_explanations(df: DataFrame, model, stats: TrainingStats, n_samples: int = 5000, n_features: int = 10,
                      method: str = "auto", seed: int = 42, kernel_width: float | None = None) -> DataFrame:
    """``df`` with ``probability``, ``explanation`` (map<feature, weight>, largest
    first), ``intercept``, ``score`` (weighted R²) and ``local_pred`` of every row.

    ``model`` is a fitted pipeline taking the raw feature columns and producing
    ``probability``; what it does with a null or an unseen class decides those
    rows. Any number of features; rows and ids may repeat.
    """
    feats = stats.features
    model = without_summary(model)
    codes, values = draw_samples(stats, n_samples, seed)
    drawn = _score_samples(df.sparkSession, model, stats, values)
    fit = _fit_udf(stats, codes, drawn, n_features, method, kernel_width)
    rows = model.transform(df.select(*feats, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")))
    rows = rows.select("_row", *[F.col(c).cast("string" if c in stats.classes else "double").alias(c) for c in feats],
                       vector_to_array(F.col("probability"))[1].alias("probability"))
    rows = rows.withColumn("_fit", fit("probability", *feats))
    names = F.array(*[F.lit(c) for c in feats])
    expl = F.map_from_arrays(F.transform("_fit.order", lambda i: F.element_at(names, i + 1)), F.col("_fit.weights"))
    new = {"probability": F.col("probability"), "explanation": expl,
           **{c: F.col(f"_fit.{c}") for c in ("intercept", "score", "local_pred")}}
    return rows.select(*[F.col(f"_row.`{c}`") for c in df.columns if c not in new],
                       *[v.alias(c) for c, v in new.items()])


def explain(df: DataFrame, model, stats: TrainingStats, id_col: str = "id", n_samples: int = 5000,
            n_features: int = 10, method: str = "auto", seed: int = 42,
            kernel_width: float | None = None) -> DataFrame:
    """Explain every row of ``df`` (X1): ``(id, probability, explanation
    map<feature, weight>, intercept, score, local_pred)``."""
    got = with_explanations(df.select(id_col, *stats.features), model, stats, n_samples, n_features, method, seed,
                            kernel_width)
    return got.select(id_col, "probability", "explanation", "intercept", "score", "local_pred")


def explanation_list(stats: TrainingStats, data_col: str = "data", expl_col: str = "explanation") -> "F.Column":
    """Readable form of an explanation (X1 ``as_list``): one
    ``"<condition>: <weight>"`` string per feature, e.g. ``segment=BUILDING``
    or ``1.00 < n_orders <= 9.00``; ordered as in the map."""
    parts = []
    for c in stats.features:
        v = F.col(f"{data_col}.{c}")
        if c in stats.classes:
            cond = F.concat(F.lit(f"{c}="), v.cast("string"))
        else:
            q = stats.quartiles[c]
            f = [f"{x:.2f}" for x in q]
            cond = (F.when(v <= q[0], F.lit(f"{c} <= {f[0]}"))
                    .when(v <= q[1], F.lit(f"{f[0]} < {c} <= {f[1]}"))
                    .when(v <= q[2], F.lit(f"{f[1]} < {c} <= {f[2]}"))
                    .otherwise(F.lit(f"{c} > {f[2]}")))
        parts.append(F.struct(F.lit(c).alias("feature"), cond.alias("cond")))
    conds = F.map_from_entries(F.array(*parts))
    return F.transform(F.map_entries(F.col(expl_col)),
                       lambda e: F.concat(F.element_at(conds, e["key"]), F.lit(": "),
                                          F.format_number(e["value"], 4)))


def explain_table(df: DataFrame, model, stats: TrainingStats, id_col: str = "id", sample: int | None = None,
                  seed: int = 42, **kw) -> DataFrame:
    """Scored and explained rows (X2): ``(id, data struct, probability,
    explanation)``; ``sample`` explains a reproducible hash sample of that
    many rows instead of all."""
    from flurry.operators.sampling import sample_n
    rows = sample_n(df, id_col, sample, seed) if sample else df
    rows = rows.select(id_col, F.struct(*stats.features).alias("data"), *stats.features)
    return with_explanations(rows, model, stats, seed=seed, **kw).select(id_col, "data", "probability", "explanation")


def global_importance(explained: DataFrame, expl_col: str = "explanation") -> DataFrame:
    """Mean |weight| per feature over all explained rows (X6); a row whose
    explanation lacks the feature counts as weight 0. ``n_rows``: rows that have it."""
    mark = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(0.0).alias("value")))  # one per row
    entries = F.concat(F.coalesce(F.map_entries(expl_col), F.filter(mark, lambda _: F.lit(False))), mark)
    e = explained.select(F.explode(entries).alias("x")).groupBy(F.col("x.key").alias("feature"))
    per = e.agg(F.sum(F.abs("x.value")).alias("total"), F.count(F.lit(1)).alias("n_rows"))
    rows = F.max(F.when(F.col("feature").isNull(), F.col("n_rows"))).over(Window.partitionBy())  # one row per feature
    return (per.withColumn("importance", F.col("total") / rows).filter("feature is not null")
            .select("feature", "importance", "n_rows"))


def heat_bins(explained: DataFrame, expl_col: str = "explanation", prob_col: str = "probability",
              bins: int = 7, weight_range: tuple | None = None, prob_range: tuple | None = None) -> DataFrame:
    """Colour bins 1..7 of every weight and of the probability.

    A range of ``None`` is the extent of the data: of all weights (A12) and of
    all probabilities, as in the table view; the single-row view uses the
    fixed ranges (-0.3, 0.3) and (0, 1). Values outside the range fall in the
    end bins."""
    if weight_range is None:
        # the extent goes into a column first (lambdas may not hold subqueries)
        ext = map_extent(explained, expl_col).select(F.struct("lo", "hi").alias("e")).scalar()
        out = explained.withColumn("_e", ext).withColumn("_lo", F.col("_e.lo")).withColumn(
            "_hi", F.col("_e.hi")).drop("_e")
    else:
        out = explained.withColumn("_lo", F.lit(float(weight_range[0]))).withColumn(
            "_hi", F.lit(float(weight_range[1])))
    if prob_range is None:
        ends = explained.agg(F.struct(F.min(prob_col).alias("lo"), F.max(prob_col).alias("hi")).alias("p")).scalar()
    else:
        ends = F.struct(F.lit(float(prob_range[0])).alias("lo"), F.lit(float(prob_range[1])).alias("hi"))
    out = out.withColumn("_p", ends).withColumn("weight_bins", F.transform_values(
        F.col(expl_col), lambda k, v: quantize(v, F.col("_lo"), F.col("_hi"), bins))).withColumn(
        "probability_bin", quantize(F.col(prob_col), F.col("_p.lo"), F.col("_p.hi"), bins))
    return out.drop("_lo", "_hi", "_p")


def table_view(explained: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per id, data fields as columns, highest probability first."""
    return explained.select(id_col, "probability", "data.*", "explanation").orderBy(
        F.col("probability").desc(), F.col(id_col))


def what_if(df: DataFrame, model, stats: TrainingStats, id_col: str = "id",
            numeric_values: dict | None = None) -> DataFrame:
    """Probability change when one feature takes another value (X3):
    ``(id, feature, value, probability, base_probability, delta)``.

    Each categorical feature is set in turn to every training class; each
    numeric feature to the values given in ``numeric_values`` (``None``: the
    training quartiles of every numeric feature). All variants of all rows are
    scored in one narrow pass that carries the row's own probability.
    """
    feats = stats.features
    if numeric_values is None:
        numeric_values = {c: sorted(set(stats.quartiles[c])) for c in stats.numeric}
    model = without_summary(model)
    p1 = vector_to_array(F.col("probability"))[1]
    base = model.transform(df.select(id_col, *feats)).select(id_col, *feats, p1.alias("base_probability"))
    alts = []
    for c in stats.categorical:
        for v in stats.classes[c][0]:
            alts.append(F.struct(F.lit(c).alias("f"), F.lit(str(v)).alias("s"), F.lit(None).cast("double").alias("x")))
    for c, vals in numeric_values.items():
        for v in vals:
            alts.append(F.struct(F.lit(c).alias("f"), F.lit(None).cast("string").alias("s"),
                                 F.lit(float(v)).alias("x")))
    variants = base.select(id_col, "base_probability", *feats, F.explode(F.array(*alts)).alias("_a"))
    variants = variants.select(
        id_col, "base_probability", F.col("_a.f").alias("feature"),
        F.coalesce(F.col("_a.s"), F.col("_a.x").cast("string")).alias("value"),
        *[F.when(F.col("_a.f") == c, F.col("_a.s") if c in stats.classes else F.col("_a.x"))
          .otherwise(F.col(c)).alias(c) for c in feats])
    scored = model.transform(variants).select(id_col, "feature", "value", p1.alias("probability"), "base_probability")
    return scored.withColumn("delta", F.col("probability") - F.col("base_probability"))


def score_log(requests: DataFrame, model, stats: TrainingStats | None = None, defaults: DataFrame | None = None,
              explain_samples: int = 0, id_col: str = "id", schema: T.StructType | None = None,
              explain_features: int = 10) -> DataFrame:
    """Scoring log (L1): requests cast to their training types (``schema``; text
    that is no value of the type becomes null), filled from defaults, scored,
    explained (``explain_samples`` > 0), stamped with a new uuid and the scoring
    time. ``(uuid, ts, id, input_data, probability[, explanation])``."""
    from flurry.functions.structs import cast_like
    from flurry.operators.clean import with_defaults
    req = cast_like(requests, schema) if schema is not None else requests
    req = with_defaults(req, defaults) if defaults is not None else req
    feats = [c for c in req.columns if c != id_col]
    req = req.withColumn("input_data", F.to_json(F.struct(*[F.col(f"`{c}`") for c in feats])))
    if explain_samples and stats is not None:
        out = with_explanations(req, model, stats, explain_samples, explain_features).select(
            id_col, "input_data", "probability", "explanation")
    else:
        p1 = vector_to_array(F.col("probability"))[1]
        out = without_summary(model).transform(req).select(id_col, "input_data", p1.alias("probability"))
    return out.select(F.expr("uuid()").alias("uuid"), F.current_timestamp().alias("ts"), "*")
