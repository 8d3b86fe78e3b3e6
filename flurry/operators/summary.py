"""Aggregations and summaries.

Exact quantiles (median, quartiles) are computed by position instead of by
Spark's ``percentile`` aggregate, whose buffer holds every distinct value of
a group in one task: rows are first counted per (group, value), combined
map-side, so equal values become one row; the distinct values get running
counts from ``positions`` (a group with many values is split across tasks),
and one aggregate picks the values that cover the interpolation positions.
The interpolation is the linear one of ``median`` / ``quantile_cont``:
position (n-1)·p between floor and ceil. ``approx=True`` switches to
``percentile_approx`` (one pass, bounded memory).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flurry.operators.keys import join_on_keys
from flurry.operators.windows import positions


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as a one-row DataFrame (A1)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("long"))


def count_by(df: DataFrame, cols: list[str], name: str = "count") -> DataFrame:
    """Rows per group (A2); null keys form their own group (SQL semantics)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def label_summary(df: DataFrame, label: str, yes="Yes", no="No") -> DataFrame:
    """Total, positive and negative counts in one pass (A3)."""
    c = F.col(label)
    return df.agg(F.count(F.lit(1)).alias("n_total"),
                  F.count_if(c == F.lit(yes)).alias("n_yes"),
                  F.count_if(c == F.lit(no)).alias("n_no"))


def unpivot_numeric(df: DataFrame, cols: list[str], key: str = "feature",
                    value: str = "value") -> DataFrame:
    """Wide numeric columns -> long (feature, value) in double."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, key, value)


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``(keys, _v, _c, _upto, _n, _mean)``: every distinct non-null value
    with its count, the running count inside its key, and the key's row count
    and mean."""
    v, c = F.col("_v"), F.col("_c")
    counted = (df.select(*keys, F.col(value).cast("double").alias("_v")).where(v.isNotNull())
               .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    ranked = positions(counted.withColumn("_w", v * c), keys, ["_v"], "_pos", sum_cols=["_c", "_w"], totals=True)
    return ranked.select(*keys, "_v", "_c", F.col("_c_running").alias("_upto"), F.col("_c_total").alias("_n"),
                         (F.col("_w_total") / F.col("_c_total")).alias("_mean"))


_MOMENTS = {
    "mean": lambda: F.first("_mean"),
    "min": lambda: F.min("_v"),
    "max": lambda: F.max("_v"),
    # sample standard deviation around the key's mean; null for one row
    "std": lambda: F.sqrt(F.sum(F.col("_c") * F.pow(F.col("_v") - F.col("_mean"), 2))
                          / F.nullif(F.first("_n") - 1, F.lit(0.0))),
}


def _from_counts(counts: DataFrame, keys: list[str], probs: list[float], names: list[str],
                 moments: dict[str, str] | None = None) -> DataFrame:
    """Quantiles and moments from ``value_counts`` in one aggregate: a value
    covers the positions [running count - count, running count)."""
    def at(pos: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_c") <= pos) & (pos < F.col("_upto")), F.col("_v")))

    moments = moments or {}
    x = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    picked = counts.groupBy(*keys).agg(
        *[at(F.floor(xi)).alias(f"_lo{i}") for i, xi in enumerate(x)],
        *[at(F.ceil(xi)).alias(f"_hi{i}") for i, xi in enumerate(x)],
        *[_MOMENTS[kind]().alias(n) for n, kind in moments.items()], F.first("_n").alias("_n"))
    return picked.select(*keys, *[
        (F.col(f"_lo{i}") + (x[i] - F.floor(x[i])) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(n)
        for i, n in enumerate(names)], *moments)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    names: list[str] | None = None, moments: dict[str, str] | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per ``keys``.

    Nulls are ignored. One row per key with one column per probability
    (``names`` or ``q<p>``); without keys and without values one row of
    nulls. Groups and hot values of any size: see the module doc.
    ``moments`` {name: "mean" | "min" | "max" | "std"} come from the same
    value counts, so the source is read once.
    """
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    return _from_counts(value_counts(df, keys, value), keys, probs, names, moments)


def quantiles_of(df: DataFrame, keys: list[str], value: str, probs: list[float],
                 names: list[str] | None = None, approx: bool = False,
                 accuracy: int = 10000) -> DataFrame:
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    if not approx:
        return exact_quantiles(df, keys, value, probs, names)
    agg = F.percentile_approx(F.col(value).cast("double"), list(probs), accuracy)
    out = df.groupBy(*keys).agg(agg.alias("_qs"))
    return out.select(*keys, *[F.col("_qs")[i].alias(n) for i, n in enumerate(names)])


def describe_features(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Per numeric column: median, mean, min, max, std (sample, n-1) (A4).

    Long format ``(feature, median, mean, min, max, std)``.
    """
    long = unpivot_numeric(df, cols)
    if not approx:
        out = exact_quantiles(long, ["feature"], "value", [0.5], ["median"], {k: k for k in _MOMENTS})
    else:
        basic = long.groupBy("feature").agg(*[fn("value").alias(n) for n, fn in (
            ("mean", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev_samp))])
        out = basic.join(quantiles_of(long, ["feature"], "value", [0.5], ["median"], approx=True), "feature")
    return out.select("feature", "median", "mean", "min", "max", "std")


def default_row(df: DataFrame, categorical: list[str], numeric: list[str],
                approx: bool = False) -> DataFrame:
    """One row: first class (alphabetical) of each category and the median of
    each numeric column (A5)."""
    cats = df.agg(*[F.min(c).alias(c) for c in categorical]) if categorical else None
    if numeric:
        med = describe_features(df, numeric, approx=approx).select("feature", "median")
        meds = med.groupBy().pivot("feature", numeric).agg(F.first("median"))
        meds = meds.select(*[F.col(c).alias(c) for c in numeric])
    else:
        meds = None
    if cats is not None and meds is not None:
        # two one-row frames side by side: a scalar subquery, not a join
        s = meds.select(F.struct(*numeric).alias("m")).scalar()
        return cats.withColumn("_m", s).select(*categorical, *[F.col("_m").getField(c).alias(c) for c in numeric])
    return cats if cats is not None else meds


def category_domains(df: DataFrame, categorical: list[str]) -> DataFrame:
    """(feature, idx, value): sorted distinct values of each category, index
    0..k-1 in alphabetical order (A6). Distinct runs per (feature, value)
    with map-side combining; nulls are not a class."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in categorical]).unpivot(
        [], categorical, "feature", "value")
    d = long.where(F.col("value").isNotNull()).distinct()
    # numbered with `positions`, so even a high-cardinality feature is split
    return positions(d, ["feature"], ["value"], "idx").select("feature", "idx", "value")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weights n / (k · count_c) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    tot = df.select(F.count(F.lit(1)).alias("n")).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return counts.select(label, "n_class", (tot / (k * F.col("n_class"))).alias(name))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Rows with their class weight. The weight table has one row per class;
    AQE broadcasts it when its measured size is small (no forced hint)."""
    w = class_weights(df, label, name).select(label, name)
    return df.join(w, label, "left")


def corr_pairs(df: DataFrame, cols: list[str], digits: int | None = 6) -> DataFrame:
    """Pearson correlation of every pair below the diagonal (A8), long
    ``(col_a, col_b, corr)`` with col_a after col_b in ``cols``. All pairs in
    one aggregation pass; nulls skipped pair by pair."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)]
    row = df.agg(*aggs)
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")
    if digits is not None:
        stacked = stacked.withColumn("corr", F.round("corr", digits))
    return stacked


def _hist_params(data: DataFrame, bins: int | None, max_bins: int) -> DataFrame:
    """One row (lo, hi, nb) for the histogram of ``_v``: the range and the
    bin count, given or Freedman-Diaconis (2 IQR / n^(1/3) wide), capped,
    at least 1."""
    stats = data.agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    if bins:
        return stats.select("lo", "hi", F.lit(bins).alias("nb"))
    q = exact_quantiles(data, [], "_v", [0.25, 0.75], ["q1", "q3"])
    stats = stats.withColumn("_q", q.select(F.struct("q1", "q3").alias("q")).scalar())
    width = 2.0 * (F.col("_q.q3") - F.col("_q.q1")) / F.pow(F.col("n").cast("double"), 1.0 / 3.0)
    raw = F.ceil(F.try_divide(F.col("hi") - F.col("lo"), width))
    nb = F.least(F.greatest(F.coalesce(raw, F.lit(1)), F.lit(1)), F.lit(max_bins)).cast("int")
    return stats.select("lo", "hi", nb.alias("nb"))


def _bin_of(v, lo, hi, nb) -> Column:
    """1-based equal-width bin of v in [lo, hi]; hi falls in the last bin."""
    raw = F.floor(nb * (v - lo) / (hi - lo)).cast("long") + 1
    return F.when(hi == lo, F.lit(1).cast("long")).otherwise(F.least(raw, nb.cast("long")))


def histogram(df: DataFrame, col: str, bins: int | None = None, max_bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max] (A9): ``(bin, lo, hi, count)``.

    ``bins=None`` picks Freedman-Diaconis, capped at ``max_bins``. The max
    value falls in the last bin (``width_bucket`` alone would give bins+1).
    Empty bins are not listed. Range and bin count are one scalar subquery,
    projected once next to the values.
    """
    data = df.select(F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    p = _hist_params(data, bins, max_bins).select(F.struct("lo", "hi", "nb").alias("p")).scalar()
    x = data.withColumn("_p", p)
    lo, hi, nb = F.col("_p.lo"), F.col("_p.hi"), F.col("_p.nb")
    counted = x.groupBy(_bin_of(F.col("_v"), lo, hi, nb).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.first(lo).alias("_lo"), F.first(hi).alias("_hi"),
        F.first(nb).alias("_nb"))
    width = (F.col("_hi") - F.col("_lo")) / F.col("_nb")
    return counted.select("bin", (F.col("_lo") + (F.col("bin") - 1) * width).alias("lo"),
                          (F.col("_lo") + F.col("bin") * width).alias("hi"), "count")


def box_stats(df: DataFrame, x: str | None, y: str, approx: bool = False) -> DataFrame:
    """Box-plot numbers of ``y`` per ``x`` group (A10): quartiles, whiskers
    (most extreme values inside 1.5·IQR fences) and outlier count."""
    keys = [x] if x else []
    names, probs = ["q1", "median", "q3"], [0.25, 0.5, 0.75]
    # distinct values with their counts stand for the rows from here on
    if approx:
        values = (df.select(*keys, F.col(y).cast("double").alias("_v")).where(F.col("_v").isNotNull())
                  .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
        q = quantiles_of(df, keys, y, probs, names, approx=True)
    else:
        values = value_counts(df, keys, y)
        q = _from_counts(values, keys, probs, names)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr")).withColumn(
        "hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    qcols = ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence"]
    values = values.select(*keys, "_v", "_c")
    if keys:
        # one row per group on the right: Spark broadcasts it when small,
        # else a sort-merge join that AQE splits for skewed groups
        joined = join_on_keys(values, q, keys)
    else:
        # ungrouped: the quartiles are one scalar subquery, no join at all
        sq = q.select(F.struct(*qcols).alias("q")).scalar()
        joined = values.withColumn("_q", sq).select("_v", "_c", *[F.col("_q").getField(c).alias(c) for c in qcols])
    v, inside = F.col("_v"), F.col("_v").between(F.col("lo_fence"), F.col("hi_fence"))
    # the quartiles are constant within a group: carried through with first()
    # rather than joined back a second time
    return joined.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in qcols], F.sum("_c").alias("n"),
        F.min(F.when(v >= F.col("lo_fence"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("hi_fence"), v)).alias("whisker_hi"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_c"))).cast("long").alias("n_outliers"))


def pair_bins(df: DataFrame, x: str, y: str, hue: str | None, bins: int = 10) -> DataFrame:
    """2-D equal-width bin counts per hue (A11): ``(hue, bx, by, count)``."""
    st = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in (x, y)
                  for n, f in (("lo", F.min), ("hi", F.max))])
    sq = st.select(F.struct(*st.columns).alias("s")).scalar()
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("_s", sq)

    def binned(c):
        return _bin_of(F.col(c).cast("double"), F.col("_s").getField(f"lo_{c}"),
                       F.col("_s").getField(f"hi_{c}"), F.lit(bins))
    keys = ([F.col(hue)] if hue else []) + [binned(x).alias("bx"), binned(y).alias("by")]
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def pair_grid(df: DataFrame, cols: list[str], hue: str | None = None, bins: int = 10) -> DataFrame:
    """2-D bin counts of every pair of ``cols`` (A11, the pair plot's grid):
    ``(x, y, [hue,] bx, by, count)``.

    Every column is binned once, on its own extent; the pairs of a row are
    stacked and counted in one aggregation, combined before the shuffle to at
    most pairs x bins x bins (x hue) rows a task. A pair with a null is left out.
    """
    st = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    sq = st.select(F.struct(*st.columns).alias("s")).scalar()
    own = [F.col(hue).alias("_hue")] if hue else []
    d = df.select(*own, *[F.col(c).cast("double").alias(c) for c in cols]).withColumn("_s", sq)
    d = d.select(*[F.col("_hue")] * bool(hue), *[F.when(F.col(c).isNotNull(), _bin_of(
        F.col(c), F.col("_s").getField(f"lo_{c}"), F.col("_s").getField(f"hi_{c}"), F.lit(bins))).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(x).alias("bx"), F.col(y).alias("by"))
                      for i, x in enumerate(cols) for y in cols[i + 1:]])
    long = d.select(*[F.col("_hue").alias(hue)] if hue else [], F.explode(pairs).alias("p")).select(*[hue] if hue else [], "p.*")
    return long.where("bx is not null and by is not null").groupBy("x", "y", *[hue] if hue else [], "bx", "by").agg(
        F.count(F.lit(1)).alias("count"))


def map_extent(df: DataFrame, map_col: str) -> DataFrame:
    """min and max over all values of a map column."""
    vals = df.select(F.explode(F.map_values(F.col(map_col))).alias("v"))
    return vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))


def scaler_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population std per column (A14), long ``(feature, mean, std)``."""
    long = unpivot_numeric(df, cols)
    return long.groupBy("feature").agg(F.avg("value").alias("mean"),
                                       F.stddev_pop("value").alias("std"))
