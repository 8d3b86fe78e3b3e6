"""Feature encoding (M1-M3).

Semantics follow the reference's encoders, which differ from Spark's
defaults in three places: classes are indexed alphabetically (Spark's
default is by frequency), one-hot keeps every class (Spark drops the last)
and standardisation divides by the population std (Spark's scaler uses the
sample std).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.operators.summary import scaler_stats


def indexer_stages(categorical: list[str], suffix: str = "_idx", handle_invalid: str = "error") -> list:
    """Alphabetical ``StringIndexer`` over all categories (M1): one
    multi-column indexer, so fitting is one pass over the data. By default
    unknown or null values at transform time are an error, as with a label
    encoder; ``keep`` gives them index k (the number of classes)."""
    if not categorical:
        return []
    return [StringIndexer(inputCols=list(categorical), outputCols=[c + suffix for c in categorical],
                          stringOrderType="alphabetAsc", handleInvalid=handle_invalid)]


def one_hot_stage(categorical: list[str], suffix: str = "_idx", out_suffix: str = "_oh") -> OneHotEncoder:
    """One-hot with every class kept (M2)."""
    return OneHotEncoder(inputCols=[c + suffix for c in categorical],
                         outputCols=[c + out_suffix for c in categorical], dropLast=False)


def encode_categories(df: DataFrame, categorical: list[str]) -> DataFrame:
    """Replace each category by its alphabetical code 0..k-1 (M1). Null is
    not a class: it stays null."""
    model = Pipeline(stages=indexer_stages(categorical, handle_invalid="keep")).fit(df)
    out = model.transform(df)
    return out.select(*[F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.col(c + "_idx")).cast("int").alias(c)
                        if c in categorical else F.col(c) for c in df.columns])


def one_hot(df: DataFrame, categorical: list[str], numeric: list[str], out: str = "features") -> DataFrame:
    """One-hot encoded categories first, then the numeric columns, as one
    vector column (M2)."""
    stages = indexer_stages(categorical) + [one_hot_stage(categorical),
                                            VectorAssembler(inputCols=[c + "_oh" for c in categorical] + numeric,
                                                            outputCol=out)]
    return Pipeline(stages=stages).fit(df).transform(df)


def standardize(df: DataFrame, cols: list[str], stats: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std per column (M3); zero variance gives 0.

    ``stats`` (feature, mean, std) from training data can be passed to apply
    a fitted scaling to new data. The statistics are one small aggregate,
    read as a scalar subquery, so the rows are not joined or shuffled.
    """
    st = stats if stats is not None else scaler_stats(df, cols)
    s = st.groupBy().pivot("feature", cols).agg(F.first(F.struct("mean", "std")))
    sq = s.select(F.struct(*[F.col(c).alias(c) for c in cols]).alias("s")).scalar()
    x = df.withColumn("_scale", sq)   # one subquery, read by field below
    out = []
    for c in df.columns:
        if c in cols:
            m, sd = F.col("_scale").getField(c).getField("mean"), F.col("_scale").getField(c).getField("std")
            out.append(F.when(sd > 0, (F.col(c) - m) / sd).otherwise(F.lit(0.0)).alias(c))
        else:
            out.append(F.col(c))
    return x.select(*out)
