"""Sorts, top-k, samples and splits.

Random choices are made from a hash of the row key, not from a generator,
so they are the same on every run, on every cluster size and in any engine
that has md5: bucket = first 8 hex digits of md5(key) as a number, mod 100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flurry.operators.windows import positions


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash_bucket(key, buckets: int = 100, salt: str | None = None) -> Column:
    """Deterministic bucket 0..buckets-1 of a key."""
    k = _c(key).cast("string")
    if salt is not None:
        k = F.concat(k, F.lit(str(salt)))
    h = F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))


def sort_desc(df: DataFrame, score: str, tiebreak: str | None = None) -> DataFrame:
    """Descending score, ascending id on ties (O1): a deterministic order."""
    keys = [F.col(score).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return df.orderBy(*keys)


def top_k(df: DataFrame, score: str, k: int, tiebreak: str | None = None,
          ascending: bool = False) -> DataFrame:
    """Top-k rows (O3). ``orderBy().limit()`` plans as TakeOrderedAndProject:
    each task keeps only its own k best, so no full sort is shuffled."""
    s = F.col(score).asc() if ascending else F.col(score).desc()
    keys = [s] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return df.orderBy(*keys).limit(k)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 83, key: str | None = None) -> DataFrame:
    """Each row kept with probability ``fraction`` (O4). With ``key`` a hash of
    key and seed decides (the same rows in any md5 engine and on any number of
    tasks), without it Spark's seeded sampler."""
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(hash_bucket(key, 1 << 32, str(seed)) < int(fraction * (1 << 32)))


def sample_n(df: DataFrame, key: str, n: int, seed: int | str = 42,
             exclude: list | None = None) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), chosen by hash order of
    key‖seed (O5). Same rows on any cluster and in any md5 engine; the
    per-task top-n keeps the shuffle to n rows per task."""
    d = df.where(~F.col(key).isin(list(exclude))) if exclude else df
    return d.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)).limit(n)


def train_test_split(df: DataFrame, key: str, test: float = 0.25,
                     salt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Hash split (O6): a row is in test when its bucket of 100 is below the
    whole percents of the share; the bucket that the share cuts is divided by
    the rest of the hash. The halves are disjoint and complete; sizes are
    close to, not exactly, the share."""
    h = hash_bucket(key, 1 << 32, salt)
    whole = int(round(test * 100, 9))
    part = int(round(test * 100 - whole, 9) * ((1 << 32) // 100))
    b = F.pmod(h, F.lit(100))
    inside = (b < whole) | ((b == whole) & (F.floor(h / 100) < part))
    return df.where(~inside), df.where(inside)


def with_fold(df: DataFrame, key: str, folds: int = 5, name: str = "fold",
              salt: str | None = None) -> DataFrame:
    """Deterministic fold id 0..folds-1 from the key hash (for CV)."""
    return df.withColumn(name, F.pmod(hash_bucket(key, 1 << 30, salt), F.lit(folds)).cast("int"))


def with_stratified_fold(df: DataFrame, key: str, label: str, folds: int = 5, name: str = "fold") -> DataFrame:
    """Fold id 0..folds-1 such that every label's rows are spread evenly: rows of
    one label, numbered in hash order of the key, take the folds in turn, so
    counts of a label differ by at most one a fold. The numbering is
    range-partitioned: a label holding most rows is not one task."""
    order = F.md5(F.col(key).cast("string"))
    return positions(df, [label], [order, key], "_pos").withColumn(name, F.pmod(F.col("_pos"), F.lit(folds)).cast("int")).drop("_pos")


def split_before(df: DataFrame, col: str, cut) -> tuple[DataFrame, DataFrame]:
    """Time split (O7): (rows before ``cut``, rows at or after it)."""
    return df.where(F.col(col) < F.lit(cut)), df.where(F.col(col) >= F.lit(cut))
