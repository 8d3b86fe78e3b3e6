"""Joins on group keys with SQL GROUP BY semantics (a null key is a key)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], other: list[str] | None = None,
                 how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null-safe equality plus plain equality on
    ``other``; the result keeps one copy of each join column. Null-safe
    equality is still an equi-join key, so Spark plans hash or sort-merge
    joins as usual."""
    other = list(other or [])
    on = keys + other
    if not on:
        raise ValueError("a join needs at least one key")
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in on], *[c for c in right.columns if c not in on])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] + [F.col(k) == F.col(f"_r_{k}") for k in other]
    j = left.join(r, reduce(lambda a, b: a & b, cond), how)
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return j
    if how in ("full", "outer", "full_outer", "fullouter", "right", "right_outer", "rightouter"):
        # a row from the right side only carries its key in the right copy
        j = j.select(*[F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) if k in on else F.col(k)
                       for k in left.columns],
                     *[c for c in j.columns if c not in left.columns and not c.startswith("_r_")])
        return j
    return j.drop(*[f"_r_{k}" for k in on])
