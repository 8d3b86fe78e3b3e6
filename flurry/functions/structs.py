"""Nested-record helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> top-level columns named by their path (F12), e.g.
    ``metrics.probability``. Maps and arrays stay as values. Works from the
    schema only, so it is a projection with no data pass."""
    cols: list[Column] = []

    def walk(dtype: T.DataType, path: list[str]) -> None:
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name])
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))

    walk(df.schema, [])
    return df.select(*cols)


def cast_like(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Cast every column to the type it had at training time (P20). An
    unknown column is an error when ``strict``; ``try_cast`` turns dirty
    text into null instead of failing the job."""
    types = {f.name: f.dataType for f in schema.fields}
    out = []
    for c in df.columns:
        if c not in types:
            if strict:
                raise KeyError(c)
            out.append(F.col(c))
            continue
        out.append(F.col(c).try_cast(types[c]).alias(c))
    return df.select(*out)


def round_all(df: DataFrame, digits: int = 4, exclude: list[str] | None = None) -> DataFrame:
    """Round every double column and the values of double maps."""
    skip = set(exclude or [])
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in skip:
            out.append(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(c, digits).alias(f.name))
        elif isinstance(f.dataType, T.MapType) and isinstance(f.dataType.valueType, (T.DoubleType, T.FloatType)):
            out.append(F.transform_values(c, lambda k, v: F.round(v, digits)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def map_lookup(m, key) -> Column:
    """Null-safe map lookup."""
    m = F.col(m) if isinstance(m, str) else m
    key = F.lit(key) if not isinstance(key, Column) else key
    return F.try_element_at(m, key)
