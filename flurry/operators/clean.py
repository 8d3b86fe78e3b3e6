"""Projections, filters and cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def select_features(df: DataFrame, id_col: str | None, features: list[str],
                    label: str | None = None) -> DataFrame:
    """id, features..., label (P1). Column pruning reaches the scan."""
    cols = ([id_col] if id_col else []) + list(features) + ([label] if label else [])
    return df.select(*cols)


def drop_blank_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Blank -> null, then drop rows with any null.

    "Blank" is exactly one whitespace character: ``''`` and two spaces are
    kept. Only string columns can be blank; every column counts
    for the null drop.
    """
    targets = set(columns or [f.name for f in df.schema.fields
                              if isinstance(f.dataType, T.StringType)])
    out = df.select(*[
        F.when(is_blank(F.col(f"`{c}`")), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c)
        if c in targets else F.col(f"`{c}`")
        for c in df.columns
    ])
    return out.na.drop(how="any")


# --- fixed values: the whitespace characters of the "blank" rule -------------
# space, tab, newline, vertical tab, form feed, carriage return
BLANK_CHARS = "[ \t\n\x0B\f\r]"
# ---------------------------------------------------------------------------


def is_blank(c: Column) -> Column:
    """Exactly one whitespace character."""
    return (F.length(c) == 1) & c.rlike(BLANK_CHARS)


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows null in any of ``subset``."""
    return df.na.drop(how="any", subset=subset)


def recode(df: DataFrame, mapping: dict[str, dict]) -> DataFrame:
    """Replace values column by column.

    Keys and values are compared as text, so ``{1: 'Yes'}`` also recodes the
    string ``'1'`` (and the reverse); values not in the map pass unchanged.
    The result column is a string.
    """
    out = []
    for c in df.columns:
        if c in mapping and mapping[c]:
            m = F.create_map(*[x for k, v in mapping[c].items()
                               for x in (F.lit(str(k)), F.lit(None if v is None else str(v)))])
            s = F.col(f"`{c}`").cast("string")
            hit = F.map_contains_key(m, s)
            out.append(F.when(hit, F.element_at(m, s)).otherwise(s).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def presence_label(col, yes: str = "Yes", no: str = "No") -> Column:
    """'Yes' where the column is present, else 'No' (P9). A regex ``.*``
    replacement would give 'YesYes' (empty match after the whole string)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNotNull(), F.lit(yes)).otherwise(F.lit(no))


def concat_key(cols: list, sep: str = "_", null_propagates: bool = True) -> Column:
    """Composite key (P12). ``null_propagates`` mirrors '+' on text: any null
    part makes the key null; otherwise null parts are skipped."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    if null_propagates:
        parts = []
        for i, c in enumerate(cs):
            if i:
                parts.append(F.lit(sep))
            parts.append(c.cast("string"))
        return F.concat(*parts)
    return F.concat_ws(sep, *[c.cast("string") for c in cs])


def scale_by(df: DataFrame, denom: str, exclude: list[str] | None = None,
             exclude_containing: list[str] | None = None) -> DataFrame:
    """Divide numeric columns by a per-row denominator.

    Skips the denominator, ``exclude`` and names containing any of
    ``exclude_containing``. Zero denominator gives null (``try_divide``).
    """
    skip = set(exclude or []) | {denom}
    subs = list(exclude_containing or [])
    out = []
    for f in df.schema.fields:
        if (f.name not in skip and not any(s in f.name for s in subs)
                and isinstance(f.dataType, NUMERIC_TYPES)):
            out.append(F.try_divide(F.col(f"`{f.name}`").cast("double"),
                                    F.col(f"`{denom}`").cast("double")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def columns_where(df: DataFrame, numeric: bool | None = None, string: bool | None = None,
                  contains: str | None = None, exclude: list[str] | None = None) -> list[str]:
    """Column names by type and name pattern (P15); schema only, no job."""
    out = []
    for f in df.schema.fields:
        if exclude and f.name in exclude:
            continue
        if numeric is not None and isinstance(f.dataType, NUMERIC_TYPES) != numeric:
            continue
        if string is not None and isinstance(f.dataType, T.StringType) != string:
            continue
        if contains is not None and contains not in f.name:
            continue
        out.append(f.name)
    return out


def with_row_id(df: DataFrame, order_by: list[str], name: str = "row_id",
                start: int = 0) -> DataFrame:
    """Dense consecutive ids in ``order_by`` order without a one-partition
    window (P17). Range-partitioned numbering (see ``windows.positions``);
    ``order_by`` should be unique for a deterministic numbering."""
    from flurry.operators.windows import positions

    out = positions(df, [], order_by, name)
    return out.withColumn(name, F.col(name) + F.lit(start)) if start else out


def preview(df: DataFrame, n: int = 5, index_col: str | None = None) -> DataFrame:
    """First ``n`` rows transposed: one row per column (P18). ``n`` is bounded
    by the caller; every column is cast to string first."""
    head = df.limit(n)
    if index_col is None:
        head = head.withColumn("_row", F.monotonically_increasing_id().cast("string"))
        index_col = "_row"
    return head.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in head.columns]).transpose(
        F.col(index_col))


def with_defaults(df: DataFrame, defaults: DataFrame, keep_only_known: bool = False) -> DataFrame:
    """Fill each null field from a one-row defaults table.

    ``defaults`` must have one row. It is read as one scalar subquery
    returning a struct: Spark evaluates it once, inlines the value into the
    projection (no join, no shuffle) and fails the job if it has more than
    one row. The request value wins when present.
    """
    d = defaults.select(F.struct(*[F.col(f"`{c}`") for c in defaults.columns]).alias("d")).scalar()
    # the subquery is projected once and its fields read from that column
    x = df.withColumn("_dflt", d)
    cols = []
    for c in df.columns:
        if c in defaults.columns:
            cols.append(F.coalesce(F.col(f"`{c}`"), F.col("_dflt").getField(c)).alias(c))
        elif not keep_only_known:
            cols.append(F.col(f"`{c}`"))
    for c in defaults.columns:
        if c not in df.columns:
            cols.append(F.col("_dflt").getField(c).alias(c))
    return x.select(*cols)


def display_projection(df: DataFrame, uid: str, features: list[str]) -> DataFrame:
    """uid first, then the used features."""
    return df.select(uid, *[c for c in features if c != uid])


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """Equality filter (P4); pushed into the parquet scan."""
    return df.where(F.col(col) == F.lit(value))


def filter_cmp(df: DataFrame, col: str, op: str, value) -> DataFrame:
    """Comparison filter (P5): op in <, <=, >, >=, !=."""
    c, v = F.col(col), F.lit(value)
    ops = {"<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v, "!=": c != v, "==": c == v}
    return df.where(ops[op])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name, missing columns null.

    For many inputs prefer one partitioned read of a folder; this folds a
    short list only.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
