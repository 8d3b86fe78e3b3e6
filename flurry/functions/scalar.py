"""Column -> Column helpers.

Everything here is a built-in expression, so it stays inside whole-stage
codegen; nothing calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def contains_all(s, tokens: list[str]) -> Column:
    """True when the string contains every token (F3); null string -> false."""
    s = _c(s)
    cond = F.lit(True)
    for t in tokens:
        cond = cond & (F.instr(s, t) > 0)
    return F.coalesce(cond, F.lit(False))


def int_string(c) -> Column:
    """Number -> integer text, e.g. 2021.0 -> '2021' (F2)."""
    return _c(c).cast("int").cast("string")


def truncate(c, n: int = 5) -> Column:
    """First ``n`` characters of the text form."""
    return F.substring(_c(c).cast("string"), 1, n)


def epoch_ms_to_ts(c) -> Column:
    """Epoch milliseconds -> timestamp."""
    return F.timestamp_millis(_c(c))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(c) -> Column:
    """Epoch microseconds of a wall-clock (NTZ) timestamp, independent of the
    session time zone."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(c).cast("timestamp_ntz"))


def duration_micros(start, end) -> Column:
    """True elapsed time end - start in microseconds."""
    return epoch_micros(end) - epoch_micros(start)


def subsecond_nanos(start, end) -> Column:
    """Sub-second part of end - start, in ns: what a ``.microseconds * 1000``
    on a timedelta keeps (whole seconds are lost). Kept for comparison only."""
    return F.pmod(duration_micros(start, end), F.lit(1_000_000)) * 1000


def enumerate_map(arr) -> Column:
    """array [a, b, ...] -> map {0: a, 1: b, ...}."""
    return F.map_from_entries(
        F.transform(_c(arr), lambda x, i: F.struct(i.alias("k"), x.alias("v"))))


def merge_maps(base, override) -> Column:
    """Map merge where ``override`` wins (F15), whatever the session's policy for duplicate keys."""
    new = _c(override)
    return F.map_concat(F.map_filter(_c(base), lambda k, _: ~F.map_contains_key(new, k)), new)


def vector_element(vec, i: int = 1) -> Column:
    """Element ``i`` (0-based) of an ML vector, e.g. P(class 1) (F16)."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(_c(vec)).getItem(i)


def quantize(v, lo, hi, bins: int = 7) -> Column:
    """Bin index 1..bins over [lo, hi]; out-of-range values clamp to the end
    bins (F17). ``width_bucket`` returns bins+1 at ``hi`` and 0 below ``lo``."""
    wb = F.width_bucket(_c(v), F.lit(lo) if not isinstance(lo, Column) else lo,
                        F.lit(hi) if not isinstance(hi, Column) else hi, F.lit(bins))
    return F.least(F.greatest(wb, F.lit(1)), F.lit(bins))


def new_uuid() -> Column:
    """Fresh unique id per row (F18). Non-deterministic: persist the result
    before using it as a join key."""
    return F.expr("uuid()")
