"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed hash, so "all documents below a threshold" is a
random, reproducible subset, and a larger budget's subset contains a smaller
one's. The words below each threshold come from histograms over hash buckets:
the bucket in which a source's budget ends is found by running sums, and only
this bucket is refined with the next bits of the hash until one document is
left in it. Documents are then filtered by comparing hashes; nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flurry.operators.windows import positions
from flurry.session import staged_table

WEIGHTS = (5, 2, 1)
REPEATS = 3        # a source gives at most so many times its size
KEY_BITS, BITS = 60, 10
LEVELS = KEY_BITS // BITS


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` of a text; null: 0. Words become one letter each, white space goes."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marks, "\t\n\x0b\x0c\r ", "")).cast("long")


def text_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size`` -> the same with ``target`` (double).

    Sources in code-point order (null last) take the weights in turn and share
    the sum of all sizes; a target stops at ``repeats`` times the source's size
    and the excess is shared again by weight among the others, until none is
    above. A round reads two sums from the driver's side; the table of sources
    itself stays distributed.
    """
    order = [F.col("source").isNull(), F.col("source").cast("string")]
    k = F.pmod(F.col("_k"), F.lit(len(weights))).cast("int")
    table = positions(sizes, [], order, "_k").select(
        "source", "source_size", F.element_at(F.array(*[F.lit(w) for w in weights]), k + 1).cast("long").alias("weight"))
    table = staged_table(table, "sources")
    cap = F.col("source_size") * repeats
    level = 0.0
    while True:
        above = cap < F.lit(level) * F.col("weight")
        r = table.agg(F.sum("source_size").alias("all"), F.sum(F.when(above, cap)).alias("capped"),
                      F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        new = ((r["all"] or 0) - (r["capped"] or 0)) / r["open"] if r["open"] else level
        if new <= level:
            break
        level = new
    target = F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    return table.select("source", "source_size", target.alias("target"))


def _digits(level: int) -> tuple[Column, Column, Column]:
    """Leading digits of (hash, tie) known before this level, and the level's digit."""
    digit = F.lit((1 << BITS) - 1)
    if level < LEVELS:
        down = KEY_BITS - BITS * level
        return F.shiftright("h", down), F.lit(0).cast("long"), F.shiftright("h", down - BITS).bitwiseAND(digit)
    down = KEY_BITS - BITS * (level - LEVELS)
    return F.col("h"), F.shiftright("tie", down), F.shiftright("tie", down - BITS).bitwiseAND(digit)


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, h_to, t_to``: documents with (h, tie) below these fit the source's budget.

    The last document is taken if that brings the sum nearer to the budget.
    """
    zero = F.lit(0).cast("long")
    state = budgets.select(F.col("source").alias("of"), "budget", zero.alias("hp"), zero.alias("tp"), zero.alias("before"))
    done = None
    for level in range(2 * LEVELS):
        h, t, digit = _digits(level)
        part = rows.select("source", "size", h.alias("_h"), t.alias("_t"), digit.alias("digit")).join(
            state, F.col("source").eqNullSafe(F.col("of")) & (F.col("_h") == F.col("hp")) & (F.col("_t") == F.col("tp")))
        bins = part.groupBy("of", "digit").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("c"),
                                               *[F.min(x).alias(x) for x in ("budget", "hp", "tp", "before")])
        earlier = Window.partitionBy("of").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("before", F.col("before") + F.coalesce(F.sum("s").over(earlier), zero))
        # the one bucket in which the budget ends
        ends = bins.filter((F.col("before") < F.col("budget")) & (F.col("before") + F.col("s") >= F.col("budget")))
        grown = lambda c: (F.shiftleft(c, BITS) + F.col("digit")).alias(c)
        ends = staged_table(ends.select(
            "of", "budget", *([grown("hp"), F.col("tp")] if level < LEVELS else [F.col("hp"), grown("tp")]),
            "before", "s", "c"), "mix-level")
        last = F.lit(level == 2 * LEVELS - 1) | (F.col("c") == 1)
        take = (2 * F.col("before") + F.col("s") <= 2 * F.col("budget")).cast("long")
        if level < LEVELS:
            h_to, t_to = F.shiftleft(F.col("hp") + take, KEY_BITS - BITS * (level + 1)), zero
        else:
            h_to, t_to = F.col("hp"), F.shiftleft(F.col("tp") + take, KEY_BITS - BITS * (level + 1 - LEVELS))
        found = ends.filter(last).select("of", h_to.alias("h_to"), t_to.alias("t_to"))
        done = found if done is None else done.union(found)
        state = ends.filter(~last).drop("s", "c")
        if state.isEmpty():
            break
    return done


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, text: str = "text") -> DataFrame:
    """Per row of ``docs`` (``doc_id, text, source``): ``doc_id, size`` (words),
    ``source_size, target`` (its source's), ``taken`` (words the mix takes,
    repeats counted), ``source``.

    A source whose target is q times its size and a rest gives every document
    q times; the rest goes to the documents below the source's hash threshold.
    So no document is taken more than ``repeats`` times, and a source misses
    its target by at most half of one document. The same rows give the same
    mix in any order and on any number of tasks.

    Texts are read once; the later passes read (source, size, hash) rows. A hot
    source is summed before it is shuffled and refined like any other. A null
    text is empty (size 0, taken 0), a null source is a source of its own, the
    last. Rows equal in id, text and source share a hash; a second key tells
    them apart, so a group of copies is split where the budget ends. A null id
    is like any id. Other columns are not read. Empty tables give an empty
    result.
    """
    whole = docs.select("doc_id", F.col(text).alias("__t"), "source")
    rows = whole.select("doc_id", "source", word_count(F.col("__t")).alias("size"), text_hash(F.col("doc_id"), F.col("__t")).alias("h"),
                        F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - KEY_BITS).alias("tie"))
    rows = staged_table(rows, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = staged_table(source_targets(sizes, weights, repeats), "mix-plan")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.select(F.col("source").alias("of"), "source_size", "target", full.alias("full"))
    budgets = plan.select(F.col("of").alias("source"), (F.col("target") - F.col("full") * F.col("source_size")).alias("budget"))
    ends = _thresholds(rows.filter("size > 0"), budgets.filter("budget > 0"))
    plan = staged_table(plan.join(ends.withColumnRenamed("of", "_e"), F.col("of").eqNullSafe(F.col("_e")), "left").drop("_e"), "mix-ends")
    below = (F.col("h") < F.col("h_to")) | ((F.col("h") == F.col("h_to")) & (F.col("tie") < F.col("t_to")))
    times = F.col("full") + F.coalesce(below, F.lit(False)).cast("long")
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), "source"))


# The same in SQL: the documents of a source in hash order, taken while their sum stays within half a document of the budget.
MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  ('0x' || substring(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight FROM s),
r AS (SELECT *, 3.0::DOUBLE * source_size / weight AS ratio FROM w),
-- levels with the sources of the smallest ratios capped; the first at which no other is above
c AS (SELECT ratio, coalesce(sum(3 * source_size) OVER b, 0)::BIGINT AS capped, coalesce(sum(weight) OVER b, 0)::BIGINT AS gone,
             row_number() OVER (ORDER BY ratio, source IS NULL, source) AS k
      FROM r WINDOW b AS (ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT k, ratio, ((SELECT sum(source_size) FROM s) - capped)::DOUBLE / ((SELECT sum(weight) FROM w) - gone)::DOUBLE AS level FROM c),
l AS (SELECT level FROM v WHERE level <= ratio ORDER BY k LIMIT 1),
p AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, level * weight) AS target FROM w, l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS times FROM p),
o AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.times, d.source, target - times * source_size AS budget,
             sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (size * (times + CASE WHEN 2 * upto - size <= 2 * budget THEN 1 ELSE 0 END))::BIGINT AS taken, source FROM o
"""
