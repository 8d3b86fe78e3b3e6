"""Analysis tables derived from the driver's parquet tables.

Each is a lazy DataFrame over whole tables, so the work grows with them:

customer_features   (F-A) churn-style feature table from customer/orders
supplier_seasons    (F-B) team-season analogue from lineitem x orders
season_champions    (F-B) champion per season: top revenue supplier
predictions         (F-C) scored 'view' events with probability
ground_truth        (F-C) truth per prediction: a purchase by the same user
                          within 6 hours
labelled_scores     (F-D) labels x documents: label and a score with ties
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flurry.functions.scalar import epoch_micros
from flurry.sources.tables import table

CUSTOMER_CATEGORICAL = ["segment", "region", "top_priority"]
CUSTOMER_NUMERIC = ["n_orders", "avg_price", "total_price", "acctbal"]
CHURN_WINDOW_DAYS = 180
TRUTH_WINDOW_HOURS = 6
TASK_ROWS = 1 << 19   # lineitem rows one task joins and groups


def cents(c: str):
    """A 2-decimal quantity (price, rate) as an exact integer number of
    hundredths. Summing these longs is exact and order-independent like a
    DECIMAL sum, without DECIMAL's arbitrary-precision arithmetic (sums of
    DECIMAL(15,2) exceed 18 digits and fall back to BigDecimal per row)."""
    return F.rint(F.col(c) * 100).cast("long")


def money_sum(c: str):
    """Exact sum of a 2-decimal quantity, converted once to double
    (hundredths / 100.0 rounds exactly like a DECIMAL -> DOUBLE cast)."""
    return F.sum(cents(c)) / 100.0


def customer_features(spark: SparkSession, d: str) -> DataFrame:
    """F-A: one row per customer.

    id, segment, region, top_priority (most urgent priority ordered),
    n_orders, avg_price, total_price, acctbal, Churn = 'Yes' when the
    customer's last order is more than 180 days before the last order date
    in the data.
    """
    orders = table(spark, d, "orders")
    last_day = orders.agg(F.max("o_orderdate")).scalar()
    cutoff = last_day - F.expr(f"INTERVAL {CHURN_WINDOW_DAYS} DAYS")
    per_cust = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        money_sum("o_totalprice").alias("total_price"),
        F.max("o_orderdate").alias("_last"),
        F.min("o_orderpriority").alias("top_priority"))
    per_cust = per_cust.withColumn("avg_price", F.col("total_price") / F.col("n_orders"))
    cust = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, d, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    j = (cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")
         .join(per_cust, cust.c_custkey == per_cust.o_custkey, "left"))
    churn = F.when(F.col("_last").isNull() | (F.col("_last") < cutoff), "Yes").otherwise("No")
    return j.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        "top_priority",
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        "avg_price", "total_price",
        F.col("c_acctbal").alias("acctbal"),
        churn.alias("Churn"))


def supplier_seasons(spark: SparkSession, d: str) -> DataFrame:
    """F-B: one row per supplier and order year.

    name, season, games_played (distinct orders), counting stats (sums of
    quantity, extended price, discount, tax, revenue) and a ratio column
    ``discount_percentage`` (average discount in percent; not a count).
    """
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity",
                                             "l_extendedprice", "l_discount", "l_tax")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    supp = table(spark, d, "supplier").select("s_suppkey", "s_name")
    # Nearly every line is a group of its own below, so a task's memory follows
    # its rows: the number of tasks follows the table (row counts of the files).
    rows = table(spark, d, "lineitem").count()
    if rows > TASK_ROWS:
        n = max(math.ceil(rows / TASK_ROWS), spark.sparkContext.defaultParallelism)
        li, orders = li.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    price, disc = cents("l_extendedprice"), cents("l_discount")
    # Two steps instead of count(DISTINCT) beside the sums (which makes Spark
    # duplicate every row through an Expand): per (supplier, year, order)
    # first -- a grouping that contains the join key, so a join shuffled on
    # l_orderkey already satisfies it -- then per (supplier, year) on the
    # reduced rows. Decimal sums stay exact across both steps.
    # revenue in 1/10000 units: price (1/100) x (1 - discount) (1/100), exact
    per_order = j.groupBy("l_suppkey", F.year("o_orderdate").alias("season"), "l_orderkey").agg(
        F.sum(cents("l_quantity")).alias("q"), F.sum(price).alias("p"), F.sum(disc).alias("dc"),
        F.sum(cents("l_tax")).alias("tx"), F.sum(price * (100 - disc)).alias("rv"),
        F.count(F.lit(1)).alias("nl"))
    agg = per_order.groupBy("l_suppkey", "season").agg(
        F.count(F.lit(1)).alias("games_played"),
        (F.sum("q") / 100.0).alias("quantity"),
        (F.sum("p") / 100.0).alias("extendedprice"),
        (F.sum("dc") / 100.0).alias("discount"),
        (F.sum("tx") / 100.0).alias("tax"),
        (F.sum("rv") / 10000.0).alias("revenue"),
        ((F.sum("dc") / 100.0) * 100 / F.sum("nl")).alias("discount_percentage"))
    return (agg.join(supp, agg.l_suppkey == supp.s_suppkey, "left")
            .select(F.col("s_name").alias("name"), "season", "games_played", "quantity",
                    "extendedprice", "discount", "tax", "revenue", "discount_percentage"))


def season_champions(seasons: DataFrame) -> DataFrame:
    """F-B champion table ``(Year, Champion)``: the top-revenue supplier of
    each season (ties: greater name). One map-side combined ``max_by``."""
    return seasons.groupBy(F.col("season").alias("Year")).agg(
        F.max_by("name", F.struct("revenue", "name")).alias("Champion"))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """F-C predictions: every 'view' event is one scored request.

    uuid = event_id, probability = least(value / 100, 1), prediction =
    probability >= 0.5 (threshold inclusive).
    """
    ev = table(spark, d, "events")
    p = ev.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("uuid"), "user_id", "ts",
        F.least(F.col("value") / 100.0, F.lit(1.0)).alias("probability"))
    return p.withColumn("prediction", F.col("probability") >= 0.5)


def ground_truth(spark: SparkSession, d: str) -> DataFrame:
    """F-C truth: ``final_label`` is true when the same user purchases within
    [view ts, view ts + 6 h].

    No view x purchase pairs are formed. Purchases are reduced to the first
    and last purchase time per (user, 6-hour bucket); a window [t, t+6h]
    starting in bucket b only reaches buckets b and b+1, so a purchase
    exists in it iff max(b) >= t or min(b+1) <= t+6h. Both lookups are
    one-to-one equi-joins on (user, bucket).
    """
    ev = table(spark, d, "events")
    width = TRUTH_WINDOW_HOURS * 3600 * 1_000_000
    us = epoch_micros("ts")
    pur = (ev.where(F.col("event_type") == "purchase")
           .select("user_id", us.alias("_t"))
           .groupBy("user_id", F.floor(F.col("_t") / width).alias("_b"))
           .agg(F.min("_t").alias("_tmin"), F.max("_t").alias("_tmax")))
    views = (ev.where(F.col("event_type") == "view")
             .select(F.col("event_id").alias("uuid"), "user_id", us.alias("_t"))
             .withColumn("_b", F.floor(F.col("_t") / width)))
    same = pur.select("user_id", "_b", "_tmax")
    nxt = pur.select("user_id", (F.col("_b") - 1).alias("_b"), F.col("_tmin").alias("_nmin"))
    j = views.join(same, ["user_id", "_b"], "left").join(nxt, ["user_id", "_b"], "left")
    hit = (F.coalesce(F.col("_tmax") >= F.col("_t"), F.lit(False))
           | F.coalesce(F.col("_nmin") <= F.col("_t") + width, F.lit(False)))
    return j.select("uuid", hit.alias("final_label"))


def labelled_scores(spark: SparkSession, d: str) -> DataFrame:
    """F-D: (doc_id, label, score, pred). label = quality; score =
    least(n_chars / 5000, 1), which has ties (equal lengths and the cap);
    pred = score >= 0.5."""
    lab = table(spark, d, "labels").select("doc_id", "quality")
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    j = lab.join(docs, "doc_id")
    score = F.least(F.col("n_chars") / 5000.0, F.lit(1.0))
    return j.select("doc_id", F.col("quality").cast("int").alias("label"), score.alias("score"),
                    (score >= 0.5).cast("int").alias("pred"))


def truth_events(spark: SparkSession, d: str) -> DataFrame:
    """F-C truth as events: (uuid, final_label, truth_ts) where truth_ts is
    the time the 6-hour window closes, i.e. when the label becomes final."""
    p = predictions(spark, d).select("uuid", "ts")
    t = ground_truth(spark, d)
    return p.join(t, "uuid").select(
        "uuid", "final_label", (F.col("ts") + F.expr(f"INTERVAL {TRUTH_WINDOW_HOURS} HOURS")).alias("truth_ts"))
