"""Classifier evaluation.

Everything starts from a tiny aggregate: the (label, prediction) count table
for the report metrics, the (score -> positives, negatives) table for ROC and
AUC. The ROC cumulative sums use ``running_sums`` (range partitioned), not a
one-partition window, so the number of distinct scores may be as large as
the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.operators.windows import running_sums


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Share of rows with pred == label."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: list | None = None) -> DataFrame:
    """label x predicted counts (E7), zeros filled."""
    cc = confusion_counts(df, label, pred)
    piv = cc.groupBy("label").pivot("pred", classes).agg(F.first("n"))
    return piv.na.fill(0)


def _per_class(df: DataFrame, label: str, pred: str) -> DataFrame:
    """class, support (true count), predicted count, tp -- one pass: each row
    counts once for its true class and once for its predicted class."""
    y, p = F.col(label), F.col(pred)
    hit = (y == p).cast("long")
    both = F.array(
        F.struct(y.alias("cls"), F.lit(1).cast("long").alias("t"), F.lit(0).cast("long").alias("pr"),
                 hit.alias("tp")),
        F.struct(p.alias("cls"), F.lit(0).cast("long").alias("t"), F.lit(1).cast("long").alias("pr"),
                 F.lit(0).cast("long").alias("tp")))
    e = df.select(F.explode(both).alias("e")).select("e.*")
    return e.groupBy("cls").agg(F.sum("t").alias("support"), F.sum("pr").alias("predicted"),
                                F.sum("tp").alias("tp"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """precision, recall, f1, support per class, then the 'accuracy',
    'macro avg' and 'weighted avg' rows (E2). 0/0 is 0.0.
    Rows: (cls string, precision, recall, f1, support)."""
    # one row per class, read several times below: materialised once
    from flurry.session import cut_lineage
    pc = cut_lineage(_per_class(df, label, pred))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    pc = pc.select(F.col("cls").cast("string").alias("cls"), prec.alias("precision"), rec.alias("recall"),
                   "support", "tp")
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    pc = pc.withColumn("f1", f1)
    tot = pc.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("k"),
                 F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                 (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                 (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                 (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("cls"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                     F.col("n").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("cls"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("cls"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support"))
    return (pc.select("cls", "precision", "recall", "f1", "support")
            .unionByName(acc).unionByName(macro).unionByName(weighted))


def balanced_accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Mean recall over the classes present in ``label`` (E5)."""
    pc = _per_class(df, label, pred).where(F.col("support") > 0)
    return pc.agg(F.avg(F.col("tp") / F.col("support")).alias("balanced_accuracy"))


def positive_class_scores(df: DataFrame, label: str, pred: str, positive=1) -> DataFrame:
    """precision, recall, f1 of the positive class."""
    pos = F.lit(positive)
    agg = df.agg(F.count_if((F.col(label) == pos) & (F.col(pred) == pos)).alias("tp"),
                 F.count_if(F.col(pred) == pos).alias("pp"),
                 F.count_if(F.col(label) == pos).alias("ap"))
    p = F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(0.0)
    r = F.when(F.col("ap") > 0, F.col("tp") / F.col("ap")).otherwise(0.0)
    out = agg.select(p.alias("precision"), r.alias("recall"))
    return out.withColumn("f1", F.when((F.col("precision") + F.col("recall")) > 0,
                                       2 * F.col("precision") * F.col("recall")
                                       / (F.col("precision") + F.col("recall"))).otherwise(0.0))


def score_counts(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """(score, pos, neg) per distinct score; map-side combined."""
    is_pos = (F.col(label) == F.lit(positive)).cast("long")
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg"))


def roc_curve(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, highest first.
    All points are kept (no collinear-point dropping)."""
    sc = score_counts(df, label, score, positive)
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).select(F.struct("P", "N").alias("t")).scalar()
    run = running_sums(sc, [F.col("score").desc()], ["pos", "neg"]).withColumn("_t", tot)
    return run.select(F.col("score").alias("threshold"),
                      (F.col("neg_running") / F.col("_t.N")).alias("fpr"),
                      (F.col("pos_running") / F.col("_t.P")).alias("tpr"))


def auc(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """Area under ROC (E4), exact with ties counted half: for each distinct
    score, positives there beat the negatives below and tie with the
    negatives at the same score. Equals the rank-sum (Mann-Whitney) form."""
    sc = score_counts(df, label, score, positive)
    run = running_sums(sc, [F.col("score").asc()], ["neg"])
    below = F.col("neg_running") - F.col("neg")
    return run.agg(
        (F.sum(F.col("pos") * (below + 0.5 * F.col("neg")))
         / (F.sum("pos") * F.sum("neg"))).alias("auc"))
