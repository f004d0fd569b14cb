"""Classification metrics as aggregations.

Everything reduces to counts per (label, prediction) or per distinct score,
so evaluation is one partial aggregation over the scored rows, whatever
their number.  ROC and AUC use running sums over distinct scores computed
with range-partitioned prefix sums (no single-task window).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import BASELINE_RECALL
from .ordering import prefix_sums


def _div(a, b):
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5,
                     pred: str | None = None) -> DataFrame:
    """One row: tp, fp, fn, tn (prediction = score >= threshold unless ``pred`` is given)."""
    p = F.col(pred) == 1 if pred else F.col(score) >= threshold
    y = F.col(label) == 1
    return df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def confusion_matrix(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """2x2 long form (label, predicted, n), zero cells included."""
    c = confusion_counts(df, label, score, threshold)
    return c.selectExpr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (label, predicted, n)")


def metrics_from_counts(c: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    recall = _div(tp, tp + fn)
    precision = _div(tp, tp + fp)
    return c.select(
        "tp", "fp", "fn", "tn",
        recall.alias("recall"), precision.alias("precision"),
        _div(2 * precision * recall, precision + recall).alias("f1"),
        _div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _div(fp, fp + tn).alias("false_positive_rate"),
        _div(fn, fn + tp).alias("false_negative_rate"),
    )


def score_table(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score: positives and negatives (the only input ROC/AUC need)."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, thresholds descending."""
    st = score_table(df, label, score).withColumn("_desc", -F.col("score"))
    cum = prefix_sums(st, ["_desc"], ["pos", "neg"])
    tot = st.agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    return cum.crossJoin(F.broadcast(tot)).select(
        F.col("score").alias("threshold"),
        _div(F.col("neg_cum"), F.col("_N")).alias("fpr"),
        _div(F.col("pos_cum"), F.col("_P")).alias("tpr"))


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under ROC (= Mann-Whitney U / (P*N)); ties count one half."""
    st = score_table(df, label, score).withColumn("_desc", -F.col("score"))
    cum = prefix_sums(st, ["_desc"], ["pos"])
    # negatives at score s are beaten by positives strictly above s, tied with those at s
    u = cum.agg(F.sum(F.col("neg") * (F.col("pos_cum") - F.col("pos") / 2.0)).alias("_u"),
                F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    return u.select(_div(F.col("_u"), F.col("_P") * F.col("_N")).alias("auc_roc"))


def binary_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """recall, precision, F1, accuracy (class 1 at the threshold) and AUC in one row."""
    m = metrics_from_counts(confusion_counts(df, label, score, threshold))
    return m.crossJoin(auc(df, label, score))


def classification_report(df: DataFrame, label: str = "label", score: str = "score",
                          threshold: float = 0.5) -> DataFrame:
    """Per class precision / recall / F1 / support, plus macro and weighted averages."""
    c = confusion_counts(df, label, score, threshold)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))

    def row(name, t_p, f_p, f_n, support):
        prec, rec = _div(t_p, t_p + f_p), _div(t_p, t_p + f_n)
        return c.select(F.lit(name).alias("class"), prec.alias("precision"), rec.alias("recall"),
                        _div(2 * prec * rec, prec + rec).alias("f1"), support.cast("long").alias("support"))

    per = row("0", tn, fn, fp, tn + fp).unionByName(row("1", tp, fp, fn, tp + fn))
    tot = per.agg(F.sum("support").alias("_s"))
    avg = per.crossJoin(tot).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support") / F.col("_s")).alias("wp"),
        F.sum(F.col("recall") * F.col("support") / F.col("_s")).alias("wr"),
        F.sum(F.col("f1") * F.col("support") / F.col("_s")).alias("wf"),
        F.max("_s").alias("_s"))
    macro = avg.select(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("_s").alias("support"))
    weighted = avg.select(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("_s").alias("support"))
    return reduce(DataFrame.unionByName, [per, macro, weighted])


def compare_runs(metrics: DataFrame, baseline_recall: float = BASELINE_RECALL) -> DataFrame:
    """Gain in recall points over the baseline and a verdict."""
    gain = (F.col("recall") - F.lit(baseline_recall)) * 100
    return metrics.select(
        "recall", F.lit(baseline_recall).alias("baseline_recall"), gain.alias("gain_points"),
        F.when(gain > 0, "better").when(gain == 0, "equal").otherwise("worse").alias("verdict"))


def leaderboard(results: DataFrame, k: int | None = None) -> DataFrame:
    """results(model, recall, precision, f1, auc_roc[, rounds]) -> formatted columns, best recall first."""
    out = results.select(
        "model", F.format_string("%.3f", F.bround("recall", 3)).alias("Recall"),
        F.format_string("%.3f", F.bround("precision", 3)).alias("Precision"),
        F.format_string("%.3f", F.bround("f1", 3)).alias("F1-Score"),
        F.format_string("%.3f", F.bround("auc_roc", 3)).alias("AUC-ROC"),
        *[F.col(c) for c in ("rounds",) if c in results.columns],
        F.col("recall").alias("recall_raw"))
    out = out.orderBy(F.desc("recall_raw"), F.asc("model"))
    return out.limit(k) if k else out
