"""Registered evaluation queries over (label, score) rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..sources import bindings as B
from .registry import r6, register

COUNTS = """c AS (SELECT count(*) FILTER (WHERE label = 1 AND score >= 0.5e0) AS tp,
                    count(*) FILTER (WHERE label <> 1 AND score >= 0.5e0) AS fp,
                    count(*) FILTER (WHERE label = 1 AND score < 0.5e0) AS fn,
                    count(*) FILTER (WHERE label <> 1 AND score < 0.5e0) AS tn FROM scored)"""
SCORE_TABLE = """st AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
                         count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY score),
cum AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS pos_cum,
               sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS neg_cum FROM st),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM st),
auc AS (SELECT sum(neg * (pos_cum - pos / 2e0)) / (max(P) * max(N)) AS auc_roc FROM cum, tot)"""


def div(a, b):
    return f"CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) ELSE 0e0 END"


METRICS = f"""m AS (SELECT tp, fp, fn, tn, {div('tp', 'tp + fn')} AS recall, {div('tp', 'tp + fp')} AS precision,
     {div('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {div('fp', 'fp + tn')} AS false_positive_rate,
     {div('fn', 'fn + tp')} AS false_negative_rate FROM c)"""


@register("confusion_matrix", B.with_views(
    """SELECT 0 AS label, 0 AS predicted, tn AS n FROM c UNION ALL SELECT 0, 1, fp FROM c
       UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""", "scored",
    extra={"c": COUNTS[len("c AS ("):-1]}))
def q_confusion(spark, sf_dir):
    return ev.confusion_matrix(B.scored(spark, sf_dir))


@register("binary_metrics", B.with_views(
    f"""SELECT tp, fp, fn, tn, round(recall, 6) AS recall, round(precision, 6) AS precision,
               round({div('2 * precision * recall', 'precision + recall')}, 6) AS f1,
               round(accuracy, 6) AS accuracy, round(false_positive_rate, 6) AS false_positive_rate,
               round(false_negative_rate, 6) AS false_negative_rate, round(auc_roc, 6) AS auc_roc
        FROM m, auc""", "scored",
    extra={"c": COUNTS[len("c AS ("):-1], "m": METRICS[len("m AS ("):-1],
           "st": SCORE_TABLE.split("),\ncum AS (")[0][len("st AS ("):],
           "cum": SCORE_TABLE.split("),\ncum AS (")[1].split("),\ntot AS (")[0],
           "tot": SCORE_TABLE.split("),\ntot AS (")[1].split("),\nauc AS (")[0],
           "auc": SCORE_TABLE.split("),\nauc AS (")[1][:-1]}))
def q_binary_metrics(spark, sf_dir):
    """recall / precision / F1 / accuracy at 0.5 and AUC-ROC for the scored labels."""
    m = ev.binary_metrics(B.scored(spark, sf_dir))
    rounded = ["recall", "precision", "f1", "accuracy", "false_positive_rate", "false_negative_rate", "auc_roc"]
    return m.select("tp", "fp", "fn", "tn", *[r6(F.col(c)).alias(c) for c in rounded])


_ST_CTES = {"st": SCORE_TABLE.split("),\ncum AS (")[0][len("st AS ("):],
            "cum": SCORE_TABLE.split("),\ncum AS (")[1].split("),\ntot AS (")[0],
            "tot": SCORE_TABLE.split("),\ntot AS (")[1].split("),\nauc AS (")[0]}


@register("roc_curve", B.with_views(
    f"""SELECT score AS threshold, round({div('neg_cum', 'N')}, 6) AS fpr, round({div('pos_cum', 'P')}, 6) AS tpr
        FROM cum, tot""", "scored", extra=_ST_CTES))
def q_roc(spark, sf_dir):
    r = ev.roc_curve(B.scored(spark, sf_dir))
    return r.select("threshold", r6(F.col("fpr")).alias("fpr"), r6(F.col("tpr")).alias("tpr"))


REPORT_SQL = f"""per AS (
  SELECT '0' AS class, {div('tn', 'tn + fn')} AS precision, {div('tn', 'tn + fp')} AS recall, tn + fp AS support FROM c
  UNION ALL
  SELECT '1', {div('tp', 'tp + fp')}, {div('tp', 'tp + fn')}, tp + fn FROM c),
per2 AS (SELECT *, {div('2 * precision * recall', 'precision + recall')} AS f1 FROM per),
tt AS (SELECT sum(support) AS s FROM per2)"""


@register("classification_report", B.with_views(
    """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
              CAST(support AS BIGINT) AS support FROM per2
       UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
              CAST(max(s) AS BIGINT) FROM per2, tt
       UNION ALL SELECT 'weighted avg', round(sum(precision * support / s), 6), round(sum(recall * support / s), 6),
              round(sum(f1 * support / s), 6), CAST(max(s) AS BIGINT) FROM per2, tt""", "scored",
    extra={"c": COUNTS[len("c AS ("):-1],
           "per": REPORT_SQL.split("),\nper2 AS (")[0][len("per AS (\n"):],
           "per2": REPORT_SQL.split("),\nper2 AS (")[1].split("),\ntt AS (")[0],
           "tt": REPORT_SQL.split("),\ntt AS (")[1][:-1]}))
def q_report(spark, sf_dir):
    r = ev.classification_report(B.scored(spark, sf_dir))
    return r.select("class", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("compare_runs", B.with_views(
    f"""SELECT round(recall, 6) AS recall, 0.87e0 AS baseline_recall, round((recall - 0.87e0) * 100, 6) AS gain_points,
               CASE WHEN (recall - 0.87e0) * 100 > 0 THEN 'better' WHEN (recall - 0.87e0) * 100 = 0 THEN 'equal'
                    ELSE 'worse' END AS verdict FROM m""", "scored",
    extra={"c": COUNTS[len("c AS ("):-1], "m": METRICS[len("m AS ("):-1]}))
def q_compare(spark, sf_dir):
    """Recall of the scored labels against the published baseline recall (0.870)."""
    m = ev.metrics_from_counts(ev.confusion_counts(B.scored(spark, sf_dir)))
    c = ev.compare_runs(m)
    return c.select(r6(F.col("recall")).alias("recall"), "baseline_recall",
                    r6(F.col("gain_points")).alias("gain_points"), "verdict")
