"""Classification metrics as DataFrames from (label, prediction) rows.

Everything is derived from the confusion counts ``(label, prediction, n)``,
which have at most (#classes)^2 rows; the scan itself is one partially
aggregated group-by.  Definitions follow Spark's multiclass metrics: labels
are the distinct values of the label column; a ratio with a zero
denominator is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return (df.groupBy(F.col(label).cast("double").alias("label"),
                       F.col(prediction).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def _ratio(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def by_label(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """label, tp, fp, fn, tn, fpr, tpr, precision, recall, f_measure."""
    conf = confusion(df, label, prediction)
    per_label = conf.groupBy("label").agg(F.sum("n").alias("n_label"),
                                          F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))
                                                .otherwise(0)).alias("tp"))
    per_pred = conf.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("n_pred"))
    # tiny: one row per class; the total is a window over those rows only
    j = (per_label.join(per_pred, "label", "left")
         .withColumn("n_pred", F.coalesce("n_pred", F.lit(0)))
         .withColumn("total", F.sum("n_label").over(Window.partitionBy())))
    fp = F.col("n_pred") - F.col("tp")
    fn = F.col("n_label") - F.col("tp")
    tn = F.col("total") - F.col("n_label") - fp
    p = _ratio(F.col("tp"), F.col("n_pred"))
    r = _ratio(F.col("tp"), F.col("n_label"))
    return j.select(
        "label", "tp", fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        _ratio(fp, fp + tn).alias("fpr"),
        r.alias("tpr"),
        p.alias("precision"),
        r.alias("recall"),
        _ratio(2 * p * r, p + r).alias("f_measure"),
        F.col("n_label"), F.col("total"),
    )


def weighted(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and label-frequency-weighted fpr, tpr, f, precision, recall."""
    b = by_label(df, label, prediction)
    w = F.col("n_label") / F.col("total")
    return b.agg(
        (F.sum("tp") / F.first("total")).alias("accuracy"),
        F.sum(w * F.col("fpr")).alias("weighted_fpr"),
        F.sum(w * F.col("tpr")).alias("weighted_tpr"),
        F.sum(w * F.col("f_measure")).alias("weighted_f_measure"),
        F.sum(w * F.col("precision")).alias("weighted_precision"),
        F.sum(w * F.col("recall")).alias("weighted_recall"),
    )


def mae(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean absolute error (equals the error rate for 0/1 predictions)."""
    return df.agg(F.avg(F.abs(F.col(label).cast("double") - F.col(prediction).cast("double"))).alias("mae"))
