"""Evaluation metrics as partial/final aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.functions.vectors import argmax, cross_entropy, log_softmax

EPSILON = 1e-5


def weighted_mean(value: Column, weight: Column) -> Column:
    """0 when the weights sum to 0."""
    total = F.sum(weight)
    return F.when(total == 0, F.lit(0.0)).otherwise(F.sum(weight * value) / total)


def accuracy(pred: Column, label: Column, weight: Column | None = None) -> Column:
    hit = (pred == label).cast("double")
    return weighted_mean(hit, weight if weight is not None else F.lit(1.0))


def batch_loss(loss: Column, weight: Column) -> Column:
    return F.sum(weight * loss) / (F.sum(weight) + F.lit(EPSILON))


def scored(preds: DataFrame, logits: str = "logits", label: str = "label_id") -> DataFrame:
    """Add pred and loss of each prediction row."""
    with_lp = preds.withColumn("_lp", log_softmax(F.col(logits)))
    return with_lp.withColumn("pred", argmax(F.col("_lp"))).withColumn(
        "loss", cross_entropy(F.col("_lp"), F.col(label))).drop("_lp")


def eval_report(masked: DataFrame, following: DataFrame) -> DataFrame:
    """The four metrics in one row."""
    m = masked.agg(accuracy(F.col("pred"), F.col("label_id"), F.col("weight")).alias("masked_lm_accuracy"),
                   weighted_mean(F.col("loss"), F.col("weight")).alias("masked_lm_loss"))
    n = following.agg(accuracy(F.col("pred"), F.col("label_id")).alias("next_sentence_accuracy"),
                      F.avg("loss").alias("next_sentence_loss"))
    # Two one-row relations side by side.
    return m.withColumn("_k", F.lit(1)).join(n.withColumn("_k", F.lit(1)), "_k").drop("_k")


def as_key_values(report: DataFrame) -> DataFrame:
    """Metric columns as (key, value) rows."""
    return report.unpivot([], sorted(report.columns), "key", "value")
