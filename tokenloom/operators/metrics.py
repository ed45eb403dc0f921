"""Evaluation metrics over prediction tables.

All are partial+final aggregates: each task folds its rows into a few sums.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.arrays import argmax, shifted_matches


def with_argmax(df: DataFrame, logits_col: str = "logits", out_col: str = "pred") -> DataFrame:
    """F13 per row: first position of the largest logit."""
    return df.withColumn(out_col, argmax(logits_col).cast("bigint"))


def with_argmax_per_position(df: DataFrame, logits_col: str = "logits", out_col: str = "preds") -> DataFrame:
    """F13 for ``array<array<float>>`` logits (one row per position)."""
    return df.withColumn(out_col, F.transform(logits_col, lambda v: argmax(v)))


def shifted_accuracy(df: DataFrame, preds_col: str = "preds", labels_col: str = "labels",
                     ignore_masked: bool = False, group_cols: Sequence[str] = ()) -> DataFrame:
    """Accuracy of ``preds[:-1]`` against ``labels[1:]`` over all rows.

    By default -100 labels count as ordinary (always wrong) targets, as in
    the reference metric; ``ignore_masked=True`` leaves them out.
    """
    total, hits = shifted_matches(preds_col, labels_col, ignore_masked)
    t = df.select(*group_cols, total.alias("_t"), hits.alias("_h"))
    aggs = [F.sum("_t").cast("bigint").alias("n_positions"),
            F.sum("_h").cast("bigint").alias("n_correct")]
    out = t.groupBy(*group_cols).agg(*aggs) if group_cols else t.agg(*aggs)
    return out.withColumn("accuracy", F.when(F.col("n_positions") > 0,
                                             F.col("n_correct") / F.col("n_positions")))


def perplexity(df: DataFrame, loss_col: str = "loss", group_cols: Sequence[str] = ()) -> DataFrame:
    """``exp(mean loss)``; overflow gives +Infinity."""
    aggs = [F.count(loss_col).alias("n_loss"), F.avg(loss_col).alias("mean_loss")]
    out = df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    return out.withColumn("perplexity", F.exp("mean_loss"))


def cross_entropy(logits_col: str, target_col: str) -> F.Column:
    """Per-row loss of a logits vector against a 0-based target class:
    log-sum-exp minus the target logit (max-shifted for stability)."""
    m = F.array_max(logits_col)
    lse = m + F.log(F.aggregate(F.col(logits_col), F.lit(0.0).cast("double"),
                                lambda acc, x: acc + F.exp(x - m)))
    return lse - F.get(F.col(logits_col), F.col(target_col))
