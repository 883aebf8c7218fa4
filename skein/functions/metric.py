"""The per-entity F0.5 and its parts, as expressions over counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """1 if truth and prediction are empty, 0 if only one is, else F0.5; with integers it has a closed form."""
    return F.when(n_true == 0, (n_pred == 0).cast("double")).otherwise(F.lit(1.25) * tp / (F.lit(0.25) * n_true + n_pred))


def precision(tp: Column, n_pred: Column) -> Column:
    return F.when(n_pred > 0, tp / n_pred)


def recall(tp: Column, n_true: Column) -> Column:
    return F.when(n_true > 0, tp / n_true)


def source_mix(n_s2: Column, n_s3: Column) -> Column:
    return F.when((n_s2 > 0) & (n_s3 > 0), "both").when(n_s2 > 0, "S2 only").when(n_s3 > 0, "S3 only").otherwise("none")


def count_bucket(n: Column) -> Column:
    return F.when(n >= 3, "3+").otherwise(n.cast("string"))
