"""Regression metrics as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.functions import numbers

METRICS = ("mae", "rmse", "r2", "mape")


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and MAPE percent per group, predictions bounded below by 0.

    MAPE is over non-zero actual values, null without any. R2 of constant
    actual values is 1 for a perfect prediction, else 0.
    """
    y = F.col(actual).cast("double")
    miss = y - numbers.clip(F.col(predicted).cast("double"), low=0)
    spread = F.var_pop(y) * F.count(y)
    squares = F.sum(miss * miss)
    relative = F.when(y != 0, F.abs(miss / F.nullif(y, F.lit(0.0))))
    return df.groupBy(*by).agg(
        F.avg(F.abs(miss)).alias("mae"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.when(spread != 0, 1 - squares / F.nullif(spread, F.lit(0.0)))
        .when(squares == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
        .alias("r2"),
        (F.avg(relative) * 100).alias("mape"),
    )


def fold_summary(per_fold: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation over folds."""
    return per_fold.groupBy(*by).agg(
        *[
            f(m).alias(f"{m}_{name}")
            for m in METRICS
            for name, f in (("mean", F.avg), ("std", F.stddev_pop))
        ],
        F.count("*").alias("n_folds"),
    )


def mean_importance(per_fold: DataFrame, n_splits: int, by: Sequence[str] = ()) -> DataFrame:
    """Importance summed by feature over folds, divided by the number of folds."""
    return per_fold.groupBy(*by, "feature_name").agg(
        (F.sum("importance_score") / n_splits).alias("importance_score")
    )
