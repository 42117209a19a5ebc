"""Read queries over the marts and the model results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumetric.functions import numbers, text
from lumetric.operators.quantiles import exact_quantiles

DEFAULT_R2 = 0.53


def latest_run(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("run_timestamp") == rows.agg(F.max("run_timestamp")).scalar())


def global_stats(
    metrics: DataFrame, creatives: DataFrame, campaigns: DataFrame, benchmarks: DataFrame
) -> DataFrame:
    """Impressions, creatives, campaigns and the latest multimodal R2, in one row."""
    r2 = benchmarks.where("model_name = 'multimodal'").agg(
        F.max_by("r2", F.struct("run_timestamp", "r2"))
    )
    return metrics.agg(
        F.coalesce(F.sum("n_impressions"), F.lit(0)).alias("total_events")
    ).select(
        "total_events",
        creatives.agg(F.count("*")).scalar().alias("total_creatives"),
        campaigns.agg(F.count("*")).scalar().alias("total_campaigns"),
        numbers.float_round(F.coalesce(r2.scalar(), F.lit(DEFAULT_R2)), 4).alias("multimodal_r2"),
    )


def latest_benchmarks(benchmarks: DataFrame) -> DataFrame:
    return latest_run(benchmarks).select(
        "model_name",
        numbers.float_round(F.col("r2"), 4).alias("r2"),
        numbers.float_round(F.col("mae"), 4).alias("mae"),
        numbers.float_round(F.col("mape"), 2).alias("mape"),
        "n_features",
    )


def top_features(importances: DataFrame, k: int = 10, model: str = "multimodal") -> DataFrame:
    """The k most important features of the latest run, names breaking ties."""
    rows = latest_run(importances).where(F.col("model_name") == model)
    return rows.orderBy(F.desc("importance_score"), "feature_name").limit(k).select(
        text.display_name(F.col("feature_name")).alias("name"),
        numbers.float_round(F.col("importance_score"), 4).alias("importance"),
        "category",
    )


def metrics_long(benchmarks: DataFrame) -> DataFrame:
    """(model, metric, value) for charts; MAPE as a share."""
    return (
        benchmarks.select(
            F.initcap("model_name").alias("model"),
            F.col("mae").alias("MAE"),
            F.col("rmse").alias("RMSE"),
            (F.col("mape") / 100.0).alias("MAPE"),
            F.col("r2").alias("R2"),
        )
        .unpivot("model", ["MAE", "RMSE", "MAPE", "R2"], "metric", "value")
    )


def top_creatives(
    metrics: DataFrame, campaigns: DataFrame, k: int = 5, min_impressions: int = 1000
) -> DataFrame:
    """The best rows by engagement rate; only the winners meet the order, per task."""
    rows = metrics.where(F.col("n_impressions") >= min_impressions)
    named = rows.join(campaigns.select("campaign_id", "campaign_name"), "campaign_id")
    grain = ("campaign_id", "game_key", "device_type", "platform_os", "geo_country")
    return named.orderBy(F.desc("engagement_rate"), *grain).limit(k).select(
        "game_key",
        "campaign_name",
        "n_impressions",
        "n_engagements",
        numbers.percent(F.col("n_engagements"), F.col("n_impressions")).alias("er_percent"),
        numbers.percent(F.col("n_clicks"), F.col("n_impressions")).alias("ctr_percent"),
    )


def top_campaigns(rollup: DataFrame, k: int = 10) -> DataFrame:
    ordered = rollup.orderBy(F.desc_nulls_last("total_impressions"), "campaign_id")
    return ordered.limit(k).select(
        "campaign_name",
        "num_creatives",
        "total_impressions",
        "avg_engagement_rate_pct",
        "avg_click_through_rate_pct",
    )


def rate_percentiles(
    metrics: DataFrame, by: str = "geo_country", rate: str = "engagement_rate"
) -> DataFrame:
    """Exact 25th, 50th and 75th percentile of a rate per group."""
    found = exact_quantiles(metrics, by, rate, [0.25, 0.5, 0.75])
    return found.groupBy(by).agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
            for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
        ]
    )


def column_profile(df: DataFrame) -> DataFrame:
    """(column, type, non_null, n_rows) in one pass."""
    kinds = dict(df.dtypes)
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns], F.count("*").alias("_rows"))
    long = counts.unpivot("_rows", df.columns, "column", "non_null")
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), F.col("column"))
    return long.select("column", kind.alias("type"), "non_null", F.col("_rows").alias("n_rows"))


def sample(df: DataFrame, n: int = 1000, key: Sequence[str] = (), seed: int = 0) -> DataFrame:
    """The ``n`` rows of smallest hash: the same rows however the table is partitioned.

    The hash is of ``seed`` and the ``key`` columns as text, all columns without
    a key; ties of a key go by all columns. Each task keeps its ``n`` best rows, so that
    no more of them leave it. Fewer rows than ``n`` are all taken.
    """

    def hashed(columns: Sequence[str]) -> Column:
        texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in columns]
        return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))

    order = [hashed(key), hashed(df.columns)] if key else [hashed(df.columns)]
    return df.orderBy(*order).limit(n)
