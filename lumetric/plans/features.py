"""The feature matrix: join, encode, impute."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetric.functions import numbers
from lumetric.operators.encode import apply_encoders, fit_encoders
from lumetric.operators.quantiles import medians
from lumetric.operators.rows import keep_first, lookup_join
from lumetric.plans.vision import PCA_PREFIX
from lumetric.session import settle, together

# The feature lists, in model order.
CATEGORICAL = ("device_type", "platform_os", "geo_country", "interaction_direction")
CONTEXT_NUMERIC = (
    "has_video", "video_length_seconds", "n_engagement_labels", "n_click_through_labels",
    "n_engagement_texts", "n_click_through_texts", "dominant_color_r", "dominant_color_g",
    "dominant_color_b", "dominant_color_proportion", "color_saturation_mean",
    "color_luminosity_mean", "color_diversity", "brightness", "aspect_ratio",
)
CAMPAIGN_NUMERIC = (
    "buy_rate_cpe", "volume_agreed", "gross_cost_budget", "campaign_duration_days",
)
VISION_NUMERIC = (
    "brightness_mean", "saturation_mean", "colorfulness", "visual_entropy",
    "color_diversity_score", "is_dark_background", "is_light_background", "file_size_kb",
)


@dataclass(frozen=True)
class Fitted:
    """What fitting learned: category codes and the value for missing numbers."""

    encoders: DataFrame
    fills: dict[str, float]

    def save(self, path: str) -> None:
        spark = self.encoders.sparkSession
        self.encoders.write.mode("overwrite").parquet(f"{path}/encoders")
        fills = spark.createDataFrame(list(self.fills.items()), "feature string, fill double")
        fills.coalesce(1).write.mode("overwrite").parquet(f"{path}/fills")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Fitted:
        fills = spark.read.parquet(f"{path}/fills").collect()
        return Fitted(
            spark.read.parquet(f"{path}/encoders"), {r["feature"]: r["fill"] for r in fills}
        )


def tabular_features(columns: list[str]) -> list[str]:
    wanted = [f"{c}_enc" for c in CATEGORICAL] + list(CONTEXT_NUMERIC + CAMPAIGN_NUMERIC)
    return [c for c in wanted if c in columns]


def visual_features(columns: list[str], pca: bool = True) -> list[str]:
    """Measures, then PCA columns sorted as text."""
    chosen = [c for c in VISION_NUMERIC if c in columns]
    return chosen + (sorted(c for c in columns if c.startswith(PCA_PREFIX)) if pca else [])


def feature_sets(columns: list[str]) -> dict[str, list[str]]:
    """Feature columns of the tabular, vision and multimodal models."""
    tabular, visual = tabular_features(columns), visual_features(columns)
    both = list(dict.fromkeys(tabular + visual))
    return {"tabular": tabular, "vision": visual, "multimodal": both}


def join_vision(linked: DataFrame, vision: DataFrame) -> DataFrame:
    """Add the image columns the linked rows lack, one image row per filename."""
    if "image_filename" not in linked.columns:
        return linked
    images = keep_first(vision.withColumnRenamed("filename", "image_filename"), ["image_filename"])
    skipped = {*linked.columns, "slug", "request_id", "filepath"}
    new = [c for c in images.columns if c not in skipped]
    return lookup_join(linked, images.select("image_filename", *new), "image_filename")


def feature_matrix(
    linked: DataFrame,
    vision: DataFrame | None = None,
    fitted: Fitted | None = None,
    fill_fitted: bool = False,
) -> tuple[DataFrame, Fitted]:
    """Linked rows with codes and complete numbers.

    Without ``fitted``, codes and medians come from these rows, which are
    written once because fitting reads them several times. With it, its codes
    apply and missing numbers become 0, or its medians with ``fill_fitted``.
    """
    df = linked if vision is None else join_vision(linked, vision)
    names = tabular_features(df.columns) + visual_features(df.columns)
    texts = {c for c, kind in df.dtypes if kind == "string"}
    df = df.withColumns(
        {c: (numbers.number if c in texts else numbers.finite)(F.col(c)) for c in names}
    )
    if fitted is None:
        df = settle(df, "joined")
        # Medians read only the numeric columns of that table, not the coded rows.
        learned = together(
            df.sparkSession,
            lambda: fit_encoders(df, CATEGORICAL),
            lambda: medians(df, names),
        )
        fitted = Fitted(*learned)
        fills = fitted.fills
    else:
        fills = fitted.fills if fill_fitted else dict.fromkeys(names, 0.0)
    return apply_encoders(df, fitted.encoders, CATEGORICAL).na.fill(fills), fitted


def feature_profile(matrix: DataFrame) -> DataFrame:
    """Rows, campaigns, mean and maximum of the rates, in one row."""
    return matrix.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("campaign_id").alias("n_campaigns"),
        *[
            f(c).alias(f"{c}_{name}")
            for c in ("engagement_rate", "click_through_rate")
            for name, f in (("mean", F.avg), ("max", F.max))
        ],
    )
