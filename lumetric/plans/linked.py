"""Rates joined with design and campaign data, from files or from the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetric.functions import numbers, text
from lumetric.operators.rows import lookup_join, only_present
from lumetric.sources import schemas
from lumetric.sources.sinks import ANALYTICS, STAGING

# Design columns of the warehouse read.
WAREHOUSE_DESIGN = (
    "n_engagement_labels", "n_click_through_labels", "engagement_labels_text",
    "n_engagement_texts", "engagement_text_content", "dominant_color_r", "dominant_color_g",
    "dominant_color_b", "dominant_color_proportion", "color_saturation_mean",
    "color_luminosity_mean", "color_diversity", "brightness", "has_video",
    "video_length_seconds", "interaction_direction", "adunit_width", "adunit_height",
    "aspect_ratio",
)


def images_with_design(images: DataFrame, design: DataFrame) -> DataFrame:
    """Registry rows with their design; a null request id matches nothing."""
    return lookup_join(images, design, "request_id")


def linked_from_files(kpi: DataFrame, design: DataFrame, briefing: DataFrame) -> DataFrame:
    """Rates with design and latest briefing.

    A request id under several design keys repeats its rates, one row per
    design record.
    """
    right = design.withColumnsRenamed(
        {"game_key": "design_game_key", "request_id": "creative_request_id"}
    )
    df = lookup_join(kpi, right, "creative_request_id")
    df = lookup_join(df, only_present(briefing, schemas.BRIEFING_COLUMNS), "campaign_id")
    if {"startdate", "enddate"} <= set(df.columns):
        days = numbers.whole_days(F.col("startdate"), F.col("enddate"))
        df = df.withColumn("campaign_duration_days", days)
    name = text.image_filename(F.col("creative_slug"), F.col("creative_request_id"))
    return df.withColumn("image_filename", name)


def linked_from_tables(
    metrics: DataFrame, creatives: DataFrame, campaigns: DataFrame, design: DataFrame
) -> DataFrame:
    """Fact with its dimensions and design, joined along the foreign keys."""
    identity = creatives.select(
        "game_key", "creative_slug", "creative_request_id", "image_filename"
    )
    looks = design.select(
        F.col("request_id").alias("creative_request_id"), *WAREHOUSE_DESIGN
    )
    rows = metrics.where(F.col("campaign_id").isNotNull()).drop("id")
    df = lookup_join(rows, identity, "game_key")
    df = lookup_join(df, campaigns, "campaign_id")
    df = lookup_join(df, looks, "creative_request_id")
    days = numbers.whole_days(F.col("startdate"), F.col("enddate"), clipped=False)
    return df.withColumn("campaign_duration_days", days)


def read_linked(spark: SparkSession, ordered: bool = False) -> DataFrame:
    """The warehouse read; ordering is for presentation only."""
    df = linked_from_tables(
        spark.table(f"{ANALYTICS}.creative_metrics"),
        spark.table(f"{ANALYTICS}.creatives"),
        spark.table(f"{ANALYTICS}.campaigns"),
        spark.table(f"{STAGING}.raw_design_metadata"),
    )
    return df.orderBy("campaign_id", "game_key") if ordered else df


def read_vision_features(spark: SparkSession) -> DataFrame:
    return spark.table(f"{STAGING}.raw_vision_features")


def registry_with_sizes(assets: DataFrame, files: DataFrame, ordered: bool = False) -> DataFrame:
    """Stored registry with placement from the slug and size from a listing, 0 if gone.

    Ordering by file name is for presentation only.
    """
    sizes = files.select(
        F.col("path").alias("filepath"), numbers.kilobytes(F.col("length")).alias("_kb")
    )
    rows = assets.select(
        "filename",
        F.col("file_path").alias("filepath"),
        F.col("creative_slug").alias("slug"),
        "request_id",
    )
    found = lookup_join(rows, sizes, "filepath").select(
        "filename",
        "filepath",
        "slug",
        "request_id",
        text.placement(F.col("slug")).alias("placement_type"),
        F.coalesce("_kb", F.lit(0.0)).alias("file_size_kb"),
    )
    return found.orderBy("filename") if ordered else found
