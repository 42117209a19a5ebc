"""Cleaned staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumetric.functions import numbers
from lumetric.operators import kpi
from lumetric.operators.rows import keep_first, only_present, with_defaults
from lumetric.sources import schemas


def stg_inventory(events: DataFrame) -> DataFrame:
    return kpi.staged_events(events, kpi.MART)


def stg_briefing(briefing: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One row per trimmed campaign id; ``order`` names the row to keep."""
    rows = briefing.where(F.col("campaign_id").isNotNull())
    rows = rows.withColumn("campaign_id", F.trim("campaign_id"))
    rows = keep_first(rows, ["campaign_id"], order or [])
    fixes = {"campaign_name": F.trim("campaign_name"), "currency": F.upper(F.trim("currency"))}
    fixes |= {c: numbers.number_or_zero(F.col(c)) for c in schemas.BRIEFING_NUMBERS}
    full = with_defaults(rows, {c: None for c in schemas.CAMPAIGN_COLUMNS})
    return full.withColumns(fixes).select(*schemas.CAMPAIGN_COLUMNS)


def stg_vision_features(vision: DataFrame) -> DataFrame:
    full = with_defaults(vision, {c: None for c in schemas.VISION_MEASURES + schemas.VISION_FLAGS})
    return full.where(F.col("filename").isNotNull()).select(
        "filename",
        *[numbers.number_or_zero(F.col(c)).alias(c) for c in schemas.VISION_MEASURES],
        *[numbers.nonzero(F.col(c)).alias(c) for c in schemas.VISION_FLAGS],
    )


def stg_creative_assets(assets: DataFrame) -> DataFrame:
    return assets.where(F.col("filename").isNotNull()).select(
        "filename", "request_id", "creative_slug", "file_path"
    )


def raw_inventory(events: DataFrame) -> DataFrame:
    """The modelled event columns that exist, unfiltered."""
    return only_present(events, schemas.STAGED_EVENT_COLUMNS)


def raw_briefing(briefing: DataFrame, dated: bool = False) -> DataFrame:
    """The modelled briefing columns that exist; dates month-first, numbers as read.

    ``dated`` also keeps the submission date, by which the latest row is chosen.
    """
    rows = only_present(briefing, schemas.BRIEFING_COLUMNS + ("submission_date",) * dated)
    fixes = {
        c: numbers.date_text(F.col(c), day_first=False)
        for c in schemas.BRIEFING_DATES
        if c in rows.columns
    }
    fixes |= {c: numbers.number(F.col(c)) for c in schemas.BRIEFING_NUMBERS if c in rows.columns}
    return rows.withColumns(fixes) if fixes else rows


def raw_design(flat: DataFrame) -> DataFrame:
    return flat.withColumnRenamed("game_key", "md5_game_key")


def raw_assets(registry: DataFrame) -> DataFrame:
    return registry.select(
        "filename",
        "request_id",
        F.col("slug").alias("creative_slug"),
        F.col("filepath").alias("file_path"),
    )
