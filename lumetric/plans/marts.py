"""Star schema: campaigns, creatives, creative metrics and the campaign roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.functions import numbers, text
from lumetric.operators import kpi
from lumetric.operators.rows import dense_id, hash_id, keep_first
from lumetric.plans import staging
from lumetric.session import settle, together
from lumetric.sources import schemas


def dim_campaigns(staged_briefing: DataFrame) -> DataFrame:
    return staged_briefing.select(*schemas.CAMPAIGN_COLUMNS)


def campaigns_sql(briefing: DataFrame) -> DataFrame:
    """One row per raw campaign id, numbers completed, text untouched."""
    rows = keep_first(briefing.where(F.col("campaign_id").isNotNull()), ["campaign_id"])
    fixes = {c: numbers.number_or_zero(F.col(c)) for c in schemas.BRIEFING_NUMBERS}
    return rows.withColumns(fixes).select(*schemas.CAMPAIGN_COLUMNS)


def creative_keys(rows: DataFrame) -> DataFrame:
    """Distinct keys with a request part, from events or, cheaper, from the fact."""
    return rows.where(text.has_request(F.col("game_key"))).select("game_key").distinct()


def dim_creatives(
    keys: DataFrame,
    staged_vision: DataFrame,
    split_at: str = "first",
    video: DataFrame | None = None,
) -> DataFrame:
    """One row per creative with its image features, zero without an image.

    Images are made unique before the join, so it cannot fan out. ``video``
    (request_id, has_video) replaces the constant false.
    """
    slug, request = text.split_key(F.col("game_key"), split_at)
    named = keys.select(
        "game_key", slug.alias("creative_slug"), request.alias("creative_request_id")
    ).withColumn(
        "image_filename",
        text.image_filename(F.col("creative_slug"), F.col("creative_request_id")),
    )
    images = keep_first(staged_vision, ["filename"]).withColumnRenamed("filename", "image_filename")
    joined = named.join(images, "image_filename", "left")
    has_video = F.lit(False)
    if video is not None:
        flags = video.groupBy(F.col("request_id").alias("creative_request_id")).agg(
            F.max(F.col("has_video").cast("int")).alias("_video")
        )
        joined = joined.join(flags, "creative_request_id", "left")
        has_video = F.coalesce(F.col("_video") != 0, F.lit(False))
    return joined.select(
        "game_key",
        "creative_slug",
        "creative_request_id",
        "image_filename",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in schemas.VISION_MEASURES],
        has_video.alias("has_video"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in schemas.VISION_FLAGS],
    )


def creative_metrics(
    staged: DataFrame,
    creatives: DataFrame | None = None,
    rules: kpi.KpiRules = kpi.MART,
    surrogate: str | None = "hash",
) -> DataFrame:
    """The fact: rates on the full grain, for known creatives.

    The key is part of the grain, so the semi-join commutes with the
    aggregation; it runs after it, on groups rather than on events.
    """
    fact = kpi.aggregate(staged, rules)
    if creatives is not None:
        fact = fact.join(creatives.select("game_key"), "game_key", "left_semi")
        fact = fact.select(*kpi.GRAIN, *[c for c in fact.columns if c not in kpi.GRAIN])
    if surrogate == "dense":
        return dense_id(fact, kpi.GRAIN)
    return hash_id(fact, kpi.GRAIN) if surrogate == "hash" else fact


def campaign_benchmarks(campaigns: DataFrame, fact: DataFrame) -> DataFrame:
    """Roll-up per campaign; campaigns without facts keep a zero count and null sums.

    The fact is reduced to one row per campaign before the join. The distinct
    count runs in two steps, so a hot campaign is spread over its creatives.
    """
    per_campaign = fact.groupBy("campaign_id").agg(
        F.countDistinct("game_key").alias("num_creatives"),
        F.sum("n_impressions").alias("total_impressions"),
        F.sum("n_engagements").alias("total_engagements"),
        F.sum("n_clicks").alias("total_clicks"),
    )
    shown = F.col("total_impressions")
    return campaigns.select("campaign_id", "campaign_name").join(
        per_campaign, "campaign_id", "left"
    ).select(
        "campaign_id",
        "campaign_name",
        F.coalesce("num_creatives", F.lit(0)).alias("num_creatives"),
        "total_impressions",
        "total_engagements",
        "total_clicks",
        numbers.percent(F.col("total_engagements"), shown).alias("avg_engagement_rate_pct"),
        numbers.percent(F.col("total_clicks"), shown).alias("avg_click_through_rate_pct"),
    )


def star_schema(
    events: DataFrame, staged_briefing: DataFrame, vision: DataFrame
) -> dict[str, DataFrame]:
    """All curated tables. Events are read once: the fact is written first, and
    the creative keys come from it."""
    fact, campaigns = together(
        events.sparkSession,
        lambda: settle(creative_metrics(staging.stg_inventory(events)), "creative_metrics"),
        lambda: settle(dim_campaigns(staged_briefing), "campaigns"),
    )
    images = staging.stg_vision_features(vision)
    creatives = settle(dim_creatives(creative_keys(fact), images), "creatives")
    return {
        "stg_briefing": campaigns,
        "dim_campaigns": campaigns,
        "dim_creatives": creatives,
        "creative_metrics": fact,
        "v_campaign_benchmarks": campaign_benchmarks(campaigns, fact),
    }


def sql_schema(events: DataFrame, briefing: DataFrame, vision: DataFrame) -> dict[str, DataFrame]:
    """The loader's own transforms: raw text, null contexts kept.

    Its creatives are those of all events, also of events without a campaign.
    The groups of all events are written first; creatives and fact both come
    from them, so events are read once here too.
    """
    staged = kpi.staged_events(events, kpi.SQL, campaign_required=False)
    groups = settle(kpi.aggregate(staged, kpi.SQL), "groups")
    keys = creative_keys(groups)
    fact = groups.where(F.col("campaign_id").isNotNull())
    return {
        "campaigns": campaigns_sql(briefing),
        "creatives": dim_creatives(keys, staging.stg_vision_features(vision)),
        "creative_metrics": fact.join(keys, "game_key", "left_semi").select(groups.columns),
    }
