"""Events to engagement and click-through rates."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumetric.functions import numbers, text

CONTEXT = ("device_type", "platform_os", "geo_country")
GRAIN = ("campaign_id", "game_key", *CONTEXT)

# The event types that are counted, by output column.
COUNTED = {
    "n_impressions": "impression",
    "n_engagements": "first_dropped",
    "n_clicks": "click-through-event",
}


@dataclass(frozen=True)
class KpiRules:
    """How raw events become rates.

    null_context: ``drop`` rows with any null grain column, ``keep`` nulls as
    their own group, or replace null and blank by ``unknown``.
    """

    null_context: str
    min_impressions: int
    clip: bool
    lower_type: bool
    trim_type: bool
    split_at: str | None

    def with_(self, **changes: object) -> KpiRules:
        return replace(self, **changes)


# The three definitions in use: file pipeline, loader SQL, curated marts.
FILE = KpiRules("drop", 10, True, True, True, "last")
SQL = KpiRules("keep", 0, False, False, False, None)
MART = KpiRules("unknown", 0, False, False, True, None)


def event_counts(kind: Column) -> list[Column]:
    return [F.count_if(kind == value).alias(name) for name, value in COUNTED.items()]


def rates(impressions: Column, engagements: Column, clicks: Column, clip: bool) -> list[Column]:
    def rate(n: Column) -> Column:
        raw = numbers.ratio(n, impressions)
        if not clip:
            return raw
        # With no impressions a clipped rate is 1 where there are events, else unknown.
        return F.when((impressions == 0) & (n > 0), F.lit(1.0)).otherwise(numbers.clip(raw, 0, 1))

    return [
        rate(engagements).alias("engagement_rate"),
        rate(clicks).alias("click_through_rate"),
    ]


def staged_events(
    events: DataFrame, rules: KpiRules, campaign_required: bool = True
) -> DataFrame:
    """The grain columns and ``event_type``, cleaned by ``rules``; narrow on purpose,
    so that at most six columns are read. Context columns may be absent."""
    kind = F.col("type")
    if rules.trim_type:
        kind = text.event_type(kind) if rules.lower_type else F.trim(kind)
    context = {c: F.col(c) for c in CONTEXT if c in events.columns}
    if rules.null_context == "unknown":
        context = {
            name: text.filled(F.upper(c) if name == "geo_country" else c)
            for name, c in context.items()
        }
    rows = events.where(text.has_request(F.col("game_key")))
    if campaign_required:
        rows = rows.where(F.col("campaign_id").isNotNull())
    # Trimmed on both sides of the campaign join, so padded ids still match.
    campaign = F.trim("campaign_id") if rules.null_context == "unknown" else F.col("campaign_id")
    staged = rows.select(
        campaign.alias("campaign_id"),
        "game_key",
        kind.alias("event_type"),
        *[c.alias(name) for name, c in context.items()],
    )
    return staged.dropna() if rules.null_context == "drop" else staged


def grain_counts(staged: DataFrame) -> DataFrame:
    """Counted events of each group: one shuffle; partial counts bound what a hot campaign sends."""
    grain = [c for c in GRAIN if c in staged.columns]
    return staged.groupBy(*grain).agg(*event_counts(F.col("event_type")))


def counted_rates(counts: DataFrame, rules: KpiRules) -> DataFrame:
    """Rates from counts by group."""
    if rules.min_impressions > 0:
        counts = counts.where(F.col("n_impressions") >= rules.min_impressions)
    columns = ["*"]
    if rules.split_at:
        slug, request = text.split_key(F.col("game_key"), rules.split_at)
        columns += [slug.alias("creative_slug"), request.alias("creative_request_id")]
    columns += rates(*[F.col(c) for c in COUNTED], clip=rules.clip)
    return counts.select(*columns)


def aggregate(staged: DataFrame, rules: KpiRules) -> DataFrame:
    """Counts and rates by group."""
    return counted_rates(grain_counts(staged), rules)


def creative_kpi(events: DataFrame, rules: KpiRules = MART) -> DataFrame:
    """Rates per campaign, creative, device, system and country from raw events."""
    return aggregate(staged_events(events, rules), rules)


def event_pivot(staged: DataFrame, by: list[str]) -> DataFrame:
    """Counted event types as columns, absent ones 0; fixed values spare a scan."""
    wide = staged.groupBy(*by).pivot("event_type", list(COUNTED.values())).count()
    return wide.select(
        *by, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(n) for n, v in COUNTED.items()]
    )


def kpi_summary(kpi: DataFrame) -> DataFrame:
    """Sizes, mean and sample deviation of the rates, in one row."""
    return kpi.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("campaign_id").alias("n_campaigns"),
        F.countDistinct("game_key").alias("n_creatives"),
        *[
            f(c).alias(f"{c}_{name}")
            for c in ("engagement_rate", "click_through_rate")
            for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max))
        ],
    )


def match_report(joined: DataFrame, column: str) -> DataFrame:
    """How many rows of a left join found a partner, read from one right column."""
    return joined.agg(
        F.count(column).alias("matched"),
        F.count("*").alias("total"),
        numbers.ratio(F.count(column), F.count("*")).alias("match_rate"),
    )
