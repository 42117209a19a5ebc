"""Batch scoring by model or by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.functions import numbers
from lumetric.operators.encode import UNKNOWN, apply_encoders
from lumetric.operators.kpi import CONTEXT
from lumetric.operators.rows import with_defaults
from lumetric.plans.features import join_vision
from lumetric.plans.models import Model, inputs_of, zero_filled

# Notes that go with a score.
NOTE_NO_MODEL = "Model not trained yet. Run pipeline first."
NOTE_VISION = "Prediction from multimodal model (tabular + vision)"
NOTE_TABULAR = "Prediction from tabular-only model (no image provided)"
NOTE_FAILED = "Vision extraction failed: {}. Using tabular-only."
CTR_SHARE = 0.1

# The rule-based score.
BASE_RATE = 0.12
CONTEXT_BOOSTS = (("device", "smartphone", 1.15), ("os", "iOS", 1.08), ("region", "USA", 1.10))
VISUAL_SLOPES = (("brightness", 0.8, 0.004), ("saturation", 0.85, 0.003), ("colorfulness", 0.9, 0.002))
CPE_SLOPE, VIDEO_BOOST, RULE_CTR_SHARE = 0.3, 1.12, 0.45
LOW_BELOW, HIGH_ABOVE, TOP_ABOVE = 0.08, 0.12, 0.15
TIER_LABELS = {
    "low": "🔴 Low", "top": "⭐ Top Performer", "high": "🟢 High", "avg": "🟡 Average",
}


def predict(df: DataFrame, model: Model, name: str) -> DataFrame:
    """Add ``name``, the model's prediction in [0, 1]; inputs that lack or are missing count as 0."""
    inputs = inputs_of(model)
    rows = zero_filled(with_defaults(df, dict.fromkeys(inputs, 0.0)), inputs)
    found = model.transform(rows).withColumn(name, numbers.clip(F.col("prediction"), 0, 1))
    return found.select(*[c for c in rows.columns if c != name], name)


def score(
    contexts: DataFrame,
    models: dict[str, Model],
    encoders: DataFrame | None = None,
    vision: DataFrame | None = None,
) -> DataFrame:
    """Predicted rates in [0, 1] per context row.

    Codes come from the saved encoders; columns a model expects and the
    contexts lack are 0. Without a click model the click rate is a tenth of the
    engagement rate. Rows with an image row in ``vision`` are marked. An image
    that is named but not there, or that could not be read (its width is 0), is
    noted and does not count.
    """
    model = models.get("engagement_rate")
    if model is None:
        return contexts.select(
            "*",
            F.lit(None).cast("double").alias("engagement_rate_predicted"),
            F.lit(None).cast("double").alias("click_through_rate_predicted"),
            F.lit(NOTE_NO_MODEL).alias("confidence_note"),
            F.lit(False).alias("vision_features_used"),
        )
    df = contexts
    note, used = F.lit(NOTE_TABULAR), F.lit(False)
    if vision is not None and "image_filename" in contexts.columns:
        readable = F.coalesce(F.col("image_width") > 0, F.lit(True)) if "image_width" in vision.columns else F.lit(True)
        df = join_vision(df, vision.where(readable).withColumn("_seen", F.lit(True)))
        used = F.coalesce("_seen", F.lit(False))
        failed = F.lit(NOTE_FAILED.format("no readable image"))
        note = F.when(F.coalesce("image_filename", F.lit("")) != "", failed).otherwise(note)
    df = with_defaults(df, dict.fromkeys(CONTEXT, UNKNOWN) | {"has_video": 0, "buy_rate_cpe": 0.0})
    if encoders is not None:
        raw = [F.col(c).alias(f"_given_{c}") for c in CONTEXT]
        df = apply_encoders(df.select("*", *raw), encoders, CONTEXT, free_code=0)
        df = df.withColumns({c: F.col(f"_given_{c}") for c in CONTEXT})
    df = predict(df, model, "engagement_rate_predicted")
    click = models.get("click_through_rate")
    if click is None:
        rate = F.coalesce(F.col("engagement_rate_predicted") * CTR_SHARE, F.lit(0.0))
        df = df.withColumn("click_through_rate_predicted", rate)
    else:
        df = predict(df, click, "click_through_rate_predicted")
    return df.select(
        *[F.col(c) for c in contexts.columns],
        "engagement_rate_predicted",
        "click_through_rate_predicted",
        F.when(used, F.lit(NOTE_VISION)).otherwise(note).alias("confidence_note"),
        used.alias("vision_features_used"),
    )


def rule_score(scenarios: DataFrame) -> DataFrame:
    """Rule-based rates in percent and a tier, as column expressions only."""
    rate = F.lit(BASE_RATE)
    for column, value, boost in CONTEXT_BOOSTS:
        rate = rate * F.when(F.col(column) == value, F.lit(boost)).otherwise(F.lit(1.0))
    rate = rate * (1 - F.col("cpe") * CPE_SLOPE)
    for column, start, slope in VISUAL_SLOPES:
        rate = rate * (F.lit(start) + F.col(column) * slope)
    rate = rate * F.when(F.col("has_video"), F.lit(VIDEO_BOOST)).otherwise(F.lit(1.0))
    rated = scenarios.withColumn("_rate", rate)
    r = F.col("_rate")
    tier = (
        F.when(r < LOW_BELOW, "low")
        .when(r > TOP_ABOVE, "top")
        .when(r > HIGH_ABOVE, "high")
        .otherwise("avg")
    )
    label = F
    for name, text in TIER_LABELS.items():
        label = label.when(F.col("tier") == name, F.lit(text))
    return (
        rated.withColumn("er_percent", numbers.float_round(r * 100, 1))
        .withColumn("ctr_percent", numbers.float_round(r * RULE_CTR_SHARE * 100, 1))
        .withColumn("tier", tier)
        .withColumn("tier_label", label)
        .drop("_rate")
    )
