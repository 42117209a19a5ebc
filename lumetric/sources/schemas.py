"""Explicit schemas; text sources are read as text and converted with tolerance."""

# Column names of the sources and tables, in their usual order.
EVENT_COLUMNS = (
    "campaign_id", "game_key", "type", "device_type", "platform_os", "geo_country", "browser_ts",
)
STAGED_EVENT_COLUMNS = EVENT_COLUMNS[:-1]
BRIEFING_COLUMNS = (
    "campaign_id", "campaign_name", "campaign_objectives", "kpis", "startdate", "enddate",
    "currency", "buy_rate_cpe", "volume_agreed", "gross_cost_budget",
)
BRIEFING_DATES = ("startdate", "enddate")
BRIEFING_NUMBERS = ("buy_rate_cpe", "volume_agreed", "gross_cost_budget")
CAMPAIGN_COLUMNS = tuple(c for c in BRIEFING_COLUMNS if c != "kpis")

HANDCRAFTED = (
    "aspect_ratio", "image_width", "image_height", "brightness_mean", "saturation_mean",
    "colorfulness", "visual_entropy", "color_diversity_score", "is_dark_background",
    "is_light_background",
)
VISION_MEASURES = (
    "aspect_ratio", "brightness_mean", "saturation_mean", "colorfulness", "visual_entropy",
    "color_diversity_score",
)
VISION_FLAGS = ("is_dark_background", "is_light_background")

# Texts a CSV reader takes as missing.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

RESULTS = (
    "target string, group_col string, dataset_size long, n_campaigns long, "
    "models map<string, struct<mae_mean double, mae_std double, rmse_mean double, rmse_std double, "
    "r2_mean double, r2_std double, mape_mean double, mape_std double, "
    "feature_importance map<string, double>, n_folds long, n_features long, "
    "n_train_campaigns long, error string, n_rows long>>"
)
