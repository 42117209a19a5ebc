"""Keys, names and text cleaning as built-in column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters a full strip removes (trim alone removes only spaces).
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

# Placement by the first marker found in the slug, in this order.
PLACEMENTS = (("-mob", "mobile"), ("-mpu", "mpu"), ("-tap", "tap"), ("-bio", "bio"))

# Feature-name prefixes that make a feature visual.
VISUAL_PREFIXES = (
    "vision_", "color_", "dominant_", "brightness", "saturation", "aspect_", "visual_", "is_",
)

REQUEST_ID_LENGTH = 20


def normal_name(name: str) -> str:
    """``Buy Rate (CPE)`` -> ``buy_rate_cpe``."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def normalised(columns: Iterable[str]) -> list[str]:
    names = [normal_name(c) for c in columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after normalising: {clashes}")
    return names


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalised(df.columns))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def event_type(c: Column) -> Column:
    return F.lower(strip(c))


def filled(c: Column, default: str = "Unknown") -> Column:
    """Trimmed text, with null and blank replaced by ``default``."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def has_request(key: Column) -> Column:
    """Null keys give null, so a filter on this also drops them."""
    return key.contains("/")


def split_key(key: Column, at: str = "last") -> tuple[Column, Column]:
    """(slug, request id) of ``slug/request``.

    ``last`` cuts at the last slash; ``first`` takes the first two segments.
    They differ for keys with two or more slashes. A key without a slash is
    all slug.
    """
    if at == "first":
        return F.split_part(key, F.lit("/"), F.lit(1)), F.split_part(key, F.lit("/"), F.lit(2))
    tail = F.substring_index(key, "/", -1)
    head = F.left(key, F.length(key) - F.length(tail) - 1)
    return (
        F.when(has_request(key), head).otherwise(key),
        F.when(has_request(key), tail),
    )


def image_filename(slug: Column, request_id: Column) -> Column:
    blank = F.lit("")
    return F.concat(
        F.coalesce(slug, blank), F.lit("-"), F.coalesce(request_id, blank), F.lit(".png")
    )


def split_filename(filename: Column, strict: bool = True) -> tuple[Column, Column]:
    """(slug, request id) of ``slug-request.png``.

    ``strict`` accepts only a request id of the standard length; otherwise the
    whole stem is the slug.
    """
    stem = F.regexp_replace(filename, r"\.png$", "")
    token = F.substring_index(stem, "-", -1)
    found = stem.contains("-")
    if strict:
        found = found & (F.length(token) == REQUEST_ID_LENGTH)
    head = F.left(stem, F.length(stem) - F.length(token) - 1)
    return F.when(found, head).otherwise(stem), F.when(found, token)


def placement(slug: Column) -> Column:
    out = F
    for marker, name in PLACEMENTS:
        out = out.when(slug.contains(marker), F.lit(name))
    return out.otherwise(F.lit("unknown"))


def display_name(feature: Column) -> Column:
    return F.initcap(F.replace(feature, F.lit("_"), F.lit(" ")))


def feature_category(feature: Column) -> Column:
    visual = F.lit(False)
    for prefix in VISUAL_PREFIXES:
        visual = visual | feature.startswith(prefix)
    return F.when(visual, F.lit("Visual")).otherwise(F.lit("Contextual"))
