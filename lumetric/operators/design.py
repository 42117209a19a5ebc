"""Nested design documents to one typed row per design record.

A document maps design key to request id to a record, and any node may have the
wrong type. Documents are parsed once to variants; each wanted field is then
read by path with its type, giving null where the path or the type is not
there. One fixed schema would instead null the whole document for a single bad
node.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_KEY_WINS = "spark.sql.variant.allowDuplicateKeys"
_SETTING = threading.Lock()


def _get(node: str | Column, path: str, kind: str) -> Column:
    return F.try_variant_get(node, path, kind)


def _map(node: str | Column, path: str = "$") -> Column:
    """An object node as key to variant, null for any other node."""
    return _get(node, path, "map<string,variant>")


def _list(path: str) -> Column:
    return F.coalesce(_get("record", path, "array<string>"), F.array().cast("array<string>"))


def _double(node: str | Column, path: str) -> Column:
    return F.coalesce(_get(node, path, "double"), F.lit(0.0))


def _mean(values: Column) -> Column:
    """Mean of an array, 0 for an empty or missing one."""
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return F.coalesce(total / F.nullif(F.size(values).cast("double"), F.lit(0.0)), F.lit(0.0))


def _swatch_mean(field: str) -> Column:
    return _mean(F.transform("swatches", lambda v: _double(v, f"$.{field}")))


def _entries(df: DataFrame, node: str, key: str, value: str, *keep: str) -> DataFrame:
    """One row per entry of an object node; array items have no key and go."""
    opened = df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(node).outer()))
    rows = opened.where(F.col("key").isNotNull())
    return rows.select(*keep, F.col("key").alias(key), F.col("value").alias(value))


def design_records(documents: DataFrame, column: str = "doc", broken: str = "fail") -> DataFrame:
    """(game_key, request_id, record) of every record that is an object.

    A document that is no JSON fails the job, or is left out with ``broken="drop"``;
    ``broken_documents`` counts those. A null document has no records.
    """
    spark = documents.sparkSession
    parse = F.try_parse_json if broken == "drop" else F.parse_json
    with _SETTING:
        before = spark.conf.get(LAST_KEY_WINS)
        try:
            spark.conf.set(LAST_KEY_WINS, True)  # read when the expression below is resolved
            parsed = documents.select(parse(F.col(column)).alias("_doc"))
            parsed.schema  # noqa: B018
        finally:
            spark.conf.set(LAST_KEY_WINS, before)
    requests = _entries(parsed, "_doc", "game_key", "_requests")
    records = _entries(requests, "_requests", "request_id", "record", "game_key")
    return records.where(_map("record").isNotNull())


def broken_documents(documents: DataFrame, column: str = "doc") -> DataFrame:
    """n_documents, n_broken: how many there are, and how many of them are no JSON."""
    bad = F.col(column).isNotNull() & F.try_parse_json(F.col(column)).isNull()
    return documents.agg(F.count(column).alias("n_documents"), F.count_if(bad).alias("n_broken"))


def flatten_design(documents: DataFrame, column: str = "doc", broken: str = "fail") -> DataFrame:
    """Twenty design features per (game_key, request_id). No shuffle."""
    parts = design_records(documents, column, broken).select(
        "*",
        F.coalesce(_map("record", "$.colors.engagement"), F.create_map().cast("map<string,variant>"))
        .alias("palette"),
        F.coalesce(_get("record", "$.videos_data.has_video", "int"), F.lit(0)).alias("has_video"),
        _double("record", "$.adunit_sizes.size_x").alias("adunit_width"),
        _double("record", "$.adunit_sizes.size_y").alias("adunit_height"),
        *[
            (_double("record", f"$.colors.engagement['1'].{c}") / 255.0).alias(f"dominant_color_{c[0]}")
            for c in ("red", "green", "blue")
        ],
    ).withColumn("swatches", F.filter(F.map_values("palette"), lambda v: _map(v).isNotNull()))
    lengths = F.map_values(_map("record", "$.videos_data.videos_length"))
    texts = {
        "n_engagement_labels": F.size(_list("$.labels.engagement")),
        "n_click_through_labels": F.size(_list("$.labels.click_through")),
        "engagement_labels_text": F.array_join(_list("$.labels.engagement"), " "),
        "n_engagement_texts": F.size(_list("$.text.engagement")),
        "n_click_through_texts": F.size(_list("$.text.click_through")),
        "engagement_text_content": F.array_join(_list("$.text.engagement"), " "),
    }
    height = F.col("adunit_height")
    return parts.select(
        "game_key",
        "request_id",
        *[c.alias(name) for name, c in texts.items()],
        "dominant_color_r",
        "dominant_color_g",
        "dominant_color_b",
        _double("record", "$.colors.engagement['1'].proportion").alias("dominant_color_proportion"),
        *[_swatch_mean(c).alias(f"color_{c}_mean") for c in ("saturation", "luminosity")],
        F.size("palette").alias("color_diversity"),
        F.expr("(dominant_color_r + dominant_color_g + dominant_color_b) / 3.0D").alias("brightness"),
        "has_video",
        F.when(F.col("has_video") != 0, _mean(F.transform(lengths, lambda v: _double(v, "$"))))
        .otherwise(F.lit(0.0))
        .alias("video_length_seconds"),
        F.coalesce(
            _get("record", "$.direction.direction", "string"), F.lit("no direction")
        ).alias("interaction_direction"),
        "adunit_width",
        "adunit_height",
        F.when(height > 0, F.col("adunit_width") / F.nullif(height, F.lit(0.0)))
        .otherwise(F.lit(0.0))
        .alias("aspect_ratio"),
    )
