"""The test tables seen as creative-analytics sources.

Each adapter is a list of (expression, column) over one table, valid in Spark
SQL and in the SQL of the correctness check alike. All rows are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One creative per user; campaigns hold three creatives, and half the events of
# some creatives belong to the next campaign. Contexts repeat every 12 events.


def _slug(number: str) -> str:
    return (
        f"'adunit-' || cast({number} as string) || case {number} % 5 when 0 then '-mob' "
        "when 1 then '-mpu' when 2 then '-tap' when 3 then '-bio' else '-xyz' end"
    )


def _padded(number: str, width: str = "20") -> str:
    return f"lpad(cast({number} as string), {width}, '0')"


INVENTORY = (
    "events",
    [
        (
            "case when event_id % 103 = 0 then null when event_id % 41 = 0 then 'lost' else 'camp_' || "
            "cast(cast(floor((user_id + event_id % 2) / 3) as bigint) as string) || "
            "case when event_id % 37 = 0 then ' ' else '' end end",
            "campaign_id",
        ),
        (
            "case when event_id % 101 = 0 then null when event_id % 97 = 0 then 'nokey' "
            "when event_id % 89 = 0 then 'promo/' || cast(user_id as string) || '/x' else "
            + _slug("user_id") + " || '/' || " + _padded("user_id") + " end",
            "game_key",
        ),
        (
            "case when event_id % 13 = 0 then ' ' when event_id % 17 = 0 then chr(9) else '' end || "
            "case event_type when 'view' then 'impression' "
            "when 'signup' then case when event_id % 19 = 0 then 'IMPRESSION' else 'impression' end "
            "when 'purchase' then 'first_dropped' when 'click' then 'click-through-event' "
            "else event_type end",
            "type",
        ),
        (
            "case when event_id % 12 = 0 then '' when event_id % 12 = 1 then null "
            "when event_id % 12 <= 6 then 'smartphone' else 'tablet' end",
            "device_type",
        ),
        ("case event_id % 3 when 0 then 'iOS' when 1 then 'Android' else ' ' end", "platform_os"),
        (
            "case event_id % 4 when 0 then 'usa' when 1 then ' SGP ' when 2 then 'GBR' "
            "else case when event_id % 12 = 3 then '' when event_id % 12 = 7 then null "
            "else 'usa' end end",
            "geo_country",
        ),
        ("cast(ts as string)", "browser_ts"),
    ],
)

_DAY = "cast(o_orderdate as date)"
BRIEFING = (
    "orders",
    [
        (
            "'camp_' || cast(cast(floor(o_custkey / 25) as bigint) as string) || "
            "case when o_orderkey % 9 = 0 then ' ' else '' end",
            "campaign_id",
        ),
        ("o_orderkey", "o_orderkey"),
        (
            "'Campaign ' || cast(cast(floor(o_custkey / 25) as bigint) as string) || ' '",
            "campaign_name",
        ),
        ("o_orderpriority", "campaign_objectives"),
        ("o_orderstatus", "kpis"),
        (
            f"case when o_orderkey % 50 = 0 then null else cast({_DAY} as string) end",
            "submission_date",
        ),
        (
            f"case o_orderkey % 4 when 0 then cast(day({_DAY}) as string) || '/' || "
            f"cast(month({_DAY}) as string) || '/' || cast(year({_DAY}) as string) "
            f"when 3 then 'soon' else cast({_DAY} as string) end",
            "startdate",
        ),
        (f"cast({_DAY} + cast(o_orderkey % 60 - 5 as int) as string)", "enddate"),
        (
            "case o_orderkey % 3 when 0 then ' usd' when 1 then 'EUR' else null end",
            "currency",
        ),
        (
            "case o_orderkey % 7 when 0 then 'n.a.' when 1 then 'NaN' when 2 then null "
            "else cast(o_orderkey % 1000 as string) || '.5' end",
            "buy_rate_cpe",
        ),
        (
            "case when o_orderkey % 13 = 0 then '1,000' else cast(o_orderkey % 1000 as string) end",
            "volume_agreed",
        ),
        ("cast(cast(floor(o_totalprice) as bigint) as string)", "gross_cost_budget"),
    ],
)

# Twenty image rows per filename, for about two thirds of the creatives.
_IMAGE = "cast(floor(p_partkey / 20) as bigint)"
VISION = (
    "part",
    [
        (
            _slug(_IMAGE) + " || '-' || " + _padded(_IMAGE) + " || '.png'",
            "filename",
        ),
        ("p_partkey", "p_partkey"),
        ("cast(p_size as double) / 10", "aspect_ratio"),
        ("p_retailprice / 3000", "brightness_mean"),
        (
            "case when p_partkey % 11 = 0 then null else cast(p_size as double) / 50 end",
            "saturation_mean",
        ),
        ("cast(p_partkey % 97 as double)", "colorfulness"),
        ("cast(p_partkey % 8 as double)", "visual_entropy"),
        ("cast(p_size as double) / 64", "color_diversity_score"),
        ("cast(p_partkey % 2 as double)", "is_dark_background"),
        ("case when p_partkey % 3 = 0 then null else p_partkey % 3 - 1 end", "is_light_background"),
        ("cast(p_size as double) * 1.5", "file_size_kb"),
    ],
)

# Of four parts two share a request id; every tenth record is a bare number.
REQUEST = "lpad(cast(case when p_partkey % 4 = 1 then p_partkey - 1 else p_partkey end as string), 20, '0')"
DESIGN = (
    "part",
    [
        ("p_partkey", "p_partkey"),
        (
            "'{\"key_' || cast(p_partkey as string) || '\":{\"' || " + REQUEST + " || '\":' || "
            "case when p_partkey % 10 = 0 then '5' else "
            "'{\"labels\":{\"engagement\":' || case p_size % 3 when 0 then '[]' "
            "when 1 then '[\"Car\"]' else '[\"Car\",\"Road\"]' end || "
            "',\"click_through\":' || case when p_partkey % 3 = 0 then '[\"Go\"]' else '7' end || "
            "'},\"text\":{\"engagement\":' || case when p_size % 2 = 0 then '[\"' || p_name || '\"]' "
            "else '[]' end || '},\"colors\":{\"engagement\":' || case when p_size % 4 = 0 then '[]' "
            "else '{\"1\":{\"red\":' || cast(p_size * 5 % 256 as string) || "
            "',\"green\":51,\"blue\":0,\"proportion\":0.5,\"saturation\":1.0,\"luminosity\":0.25}"
            ",\"2\":{\"saturation\":0.5}}' end || '},\"videos_data\":{\"has_video\":' || "
            "cast(p_size % 2 as string) || ',\"videos_length\":{\"v\":10.0,\"w\":' || "
            "cast(p_size as string) || '}}' || "
            "case when p_partkey % 6 = 0 then ',\"direction\":{\"direction\":\"up\"}' else '' end || "
            "case when p_size % 5 = 0 then '' else ',\"adunit_sizes\":{\"size_x\":320,\"size_y\":' || "
            "cast(p_size as string) || '}' end || '}' end || '}}'",
            "doc",
        ),
    ],
)

FILES = (
    "part",
    [
        (
            "'file:/assets/' || case when p_partkey % 17 = 0 then 'plain' || cast(p_partkey as string) "
            "else " + _slug("p_partkey") + " || '-' || "
            + _padded("p_partkey", "case when p_partkey % 6 = 0 then 12 else 20 end")
            + " end || '.png'",
            "path",
        ),
        ("cast(p_size * 1024 + p_partkey * 7 as bigint)", "length"),
    ],
)

# Feature names used by the model-run adapter.
FEATURES = (
    "vision_pca_0", "color_diversity", "dominant_color_r", "brightness_mean", "saturation_mean",
    "aspect_ratio", "visual_entropy", "is_dark_background", "buy_rate_cpe", "platform_os_enc",
    "volume_agreed", "geo_country_enc", "has_video", "campaign_duration_days",
    "video_length_seconds", "device_type_enc", "n_engagement_labels",
)
_MODELS = "'baseline' when 1 then 'tabular' when 2 then 'vision' when 3 then 'multimodal' else 'broken'"
RUNS = (
    "lineitem",
    [
        ("cast('2024-01-0' || cast(l_linenumber as string) as timestamp)", "run_timestamp"),
        (f"case l_suppkey % 5 when 0 then {_MODELS} end", "model_name"),
        (
            f"case l_partkey % {len(FEATURES)} "
            + " ".join(f"when {i} then '{f}'" for i, f in enumerate(FEATURES))
            + " end",
            "feature_name",
        ),
        ("l_quantity", "l_quantity"),
        ("l_linenumber", "l_linenumber"),
    ],
)

SCENARIOS = (
    "lineitem",
    [
        ("l_orderkey", "l_orderkey"),
        ("l_linenumber", "l_linenumber"),
        ("case l_linenumber % 3 when 0 then 'smartphone' when 1 then 'tablet' else 'desktop' end", "device"),
        ("case when l_returnflag = 'R' then 'iOS' else 'Android' end", "os"),
        ("case l_suppkey % 4 when 0 then 'USA' when 1 then 'GBR' else 'SGP' end", "region"),
        ("l_discount", "cpe"),
        ("l_quantity", "brightness"),
        ("l_tax * 1000", "saturation"),
        ("cast(l_linenumber * 10 as double)", "colorfulness"),
        ("l_linestatus = 'O'", "has_video"),
    ],
)

OBSERVATIONS = (
    "lineitem",
    [
        ("l_suppkey", "l_suppkey"),
        ("l_discount", "actual"),
        ("l_tax - 0.02", "predicted"),
        ("cast(l_suppkey % 5 as int)", "fold"),
    ],
)

ADAPTERS = {
    "raw_inventory": INVENTORY,
    "raw_briefing": BRIEFING,
    "raw_vision": VISION,
    "design_docs": DESIGN,
    "files": FILES,
    "run_rows": RUNS,
    "scenarios": SCENARIOS,
    "observations": OBSERVATIONS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = ADAPTERS[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} as {c}" for e, c in columns])


def adapter_sql(name: str) -> str:
    source, columns = ADAPTERS[name]
    return "select " + ",\n  ".join(f"{e} as {c}" for e, c in columns) + f"\nfrom {source}"
