"""SQL equivalents of the registered queries, over the same tables.

``PARTS`` are named subqueries; a query gets those it mentions as its WITH list.
"""

from __future__ import annotations

import re

from lumetric.adapters import ADAPTERS, adapter_sql
from lumetric.operators.quality import STAR_CHECKS
from lumetric.plans.features import (
    CAMPAIGN_NUMERIC, CATEGORICAL, CONTEXT_NUMERIC, VISION_NUMERIC,
)

GRAIN = "campaign_id, game_key, device_type, platform_os, geo_country"
MEASURES = (
    "aspect_ratio", "brightness_mean", "saturation_mean", "colorfulness", "visual_entropy",
    "color_diversity_score",
)
FLAGS = ("is_dark_background", "is_light_background")


def _number(c: str) -> str:
    return f"case when isnan(try_cast({c} as double)) then null else try_cast({c} as double) end"


def _day_first(c: str) -> str:
    return f"coalesce(try_strptime({c}, '%d/%m/%Y'), try_cast({c} as timestamp))"


def _month_first(c: str) -> str:
    return f"coalesce(try_strptime({c}, '%m/%d/%Y'), try_cast({c} as timestamp))"


def _stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _percent(n: str, d: str) -> str:
    """100 n / d rounded half up to 2 places, in whole numbers."""
    return f"(((20000 * {n} + {d}) // (2 * nullif({d}, 0))) / 100.0)::double"


def _counts(kind: str) -> str:
    return (
        f"count(*) filter (where {kind} = 'impression') as n_impressions, "
        f"count(*) filter (where {kind} = 'first_dropped') as n_engagements, "
        f"count(*) filter (where {kind} = 'click-through-event') as n_clicks"
    )


RATES = (
    "n_engagements::double / nullif(n_impressions, 0) as engagement_rate, "
    "n_clicks::double / nullif(n_impressions, 0) as click_through_rate"
)
GRAIN_TEXT = " || ".join(f"length({c}) || ':' || {c}" for c in GRAIN.split(", "))
NUMBERS = ("buy_rate_cpe", "volume_agreed", "gross_cost_budget")
NUMBERS_OR_ZERO = ", ".join(f"coalesce({_number(c)}, 0.0) as {c}" for c in NUMBERS)
LAST_SLUG = "regexp_extract(game_key, '^(.*)/([^/]*)$', 1)"
LAST_REQUEST = "regexp_extract(game_key, '^(.*)/([^/]*)$', 2)"
PLACEMENT = (
    "case when slug like '%-mob%' then 'mobile' when slug like '%-mpu%' then 'mpu' "
    "when slug like '%-tap%' then 'tap' when slug like '%-bio%' then 'bio' else 'unknown' end"
)
MISSING_VISION = ", ".join(f"coalesce({c}, 0.0) as {c}" for c in MEASURES)
FALSE_FLAGS = ", ".join(f"coalesce({c}, false) as {c}" for c in FLAGS)

PARTS = {name: adapter_sql(name) for name in ADAPTERS} | {
    "stg": """
        select trim(campaign_id) as campaign_id, game_key, trim(type) as event_type,
          coalesce(nullif(trim(device_type), ''), 'Unknown') as device_type,
          coalesce(nullif(trim(platform_os), ''), 'Unknown') as platform_os,
          coalesce(nullif(upper(trim(geo_country)), ''), 'Unknown') as geo_country
        from raw_inventory where campaign_id is not null and game_key like '%/%'""",
    "mart_kpi": f"""
        select *, {RATES} from (select {GRAIN}, {_counts('event_type')} from stg group by {GRAIN})""",
    "mart_fact": f"select sha256({GRAIN_TEXT}) as id, * from mart_kpi",
    "file_events": """
        select campaign_id, game_key, device_type, platform_os, geo_country,
          lower(trim(type, ' ' || chr(9))) as kind
        from raw_inventory
        where campaign_id is not null and game_key like '%/%' and device_type is not null
          and platform_os is not null and geo_country is not null and type is not null""",
    "file_kpi": f"""
        select *, {LAST_SLUG} as creative_slug, {LAST_REQUEST} as creative_request_id,
          least(n_engagements::double / n_impressions, 1.0) as engagement_rate,
          least(n_clicks::double / n_impressions, 1.0) as click_through_rate
        from (select {GRAIN}, {_counts('kind')} from file_events group by {GRAIN})
        where n_impressions >= 2""",
    "brief_ranked": """
        select *, row_number() over (partition by trim(campaign_id)
            order by submission_date desc nulls last, o_orderkey) as trimmed_rank,
          row_number() over (partition by campaign_id
            order by submission_date desc nulls last, o_orderkey) as raw_rank
        from raw_briefing""",
    "stg_brief": f"""
        select trim(campaign_id) as campaign_id, trim(campaign_name) as campaign_name,
          campaign_objectives, {_day_first('startdate')} as startdate,
          {_day_first('enddate')} as enddate, upper(trim(currency)) as currency, {NUMBERS_OR_ZERO}
        from brief_ranked where trimmed_rank = 1""",
    "latest_brief": f"""
        select campaign_id, o_orderkey, campaign_name, campaign_objectives, kpis, submission_date,
          {_day_first('startdate')} as startdate, {_day_first('enddate')} as enddate,
          currency, {NUMBERS_OR_ZERO}
        from brief_ranked where raw_rank = 1""",
    # Read back from CSV the tie-break column is text.
    "csv_brief": f"""
        select campaign_id, o_orderkey, campaign_name, campaign_objectives, kpis, submission_date,
          {_day_first('startdate')} as startdate, {_day_first('enddate')} as enddate,
          currency, {NUMBERS_OR_ZERO}
        from raw_briefing qualify row_number() over (partition by campaign_id
          order by submission_date desc nulls last, cast(o_orderkey as string)) = 1""",
    "first_vision": """
        select * from raw_vision
        qualify row_number() over (partition by filename order by p_partkey) = 1""",
    "stg_vision": "select filename, "
    + ", ".join(f"coalesce({c}::double, 0.0) as {c}" for c in MEASURES)
    + ", "
    + ", ".join(f"coalesce({c}::double <> 0, false) as {c}" for c in FLAGS)
    + " from first_vision",
    "creative_dim": f"""
        select game_key, split_part(game_key, '/', 1) as creative_slug,
          split_part(game_key, '/', 2) as creative_request_id, image_filename,
          {MISSING_VISION}, false as has_video, {FALSE_FLAGS}
        from (select distinct game_key, split_part(game_key, '/', 1) || '-' ||
                split_part(game_key, '/', 2) || '.png' as image_filename from stg) k
        left join stg_vision v on v.filename = k.image_filename""",
    "roll": f"""
        select campaign_id, campaign_name, count(distinct game_key) as num_creatives,
          sum(n_impressions)::bigint as total_impressions,
          sum(n_engagements)::bigint as total_engagements, sum(n_clicks)::bigint as total_clicks,
          {_percent('sum(n_engagements)', 'sum(n_impressions)')} as avg_engagement_rate_pct,
          {_percent('sum(n_clicks)', 'sum(n_impressions)')} as avg_click_through_rate_pct
        from stg_brief left join mart_fact using (campaign_id) group by all""",
    "flat": """
        select 'key_' || cast(p_partkey as string) as game_key,
          lpad(cast(p_partkey - case when p_partkey % 4 = 1 then 1 else 0 end as string), 20, '0')
            as request_id,
          p_size % 3 as n_engagement_labels,
          case when p_partkey % 3 = 0 then 1 else 0 end as n_click_through_labels,
          case p_size % 3 when 0 then '' when 1 then 'Car' else 'Car Road' end
            as engagement_labels_text,
          case when p_size % 2 = 0 then 1 else 0 end as n_engagement_texts,
          0 as n_click_through_texts,
          case when p_size % 2 = 0 then p_name else '' end as engagement_text_content,
          case when p_size % 4 = 0 then 0.0 else p_size * 5 % 256 / 255.0::double end::double
            as dominant_color_r,
          case when p_size % 4 = 0 then 0.0 else 51 / 255.0::double end::double as dominant_color_g,
          0.0::double as dominant_color_b,
          case when p_size % 4 = 0 then 0.0 else 0.5 end::double as dominant_color_proportion,
          case when p_size % 4 = 0 then 0.0 else 0.75 end::double as color_saturation_mean,
          case when p_size % 4 = 0 then 0.0 else 0.125 end::double as color_luminosity_mean,
          case when p_size % 4 = 0 then 0 else 2 end as color_diversity,
          case when p_size % 4 = 0 then 0.0
            else (p_size * 5 % 256 / 255.0::double + 51 / 255.0::double) / 3 end::double as brightness,
          p_size % 2 as has_video,
          case when p_size % 2 = 1 then (10 + p_size) / 2.0 else 0.0 end::double
            as video_length_seconds,
          case when p_partkey % 6 = 0 then 'up' else 'no direction' end as interaction_direction,
          case when p_size % 5 = 0 then 0.0 else 320.0 end::double as adunit_width,
          case when p_size % 5 = 0 then 0.0 else p_size end::double as adunit_height,
          case when p_size % 5 = 0 then 0.0 else 320.0::double / p_size end::double as aspect_ratio
        from part where p_partkey % 10 <> 0""",
    "registry": f"""
        select filename, path as filepath, slug, request_id, {PLACEMENT} as placement_type,
          format('{{:.2f}}', length / 1024.0::double)::double as file_size_kb
        from (
          select *, case when strict then stem[:-22] else stem end as slug,
            case when strict then token end as request_id
          from (select *, token <> stem and length(token) = 20 as strict from file_names))""",
    "file_names": """
        select *, regexp_extract(stem, '([^-]*)$', 1) as token from (
          select *, regexp_extract(path, '([^/]*)$', 1) as filename,
            regexp_extract(path, '([^/]*)[.]png$', 1) as stem from files)""",
    "loose_registry": """
        select filename, path as filepath, length,
          case when contains(stem, '-') then token end as request_id,
          case when contains(stem, '-') then stem[:length(stem) - length(token) - 1] else stem end
            as slug
        from file_names""",
    "linked": f"""
        select k.*, d.* exclude (game_key, request_id), d.game_key as design_game_key,
          b.campaign_name, b.campaign_objectives, b.kpis, b.startdate, b.enddate, b.currency,
          b.buy_rate_cpe, b.volume_agreed, b.gross_cost_budget,
          case when b.startdate is not null and b.enddate is not null
            then greatest(0, date_diff('day', b.startdate, b.enddate)) end::int as campaign_duration_days,
          creative_slug || '-' || creative_request_id || '.png' as image_filename
        from file_kpi k left join flat d on d.request_id = k.creative_request_id
        left join latest_brief b using (campaign_id)""",
    "model_scores": """
        select run_timestamp, model_name, feature_name, sum(l_quantity) as importance_score,
          count(*) as n
        from run_rows group by all""",
    "benchmarks": """
        select run_timestamp, 'engagement_rate' as target_metric, model_name,
          sum(importance_score) / sum(n) / 100 as mae, sum(importance_score) / sum(n) / 80 as rmse,
          sum(importance_score) / sum(n) / 50 as r2, sum(importance_score) / sum(n) * 4 as mape,
          sum(n)::bigint as n_features
        from model_scores where model_name <> 'broken' group by run_timestamp, model_name""",
    "scores": """
        select run_timestamp, model_name, feature_name, importance_score,
          case when regexp_matches(feature_name,
              '^(vision_|color_|dominant_|brightness|saturation|aspect_|visual_|is_)')
            then 'Visual' else 'Contextual' end as category
        from model_scores where model_name <> 'broken'""",
    "best_features": """
        select * from scores where model_name = 'multimodal'
          and run_timestamp = (select max(run_timestamp) from scores)""",
    "pixels": """
        select vec_id, i, q[i + 1] as r, q[(i + 21) % len(q) + 1] as g, q[(i + 42) % len(q) + 1] as b
        from (
          select vec_id, q, unnest(range(0, len(q))) as i from (
            select vec_id, list_transform(embedding,
              lambda x: greatest(least(floor((x::double * 2 + 1) * 127.5), 255), 0)::int) as q
            from embeddings))""",
    "image_names": "select vec_id, 'adunit-mob-' || lpad(cast(vec_id as string), 20, '0') || '.png' as filename from embeddings",
    "image_measures": """
        select filename, vec_id, w, round(w, 6) as aspect_ratio, w as image_width, 1.0::double as image_height,
          round(brightness, 6) as brightness_mean, round(saturation, 6) as saturation_mean,
          round(colorfulness, 6) as colorfulness, round(entropy, 6) as visual_entropy,
          round(diversity, 6) as color_diversity_score,
          case when brightness < 0.3 then 1.0 else 0.0 end::double as is_dark_background,
          case when brightness > 0.7 then 1.0 else 0.0 end::double as is_light_background
        from image_names join (
          select vec_id, count(*)::double as w,
            (0.2126::double * avg(r) + 0.7152::double * avg(g) + 0.0722::double * avg(b)) / 255 as brightness,
            avg(case when greatest(r, g, b) > 0
              then (greatest(r, g, b) - least(r, g, b))::double / greatest(r, g, b) else 0 end) as saturation,
            sqrt(var_pop((r - g) / 255.0::double) + var_pop((0.5::double * (r + g) - b) / 255))
              + 0.3::double * sqrt(pow(avg((r - g) / 255.0::double), 2)
                + pow(avg((0.5::double * (r + g) - b) / 255), 2)) as colorfulness,
            count(distinct least(r * 4 // 255, 3) * 16 + least(g * 4 // 255, 3) * 4
              + least(b * 4 // 255, 3)) / 64.0::double as diversity
          from pixels group by vec_id) using (vec_id)
        join (
          select vec_id, -(sum(p * log2(p + 1e-9)) + 0) as entropy from (
            select vec_id, count(*) / (sum(count(*)) over (partition by vec_id) + 1e-9) as p
            from (select vec_id, (19595 * r + 38470 * g + 7471 * b + 32768) // 65536 as grey from pixels)
            group by vec_id, grey)
          group by vec_id) using (vec_id)""",
    "ridge": """
        select l_orderkey, l_linenumber, my
            + ((b1 * a - b2 * c) / (a * a - c * c)) * (l_quantity - m1) / s1
            + ((b2 * a - b1 * c) / (a * a - c * c)) * (l_extendedprice - m2) / s2 as prediction
        from lineitem cross join (
          select avg(l_discount) as my, avg(l_quantity) as m1, avg(l_extendedprice) as m2,
            stddev_pop(l_quantity) as s1, stddev_pop(l_extendedprice) as s2, count(*) + 1.0 as a,
            count(*) * corr(l_quantity, l_extendedprice) as c,
            count(*) * covar_pop(l_quantity, l_discount) / stddev_pop(l_quantity) as b1,
            count(*) * covar_pop(l_extendedprice, l_discount) / stddev_pop(l_extendedprice) as b2
          from lineitem)""",
    "cv_folds": """
        select o.*, (t.s - f.s) / (t.n - f.n) as prediction from observations o
        join (select fold, sum(actual) as s, count(*) as n from observations group by fold) f
          using (fold)
        cross join (select sum(actual) as s, count(*) as n from observations) t""",
}


def _metrics(y: str, p: str) -> str:
    e = f"({y} - greatest({p}, 0))"
    return (
        f"avg(abs{e}) as mae, sqrt(avg({e} * {e})) as rmse, "
        f"1 - sum({e} * {e}) / (var_pop({y}) * count(*)) as r2, "
        f"avg(case when {y} <> 0 then abs({e} / {y}) end) * 100 as mape"
    )


def _round(columns: str, places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) as {c}" for c in columns.split(", "))


TOP = "select {name}, round(importance_score, 4) as importance, category from best_features order by importance_score desc, feature_name limit {k}"
# Title case for names whose words start with a letter or a digit.
TITLE = (
    "list_reduce(list_transform(string_split(feature_name, '_'), "
    "lambda w: upper(w[1]) || lower(w[2:])), lambda a, b: a || ' ' || b) as name"
)

FILLED = ", ".join(
    f"round(coalesce({c}::double, median({c}::double) over ()), 6) as {c}"
    for c in CONTEXT_NUMERIC + CAMPAIGN_NUMERIC + VISION_NUMERIC
)
CODES = ", ".join(
    f"dense_rank() over (order by coalesce({c}, 'unknown')) - 1 as {c}_enc" for c in CATEGORICAL
)

STAR = {
    "dim_campaigns": "stg_brief",
    "dim_creatives": "creative_dim",
    "creative_metrics": "mart_fact",
    "v_campaign_benchmarks": "roll",
    "stg_briefing": "stg_brief",
}


def _check(c) -> str:
    source = STAR[c.table]
    failed = {
        "not_null": f"from {source} where {c.column} is null",
        "range": f"from {source} where {c.column} not between {c.low} and {c.high}",
        "unique": f"from (select {c.column} from {source} group by 1 having count(*) > 1)",
        "relationship": f"from {source} where {c.column} not in "
        f"(select {c.column} from {STAR.get(c.parent)})",
    }[c.kind]
    return f"select '{c.name}' as test, count(*) as failures, count(*) = 0 as passed {failed}"


BODIES = {
    "stg_inventory": "select * from stg",
    "stg_briefing": f"select * replace ({_stamp('startdate')} as startdate, {_stamp('enddate')} as enddate) from stg_brief",
    "stg_vision_features": "select filename, "
    + ", ".join(f"coalesce({c}::double, 0.0) as {c}" for c in MEASURES)
    + ", " + ", ".join(f"coalesce({c} <> 0, false) as {c}" for c in FLAGS)
    + " from raw_vision",
    "stg_creative_assets": "select filename, request_id, slug as creative_slug, filepath as file_path from loose_registry",
    "raw_briefing_month_first": f"""
        select campaign_id, campaign_name, campaign_objectives, kpis,
          {_stamp(_month_first('startdate'))} as startdate,
          {_stamp(_month_first('enddate'))} as enddate, currency,
          {", ".join(f"{_number(c)} as {c}" for c in NUMBERS)}
        from raw_briefing""",
    "campaigns_sql": f"""
        select campaign_id, campaign_name, campaign_objectives, startdate, enddate, currency,
          {NUMBERS_OR_ZERO}
        from raw_briefing qualify row_number() over (partition by campaign_id order by o_orderkey) = 1""",
    "latest_briefing": f"select * replace ({_stamp('startdate')} as startdate, {_stamp('enddate')} as enddate) from latest_brief",
    "cleaned_events": f"""
        select * replace (lower(trim(type, ' ' || chr(9))) as type,
          {_stamp('browser_ts::timestamp')} as browser_ts)
        from raw_inventory""",
    "events_from_csv": f"""
        select * replace (lower(trim(type, ' ' || chr(9))) as type,
          nullif(device_type, '') as device_type, nullif(geo_country, '') as geo_country,
          {_stamp('browser_ts::timestamp')} as browser_ts)
        from raw_inventory""",
    "briefing_from_csv": f"select * replace ({_stamp('startdate')} as startdate, {_stamp('enddate')} as enddate) from csv_brief",
    "design_from_json": "select * from flat",
    "design_from_large_files": "select * from flat",
    "results_from_json": f"select * replace ({_stamp('run_timestamp')} as run_timestamp) from benchmarks",
    "creative_keys": f"""
        select distinct game_key,
          case when contains(game_key, '/') then {LAST_SLUG} else game_key end as slug,
          case when contains(game_key, '/') then {LAST_REQUEST} end as request_id,
          split_part(game_key, '/', 1) as first_segment,
          split_part(game_key, '/', 2) as second_segment,
          coalesce(case when contains(game_key, '/') then {LAST_SLUG} else game_key end, '') || '-'
            || coalesce(case when contains(game_key, '/') then {LAST_REQUEST} end, '') || '.png'
            as image_filename
        from raw_inventory""",
    "image_registry": "select * from registry",
    "registry_with_sizes": f"""
        select filename, filepath, slug, request_id, {PLACEMENT} as placement_type,
          format('{{:.2f}}', length / 1024.0::double)::double as file_size_kb
        from loose_registry""",
    "source_sizes": "select count(*) as n_files, sum(length)::bigint as n_bytes from files",
    "kpi_file": "select * from file_kpi",
    "kpi_sql": f"""
        select *, {RATES} from (
          select {GRAIN}, {_counts('type')} from raw_inventory
          where campaign_id is not null and game_key like '%/%' group by {GRAIN})""",
    "kpi_mart": "select * from mart_kpi",
    "kpi_running": "select * from mart_kpi",
    "kpi_pivot": f"select campaign_id, game_key, {_counts('kind')} from file_events group by 1, 2",
    "kpi_summary": """
        select count(*) as n_rows, count(distinct campaign_id) as n_campaigns,
          count(distinct game_key) as n_creatives,
          round(avg(engagement_rate), 6) as engagement_rate_mean,
          round(stddev_samp(engagement_rate), 6) as engagement_rate_std,
          round(max(engagement_rate), 6) as engagement_rate_max,
          round(avg(click_through_rate), 6) as click_through_rate_mean,
          round(stddev_samp(click_through_rate), 6) as click_through_rate_std,
          round(max(click_through_rate), 6) as click_through_rate_max
        from file_kpi""",
    "dim_campaigns": f"select * replace ({_stamp('startdate')} as startdate, {_stamp('enddate')} as enddate) from stg_brief",
    "dim_creatives": "select * from creative_dim",
    "dim_creatives_design_video": f"""
        select game_key, {LAST_SLUG} as creative_slug, {LAST_REQUEST} as creative_request_id,
          coalesce(max(f.has_video) <> 0, false) as has_video
        from (select distinct game_key from stg) k
        left join flat f on f.request_id = regexp_extract(k.game_key, '^(.*)/([^/]*)$', 2)
        group by k.game_key""".replace("select game_key,", "select k.game_key,")
    .replace("extract(game_key", "extract(k.game_key"),
    "fact_performance": "select * from mart_fact",
    "fact_dense_id": f"""
        select row_number() over (order by left(md5({GRAIN_TEXT}), 3), {GRAIN}) as id, *
        from mart_kpi""",
    "campaign_rollup": "select * from roll",
    "metrics_with_parents": """
        select campaign_id, game_key, device_type, platform_os, geo_country, campaign_name,
          creative_slug, n_impressions
        from mart_fact join stg_brief using (campaign_id) join creative_dim using (game_key)""",
    "design_flat": "select * from flat",
    "images_design": """
        select filename, r.request_id, placement_type, game_key, n_engagement_labels,
          color_saturation_mean, aspect_ratio
        from registry r left join flat f on f.request_id = r.request_id""",
    "images_design_match": """
        select count(game_key) as matched, count(*) as total,
          count(game_key)::double / count(*) as match_rate
        from registry r left join flat f on f.request_id = r.request_id""",
    "linked_file": f"select * replace ({_stamp('startdate')} as startdate, {_stamp('enddate')} as enddate) from linked",
    "linked_warehouse": f"""
        select m.* exclude (id), c.creative_slug, c.creative_request_id, c.image_filename,
          b.campaign_name, b.campaign_objectives, {_stamp('b.startdate')} as startdate,
          {_stamp('b.enddate')} as enddate, b.currency, b.buy_rate_cpe, b.volume_agreed,
          b.gross_cost_budget, date_diff('day', b.startdate, b.enddate)::int as campaign_duration_days,
          d.* exclude (game_key, request_id, n_click_through_texts)
        from mart_fact m left join creative_dim c using (game_key)
        left join stg_brief b using (campaign_id)
        left join flat d on d.request_id = c.creative_request_id""",
    "campaign_durations": f"""
        select o_orderkey, case when d is not null then greatest(0, d) end::int as duration_clipped, d::int as duration_signed from (
          select o_orderkey, trunc(date_diff('hour', {_day_first('startdate')} + interval 36 hours,
            {_day_first('enddate')}) / 24) as d
          from raw_briefing)""",
    "feature_matrix": f"""
        select campaign_id, game_key, coalesce(device_type, 'unknown') as device_type,
          coalesce(platform_os, 'unknown') as platform_os,
          coalesce(geo_country, 'unknown') as geo_country, design_game_key,
          coalesce(interaction_direction, 'unknown') as interaction_direction, {CODES}, {FILLED}
        from linked l left join (select * exclude (aspect_ratio) from first_vision) v
          on v.filename = l.image_filename""",
    "feature_profile": """
        select count(*) as n_rows, count(distinct campaign_id) as n_campaigns,
          round(avg(engagement_rate), 6) as engagement_rate_mean,
          round(max(engagement_rate), 6) as engagement_rate_max,
          round(avg(click_through_rate), 6) as click_through_rate_mean,
          round(max(click_through_rate), 6) as click_through_rate_max
        from linked""",
    "category_codes": " union all ".join(
        f"""select '{c}' as "column", value, row_number() over (order by value) - 1 as code
        from (select distinct coalesce({c}, 'unknown') as value from raw_inventory)"""
        for c in ("device_type", "platform_os", "geo_country")
    ),
    "unseen_codes": """
        select o_orderkey, case when o_orderstatus = 'O' then 'MACHINERY' else 'unknown' end as segment,
          case when o_orderstatus = 'O'
            then (select count(distinct c_mktsegment) from customer where c_mktsegment < 'MACHINERY')
            else (select count(distinct c_mktsegment) from customer) end as segment_enc
        from orders""",
    "group_folds": """
        select unnest(loads) as fold_rows from (
          select loads from dealt order by step desc limit 1)""",
    "group_folds_apart": """
        select l_suppkey, 1::bigint as n_folds, count(*) as n_rows from lineitem group by l_suppkey""",
    "regression_metrics": f"""
        select fold, {_round('mae, rmse, r2, mape')} from (
          select fold, {_metrics('actual', 'predicted')} from observations group by fold)""",
    "baseline_cv": "select "
    + ", ".join(
        f"round({f}({m}), 6) as {m}_{n}"
        for m in ("mae", "rmse", "r2", "mape")
        for n, f in (("mean", "avg"), ("std", "stddev_pop"))
    )
    + f", count(*) as n_folds from (select {_metrics('actual', 'prediction')} from cv_folds group by fold)",
    "importance_mean": """
        select model_name, feature_name, sum(l_quantity) / 5 as importance_score
        from run_rows group by all""",
    "ridge_predictions": "select l_orderkey, l_linenumber, round(prediction, 6) as prediction from ridge",
    "batch_score_ridge": """
        select l_orderkey, l_linenumber,
          round(least(greatest(prediction, 0), 1), 6) as engagement_rate_predicted,
          round(least(greatest(prediction, 0), 1) * 0.1::double, 6) as click_through_rate_predicted,
          'Prediction from tabular-only model (no image provided)' as confidence_note,
          false as vision_features_used
        from ridge""",
    "heuristic_score": """
        select * exclude (er), format('{:.1f}', er * 100)::double as er_percent,
          format('{:.1f}', er * 0.45::double * 100)::double as ctr_percent,
          case when er < 0.08::double then 'low' when er > 0.15::double then 'top'
            when er > 0.12::double then 'high' else 'avg' end as tier,
          case when er < 0.08::double then '🔴 Low' when er > 0.15::double then '⭐ Top Performer'
            when er > 0.12::double then '🟢 High' else '🟡 Average' end as tier_label
        from (select *, 0.12::double
            * case when device = 'smartphone' then 1.15::double else 1.0::double end
            * case when os = 'iOS' then 1.08::double else 1.0::double end
            * case when region = 'USA' then 1.10::double else 1.0::double end
            * (1 - cpe * 0.3::double)
            * (0.8::double + brightness * 0.004::double)
            * (0.85::double + saturation * 0.003::double)
            * (0.9::double + colorfulness * 0.002::double)
            * case when has_video then 1.12::double else 1.0::double end as er
          from scenarios)""",
    "image_features": "select * exclude (vec_id, w) from image_measures",
    "vision_features": """
        select filename, regexp_replace(filename, '-[^-]*$', '') as slug,
          regexp_extract(filename, '([^-]*)[.]png$', 1) as request_id, 'mobile' as placement_type,
          w as file_size_kb, m.* exclude (filename, w, vec_id), """
    + ", ".join(f"0.0::double as vision_pca_{i}" for i in range(32))
    + """
        from image_measures m""",
    "pca_norms": """
        with entries as (
          select vec_id, unnest(embedding)::double as x, unnest(range(0, len(embedding))) as i
          from embeddings),
        scales as (select i, avg(x) as mean, stddev_pop(x) as dev from entries group by i)
        select 'adunit-mob-' || lpad(cast(vec_id as string), 20, '0') || '.png' as filename,
          round(sum(pow((x - mean) / dev, 2)), 6) as norm
        from entries join scales using (i) group by vec_id""",
    "image_embeddings": """
        select filename, round((avg(r) / 255 - 0.485::double) / 0.229::double, 3) as channel_0,
          round((avg(g) / 255 - 0.456::double) / 0.224::double, 3) as channel_1,
          round((avg(b) / 255 - 0.406::double) / 0.225::double, 3) as channel_2
        from pixels join image_names using (vec_id) group by filename""",
    "dq_report": " union all ".join(_check(c) for c in STAR_CHECKS),
    "dq_unique": "select campaign_id, count(*) as n from raw_briefing group by 1 having count(*) > 1",
    "dq_not_null": " union all ".join(
        f"select 'not_null_raw_inventory_{c}' as test, count(*) as failures, count(*) = 0 as passed "
        f"from raw_inventory where {c} is null"
        for c in ("campaign_id", "game_key", "type", "device_type", "platform_os", "geo_country")
    ),
    "dq_relationships": f"""
        select {GRAIN} from mart_fact
        where campaign_id not in (select campaign_id from stg_brief)""",
    "dq_range": " union all ".join(
        f"select 'range_creative_metrics_{c}' as test, count(*) as failures, count(*) = 0 as passed "
        f"from mart_fact where {c} not between 0 and 1"
        for c in ("engagement_rate", "click_through_rate")
    ),
    "row_counts": " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows from {source}"
        for name, source in (
            ("raw_inventory", "events"), ("raw_briefing", "orders"),
            ("raw_vision_features", "part"), ("raw_creative_assets", "part"),
        )
    ),
    "column_profile": " union all ".join(
        f"""select '{c}' as "column", 'string' as type, count({c}) as non_null, count(*) as n_rows
        from raw_inventory"""
        for c in (
            "campaign_id", "game_key", "type", "device_type", "platform_os", "geo_country",
            "browser_ts",
        )
    ),
    "model_benchmarks": f"""
        select {_stamp('run_timestamp')} as run_timestamp, target_metric, model_name,
          {_round('mae, rmse, r2, mape')}, n_features from benchmarks""",
    "feature_importances": f"""
        select * replace ({_stamp('run_timestamp')} as run_timestamp) from scores""",
    "global_stats": """
        select (select sum(n_impressions)::bigint from mart_fact) as total_events,
          (select count(*) from creative_dim) as total_creatives,
          (select count(*) from stg_brief) as total_campaigns,
          (select format('{:.4f}', r2)::double from benchmarks where model_name = 'multimodal'
            order by run_timestamp desc limit 1) as multimodal_r2""",
    "latest_benchmarks": """
        select model_name, format('{:.4f}', r2)::double as r2, format('{:.4f}', mae)::double as mae,
          format('{:.2f}', mape)::double as mape, n_features
        from benchmarks where run_timestamp = (select max(run_timestamp) from benchmarks)""",
    "top_features": TOP.format(name=TITLE, k=10),
    "top_features_chart": TOP.format(name=TITLE, k=15),
    "metrics_long": " union all ".join(
        f"""select upper(model_name[1]) || model_name[2:] as model, '{name}' as metric,
          round({value}, 6) as value
        from benchmarks where run_timestamp = (select max(run_timestamp) from benchmarks)"""
        for name, value in (("MAE", "mae"), ("RMSE", "rmse"), ("MAPE", "mape / 100"), ("R2", "r2"))
    ),
    "top_creatives": f"""
        select game_key, campaign_name, n_impressions, n_engagements,
          {_percent('n_engagements', 'n_impressions')} as er_percent,
          {_percent('n_clicks', 'n_impressions')} as ctr_percent
        from mart_fact join stg_brief using (campaign_id) where n_impressions >= 3
        order by engagement_rate desc, {GRAIN} limit 5""",
    "sampled_events": """
        select event_id, user_id, event_type from events
        order by md5(concat_ws('|', '7', coalesce(event_id::varchar, '\\N'))) limit 1000""",
    "top_campaigns": """
        select campaign_name, num_creatives, total_impressions, avg_engagement_rate_pct,
          avg_click_through_rate_pct
        from roll order by total_impressions desc nulls last, campaign_id limit 10""",
    "percentiles_by_country": """
        select geo_country, round(quantile_cont(engagement_rate, 0.25), 6) as p25,
          round(quantile_cont(engagement_rate, 0.5), 6) as p50,
          round(quantile_cont(engagement_rate, 0.75), 6) as p75
        from mart_fact where engagement_rate is not null group by geo_country""",
}

# Groups dealt one by one, largest first, to the lightest of five folds.
DEALT = """
    sized as (
      select n, row_number() over (order by n desc) as step
      from (select count(*) as n from lineitem group by l_suppkey)),
    dealt as (
      select 0::bigint as step, [0, 0, 0, 0, 0]::bigint[] as loads
      union all
      select s.step, list_transform([1, 2, 3, 4, 5], lambda i: d.loads[i]
        + case when i = list_position(d.loads, list_min(d.loads)) then s.n else 0 end)
      from dealt d join sized s on s.step = d.step + 1)
"""


# Boosting by one split a round: sums up to each value, the best split, the two leaves' steps.
def _stump(number: int) -> str:
    def part(g: str, n: str) -> str:
        return f"power(greatest(abs({g}) - 0.1::double, 0), 2) / ({n} + 0.1::double)"

    def step(g: str, n: str) -> str:
        return f"-0.05::double * sign({g}) * greatest(abs({g}) - 0.1::double, 0) / ({n} + 0.1::double)"

    return f"""
      sums{number} as (
        select f, v, sum(g) as g, count(*) as n
        from (select unnest([1, 2, 3]) as f, unnest([q, d, t]) as v, p - y as g from fitted{number - 1}) group by f, v),
      upto{number} as (
        select f, v, sum(g) over w as gl, sum(n) over w as nl,
          sum(g) over (partition by f) - sum(g) over w as gr, sum(n) over (partition by f) - sum(n) over w as nr
        from sums{number} window w as (partition by f order by v rows unbounded preceding)),
      best{number} as (
        select * from upto{number} where nl >= 10 and nr >= 10
        order by {part("gl", "nl")} + {part("gr", "nr")} - {part("gl + gr", "nl + nr")} desc, f, v limit 1),
      fitted{number} as (
        select r.* replace (p + case when [q, d, t][f] <= v then {step("gl", "nl")} else {step("gr", "nr")} end as p)
        from fitted{number - 1} r, best{number})"""


STUMPS = f"""
    with fitted0 as (
      select l_orderkey, l_linenumber, l_quantity::double as q, l_discount::double as d, l_tax::double as t,
        l_extendedprice::double / 100000 as y, avg(l_extendedprice::double / 100000) over () as p
      from lineitem),{_stump(1)},{_stump(2)}
    select l_orderkey, l_linenumber, round(p, 6) as prediction from fitted2"""


def _with_parts(body: str) -> str:
    """Prefix the parts a query needs, each after those it builds on."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", sql):
                visit(PARTS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "with " + ",\n".join(f"{n} as ({PARTS[n]})" for n in needed) + body


ORACLES = {name: _with_parts(body if body[0] in "\n " else "\n" + body) for name, body in BODIES.items()}
ORACLES["group_folds"] = "with recursive" + DEALT + BODIES["group_folds"]
ORACLES["boosted_stumps"] = STUMPS
