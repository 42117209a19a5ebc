"""Every operator as a query over the test tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetric.adapters import adapted, table
from lumetric.functions import numbers, text
from lumetric.operators import encode, folds, kpi, metrics, quality
from lumetric.operators.design import flatten_design
from lumetric.operators.rows import keep_first
from lumetric.plans import features, linked, marts, models, reports, scoring, staging, vision
from lumetric.session import scratch_path, settle
from lumetric.sources import readers, schemas, sinks
from lumetric.streaming import running

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FILE_RULES = kpi.FILE.with_(min_impressions=2)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def events(spark: SparkSession, sf: str) -> DataFrame:
    return adapted(spark, sf, "raw_inventory")


def briefing(spark: SparkSession, sf: str) -> DataFrame:
    return adapted(spark, sf, "raw_briefing")


def latest_first() -> list[Column]:
    return [F.col("submission_date").desc_nulls_last()]


def staged_briefing(spark: SparkSession, sf: str) -> DataFrame:
    # Dates are parsed on the rows that are kept.
    return staging.stg_briefing(briefing(spark, sf), latest_first()).withColumns(
        {c: numbers.date_text(F.col(c)) for c in schemas.BRIEFING_DATES}
    )


def staged_vision(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_vision_features(adapted(spark, sf, "raw_vision"))


def first_images(spark: SparkSession, sf: str) -> DataFrame:
    return keep_first(adapted(spark, sf, "raw_vision"), ["filename"])


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return marts.creative_metrics(staging.stg_inventory(events(spark, sf)))


def creatives(spark: SparkSession, sf: str) -> DataFrame:
    keys = marts.creative_keys(staging.stg_inventory(events(spark, sf)))
    images = staging.stg_vision_features(first_images(spark, sf))
    return marts.dim_creatives(keys, images)


def campaigns(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_campaigns(staged_briefing(spark, sf))


def star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The curated tables, written once: events are scanned a single time."""
    return marts.star_schema(
        events(spark, sf), staged_briefing(spark, sf), first_images(spark, sf)
    )


def design(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_design(adapted(spark, sf, "design_docs"))


def printable(df: DataFrame) -> DataFrame:
    """Times as text and decimals as doubles, which compare alike in any engine."""
    casts = {}
    for name, kind in df.dtypes:
        if kind.startswith("timestamp"):
            casts[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("decimal"):
            casts[name] = F.col(name).cast("double")
    return df.withColumns(casts) if casts else df


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- staging ---------------------------------------------------------------


@query
def stg_inventory(spark, sf):
    return staging.stg_inventory(events(spark, sf))


@query
def stg_briefing(spark, sf):
    return printable(staged_briefing(spark, sf))


@query
def stg_vision_features(spark, sf):
    return staged_vision(spark, sf)


@query
def stg_creative_assets(spark, sf):
    registry = readers.image_registry(adapted(spark, sf, "files"), strict_request_id=False)
    return staging.stg_creative_assets(staging.raw_assets(registry))


@query
def raw_briefing_month_first(spark, sf):
    return printable(staging.raw_briefing(briefing(spark, sf)))


@query
def campaigns_sql(spark, sf):
    return marts.campaigns_sql(briefing(spark, sf))


@query
def latest_briefing(spark, sf):
    return printable(readers.latest_briefing(briefing(spark, sf)))


@query
def cleaned_events(spark, sf):
    return printable(readers.clean_events(events(spark, sf)))


# --- sources, by way of files ----------------------------------------------


@query
def events_from_csv(spark, sf):
    path = scratch_path(spark, "events-csv")
    events(spark, sf).write.csv(path, header=True, ignoreLeadingWhiteSpace=False,
                                ignoreTrailingWhiteSpace=False)
    return printable(readers.load_events(spark, path))


@query
def briefing_from_csv(spark, sf):
    path = scratch_path(spark, "briefing-csv")
    renamed = briefing(spark, sf).withColumnsRenamed(
        {"buy_rate_cpe": "Buy Rate (CPE)", "gross_cost_budget": "Gross Cost/Budget",
         "startdate": "StartDate", "campaign_id": "Campaign ID"}
    )
    renamed.write.csv(path, header=True, ignoreLeadingWhiteSpace=False,
                      ignoreTrailingWhiteSpace=False)
    found = readers.load_briefing(spark, path)
    return printable(found.withColumn("o_orderkey", F.col("o_orderkey").cast("long")))


@query
def design_from_json(spark, sf):
    path = scratch_path(spark, "design-json")
    adapted(spark, sf, "design_docs").select("doc").write.text(path)
    return flatten_design(readers.load_design(spark, path))


@query
def design_from_large_files(spark, sf):
    """Four files, each one object over all its lines, split again by key."""
    path = scratch_path(spark, "design-files")
    docs = adapted(spark, sf, "design_docs").select(
        F.pmod(F.hash("p_partkey"), F.lit(4)).alias("part"),
        F.lit(1).alias("place"),
        F.expr("concat(', ', substring(doc, 2, length(doc) - 2))").alias("value"),
    )
    edges = F.array(
        F.struct(F.lit(0).alias("place"), F.lit('{"": "a comma, a quote \\" and }"').alias("value")),
        F.struct(F.lit(2).alias("place"), F.lit("}").alias("value")),
    )
    ends = spark.range(4).select(F.col("id").cast("int").alias("part"), F.inline(edges))
    files = docs.union(ends).repartition(4, "part").sortWithinPartitions("part", "place")
    files.drop("place").write.partitionBy("part").text(path)
    return flatten_design(readers.load_design(spark, path, by_key=True))


@query
def results_from_json(spark, sf):
    path = scratch_path(spark, "results-json")
    run_documents(spark, sf).write.json(path)
    schema = f"{schemas.RESULTS}, run_timestamp timestamp"
    return printable(models.benchmark_rows(spark.read.schema(schema).json(path)))


# --- keys and the image registry -------------------------------------------


@query
def creative_keys(spark, sf):
    keys = events(spark, sf).select("game_key").distinct()
    slug, request = text.split_key(F.col("game_key"))
    first, second = text.split_key(F.col("game_key"), "first")
    return keys.select(
        "game_key",
        slug.alias("slug"),
        request.alias("request_id"),
        first.alias("first_segment"),
        second.alias("second_segment"),
        text.image_filename(slug, request).alias("image_filename"),
    )


@query
def image_registry(spark, sf):
    return readers.image_registry(adapted(spark, sf, "files"))


@query
def registry_with_sizes(spark, sf):
    files = adapted(spark, sf, "files")
    assets = staging.raw_assets(readers.image_registry(files, strict_request_id=False))
    return linked.registry_with_sizes(assets, files)


@query
def source_sizes(spark, sf):
    return readers.source_sizes(adapted(spark, sf, "files"))


# --- rates ------------------------------------------------------------------


@query
def kpi_file(spark, sf):
    return kpi.creative_kpi(events(spark, sf), FILE_RULES)


@query
def kpi_sql(spark, sf):
    tables = marts.sql_schema(
        events(spark, sf), briefing(spark, sf), adapted(spark, sf, "raw_vision")
    )
    return tables["creative_metrics"]


@query
def kpi_mart(spark, sf):
    return kpi.creative_kpi(events(spark, sf))


@query
def kpi_running(spark, sf):
    """The same rates, from a stream over the events in about five batches."""
    path = scratch_path(spark, "running")
    shares = F.pmod(F.xxhash64("browser_ts", "game_key", "type"), F.lit(5))
    events(spark, sf).withColumn("_share", shares).write.partitionBy("_share").parquet(f"{path}/events")
    files = len(spark.read.parquet(f"{path}/events").inputFiles())
    stream = running.event_files(spark, f"{path}/events", -(-files // 5))
    running.follow_rates(stream, f"{path}/rates", f"{path}/state", compact_every=2).awaitTermination()
    return running.current_rates(spark, f"{path}/rates")


@query
def kpi_pivot(spark, sf):
    return kpi.event_pivot(kpi.staged_events(events(spark, sf), kpi.FILE), ["campaign_id", "game_key"])


@query
def kpi_summary(spark, sf):
    summary = kpi.kpi_summary(kpi.creative_kpi(events(spark, sf), FILE_RULES))
    return rounded(summary, *[c for c, kind in summary.dtypes if kind == "double"])


# --- star schema ------------------------------------------------------------


@query
def dim_campaigns(spark, sf):
    return printable(campaigns(spark, sf))


@query
def dim_creatives(spark, sf):
    return creatives(spark, sf)


@query
def dim_creatives_design_video(spark, sf):
    keys = marts.creative_keys(staging.stg_inventory(events(spark, sf)))
    images = staging.stg_vision_features(first_images(spark, sf))
    dim = marts.dim_creatives(keys, images, "last", design(spark, sf))
    return dim.select("game_key", "creative_slug", "creative_request_id", "has_video")


@query
def fact_performance(spark, sf):
    staged = staging.stg_inventory(events(spark, sf))
    return marts.creative_metrics(staged, marts.creative_keys(staged))


@query
def fact_dense_id(spark, sf):
    staged = staging.stg_inventory(events(spark, sf))
    return marts.creative_metrics(staged, surrogate="dense")


@query
def campaign_rollup(spark, sf):
    return printable(marts.campaign_benchmarks(campaigns(spark, sf), fact(spark, sf)))


@query
def metrics_with_parents(spark, sf):
    tables = star(spark, sf)
    joined = tables["creative_metrics"].join(tables["dim_campaigns"], "campaign_id")
    return joined.join(tables["dim_creatives"], "game_key").select(
        "campaign_id", "game_key", "device_type", "platform_os", "geo_country",
        "campaign_name", "creative_slug", "n_impressions",
    )


# --- linked data ------------------------------------------------------------


@query
def design_flat(spark, sf):
    return design(spark, sf)


@query
def images_design(spark, sf):
    images = readers.image_registry(adapted(spark, sf, "files"))
    joined = linked.images_with_design(images, design(spark, sf))
    return joined.select(
        "filename", "request_id", "placement_type", "game_key", "n_engagement_labels",
        "color_saturation_mean", "aspect_ratio",
    )


@query
def images_design_match(spark, sf):
    images = readers.image_registry(adapted(spark, sf, "files"))
    return kpi.match_report(linked.images_with_design(images, design(spark, sf)), "game_key")


def linked_rows(spark: SparkSession, sf: str) -> DataFrame:
    return linked.linked_from_files(
        kpi.creative_kpi(events(spark, sf), FILE_RULES),
        design(spark, sf),
        readers.latest_briefing(briefing(spark, sf)),
    )


@query
def linked_file(spark, sf):
    return printable(linked_rows(spark, sf))


@query
def linked_warehouse(spark, sf):
    tables = star(spark, sf)
    return printable(
        linked.linked_from_tables(
            tables["creative_metrics"],
            tables["dim_creatives"],
            tables["dim_campaigns"],
            design(spark, sf),
        )
    )


@query
def campaign_durations(spark, sf):
    start, end = (numbers.date_text(F.col(c)) for c in schemas.BRIEFING_DATES)
    late = start + F.expr("interval 36 hours")
    return briefing(spark, sf).select(
        "o_orderkey",
        numbers.whole_days(late, end).alias("duration_clipped"),
        numbers.whole_days(late, end, clipped=False).alias("duration_signed"),
    )


# --- features and models ----------------------------------------------------


def matrix(spark: SparkSession, sf: str) -> tuple[DataFrame, features.Fitted]:
    return features.feature_matrix(linked_rows(spark, sf), first_images(spark, sf))


@query
def feature_matrix(spark, sf):
    df, _ = matrix(spark, sf)
    chosen = features.feature_sets(df.columns)["multimodal"]
    out = df.select("campaign_id", "game_key", "device_type", "platform_os", "geo_country",
                    "design_game_key", "interaction_direction", *chosen)
    return rounded(out, *[c for c, kind in out.dtypes if kind == "double"])


@query
def feature_profile(spark, sf):
    profile = features.feature_profile(linked_rows(spark, sf))
    return rounded(profile, *[c for c, kind in profile.dtypes if kind == "double"])


@query
def category_codes(spark, sf):
    return encode.fit_encoders(events(spark, sf), ["device_type", "platform_os", "geo_country"])


@query
def unseen_codes(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.lit("MACHINERY"))
        .when(F.col("o_orderstatus") == "F", F.lit("SPACE"))
        .alias("segment"),
    )
    return encode.apply_encoders(orders, encode.fit_encoders(customers, ["segment"]), ["segment"])


@query
def group_folds(spark, sf):
    rows = table(spark, sf, "lineitem")
    dealt = folds.group_folds(rows, "l_suppkey", models.N_SPLITS)
    return dealt.groupBy("fold").agg(F.sum("n_rows").alias("fold_rows")).select("fold_rows")


@query
def group_folds_apart(spark, sf):
    rows = folds.with_folds(table(spark, sf, "lineitem"), "l_suppkey", models.N_SPLITS)
    return rows.groupBy("l_suppkey").agg(
        F.countDistinct("fold").alias("n_folds"), F.count("*").alias("n_rows")
    )


@query
def regression_metrics(spark, sf):
    rows = adapted(spark, sf, "observations")
    return rounded(
        metrics.regression_metrics(rows, "actual", "predicted", ["fold"]), *metrics.METRICS
    )


@query
def baseline_cv(spark, sf):
    rows = adapted(spark, sf, "observations")
    predicted = models.baseline_predictions(rows, "actual")
    per_fold = metrics.regression_metrics(predicted, "actual", "prediction", ["fold"])
    summary = metrics.fold_summary(per_fold)
    return rounded(summary, *[c for c, kind in summary.dtypes if kind == "double"])


@query
def importance_mean(spark, sf):
    rows = adapted(spark, sf, "run_rows")
    per_fold = rows.select(
        "model_name", "feature_name", F.col("l_quantity").alias("importance_score")
    )
    return metrics.mean_importance(per_fold, models.N_SPLITS, ["model_name"])


@query
def ridge_predictions(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    model = models.fit_ridge(rows, ["l_quantity", "l_extendedprice"], "l_discount")
    found = model.transform(rows).select("l_orderkey", "l_linenumber", "prediction")
    return rounded(found, "prediction")


@query
def boosted_stumps(spark, sf):
    """Two rounds of trees with one split, which SQL can follow."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        (F.col("l_extendedprice").cast("double") / 100_000).alias("y"),
    )
    inputs = ["l_quantity", "l_discount", "l_tax"]
    model = models.fit_boosted(rows, inputs, "y", rounds=2, max_depth=1, leaves=2, column_share=1.0)
    found = model.transform(models.zero_filled(rows, inputs))
    return rounded(found.select("l_orderkey", "l_linenumber", "prediction"), "prediction")


@query
def model_comparison(spark, sf):
    df, _ = matrix(spark, sf)
    return models.compare_models(df)[0]


@query
def batch_score(spark, sf):
    # Written once: fitting and scoring read the same rows.
    rows = settle(linked_rows(spark, sf), "linked")
    df, fitted = features.feature_matrix(rows, first_images(spark, sf))
    trained = models.train_final(df, scratch_path(spark, "models"))
    contexts = rows.select(
        "campaign_id", "game_key", "image_filename", "device_type", "platform_os", "geo_country",
        "has_video", "buy_rate_cpe",
    )
    return scoring.score(contexts, trained, fitted.encoders, first_images(spark, sf))


@query
def batch_score_ridge(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    model = models.fit_ridge(rows, ["l_quantity", "l_extendedprice"], "l_discount")
    scored = scoring.score(rows.drop("l_discount"), {"engagement_rate": model})
    return rounded(scored, "engagement_rate_predicted", "click_through_rate_predicted").drop(
        "l_quantity", "l_extendedprice"
    )


@query
def heuristic_score(spark, sf):
    return scoring.rule_score(adapted(spark, sf, "scenarios"))


# --- images -----------------------------------------------------------------


def pixel_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector as an image of one row: blue, green and red are rotations of it."""
    byte = F.transform(
        "embedding",
        lambda x: F.lpad(
            F.hex(F.least(F.greatest(F.floor((x.cast("double") * 2 + 1) * 127.5), F.lit(0)), F.lit(255))),
            2,
            "0",
        ),
    )
    size = F.size("q")

    def at(i: Column, shift: int) -> Column:
        return F.get("q", ((i + shift) % size).cast("int"))

    pixels = F.transform(
        F.sequence(F.lit(0), size - 1), lambda i: F.concat(at(i, 42), at(i, 21), at(i, 0))
    )
    return (
        table(spark, sf, "embeddings")
        .withColumn("q", byte)
        .select(
            F.concat(F.lit("adunit-mob-"), F.lpad(F.col("vec_id").cast("string"), 20, "0"), F.lit(".png"))
            .alias("filename"),
            F.lit(1).alias("height"),
            size.alias("width"),
            F.lit(3).alias("n_channels"),
            F.unhex(F.array_join(pixels, "")).alias("data"),
        )
    )


@query
def image_features(spark, sf):
    found = vision.handcrafted(pixel_rows(spark, sf))
    return rounded(found, *schemas.HANDCRAFTED)


def channel_means():
    """A stand-in network: the mean of each channel."""

    def predict(batch: np.ndarray) -> np.ndarray:
        return batch.reshape(len(batch), 3, -1).mean(axis=2)

    return predict


@query
def image_embeddings(spark, sf):
    found = vision.embed(pixel_rows(spark, sf), channel_means, side=64)
    return found.select(
        "filename",
        *[F.round(F.col("embedding")[i].cast("double"), 3).alias(f"channel_{i}") for i in range(3)],
    )


def network_vectors(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("adunit-mob-"), F.lpad(F.col("vec_id").cast("string"), 20, "0"), F.lit(".png"))
    return table(spark, sf, "embeddings").select(name.alias("filename"), "embedding")


@query
def pca_embed(spark, sf):
    vectors = network_vectors(spark, sf)
    return vision.project(vectors, vision.fit_pca(vectors))


@query
def vision_features(spark, sf):
    vectors = network_vectors(spark, sf)
    files = vectors.select(
        F.concat(F.lit("file:/assets/"), "filename").alias("path"),
        (F.size("embedding") * 1024).cast("long").alias("length"),
    )
    found = vision.vision_features(readers.image_registry(files), pixel_rows(spark, sf))
    return rounded(found, *schemas.HANDCRAFTED)


@query
def vision_features_pca(spark, sf):
    vectors = network_vectors(spark, sf)
    files = vectors.select(F.concat(F.lit("file:/assets/"), "filename").alias("path"),
                           F.lit(1024).cast("long").alias("length"))
    components = vision.project(vectors, vision.fit_pca(vectors))
    return vision.vision_features(readers.image_registry(files), pixel_rows(spark, sf), components)


@query
def pca_norms(spark, sf):
    """With all components kept, PCA is a rotation of the scaled vector: its length stays."""
    vectors = network_vectors(spark, sf)
    size = vectors.agg(F.max(F.size("embedding"))).first()[0]
    found = vision.project(vectors, vision.fit_pca(vectors, k=size))
    squares = [F.col(c) * F.col(c) for c in found.columns if c.startswith(vision.PCA_PREFIX)]
    return found.select("filename", F.round(sum(squares[1:], squares[0]), 6).alias("norm"))


# --- data quality -----------------------------------------------------------


@query
def dq_report(spark, sf):
    return quality.run_checks(star(spark, sf))


@query
def dq_unique(spark, sf):
    return quality.repeated_keys(briefing(spark, sf), "campaign_id")


@query
def dq_not_null(spark, sf):
    checks = [quality.Check("not_null", "raw_inventory", c) for c in schemas.STAGED_EVENT_COLUMNS]
    return quality.run_checks({"raw_inventory": events(spark, sf)}, checks)


@query
def dq_relationships(spark, sf):
    rows = quality.orphans(fact(spark, sf), campaigns(spark, sf), "campaign_id")
    return rows.select("campaign_id", "game_key", "device_type", "platform_os", "geo_country")


@query
def dq_range(spark, sf):
    checks = [
        quality.Check("range", "creative_metrics", c)
        for c in ("engagement_rate", "click_through_rate")
    ]
    return quality.run_checks({"creative_metrics": fact(spark, sf)}, checks)


@query
def row_counts(spark, sf):
    return sinks.row_counts(
        {
            "raw_inventory": events(spark, sf),
            "raw_briefing": briefing(spark, sf),
            "raw_vision_features": adapted(spark, sf, "raw_vision"),
            "raw_creative_assets": adapted(spark, sf, "files"),
        }
    )


@query
def column_profile(spark, sf):
    return reports.column_profile(events(spark, sf))


# --- read queries -----------------------------------------------------------


def run_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One nested results document per run; a document is models times features."""
    rows = adapted(spark, sf, "run_rows")
    scores = rows.groupBy("run_timestamp", "model_name", "feature_name").agg(
        F.sum("l_quantity").alias("score"), F.count("*").alias("n")
    )
    per_model = scores.groupBy("run_timestamp", "model_name").agg(
        F.sum("n").alias("n"),
        F.sum("score").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("feature_name", "score"))).alias("feature_importance"),
    )
    share = F.col("total") / F.col("n")
    return per_model.groupBy("run_timestamp").agg(
        F.lit("engagement_rate").alias("target"),
        F.map_from_entries(
            F.collect_list(
                F.struct(
                    "model_name",
                    F.struct(
                        (share / 100).alias("mae_mean"),
                        (share / 80).alias("rmse_mean"),
                        (share / 50).alias("r2_mean"),
                        (share * 4).alias("mape_mean"),
                        "feature_importance",
                        F.col("n").alias("n_features"),
                        F.when(F.col("model_name") == "broken", F.lit("no_features")).alias("error"),
                    ),
                )
            )
        ).alias("models"),
    )


def runs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    documents = run_documents(spark, sf)
    return models.benchmark_rows(documents), models.importance_rows(documents)


@query
def model_benchmarks(spark, sf):
    return rounded(printable(runs(spark, sf)[0]), "mae", "rmse", "r2", "mape")


@query
def feature_importances(spark, sf):
    return printable(runs(spark, sf)[1])


@query
def global_stats(spark, sf):
    # Creatives are counted by their keys in the fact; no image is read.
    metrics = settle(fact(spark, sf).select("game_key", "n_impressions"), "fact")
    keys = marts.creative_keys(metrics)
    return reports.global_stats(metrics, keys, staged_briefing(spark, sf), runs(spark, sf)[0])


@query
def latest_benchmarks(spark, sf):
    return reports.latest_benchmarks(runs(spark, sf)[0])


@query
def top_features(spark, sf):
    return reports.top_features(runs(spark, sf)[1])


@query
def top_features_chart(spark, sf):
    return reports.top_features(runs(spark, sf)[1], k=15)


@query
def metrics_long(spark, sf):
    return rounded(reports.metrics_long(reports.latest_run(runs(spark, sf)[0])), "value")


@query
def top_creatives(spark, sf):
    best = reports.top_creatives(fact(spark, sf), campaigns(spark, sf), min_impressions=3)
    return printable(best)


@query
def top_campaigns(spark, sf):
    rollup = marts.campaign_benchmarks(campaigns(spark, sf), fact(spark, sf))
    return printable(reports.top_campaigns(rollup))


@query
def sampled_events(spark, sf):
    """A thousand events, the same ones in every run."""
    rows = table(spark, sf, "events")
    return reports.sample(rows.select("event_id", "user_id", "event_type"), 1000, ["event_id"], seed=7)


@query
def percentiles_by_country(spark, sf):
    return rounded(reports.rate_percentiles(fact(spark, sf)), "p25", "p50", "p75")
