"""Jobs: load staging tables, build the marts, run the modelling stages."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetric.operators import kpi, quality
from lumetric.operators.design import flatten_design
from lumetric.plans import linked, marts, staging, vision
from lumetric.plans.features import Fitted, feature_matrix
from lumetric.plans.models import (
    Model, benchmark_rows, compare_models, importance_rows, load_models, results_document, train_final,
)
from lumetric.plans.scoring import score
from lumetric.session import settle
from lumetric.sources import readers
from lumetric.sources.sinks import (
    ANALYTICS, STAGING, cached, create_namespaces, load_if_empty, materialize,
)


def stage_all(
    spark: SparkSession,
    events: DataFrame,
    briefing: DataFrame,
    documents: DataFrame,
    registry: DataFrame,
    vision: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Raw tables; events are kept when already loaded, the rest is replaced."""
    create_namespaces(spark)
    tables = {"raw_inventory": load_if_empty(staging.raw_inventory(events), "raw_inventory")}
    frames = {
        "raw_briefing": staging.raw_briefing(briefing, dated=True),
        "raw_design_metadata": staging.raw_design(flatten_design(documents)),
        "raw_creative_assets": staging.raw_assets(registry),
    }
    if vision is not None:
        frames["raw_vision_features"] = vision
    return tables | {n: materialize(df, n, STAGING) for n, df in frames.items()}


def build_marts(spark: SparkSession) -> tuple[dict[str, DataFrame], DataFrame]:
    """Curated tables from the staging tables, and the check results.

    The fact comes first and gives the creative keys: one scan of the events.
    """
    create_namespaces(spark)
    raw = {
        n: spark.table(f"{STAGING}.{n}")
        for n in ("raw_inventory", "raw_briefing", "raw_vision_features")
    }
    # The latest submission of each campaign, where submissions are dated.
    dated = "submission_date" in raw["raw_briefing"].columns
    latest = [F.col("submission_date").desc_nulls_last()] if dated else []
    staged_briefing = staging.stg_briefing(raw["raw_briefing"], latest)
    fact = materialize(
        marts.creative_metrics(staging.stg_inventory(raw["raw_inventory"])),
        "creative_metrics",
        ANALYTICS,
    )
    campaigns = materialize(marts.dim_campaigns(staged_briefing), "campaigns", ANALYTICS)
    creatives = materialize(
        marts.dim_creatives(
            marts.creative_keys(fact), staging.stg_vision_features(raw["raw_vision_features"])
        ),
        "creatives",
        ANALYTICS,
    )
    rollup = materialize(
        marts.campaign_benchmarks(campaigns, fact), "v_campaign_benchmarks", as_="view"
    )
    tables = {
        "stg_briefing": staged_briefing,
        "dim_campaigns": campaigns,
        "dim_creatives": creatives,
        "creative_metrics": fact,
        "v_campaign_benchmarks": rollup,
    }
    return tables, quality.run_checks(tables)


def build_marts_sql(spark: SparkSession) -> dict[str, DataFrame]:
    """The loader's own tables, without cleaning and checks."""
    create_namespaces(spark)
    raw = [
        spark.table(f"{STAGING}.{n}")
        for n in ("raw_inventory", "raw_briefing", "raw_vision_features")
    ]
    return {n: materialize(df, n, ANALYTICS) for n, df in marts.sql_schema(*raw).items()}


def record_results(results: DataFrame, run_timestamp: datetime) -> dict[str, DataFrame]:
    """Append a run to the benchmark and importance tables."""
    create_namespaces(results.sparkSession)
    return {
        "model_benchmarks": materialize(
            benchmark_rows(results, run_timestamp), "model_benchmarks", ANALYTICS, mode="append"
        ),
        "feature_importances": materialize(
            importance_rows(results, run_timestamp), "feature_importances", ANALYTICS, mode="append"
        ),
    }


def vision_stage(
    spark: SparkSession,
    folder: str,
    out: str,
    make_predict_fn: Callable | None = None,
    side: int = 224,
    force: bool = False,
    nested: bool = False,
) -> DataFrame:
    """Image features of a folder, kept below ``out`` with the fitted PCA.

    Images are read once for measures and embeddings; fitting and projecting
    read those back.
    """

    def build() -> DataFrame:
        registry = readers.list_images(spark, folder, nested=nested)
        images = readers.load_images(spark, folder, nested)
        if make_predict_fn is None:
            return vision.vision_features(registry, images)
        both = settle(vision.measured_and_embedded(images, make_predict_fn, side), "embeddings")
        embeddings = both.select("filename", "embedding")
        model = vision.fit_pca(embeddings)
        model.write().overwrite().save(f"{out}/pca_model")
        components = vision.project(embeddings, model)
        return vision.vision_features(registry, components=components, measures=both.drop("embedding"))

    settings = (folder, make_predict_fn is not None, side, nested)
    return cached(spark, f"{out}/vision_embeddings", build, force, settings=settings)


def score_images(
    spark: SparkSession,
    contexts: DataFrame,
    folder: str,
    out: str,
    make_predict_fn: Callable | None = None,
    side: int = 224,
    nested: bool = False,
) -> DataFrame:
    """Score contexts with new images by all that earlier runs saved below ``out``.

    Nothing is fitted: the codes, the scaler and components and the models are
    loaded. Each image is read once. Contexts name theirs in ``image_filename``;
    one that is missing or unreadable is noted.
    """
    registry = readers.list_images(spark, folder, nested=nested)
    images = readers.load_images(spark, folder, nested)
    if make_predict_fn is None:
        rows = vision.vision_features(registry, images)
    else:
        both = settle(vision.measured_and_embedded(images, make_predict_fn, side), "embeddings")
        saved = PipelineModel.load(f"{out}/pca_model")
        components = vision.project(both.select("filename", "embedding"), saved)
        rows = vision.vision_features(registry, components=components, measures=both.drop("embedding"))
    fitted = Fitted.load(spark, f"{out}/models/fitted")
    return score(contexts, load_models(spark, f"{out}/models"), fitted.encoders, rows)


def model_stages(
    linked_rows: DataFrame,
    image_features: DataFrame | None,
    out: str,
    force: bool = False,
    source: object = None,
    **settings,
) -> tuple[DataFrame, DataFrame, dict[str, Model]]:
    """(feature matrix, nested results, final models), the first two reused if present.

    ``source`` says what the rows were made from; output made from another source
    or with other settings is not reused.
    """
    spark = linked_rows.sparkSession

    def build_matrix() -> DataFrame:
        matrix, fitted = feature_matrix(linked_rows, image_features)
        fitted.save(f"{out}/models/fitted")
        return matrix

    made = (source, sorted(linked_rows.columns), image_features is not None)
    matrix = cached(spark, f"{out}/feature_dataset", build_matrix, force, settings=made)
    results = cached(
        spark,
        f"{out}/benchmark_results",
        lambda: results_document(*compare_models(matrix, **settings)),
        force,
        "json",
        (made, sorted(settings.items(), key=str)),
    )
    boosting = {k: v for k, v in settings.items() if k not in ("n_splits", "parallelism")}
    return matrix, results, train_final(matrix, f"{out}/models", **boosting)


def run_from_files(
    spark: SparkSession,
    paths: dict[str, str],
    out: str,
    rules: kpi.KpiRules = kpi.FILE,
    make_predict_fn: Callable | None = None,
    design_per_line: bool | None = None,
    force: bool = False,
    **settings,
) -> tuple[DataFrame, DataFrame, dict[str, Model]]:
    """Raw files to features, model comparison and final models.

    Design and briefing are written first: their sizes then tell whether the
    rates can be joined without shuffling them.
    """
    sources = readers.load_all(spark, paths, design_per_line)
    rows = linked.linked_from_files(
        kpi.creative_kpi(sources["events"], rules),
        settle(flatten_design(sources["design"]), "design"),
        settle(sources["briefing"], "briefing"),
    )
    images = vision_stage(spark, paths["images"], out, make_predict_fn, force=force)
    return model_stages(rows, images, out, force, (sorted(paths.items()), rules, make_predict_fn is not None), **settings)


def run_from_tables(
    spark: SparkSession, out: str, force: bool = False, **settings
) -> tuple[DataFrame, DataFrame, dict[str, Model]]:
    """The same from the warehouse tables."""
    rows, images = linked.read_linked(spark), linked.read_vision_features(spark)
    return model_stages(rows, images, out, force, "tables", **settings)
