"""Model comparison by group k-fold, final models and their importances."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetric.functions.text import feature_category
from lumetric.operators.boosting import BoostedModel, Fit, Settings, fit_many
from lumetric.operators.folds import with_folds
from lumetric.operators.metrics import fold_summary, mean_importance, regression_metrics
from lumetric.plans.features import CATEGORICAL, feature_matrix, feature_sets
from lumetric.plans.vision import population_scaler
from lumetric.session import file_exists, settle, together

N_SPLITS = 5
RIDGE_ALPHA = 1.0
Model = PipelineModel | BoostedModel

IMPORTANCE_SCHEMA = "model_name string, fold int, feature_name string, importance_score double"


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def zero_filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles, null and NaN as 0."""
    return df.withColumns(
        {c: F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features}
    )


def fit_boosted(df: DataFrame, features: Sequence[str], target: str, **settings) -> BoostedModel:
    """Boosted trees on one target; ``settings`` are those of ``boosting.Settings``."""
    rows = zero_filled(df.where(F.col(target).isNotNull()), features)
    spec = Fit(0, tuple(range(len(features))))
    return fit_many(rows, features, [target], [spec], settings=Settings(**settings))[0]


def fit_ridge(
    df: DataFrame, features: Sequence[str], target: str, alpha: float = RIDGE_ALPHA
) -> PipelineModel:
    """Ridge regression on features scaled to unit population deviation.

    The learner minimises the mean squared error over the label's deviation,
    hence the scaling of ``alpha``.
    """
    rows = zero_filled(df.where(F.col(target).isNotNull()), features)
    n, spread = rows.agg(F.count("*"), F.stddev_pop(target)).first()
    line = LinearRegression(
        featuresCol="scaled",
        labelCol=target,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
        regParam=alpha / n * spread,
    )
    scaler = population_scaler(n, len(features), "features", "scaled")
    return Pipeline(stages=[assembler(features), *scaler, line]).fit(rows)


def inputs_of(model: Model) -> list[str]:
    """The columns that a model reads."""
    return model.inputs if isinstance(model, BoostedModel) else model.stages[0].getInputCols()


def importances(model: Model, features: Sequence[str], kind: str = "split") -> list[tuple]:
    """(feature, score), highest first: split counts or normalised gain of trees,
    absolute coefficients of a line, nothing otherwise."""
    if isinstance(model, BoostedModel):
        scores = model.importances(kind)
    elif hasattr(model.stages[-1], "coefficients"):
        scores = [abs(c) for c in model.stages[-1].coefficients.toArray().tolist()]
    else:
        return []
    if len(scores) != len(features):
        return []
    return sorted(zip(features, scores), key=lambda pair: (-pair[1], pair[0]))


def baseline_predictions(rows: DataFrame, target: str) -> DataFrame:
    """Each fold predicted by the mean of the other folds: one pass for all folds."""
    per_fold = rows.groupBy("fold").agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    total = per_fold.agg(F.sum("_s").alias("s"), F.sum("_n").alias("n"))
    # One row per fold, so the broadcast is bounded by the number of folds.
    means = per_fold.select(
        "fold",
        (
            (total.select("s").scalar() - F.col("_s"))
            / F.nullif((total.select("n").scalar() - F.col("_n")).cast("double"), F.lit(0.0))
        ).alias("prediction"),
    )
    return rows.join(F.broadcast(means), "fold").select("fold", target, "prediction")


def fold_predictions(
    rows: DataFrame,
    features: Sequence[str],
    target: str,
    n_splits: int,
    fit: Callable[[DataFrame], Model],
    parallelism: int = 2,
    leak_free: bool = False,
) -> tuple[DataFrame, list[tuple]]:
    """Out-of-fold predictions and the importances by fold; folds fit concurrently."""

    def run(fold: int) -> tuple[DataFrame, list[tuple]]:
        train, held_out = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        if leak_free:
            train, fitted = feature_matrix(train)
            held_out, _ = feature_matrix(held_out, fitted=fitted, fill_fitted=True)
        model = fit(train)
        predicted = model.transform(zero_filled(held_out, features)).select("fold", target, "prediction")
        return predicted, [(fold, f, s) for f, s in importances(model, features)]

    folds = [lambda fold=fold: run(fold) for fold in range(n_splits)]
    parts = together(rows.sparkSession, *folds, at_once=parallelism)
    return reduce(DataFrame.unionByName, [p for p, _ in parts]), [r for _, s in parts for r in s]


def boosted_predictions(
    rows: DataFrame, sets: dict[str, list[str]], target: str, n_splits: int, **settings
) -> tuple[list[DataFrame], list[tuple]]:
    """Out-of-fold predictions and importances of all feature sets and folds, fitted together."""
    features = list(dict.fromkeys(c for chosen in sets.values() for c in chosen))
    place = {c: i for i, c in enumerate(features)}
    fits = [Fit(0, tuple(place[c] for c in chosen), fold) for chosen in sets.values() for fold in range(n_splits)]
    filled = zero_filled(rows, features)
    models = fit_many(filled, features, [target], fits, F.col("fold"), Settings(**settings))
    predicted, scores = [], []
    for (name, chosen), own in zip(sets.items(), (models[i : i + n_splits] for i in range(0, len(models), n_splits))):
        for fold, model in enumerate(own):
            held_out = model.transform(filled.where(F.col("fold") == fold))
            predicted.append(held_out.select(F.lit(name).alias("model_name"), "fold", target, "prediction"))
            scores += [(name, fold, f, s) for f, s in importances(model, chosen)]
    return predicted, scores


def compare_models(
    matrix: DataFrame,
    target: str = "engagement_rate",
    group: str = "campaign_id",
    n_splits: int = N_SPLITS,
    models: Sequence[str] = ("baseline", "tabular", "vision", "multimodal"),
    fit: Callable[..., Model] = fit_boosted,
    parallelism: int = 2,
    leak_free: bool = False,
    **settings,
) -> tuple[DataFrame, DataFrame]:
    """(benchmarks, importances) of the mean baseline and three feature sets.

    Folds are assigned once. Rows and out-of-fold predictions are written to
    the shared folder, rows in one folder per fold; metrics are aggregates over
    the predictions. ``leak_free`` takes joined but uncoded rows and learns
    codes and medians within each fold's training rows. Boosted trees of all sets
    and folds are fitted together, unless that differs by fold.
    """
    spark = matrix.sparkSession
    raw = [c for c in CATEGORICAL if leak_free and c in matrix.columns]
    sets = feature_sets(matrix.columns + [f"{c}_enc" for c in raw])
    sets["baseline"] = (sets["tabular"] or ["has_video"])[:1]
    used = dict.fromkeys([c for m in models for c in sets[m]] + raw)
    wanted = [c for c in used if c in matrix.columns]
    everything = settle(matrix.select(group, target, *wanted), "compared")
    usable = F.col(target).isNotNull() & F.col(group).isNotNull()
    clean = everything.where(usable)
    n_rows, n_groups = clean.agg(F.count("*"), F.countDistinct(group)).first()
    size = everything.agg(F.count("*"), F.countDistinct(group)).first()

    failed, results, scores = {}, [], []
    if n_rows < 2 * n_splits:
        failed = dict.fromkeys(models, "insufficient_data")
    else:
        rows = settle(with_folds(clean, group, n_splits), "rows", by=["fold"])
        shared = {m: sets[m] for m in models if m != "baseline" and sets[m]} if fit is fit_boosted and not leak_free else {}
        if shared:
            predicted, scores = boosted_predictions(rows, shared, target, n_splits, **settings)
            results += predicted
        for name in models:
            if name in shared:
                continue
            if name == "baseline":
                predicted = baseline_predictions(rows, target)
            elif not sets[name]:
                failed[name] = "no_features"
                continue
            else:
                features = sets[name]
                predicted, found = fold_predictions(
                    rows,
                    features,
                    target,
                    n_splits,
                    lambda train, f=features: fit(train, f, target, **settings),
                    parallelism,
                    leak_free,
                )
                scores += [(name, *row) for row in found]
            results.append(predicted.select(F.lit(name).alias("model_name"), "*"))

    meta = spark.createDataFrame(
        [(m, len(sets[m]), n_groups, failed.get(m), n_rows) for m in models],
        "model_name string, n_features long, n_train_campaigns long, error string, n_rows long",
    )
    empty = spark.createDataFrame([], f"model_name string, fold int, {target} double, prediction double")
    oof = settle(reduce(DataFrame.unionByName, results, empty), "predictions")
    per_fold = regression_metrics(oof, target, "prediction", ["model_name", "fold"])
    labels = {"target": target, "group_col": group, "dataset_size": size[0], "n_campaigns": size[1]}
    benchmarks = meta.join(fold_summary(per_fold, ["model_name"]), "model_name", "left").withColumns(
        {name: F.lit(value) for name, value in labels.items()}
    )
    per_feature = mean_importance(
        spark.createDataFrame(scores, IMPORTANCE_SCHEMA), n_splits, ["model_name"]
    )
    return benchmarks, per_feature.withColumn("category", feature_category(F.col("feature_name")))


def results_document(benchmarks: DataFrame, scores: DataFrame) -> DataFrame:
    """The comparison as one nested row; its size is models times features."""
    trees = scores.groupBy("model_name").agg(
        F.map_from_entries(
            F.collect_list(F.struct("feature_name", "importance_score"))
        ).alias("feature_importance")
    )
    joined = benchmarks.join(trees, "model_name", "left")
    fields = [
        *[f"{m}_{s}" for m in ("mae", "rmse", "r2", "mape") for s in ("mean", "std")],
        "feature_importance", "n_folds", "n_features", "n_train_campaigns", "error", "n_rows",
    ]
    return joined.groupBy("target", "group_col", "dataset_size", "n_campaigns").agg(
        F.map_from_entries(F.collect_list(F.struct("model_name", F.struct(*fields)))).alias("models"),
    )


def benchmark_rows(results: DataFrame, run_timestamp: datetime | None = None) -> DataFrame:
    """One row per model that ran, from nested results."""
    stamp = F.lit(run_timestamp) if run_timestamp else F.col("run_timestamp")
    rows = results.select(
        stamp.alias("run_timestamp"),
        F.coalesce("target", F.lit("engagement_rate")).alias("target_metric"),
        F.explode("models").alias("model_name", "m"),
    ).where("m.error is null")
    return rows.select(
        "run_timestamp",
        "target_metric",
        "model_name",
        # An undefined metric stays undefined: 0 would be a perfect error.
        *[F.col(f"m.{x}_mean").alias(x) for x in ("mae", "rmse", "r2", "mape")],
        F.coalesce("m.n_features", F.lit(0)).alias("n_features"),
    )


def importance_rows(results: DataFrame, run_timestamp: datetime | None = None) -> DataFrame:
    """One row per model and feature, with the feature's category."""
    stamp = F.lit(run_timestamp) if run_timestamp else F.col("run_timestamp")
    rows = results.select(
        stamp.alias("run_timestamp"), F.explode("models").alias("model_name", "m")
    ).where("m.error is null")
    return rows.select(
        "run_timestamp",
        "model_name",
        F.explode("m.feature_importance").alias("feature_name", "importance_score"),
    ).withColumn("category", feature_category(F.col("feature_name")))


def train_final(
    matrix: DataFrame,
    path: str,
    targets: Sequence[str] = ("engagement_rate", "click_through_rate"),
    fit: Callable[..., Model] = fit_boosted,
    **settings,
) -> dict[str, Model]:
    """Multimodal models on all rows with their own target, fitted at the same time, saved below ``path``."""
    features = feature_sets(matrix.columns)["multimodal"]
    wanted = [t for t in targets if t in matrix.columns]
    if not wanted:
        return {}
    fits = [lambda target=target: fit(matrix, features, target, **settings) for target in wanted]
    models = dict(zip(wanted, together(matrix.sparkSession, *fits)))
    for target, model in models.items():
        if isinstance(model, BoostedModel):
            model.save(f"{path}/{target}")
        else:
            model.write().overwrite().save(f"{path}/{target}")
    return models


def load_models(spark: SparkSession, path: str) -> dict[str, Model]:
    """The saved models that exist."""
    models = {}
    for target in ("engagement_rate", "click_through_rate"):
        if file_exists(spark, f"{path}/{target}/nodes"):
            models[target] = BoostedModel.load(spark, f"{path}/{target}")
        elif file_exists(spark, f"{path}/{target}"):
            models[target] = PipelineModel.load(f"{path}/{target}")
    return models
