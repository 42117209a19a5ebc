"""Image features: handcrafted measures, network embeddings, scale and PCA."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.functions.images import FALLBACK, image_measures, network
from lumetric.operators.rows import lookup_join
from lumetric.sources.schemas import HANDCRAFTED

PCA_PREFIX = "vision_pca_"
PCA_SIZE = 32


def handcrafted(images: DataFrame) -> DataFrame:
    """The measures per decoded image; unreadable images get the fallback record."""
    measured = images.select(
        "filename", image_measures("height", "width", "n_channels", "data").alias("m")
    )
    return measured.select("filename", "m.*")


def embed(
    images: DataFrame,
    make_predict_fn: Callable,
    side: int = 224,
    batch_size: int = 16,
) -> DataFrame:
    """(filename, embedding) by a model of the caller's choice.

    ``make_predict_fn`` loads the model once per Python worker and returns a
    function from a (batch, 3, side, side) array to a (batch, d) array. Tensors
    are made and used in one step, ``batch_size`` at a time.
    """
    model = network(make_predict_fn, side, batch_size)
    return images.select("filename", model("height", "width", "n_channels", "data").alias("embedding"))


def measured_and_embedded(
    images: DataFrame, make_predict_fn: Callable, side: int = 224, batch_size: int = 16
) -> DataFrame:
    """The measures and the embedding of each image from one pass over the files."""
    model = network(make_predict_fn, side, batch_size)
    pixels = ("height", "width", "n_channels", "data")
    return images.select(
        "filename", image_measures(*pixels).alias("m"), model(*pixels).alias("embedding")
    ).select("filename", "m.*", "embedding")


def population_scaler(n: int, size: int, input_col: str, output_col: str) -> list:
    """Centre and divide by the population deviation (the scaler alone uses the sample's)."""
    factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
    return [
        StandardScaler(withMean=True, withStd=True, inputCol=input_col, outputCol="_centred"),
        ElementwiseProduct(
            scalingVec=Vectors.dense([factor] * size), inputCol="_centred", outputCol=output_col
        ),
    ]


def fit_pca(embeddings: DataFrame, k: int = PCA_SIZE, column: str = "embedding") -> PipelineModel:
    """Scale and PCA to at most ``k``, n - 1 or d dimensions.

    The sign of each component is fixed so that its largest loading is positive.
    """
    rows = embeddings.select(array_to_vector(F.col(column).cast("array<double>")).alias("_vector"))
    n, size = embeddings.agg(F.count("*"), F.max(F.size(column))).first()
    stages = population_scaler(n, size, "_vector", "_scaled")
    stages.append(PCA(k=max(1, min(k, n - 1, size)), inputCol="_scaled", outputCol="_raw_pca"))
    fitted = Pipeline(stages=stages).fit(rows)
    loadings = fitted.stages[-1].pc.toArray()
    signs = [1.0 if col[abs(col).argmax()] >= 0 else -1.0 for col in loadings.T]
    flip = ElementwiseProduct(
        scalingVec=Vectors.dense(signs), inputCol="_raw_pca", outputCol="_pca"
    )
    return PipelineModel(stages=[*fitted.stages, flip])


def explained_variance(model: PipelineModel) -> list[float]:
    return list(next(s for s in model.stages if hasattr(s, "explainedVariance")).explainedVariance)


def project(embeddings: DataFrame, model: Transformer, column: str = "embedding") -> DataFrame:
    """Replace the embedding by columns ``vision_pca_0 ...``."""
    size = len(explained_variance(model))
    vectors = embeddings.withColumn(
        "_vector", array_to_vector(F.col(column).cast("array<double>"))
    )
    reduced = model.transform(vectors).withColumn("_pca", vector_to_array("_pca"))
    keep = [c for c in embeddings.columns if c != column]
    return reduced.select(*keep, *[F.col("_pca")[i].alias(f"{PCA_PREFIX}{i}") for i in range(size)])


def vision_features(
    registry: DataFrame,
    images: DataFrame | None = None,
    components: DataFrame | None = None,
    measures: DataFrame | None = None,
) -> DataFrame:
    """One row per registered file: registry, measures of its image and PCA columns.

    Everything is matched by filename. Without an embedding model the PCA
    columns are zero, so later stages see the same schema.
    """
    rows = registry.select("filename", "slug", "request_id", "placement_type", "file_size_kb")
    rows = lookup_join(rows, handcrafted(images) if measures is None else measures, "filename")
    defaults = dict.fromkeys(HANDCRAFTED, 0.0) | FALLBACK
    rows = rows.withColumns({c: F.coalesce(c, F.lit(defaults[c])) for c in HANDCRAFTED})
    if components is None:
        return rows.withColumns({f"{PCA_PREFIX}{i}": F.lit(0.0) for i in range(PCA_SIZE)})
    return lookup_join(rows, components, "filename")
