"""Image measures over Arrow batches. Spark decodes and distributes; numpy measures."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.model_cache import ModelCache
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from lumetric.sources.schemas import HANDCRAFTED

# Luminance weights, grey weights in 1/65536, flag limits, fallback record.
LUMINANCE = (0.2126, 0.7152, 0.0722)
GREY = (19595, 38470, 7471)
DARK_BELOW, LIGHT_ABOVE = 0.3, 0.7
FALLBACK = {"aspect_ratio": 1.0, "brightness_mean": 0.5}

# Channel means and deviations of the usual network input.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


def rgb_pixels(height: int, width: int, channels: int, data: bytes) -> np.ndarray | None:
    """(height, width, 3) RGB bytes of an image row stored as grey, BGR or BGRA."""
    if data is None or height is None or height <= 0 or width <= 0:
        return None
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    return pixels[:, :, 2::-1]


def _cubic(x: np.ndarray) -> np.ndarray:
    x = np.abs(x)
    near = 1.5 * x**3 - 2.5 * x**2 + 1
    far = -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


def _linear(x: np.ndarray) -> np.ndarray:
    return np.clip(1 - np.abs(x), 0, None)


def resample_weights(size: int, target: int, kernel=_cubic, reach: float = 2.0) -> np.ndarray:
    """(target, size) weights of a resize whose kernel widens when shrinking."""
    scale = size / target
    wide = max(scale, 1.0)
    centre = (np.arange(target) + 0.5) * scale
    first = np.clip((centre - reach * wide + 0.5).astype(int), 0, None)
    end = np.clip((centre + reach * wide + 0.5).astype(int), None, size)
    at = np.arange(size)
    weights = kernel((at[None, :] - centre[:, None] + 0.5) / wide)
    weights[(at[None, :] < first[:, None]) | (at[None, :] >= end[:, None])] = 0.0
    return weights / weights.sum(axis=1, keepdims=True)


def _bytes(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values + 0.5), 0, 255).astype(np.uint8)


def resize(pixels: np.ndarray, target: int, kernel=_cubic, reach: float = 2.0) -> np.ndarray:
    """Square resize: rows, then columns, each rounded back to bytes."""
    height, width, _ = pixels.shape
    if width != target:
        across = resample_weights(width, target, kernel, reach)
        pixels = _bytes(np.tensordot(pixels, across, axes=(1, 1)).swapaxes(1, 2))
    if height != target:
        down = resample_weights(height, target, kernel, reach)
        pixels = _bytes(np.tensordot(down, pixels, axes=(1, 0)))
    return pixels


def measure(pixels: np.ndarray | None) -> dict[str, float]:
    """The handcrafted measures of one image, or the fallback record."""
    if pixels is None:
        return dict.fromkeys(HANDCRAFTED, 0.0) | FALLBACK
    height, width, _ = pixels.shape
    r, g, b = np.moveaxis(pixels.astype(np.float64) / 255.0, 2, 0)
    brightness = float(np.dot([r.mean(), g.mean(), b.mean()], LUMINANCE))

    top = np.maximum(np.maximum(r, g), b)
    span = top - np.minimum(np.minimum(r, g), b)
    saturation = np.divide(span, top, out=np.zeros_like(top), where=top > 0)

    red_green, yellow_blue = r - g, 0.5 * (r + g) - b
    colorfulness = np.hypot(red_green.std(), yellow_blue.std()) + 0.3 * np.hypot(
        red_green.mean(), yellow_blue.mean()
    )

    grey = (pixels.astype(np.int64) @ np.array(GREY) + 32768) >> 16
    share = np.bincount(grey.ravel(), minlength=256) / (grey.size + 1e-9)
    entropy = -float(np.sum(share * np.log2(share + 1e-9)))

    level = np.minimum((resize(pixels, 64).astype(np.float32) / np.float32(255) * 4).astype(int), 3)
    buckets = np.unique(level @ np.array([16, 4, 1])).size
    return {
        "aspect_ratio": width / height,
        "image_width": float(width),
        "image_height": float(height),
        "brightness_mean": brightness,
        "saturation_mean": float(saturation.mean()),
        "colorfulness": float(colorfulness),
        "visual_entropy": entropy,
        "color_diversity_score": buckets / 64.0,
        "is_dark_background": float(brightness < DARK_BELOW),
        "is_light_background": float(brightness > LIGHT_ABOVE),
    }


@F.pandas_udf(StructType([StructField(c, DoubleType()) for c in HANDCRAFTED]))
def image_measures(
    height: pd.Series, width: pd.Series, n_channels: pd.Series, data: pd.Series
) -> pd.DataFrame:
    rows = [measure(rgb_pixels(*row)) for row in zip(height, width, n_channels, data)]
    return pd.DataFrame(rows, columns=list(HANDCRAFTED))


def network_input(pixels: np.ndarray | None, side: int = 224) -> np.ndarray:
    """The normalised (3, side, side) tensor of one image; zeros for an unreadable one."""
    if pixels is None:
        return np.zeros((3, side, side), np.float32)
    small = resize(pixels, side, _linear, 1.0) / 255.0
    scaled = (small - np.array(CHANNEL_MEAN)) / np.array(CHANNEL_STD)
    return np.moveaxis(scaled, 2, 0).astype(np.float32, order="C")


def network(make_predict_fn: Callable, side: int = 224, batch_size: int = 16) -> Callable[..., Column]:
    """A function of (height, width, n_channels, data) giving the model's vector.

    Tensors are far larger than small images, so they never leave the worker and
    only those of ``batch_size`` images exist at a time. The model is loaded once
    per Python worker.
    """
    key = uuid.uuid4()

    @F.pandas_udf(ArrayType(FloatType()))
    def embedding(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        predict = ModelCache.get(key)
        if predict is None:
            predict = make_predict_fn()
            ModelCache.add(key, predict)
        for columns in batches:
            found: list[np.ndarray] = []
            for start in range(0, len(columns[0]), batch_size):
                few = zip(*(c.iloc[start : start + batch_size] for c in columns))
                tensors = np.stack([network_input(rgb_pixels(*row), side) for row in few])
                vectors = np.asarray(predict(tensors), np.float32)
                if vectors.ndim != 2 or len(vectors) != len(tensors):
                    raise ValueError(f"a model of {len(tensors)} images gave an array of shape {vectors.shape}")
                found.extend(vectors)
            yield pd.Series(found, dtype=object)

    return embedding
