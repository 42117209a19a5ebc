"""Inputs that used to be lost or mixed up without a word."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumetric.functions import numbers
from lumetric.operators import quantiles
from lumetric.operators.rows import lookup_join
from lumetric.plans import jobs, models, scoring
from lumetric.plans.features import Fitted, feature_matrix
from lumetric.session import file_exists, settle, shared_folder
from tests.conftest import solid


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[1] for r in df.select("i", f(F.col("c"))).orderBy("i").collect()]


def test_numbers_without_java_suffixes(spark):
    texts = ["1.5d", "2f", "0x1p3", "1e3", "-.5", " 7 ", "1.5 D", "inf", "3.", "1,000"]
    assert column(spark, texts, numbers.number) == [None, None, None, 1000.0, -0.5, 7.0, None, np.inf, 3.0, None]


@pytest.mark.parametrize(
    "text, day_first, wanted",
    [
        ("1/2/24", True, (2024, 2, 1)), ("1/2/24", False, (2024, 1, 2)), ("01.02.1999", True, (1999, 2, 1)),
        ("31/12/68", True, (2068, 12, 31)), ("31/12/69", True, (1969, 12, 31)), ("1 Jan 2024", True, (2024, 1, 1)),
        ("2024/01/02", True, (2024, 1, 2)), ("2024.1.2", False, (2024, 1, 2)), ("2024-01-02", True, (2024, 1, 2)),
        ("March 5, 2021", True, (2021, 3, 5)), ("5-Sep-21", True, (2021, 9, 5)), ("3rd sept. 2020", True, (2020, 9, 3)),
        ("Dec 31st 2020 23:59", True, (2020, 12, 31, 23, 59)), ("1/2/2024 3:04:05", True, (2024, 2, 1, 3, 4, 5)),
        ("1/2/2024 3:04", False, (2024, 1, 2, 3, 4)), ("2024-01-02T03:04:05", True, (2024, 1, 2, 3, 4, 5)),
        ("31/2/2024", True, None), ("Mayor 5 2020", True, None), ("1/2", True, None), ("soon", True, None), ("", True, None),
    ],
)
def test_dates_of_many_shapes(spark, text, day_first, wanted):
    found = column(spark, [text], lambda c: numbers.date_text(c, day_first))[0]
    assert found == (dt.datetime(*wanted) if wanted else None)


@pytest.mark.parametrize(
    "left, right", [("int", "bigint"), ("bigint", "string"), ("string", "int"), ("int", "double"), ("string", "string")]
)
def test_keys_of_unlike_types_meet(spark, left, right):
    a = spark.range(6).select(F.when(F.col("id") < 4, F.col("id")).cast(left).alias("k"), F.col("id").alias("x"))
    b = spark.range(2, 9).select(F.col("id").cast(right).alias("k"), (F.col("id") * 10).alias("y"))
    joined = lookup_join(a, b, "k")
    assert dict(joined.dtypes)["k"] == dict(a.dtypes)["k"] and joined.columns == ["k", "x", "y"]
    assert {r["x"]: r["y"] for r in joined.collect()} == {0: None, 1: None, 2: 20, 3: 30, 4: None, 5: None}


@pytest.fixture
def narrow(monkeypatch):
    """So few values for the last pass that small data take several."""
    monkeypatch.setattr(quantiles, "LAST", 30)


SHAPES = {
    "uniform": lambda rng, n: [rng.random() for _ in range(n)],
    "skewed": lambda rng, n: [rng.lognormvariate(0, 6) for _ in range(n)],
    "repeated": lambda rng, n: [rng.choice([0.0, 0.0, 1.0, rng.random()]) for _ in range(n)],
    "halves": lambda rng, n: [float(i % 2) for i in range(n)],
    "spike": lambda rng, n: [5.0] * (n - 400) + [rng.random() * 10 for _ in range(400)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles_of_large_groups_narrow_to_the_rank(spark, narrow, shape):
    rng = random.Random(shape)
    groups = {"big": SHAPES[shape](rng, 20_001), "even": SHAPES[shape](rng, 5000), "small": SHAPES[shape](rng, 401)[:7], None: [2.5]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    found = quantiles.exact_quantiles(df, "g", "v", [0.0, 0.25, 0.5, 0.99, 1.0]).collect()
    assert len(found) == 5 * len(groups)
    for r in found:
        assert r["quantile"] == pytest.approx(np.quantile(groups[r["g"]], r["prob"]), rel=1e-12), (r["g"], r["prob"])


def test_medians_of_many_columns_in_wide_form(spark, narrow):
    rng = random.Random(5)
    data = {name: f(rng, 3000) for name, f in SHAPES.items()}
    rows = [tuple(data[name][i] if (i + j) % 7 else None for j, name in enumerate(data)) for i in range(3000)]
    df = spark.createDataFrame(rows, ", ".join(f"{name} double" for name in data)).withColumn("none", F.lit(None).cast("double"))
    found = quantiles.medians(df, [*data, "none"])
    for j, name in enumerate(data):
        assert found[name] == pytest.approx(np.median([r[j] for r in rows if r[j] is not None]), rel=1e-12), name
    assert found["none"] == 0.0
    assert quantiles.medians(df.limit(0), ["uniform"]) == {"uniform": 0.0}


def test_two_linear_models_and_failed_images(spark):
    rows = spark.range(60).select(
        (F.col("id") % 7).alias("has_video"), (F.col("id") / 60.0).alias("brightness_mean"),
        (F.col("id") / 100.0).alias("engagement_rate"), (F.col("id") / 200.0).alias("click_through_rate"),
    )
    fitted = {t: models.fit_ridge(rows, ["has_video", "brightness_mean"], t) for t in ("engagement_rate", "click_through_rate")}
    images = spark.createDataFrame([("ok.png", 0.9, 10.0), ("broken.png", 0.5, 0.0)], "filename string, brightness_mean double, image_width double")
    contexts = spark.createDataFrame([(1, "ok.png"), (2, "broken.png"), (3, "gone.png"), (4, None)], "id int, image_filename string")
    found = {r["id"]: r for r in scoring.score(contexts, fitted, vision=images).collect()}
    assert found[1]["vision_features_used"] and found[1]["confidence_note"] == scoring.NOTE_VISION
    failed = scoring.NOTE_FAILED.format("no readable image")
    assert [found[i]["confidence_note"] for i in (2, 3, 4)] == [failed, failed, scoring.NOTE_TABULAR]
    assert found[2]["engagement_rate_predicted"] == found[4]["engagement_rate_predicted"] < found[1]["engagement_rate_predicted"]
    assert found[1]["click_through_rate_predicted"] == pytest.approx(found[1]["engagement_rate_predicted"] / 2, rel=0.05)


def test_undefined_metrics_stay_undefined(spark):
    kinds = "target string, run_timestamp timestamp, models map<string, struct<mae_mean double, rmse_mean double, r2_mean double, mape_mean double, n_features long, error string>>"
    df = spark.createDataFrame([("t", dt.datetime(2024, 1, 1), {"m": (1.0, 2.0, 0.5, None, 3, None)})], kinds)
    row = models.benchmark_rows(df).first()
    assert (row["mae"], row["mape"]) == (1.0, None)


def test_new_images_by_saved_artifacts(spark, tmp_path):
    def network():
        return lambda batch: batch.reshape(len(batch), -1)[:, ::9000].copy()

    old, new, out = (tmp_path / n for n in ("old", "new", "out"))
    for folder, n in ((old, 12), (new, 3)):
        folder.mkdir()
        for i in range(n):
            (folder / f"s{i}-mob-{i:020d}.png").write_bytes(solid((17 * i % 256, 40, 200 - 9 * i), 9 + i, 7))
    (new / "junk.png").write_bytes(b"no image")
    images = jobs.vision_stage(spark, str(old), str(out), network)
    rows = images.select(
        F.col("filename").alias("image_filename"), F.lit("c").alias("campaign_id"), F.lit("phone").alias("device_type"),
        F.lit("ios").alias("platform_os"), F.lit("PT").alias("geo_country"), F.lit("up").alias("interaction_direction"),
        F.col("brightness_mean").alias("engagement_rate"), F.col("colorfulness").alias("click_through_rate"),
    )
    matrix, fitted = feature_matrix(rows, images)
    fitted.save(f"{out}/models/fitted")
    trained = models.train_final(matrix, f"{out}/models", fit=models.fit_ridge)
    assert Fitted.load(spark, f"{out}/models/fitted").fills == fitted.fills
    names = [f"s{i}-mob-{i:020d}.png" for i in range(3)] + ["junk.png", None]
    contexts = spark.createDataFrame([(i, n, "phone") for i, n in enumerate(names)], "id int, image_filename string, device_type string")
    found = jobs.score_images(spark, contexts, str(new), str(out), network).orderBy("id").collect()
    assert [r["vision_features_used"] for r in found] == [True] * 3 + [False] * 2
    assert "failed" in found[3]["confidence_note"] and "no image" in found[4]["confidence_note"]
    # The same pictures as before get the same components, so the same scores.
    again = {r["image_filename"]: r["prediction"] for r in trained["engagement_rate"].transform(matrix).collect()}
    for r in found[:3]:
        assert r["engagement_rate_predicted"] == pytest.approx(min(1.0, max(0.0, again[r["image_filename"]])), abs=1e-9)


def test_scratch_stands_in_the_shared_folder(spark):
    kept = settle(spark.range(3), "kept")
    assert kept.count() == 3 and file_exists(spark, f"{shared_folder(spark)}/lumetric")
