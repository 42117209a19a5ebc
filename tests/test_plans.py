import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lumetric.functions.images import CHANNEL_MEAN, CHANNEL_STD, measure, resize, rgb_pixels
from lumetric.plans import features, linked, models, reports, scoring, vision
from lumetric.sources import readers, schemas
from tests.conftest import png, solid

QUICK = {"rounds": 2, "max_depth": 2, "max_bins": 8}


# --- images -----------------------------------------------------------------


@pytest.fixture(scope="module")
def measured(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("images")
    pictures = {
        "red": solid((255, 0, 0), 90, 90),
        "dark": solid((21, 22, 20), 120, 75),
        "white": solid((250, 251, 252), 70, 70),
        "tall": solid((90, 91, 92), 60, 144),
        "alpha": solid((0, 0, 255, 7), 20, 10),
        "grey": solid(200, 16, 16),
        "halves": png([[(255, 0, 0)] * 32 + [(0, 255, 0)] * 32] * 64),
        "broken": b"junk",
    }
    for name, data in pictures.items():
        (folder / f"{name}.png").write_bytes(data)
    images = readers.load_images(spark, str(folder))
    found = vision.handcrafted(images).collect()
    return {r["filename"].removesuffix(".png"): r.asDict() for r in found}, str(folder)


def test_shapes_and_flags(measured):
    found, _ = measured
    assert found["red"]["aspect_ratio"] == 1.0
    assert found["tall"]["aspect_ratio"] == pytest.approx(60 / 144)
    assert (found["dark"]["is_dark_background"], found["dark"]["is_light_background"]) == (1.0, 0.0)
    assert found["white"]["is_light_background"] == 1.0
    for name, record in found.items():
        assert set(schemas.HANDCRAFTED) < set(record)
        assert all(isinstance(record[c], float) for c in schemas.HANDCRAFTED), name
        assert 0 <= record["brightness_mean"] <= 1 and 0 <= record["saturation_mean"] <= 1
        assert record["visual_entropy"] >= -1e-6


def test_measures_of_known_pictures(measured):
    found, _ = measured
    assert found["red"]["brightness_mean"] == pytest.approx(0.2126)
    assert found["red"]["saturation_mean"] == 1.0
    assert found["alpha"]["brightness_mean"] == pytest.approx(0.0722)  # BGRA order, alpha dropped
    assert found["grey"]["saturation_mean"] == 0.0
    assert found["red"]["color_diversity_score"] == 1 / 64
    assert found["halves"]["visual_entropy"] == pytest.approx(1.0, abs=1e-6)
    assert found["halves"]["color_diversity_score"] == 2 / 64
    assert found["halves"]["colorfulness"] == pytest.approx(1.0 + 0.3 * 0.5)


def test_unreadable_image_gets_the_fallback(measured):
    broken = measured[0]["broken"]
    assert (broken["aspect_ratio"], broken["brightness_mean"]) == (1.0, 0.5)
    assert sum(broken[c] for c in schemas.HANDCRAFTED) == 1.5


def test_resize_keeps_flat_areas_and_means():
    rng = np.random.default_rng(1)
    flat = np.full((50, 90, 3), 77, np.uint8)
    assert (resize(flat, 64) == 77).all()
    noisy = rng.integers(0, 256, (200, 130, 3)).astype(np.uint8)
    assert resize(noisy, 64).shape == (64, 64, 3)
    assert abs(resize(noisy, 64).mean() - noisy.mean()) < 1
    assert rgb_pixels(0, 5, 3, b"") is None and measure(None)["aspect_ratio"] == 1.0


def test_embeddings_by_a_given_model(spark, measured):
    def make():
        return lambda batch: batch.reshape(len(batch), 3, -1).mean(axis=2)

    images = readers.load_images(spark, measured[1])
    found = {r["filename"]: r["embedding"] for r in vision.embed(images, make, side=8).collect()}
    assert found["broken.png"] == [0, 0, 0]
    wanted = [(1 - 0.485) / 0.229, -0.456 / 0.224, -0.406 / 0.225]
    assert found["red.png"] == pytest.approx(wanted, rel=1e-5)


def test_tensors_of_few_images_exist_at_a_time(spark):
    def make():
        def predict(batch):
            assert batch.flags.c_contiguous and batch.dtype == np.float32
            return np.c_[batch[:, :, 0, 0], np.full(len(batch), len(batch))]

        return predict

    images = spark.range(0, 37, 1, 1).selectExpr(
        "concat(id, '.png') as filename", "1 as height", "1 as width", "3 as n_channels",
        "case when id = 5 then null else unhex(repeat(lpad(hex(id), 2, '0'), 3)) end as data",
    )
    for found in (vision.embed(images, make, 8), vision.measured_and_embedded(images, make, 8)):
        rows = {r["filename"]: r["embedding"] for r in found.collect()}
        for i in range(37):
            wanted = [0, 0, 0] if i == 5 else [(i / 255 - m) / s for m, s in zip(CHANNEL_MEAN, CHANNEL_STD)]
            assert rows[f"{i}.png"][:3] == pytest.approx(wanted, rel=1e-5)
        assert sorted(r[3] for r in rows.values()) == [5] * 5 + [16] * 32
        # The pixels go to the workers, the vectors come back: no tensor is a column on the way.
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and "tensor" not in plan


def test_pca_matches_population_scaling(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 6))
    x[:, 5] = 3.0  # no variance
    df = spark.createDataFrame([(str(i), [float(v) for v in row]) for i, row in enumerate(x)],
                               "filename string, embedding array<double>")
    vision.fit_pca(df, k=4).write().save(str(tmp_path / "pca"))
    model = PipelineModel.load(str(tmp_path / "pca"))
    found = vision.project(df, model).toPandas().set_index("filename")
    std = x.std(axis=0)
    z = np.where(std > 1e-9, (x - x.mean(axis=0)) / np.where(std > 1e-9, std, 1), 0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    vt *= np.sign(vt[np.arange(len(vt)), np.abs(vt).argmax(axis=1)])[:, None]
    wanted = z @ vt[:4].T
    got = found.loc[[str(i) for i in range(40)], [f"vision_pca_{i}" for i in range(4)]].to_numpy()
    assert np.allclose(got, wanted, atol=1e-8)
    assert np.allclose(vision.explained_variance(model), (s**2 / (s**2).sum())[:4])


def test_vision_table(spark, measured):
    folder = measured[1]
    registry, images = readers.list_images(spark, folder), readers.load_images(spark, folder)
    table = vision.vision_features(registry, images)
    assert table.count() == 8 and "vision_pca_31" in table.columns
    assert table.where("filename = 'broken.png' and vision_pca_3 = 0 and brightness_mean = 0.5").count() == 1


# --- features ---------------------------------------------------------------


@pytest.fixture(scope="module")
def rows_in(spark):
    rng = np.random.default_rng(9)
    data = []
    for i in range(240):
        device = str(rng.choice(["phone", "tablet"]))
        data.append((
            f"c{i % 12}", f"k{i}/r", device, "ios" if i % 2 else None, "USA", None if i % 5 == 0 else "up",
            f"f{i % 20}.png", 0.3 * (device == "phone") + 0.01 * float(rng.random()), 0.05,
            i % 2, None if i % 3 == 0 else float(i), None, float(i % 4),
        ))
    return spark.createDataFrame(
        data,
        "campaign_id string, game_key string, device_type string, platform_os string, geo_country string, "
        "interaction_direction string, image_filename string, engagement_rate double, "
        "click_through_rate double, has_video int, buy_rate_cpe double, volume_agreed double, "
        "aspect_ratio double",
    )


@pytest.fixture(scope="module")
def pictures(spark):
    return spark.createDataFrame(
        [(f"f{i}.png", "s", "r", 9.0, 0.1 * i, float(i), 0.5, 0.25) for i in [*range(10), 3]],
        "filename string, slug string, request_id string, aspect_ratio double, brightness_mean double, "
        "vision_pca_10 double, vision_pca_2 double, file_size_kb double",
    )


@pytest.fixture(scope="module")
def matrix(rows_in, pictures):
    return features.feature_matrix(rows_in, pictures)


def test_feature_lists(matrix):
    sets = features.feature_sets(matrix[0].columns)
    assert sets["tabular"] == [
        "device_type_enc", "platform_os_enc", "geo_country_enc", "interaction_direction_enc",
        "has_video", "aspect_ratio", "buy_rate_cpe", "volume_agreed",
    ]
    assert sets["vision"] == ["brightness_mean", "file_size_kb", "vision_pca_10", "vision_pca_2"]
    assert sets["multimodal"] == sets["tabular"] + sets["vision"]


def test_matrix_is_complete_and_does_not_fan_out(matrix, rows_in):
    df, fitted = matrix
    assert df.count() == 240 and "slug" not in df.columns
    assert df.agg(F.max("aspect_ratio")).first()[0] == 3.0  # the design's, not the image's
    chosen = features.feature_sets(df.columns)["multimodal"]
    assert df.dropna(subset=chosen).count() == 240
    assert fitted.fills["volume_agreed"] == 0.0  # no values at all
    wanted = np.median([r[0] for r in rows_in.select("buy_rate_cpe").collect() if r[0] is not None])
    assert fitted.fills["buy_rate_cpe"] == wanted


def test_fitted_parts_round_trip(spark, matrix, rows_in, tmp_path):
    matrix[1].save(str(tmp_path))
    loaded = features.Fitted.load(spark, str(tmp_path))
    assert loaded.fills == matrix[1].fills
    new = rows_in.withColumn("device_type", F.lit("watch"))
    df, _ = features.feature_matrix(new, None, loaded)
    assert {r[0] for r in df.select("device_type").collect()} == {"unknown"}
    assert {r[0] for r in df.select("device_type_enc").collect()} == {2}
    assert df.where("buy_rate_cpe = 0").count() == 80  # 0, not the median, when applied


def test_profile(matrix):
    found = features.feature_profile(matrix[0]).first()
    assert (found["n_rows"], found["n_campaigns"]) == (240, 12)


# --- models -----------------------------------------------------------------


def test_ridge_matches_the_closed_form(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3)) * [1, 10, 100]
    y = x @ [1.0, 0.2, -0.01] + rng.normal(size=60) + 5
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    model = models.fit_ridge(df, ["a", "b", "c"], "y", alpha=7.0)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    weights = np.linalg.solve(z.T @ z + 7.0 * np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose(model.stages[-1].coefficients.toArray(), weights)
    assert [n for n, _ in models.importances(model, ["a", "b", "c"])] == [
        "abc"[i] for i in np.argsort(-np.abs(weights))
    ]
    assert models.importances(model, ["a"]) == []


def test_baseline_predicts_the_other_folds(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 6.0), (2, 9.0)], "fold int, y double")
    found = {r["fold"]: r["prediction"] for r in models.baseline_predictions(df, "y").collect()}
    assert found == pytest.approx({0: 7.5, 1: 4.0, 2: 3.0})


@pytest.fixture(scope="module")
def compared(matrix):
    benchmarks, scores = models.compare_models(matrix[0], n_splits=3, parallelism=3, **QUICK)
    return benchmarks.cache(), scores.cache()


def test_comparison(compared):
    benchmarks = {r["model_name"]: r for r in compared[0].collect()}
    assert sorted(benchmarks) == ["baseline", "multimodal", "tabular", "vision"]
    assert all(r["n_folds"] == 3 and r["error"] is None for r in benchmarks.values())
    assert [benchmarks[m]["n_features"] for m in ("baseline", "tabular", "vision", "multimodal")] == [1, 8, 4, 12]
    assert benchmarks["tabular"]["mae_mean"] < benchmarks["baseline"]["mae_mean"]
    assert benchmarks["tabular"]["n_train_campaigns"] == 12
    scores = {r["feature_name"]: r for r in compared[1].where("model_name = 'multimodal'").collect()}
    assert len(scores) == 12 and scores["device_type_enc"]["importance_score"] >= 1
    assert scores["device_type_enc"]["category"] == "Contextual"
    assert scores["vision_pca_2"]["category"] == "Visual"


def test_results_round_trip(spark, compared, tmp_path):
    document = models.results_document(*compared)
    document.write.json(str(tmp_path / "results"))
    loaded = readers.load_results(spark, str(tmp_path / "results"))
    first = loaded.first()
    assert (first["target"], first["dataset_size"], first["n_campaigns"]) == ("engagement_rate", 240, 12)
    stamp = dt.datetime(2024, 5, 1)
    rows = models.benchmark_rows(loaded, stamp)
    assert rows.count() == 4 and rows.first()["run_timestamp"] == stamp
    assert models.importance_rows(loaded, stamp).count() == compared[1].count()


def test_leak_free_comparison_learns_within_folds(rows_in):
    found, _ = models.compare_models(
        rows_in, n_splits=2, models=("baseline", "tabular"), leak_free=True, **QUICK
    )
    benchmarks = {r["model_name"]: r for r in found.collect()}
    assert benchmarks["tabular"]["n_features"] == 8
    assert benchmarks["tabular"]["mae_mean"] < benchmarks["baseline"]["mae_mean"]


def test_too_few_rows_and_no_features(spark, matrix):
    few, _ = models.compare_models(matrix[0].limit(9), n_splits=5, **QUICK)
    assert {r["error"] for r in few.collect()} == {"insufficient_data"}
    bare = matrix[0].select("campaign_id", "engagement_rate", "has_video")
    found, _ = models.compare_models(bare, n_splits=3, models=("baseline", "vision"), **QUICK)
    errors = {r["model_name"]: r["error"] for r in found.collect()}
    assert errors == {"baseline": None, "vision": "no_features"}


# --- scores -----------------------------------------------------------------


def test_scoring_with_saved_models(spark, matrix, pictures, tmp_path):
    models.train_final(matrix[0], str(tmp_path), **QUICK)
    loaded = models.load_models(spark, str(tmp_path))
    assert sorted(loaded) == ["click_through_rate", "engagement_rate"]
    names = models.inputs_of(loaded["engagement_rate"])
    gains = models.importances(loaded["engagement_rate"], names, kind="gain")
    assert gains[0][0] == "device_type_enc" and sum(g for _, g in gains) == pytest.approx(1)
    contexts = spark.createDataFrame(
        [(1, "phone", "f1.png"), (2, "tablet", "f99.png"), (3, "watch", None)],
        "id int, device_type string, image_filename string",
    )
    found = {r["id"]: r for r in scoring.score(contexts, loaded, matrix[1].encoders, pictures).collect()}
    assert found[1]["engagement_rate_predicted"] > found[2]["engagement_rate_predicted"]
    assert found[1]["vision_features_used"] and not found[2]["vision_features_used"]
    assert found[3]["device_type"] == "watch"
    assert all(0 <= r["engagement_rate_predicted"] <= 1 for r in found.values())
    only = scoring.score(contexts, {"engagement_rate": loaded["engagement_rate"]}).collect()
    assert all(r["click_through_rate_predicted"] == r["engagement_rate_predicted"] * 0.1 for r in only)
    assert models.load_models(spark, str(tmp_path / "none")) == {}
    assert scoring.score(contexts, {}).first()["confidence_note"] == scoring.NOTE_NO_MODEL


def test_rule_score(spark):
    df = spark.createDataFrame(
        [("smartphone", "iOS", "USA", 0.1, 60.0, 50.0, 50.0, True), ("x", "x", "x", 2.0, 0.0, 0.0, 0.0, False)],
        "device string, os string, region string, cpe double, brightness double, saturation double, "
        "colorfulness double, has_video boolean",
    )
    top, low = scoring.rule_score(df).collect()
    rate = 0.12 * 1.15 * 1.08 * 1.10 * (1 - 0.1 * 0.3) * (0.8 + 0.24) * (0.85 + 0.15) * (0.9 + 0.1) * 1.12
    assert (top["er_percent"], top["ctr_percent"]) == (round(rate * 100, 1), round(rate * 45, 1))
    assert (top["tier"], low["tier"], low["tier_label"]) == ("top", "low", "🔴 Low")


# --- linked data and reports ------------------------------------------------


def test_linked_rows_fan_out_over_design_keys(spark):
    kpi = spark.createDataFrame(
        [("c1", "s/r1", "s", "r1", 1.0), ("c2", "s/r2", "s", "r2", 0.5)],
        "campaign_id string, game_key string, creative_slug string, creative_request_id string, engagement_rate double",
    )
    design = spark.createDataFrame(
        [("m1", "r1", 3), ("m2", "r1", 4), ("m3", None, 5)], "game_key string, request_id string, color_diversity int"
    )
    briefing = spark.sql(
        "select 'c1' campaign_id, timestamp_ntz'2024-01-05' startdate, timestamp_ntz'2024-01-01' enddate, 'x' other"
    )
    found = linked.linked_from_files(kpi, design, briefing)
    assert "other" not in found.columns
    rows = {(r["campaign_id"], r["design_game_key"]): r for r in found.collect()}
    assert sorted(rows, key=str) == [("c1", "m1"), ("c1", "m2"), ("c2", None)]
    assert rows["c1", "m1"]["campaign_duration_days"] == 0
    assert rows["c2", None]["campaign_duration_days"] is None
    assert rows["c2", None]["image_filename"] == "s-r2.png"


def test_reports_use_the_latest_run(spark):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    benchmarks = spark.createDataFrame(
        [(old, "multimodal", 0.9, 0.1, 0.2, 30.0, 5), (new, "multimodal", 0.22685, 0.1, 0.2, 30.126, 5)],
        "run_timestamp timestamp, model_name string, r2 double, mae double, rmse double, mape double, n_features int",
    )
    empty = benchmarks.limit(0)
    metrics = spark.createDataFrame([(3,), (4,)], "n_impressions long")
    stats = reports.global_stats(metrics, spark.range(2), spark.range(3), benchmarks).first()
    assert tuple(stats) == (7, 2, 3, round(0.22685, 4))
    assert tuple(reports.global_stats(metrics.limit(0), spark.range(0), spark.range(0), empty).first()) == (0, 0, 0, 0.53)
    assert reports.latest_benchmarks(benchmarks).first()["mape"] == round(30.126, 2)
    assert reports.latest_benchmarks(empty).count() == 0
    long = {(r["model"], r["metric"]): r["value"] for r in reports.metrics_long(reports.latest_run(benchmarks)).collect()}
    assert long["Multimodal", "MAPE"] == pytest.approx(0.30126)
    scores = spark.createDataFrame(
        [(new, "multimodal", f"f_{i}", float(i // 2), "Contextual") for i in range(12)],
        "run_timestamp timestamp, model_name string, feature_name string, importance_score double, category string",
    )
    names = [r["name"] for r in reports.top_features(scores, 3).collect()]
    assert names == ["F 10", "F 11", "F 8"]


def test_percentiles_and_profile(spark):
    df = spark.createDataFrame([("US", 0.1), ("US", 0.3), ("GB", None), (None, 0.5)], "geo_country string, engagement_rate double")
    found = {r["geo_country"]: tuple(r)[1:] for r in reports.rate_percentiles(df).collect()}
    assert found == {"US": pytest.approx((0.15, 0.2, 0.25)), None: (0.5, 0.5, 0.5)}
    profile = {r["column"]: r for r in reports.column_profile(df).collect()}
    assert (profile["engagement_rate"]["non_null"], profile["engagement_rate"]["n_rows"]) == (3, 4)
    assert profile["geo_country"]["type"] == "string"
    assert reports.sample(df, 2).count() == 2


def test_a_sample_is_the_same_however_rows_are_dealt(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("gap"))
    first = sorted(map(tuple, reports.sample(df, 40, ["id"]).collect()))
    assert first == sorted(map(tuple, reports.sample(df.repartition(7).orderBy(F.desc("id")), 40, ["id"]).collect()))
    assert len(first) == 40 and first != sorted(map(tuple, reports.sample(df, 40, ["id"], seed=1).collect()))
    tied = [sorted(map(tuple, reports.sample(d, 40, ["k"]).collect())) for d in (df, df.repartition(5))]
    assert tied[0] == tied[1]
    twice = reports.sample(df.union(df), 6).collect()
    assert len(set(twice)) == 3 and reports.sample(df.limit(3), 9).count() == 3
