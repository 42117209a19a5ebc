import json
import random
from datetime import datetime

from pyspark.ml import PipelineModel

from lumetric.operators import kpi
from lumetric.plans import jobs, linked
from lumetric.plans.features import Fitted
from lumetric.sources import readers
from tests.conftest import solid

QUICK = {"rounds": 1, "max_depth": 2, "max_bins": 8}
RULES = kpi.FILE.with_(min_impressions=1)


def network():
    return lambda batch: batch.reshape(len(batch), -1)[:, ::10000].copy()


def raw_files(folder):
    rng = random.Random(11)
    creatives = [(f"adunit-{i}-mob", f"{i:020d}") for i in range(8)]
    lines = ["campaign_id,game_key,type,device_type,platform_os,geo_country"]
    for i in range(600):
        slug, request = creatives[rng.randrange(8)]
        kind = rng.choice(["impression", "impression", "first_dropped", "click-through-event"])
        lines.append(f"c{i % 6},{slug}/{request},{kind},{rng.choice(['phone', 'tablet'])},ios,USA")
    (folder / "events.csv").write_text("\n".join(lines))
    (folder / "briefing.csv").write_text(
        "campaign_id,submission_date,startdate,enddate,buy_rate_cpe,volume_agreed,gross_cost_budget\n"
        + "\n".join(f"c{i},2024-01-01,1/2/2024,{i + 1}/3/2024,0.{i},100,50" for i in range(6))
    )
    doc = {f"m{i}": {r: {"adunit_sizes": {"size_x": i, "size_y": 2}}} for i, (_, r) in enumerate(creatives)}
    (folder / "design.json").write_text(json.dumps(doc, indent=1))
    (folder / "images").mkdir()
    for i, (slug, request) in enumerate(creatives[:7]):
        (folder / "images" / f"{slug}-{request}.png").write_bytes(solid((30 * i, 10, 255 - 30 * i), 12, 8))
    return {
        "events": str(folder / "events.csv"), "briefing": str(folder / "briefing.csv"),
        "design": str(folder / "design.json"), "images": str(folder / "images"),
    }


def test_files_to_models_and_tables_to_models(spark, tmp_path):
    paths, out = raw_files(tmp_path), str(tmp_path / "out")
    matrix, results, models = jobs.run_from_files(
        spark, paths, out, RULES, network, design_per_line=False, n_splits=2, **QUICK
    )
    assert sorted(models) == ["click_through_rate", "engagement_rate"]
    document = results.first()
    assert document["n_campaigns"] == 6 and sorted(document["models"]) == [
        "baseline", "multimodal", "tabular", "vision",
    ]
    columns = set(matrix.columns)
    assert {"vision_pca_0", "brightness_mean", "device_type_enc", "campaign_duration_days"} <= columns
    assert PipelineModel.load(f"{out}/pca_model") and Fitted.load(spark, f"{out}/models/fitted").fills

    n_rows, made = matrix.count(), sorted((tmp_path / "out" / "feature_dataset").iterdir())
    again, _, _ = jobs.run_from_files(
        spark, paths | {"events": str(tmp_path / "events.csv")}, out, RULES, network, n_splits=2, **QUICK
    )
    assert again.count() == n_rows and sorted((tmp_path / "out" / "feature_dataset").iterdir()) == made
    other, _, _ = jobs.run_from_files(spark, paths, out, RULES, n_splits=2, **QUICK)  # no network: made anew
    assert other.count() == n_rows and sorted((tmp_path / "out" / "feature_dataset").iterdir()) != made

    sources = readers.load_all(spark, paths, design_per_line=False)
    images = spark.read.parquet(f"{out}/vision_embeddings")
    spark.sql("drop table if exists staging.raw_inventory")
    jobs.stage_all(
        spark, sources["events"], readers.read_csv(spark, paths["briefing"]), sources["design"],
        readers.list_images(spark, paths["images"], strict_request_id=False), images,
    )
    jobs.build_marts(spark)
    assert linked.read_linked(spark).count() == spark.table("analytics.creative_metrics").count()
    _, results, _ = jobs.run_from_tables(spark, str(tmp_path / "out2"), n_splits=2, **QUICK)
    recorded = jobs.record_results(results, datetime(2024, 1, 1))
    assert recorded["model_benchmarks"].count() == 4
    assert recorded["feature_importances"].count() > 4
