import datetime as dt
import gzip
import json
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from lumetric.functions import heads
from lumetric.operators.design import broken_documents, flatten_design
from lumetric.plans import jobs, linked, staging
from lumetric.sources import readers, schemas, sinks
from lumetric.streaming import ingest
from tests.conftest import solid

BANNER = {
    "labels": {"engagement": ["tulip", "meadow", "rain"], "click_through": []},
    "text": {"engagement": ["Smell it"], "click_through": ["Order", "Later", "Never"]},
    "colors": {"engagement": {
        "1": {"red": 51, "green": 204, "blue": 102, "proportion": 0.25, "saturation": 0.6, "luminosity": 0.4},
        "2": {"saturation": 0.2, "luminosity": 0.8},
    }},
    "videos_data": {"has_video": 0},
    "direction": {"direction": "sideways"},
    "adunit_sizes": {"size_x": 300, "size_y": 250},
}
CLIP = {
    "labels": {"engagement": ["river"]},
    "text": {},
    "colors": {"engagement": {}},
    "videos_data": {"has_video": 1, "videos_length": {"intro": 4.0, "main": 21.0}},
}


def documents(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, str) or t is None else json.dumps(t),) for t in texts], "doc string")


def test_design_records(spark, rows):
    doc = {"garden": {"n1": BANNER}, "water": {"n2": CLIP}}
    found = {r["request_id"]: r for r in rows(flatten_design(documents(spark, doc)))}
    banner, clip = found["n1"], found["n2"]
    assert len(found) == 2 and len(banner) == 22
    assert (banner["game_key"], clip["game_key"]) == ("garden", "water")
    assert (banner["has_video"], clip["has_video"]) == (0, 1)
    assert (banner["dominant_color_r"], banner["dominant_color_g"]) == (0.2, 0.8)
    assert banner["color_saturation_mean"] == pytest.approx(0.4) and banner["color_diversity"] == 2
    assert (clip["color_diversity"], clip["color_saturation_mean"]) == (0, 0.0)
    assert banner["engagement_labels_text"] == "tulip meadow rain" and banner["n_click_through_texts"] == 3
    assert banner["aspect_ratio"] == pytest.approx(1.2) and clip["aspect_ratio"] == 0.0
    assert (banner["video_length_seconds"], clip["video_length_seconds"]) == (0.0, 12.5)
    assert (banner["interaction_direction"], clip["interaction_direction"]) == ("sideways", "no direction")


def test_broken_documents_fail_or_are_counted(spark):
    docs = documents(spark, {"k": {"r": BANNER}}, "{broken", None)
    with pytest.raises(Exception, match="MALFORMED"):
        flatten_design(docs).collect()
    assert flatten_design(docs, broken="drop").count() == 1
    assert tuple(broken_documents(docs).first()) == (2, 1)


def test_wrong_nodes_at_each_level_are_skipped(spark, rows):
    doc = {
        "k1": 5, "k2": [1, {"r": {}}], "k3": {"r1": 7, "r2": None, "r3": [1], "r4": {}},
        "k4": {"r5": {"labels": 3, "text": {"engagement": "x"}, "colors": {"engagement": [1]},
                      "videos_data": {"has_video": True, "videos_length": 4},
                      "direction": 9, "adunit_sizes": {"size_x": 3, "size_y": 0}},
               "r6": {"colors": {"engagement": {"1": 4, "2": {"saturation": 0.5}, "3": None}}}},
    }
    texts = [doc, "not json", None, "[1]", "7", '{"d":{"r":{"direction":{"direction":"a"},"direction":{"direction":"b"}}}}']
    found = {r["request_id"]: r for r in rows(flatten_design(documents(spark, *texts), broken="drop"))}
    assert sorted(found) == ["r", "r4", "r5", "r6"]
    assert found["r"]["interaction_direction"] == "b"  # the last of repeated keys
    assert (found["r5"]["has_video"], found["r5"]["n_engagement_labels"]) == (1, 0)
    assert (found["r5"]["aspect_ratio"], found["r5"]["interaction_direction"]) == (0.0, "no direction")
    assert (found["r6"]["color_diversity"], found["r6"]["color_saturation_mean"]) == (3, 0.5)
    assert found["r4"]["interaction_direction"] == "no direction"


def test_design_needs_no_shuffle(spark):
    text = flatten_design(documents(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "PythonUDF" not in text


def test_one_document_per_file_or_line(spark, tmp_path):
    doc = {"k": {"r": BANNER}}
    (tmp_path / "whole.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "lines.json").write_text("\n".join([json.dumps(doc)] * 3))
    whole = readers.load_design(spark, str(tmp_path / "whole.json"), per_line=False)
    lines = readers.load_design(spark, str(tmp_path / "lines.json"), per_line=True)
    assert (flatten_design(whole).count(), flatten_design(lines).count()) == (1, 3)


def test_each_design_file_shows_its_layout(spark, tmp_path):
    doc = {"k": {"r": BANNER}}
    (tmp_path / "whole.json").write_text("\n\n" + json.dumps(doc, indent=2) + "\n")
    (tmp_path / "lines.json").write_text("\n".join([json.dumps(doc), "", json.dumps(doc)]))
    (tmp_path / "one.json").write_text(json.dumps(doc))
    assert flatten_design(readers.load_design(spark, str(tmp_path))).count() == 4
    (tmp_path / "bad.json").write_text('{"k": {\n"r": ')
    found = readers.load_design(spark, str(tmp_path))
    assert tuple(broken_documents(found).first()) == (5, 1)


def test_only_odd_design_files_are_read_whole(spark, tmp_path):
    doc = {"k": {"r": BANNER}}
    for name in ("a", "b c+d"):
        (tmp_path / f"{name}.json").write_text("\n".join([json.dumps(doc)] * 50))

    def plan(found, n):
        assert flatten_design(found).count() == n
        found.collect()
        return found._jdf.queryExecution().executedPlan().toString()

    shown = plan(readers.load_design(spark, str(tmp_path)), 100)
    assert "Exchange" not in shown and "Join" not in shown and shown.count("Scan text") == 1
    (tmp_path / "whole e.json").write_text(json.dumps(doc, indent=2))
    found = readers.load_design(spark, str(tmp_path))
    shown = plan(found, 101)
    assert "Exchange" not in shown and "Join" not in shown
    scans = found._jdf.queryExecution().executedPlan().collectLeaves()
    assert [scans.apply(i).metrics().apply("numFiles").value() for i in range(scans.size())] == [2, 1]


def test_briefing_csv(spark, tmp_path, rows):
    (tmp_path / "b.csv").write_text(
        "Campaign ID,Submission Date,Campaign Name,StartDate,EndDate,Buy Rate (CPE),Volume Agreed,Gross Cost/Budget\n"
        'c1,2024-01-02,"New, ""quoted""\nname",3/4/2024,2024-04-05,0.4,"1,000",N/A\n'
        "c1,2024-01-01,old,1/1/2024,1/2/2024,1,1,1\n"
        "c2,,only,junk,,x,2,3\n"
    )
    found = {r["campaign_id"]: r for r in rows(readers.load_briefing(spark, str(tmp_path / "b.csv")))}
    assert len(found) == 2
    assert found["c1"]["campaign_name"] == 'New, "quoted"\nname'
    assert found["c1"]["startdate"] == dt.datetime(2024, 4, 3)
    assert (found["c1"]["volume_agreed"], found["c1"]["gross_cost_budget"]) == (0.0, 0.0)
    assert found["c2"]["startdate"] is None and found["c2"]["buy_rate_cpe"] == 0.0


def test_latest_submission_as_text_or_date(spark):
    df = spark.createDataFrame(
        [("c", "9/1/2024", "old"), ("c", "10/2/2024", "new"), ("c", "soon", "junk")],
        "campaign_id string, submission_date string, campaign_name string",
    )
    assert readers.latest_briefing(df).first()["campaign_name"] == "junk"
    assert readers.latest_briefing(df, by_date=True).first()["campaign_name"] == "new"


EVENT_CSV = (
    "Campaign ID,Game Key,Type,Device Type,Platform OS,Geo Country,Browser TS\n"
    "c,a/b, Impression ,NA,ios,USA,2024-01-01 10:00:00\n"
    "c,a/b,first_dropped,phone,null,USA,never\n"
)


SWAPPED_CSV = (
    "Browser TS,Geo Country,Game Key,Note,Campaign ID,Type\n"
    "2024-05-06 07:08:09,FR,p/q,\"extra, \"\"quoted\"\"\",z,IMPRESSION\n"
)


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    for i, body in enumerate((EVENT_CSV, SWAPPED_CSV, EVENT_CSV.split("\n")[0] + "\n")):
        (tmp_path / f"{i}.csv").write_text(body)
    found = readers.load_events(spark, str(tmp_path))
    assert found.columns == [*schemas.EVENT_COLUMNS, "note"] and found.count() == 3
    row = found.where("note is not null").first()
    assert (row["campaign_id"], row["game_key"], row["type"]) == ("z", "p/q", "impression")
    assert (row["note"], row["device_type"]) == ('extra, "quoted"', None)
    assert found.where("campaign_id = 'c' and geo_country = 'USA'").count() == 2


def test_headers_take_the_first_bytes_only(spark, tmp_path):
    long = ",".join(f"column {i}" for i in range(20_000))
    bodies = {
        "quoted": '"a\nb","c ""d"", e",f\n1,2,3\n', "long": long + "\nx\n", "blank": "\n \r\nx,y\r\n1,2\r\n",
        "end": "only", "none": "", "odd name %": "é,ü\n",
    }
    for name, body in bodies.items():
        (tmp_path / f"{name}.csv").write_bytes(body.encode())
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(b"p,q\n" + b"1,2\n" * 100_000))

    def found(df):
        return {unquote(r.file.rsplit("/", 1)[1].split(".csv")[0]): r.header for r in df.collect()}

    plain = found(readers.csv_headers(spark, str(tmp_path)))
    assert plain == {"quoted": '"a', "long": long, "blank": "x,y", "end": "only", "odd name %": "é,ü", "packed": "p,q"}
    assert plain == found(readers.scanned_headers(spark, str(tmp_path)))
    assert found(readers.csv_headers(spark, str(tmp_path), True))["quoted"] == '"a\nb","c ""d"", e",f'
    read = readers.read_csv(spark, str(tmp_path / "quoted.csv"), multi_line=True)
    assert read.count() == 1 and len(read.columns) == 3


def test_a_header_needs_few_reads():
    sizes = []

    def read(n):
        sizes.append(n)
        return b"a,b\n" + b"1,2\n" * (n // 4 - 1)

    assert heads.first_record(read, False) == "a,b" and sizes == [heads.FIRST_BYTES]


def test_headers_of_a_store_known_to_spark_alone(spark, tmp_path):
    (tmp_path / "e.csv").write_text(EVENT_CSV)
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.t.link./in", f"file://{tmp_path}")
    assert readers.load_events(spark, "viewfs://t/in/e.csv").count() == 2


def test_large_documents_split_by_key(spark, tmp_path):
    doc = {f'k{i} ",{{[\\': {f"r{i}": {"text": {"engagement": ['x, "y" }] \\', "z"]}}, "n": [i, {}]} for i in range(3000)}
    small = {"whole": json.dumps(doc, indent=1), "empty": " {} ", "list": '[{"a": 1}, {"b": 2}]', "one": json.dumps({"é": {"r": CLIP}}),
             "twice": '{"d": {"r": {"has": 1}}, "e": 1, "d": {"r": {"has": 2}}}'}
    for name, body in small.items():
        (tmp_path / f"{name}.json").write_text(body)
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")  # blocks that start inside strings too
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(str(tmp_path / "whole.json")).rdd.getNumPartitions() > 20
        got = readers.split_objects(spark, str(tmp_path)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    docs = {}
    for r in got:
        docs.setdefault(r.file.rsplit("/", 1)[1].split(".")[0], []).append(json.loads(r.doc))
    assert len(docs["whole"]) == 3000 and {k: v for d in docs["whole"] for k, v in d.items()} == doc
    assert docs["empty"] == [{}] and docs["list"] == [[{"a": 1}, {"b": 2}]] and docs["one"] == [{"é": {"r": CLIP}}]
    assert sorted(docs["twice"], key=str) == [{"d": {"r": {"has": 2}}}, {"e": 1}]


@pytest.mark.parametrize("body", ['{"a": 1,}', '{"a": 1,, "b": 2}', '{"a": {"b": 1}', '{"a": "x, "b": 2}', '{"a": 1', "{,}"])
def test_broken_large_documents_stay_broken(spark, tmp_path, body):
    (tmp_path / "b.json").write_text(body)
    found = broken_documents(readers.load_design(spark, str(tmp_path), by_key=True)).first()
    assert found.n_broken > 0


def test_no_large_documents(spark, tmp_path):
    (tmp_path / "b.json").write_text("")
    assert readers.load_design(spark, str(tmp_path), by_key=True).collect() == []


def test_event_csv(spark, tmp_path, rows):
    (tmp_path / "e.csv").write_text(EVENT_CSV)
    first, second = rows(readers.load_events(spark, str(tmp_path / "e.csv")))
    assert (first["type"], first["device_type"]) == ("impression", None)
    assert first["browser_ts"] == dt.datetime(2024, 1, 1, 10)
    assert (second["browser_ts"], second["platform_os"]) == (None, None)


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    source, target, state = (tmp_path / n for n in ("in", "out", "state"))
    source.mkdir()

    def load():
        ingest.load_new_events(spark, str(source), str(target), str(state)).awaitTermination()
        return ingest.loaded_events(spark, str(target))

    (source / "1.csv").write_text(EVENT_CSV)
    assert load().count() == 2
    assert load().count() == 2
    (source / "2.csv").write_text(EVENT_CSV)
    loaded = load()
    assert loaded.count() == 4
    assert loaded.columns == list(schemas.EVENT_COLUMNS)
    assert loaded.where("type = 'impression' and device_type is null").count() == 2
    (source / "3.csv").write_text(SWAPPED_CSV)
    swapped = load().where("campaign_id = 'z'").first()
    assert (swapped["game_key"], swapped["type"], swapped["geo_country"]) == ("p/q", "impression", "FR")
    assert swapped["browser_ts"] == dt.datetime(2024, 5, 6, 7, 8, 9) and swapped["platform_os"] is None


def test_image_files(spark, tmp_path, rows):
    name = "adunit-a-mob-d071433c0e09216d8f80.png"
    (tmp_path / name).write_bytes(solid((255, 0, 0), 8, 4))
    (tmp_path / "broken.png").write_bytes(b"junk")
    (tmp_path / "other.txt").write_text("x")
    listed = {r["filename"]: r for r in rows(readers.list_images(spark, str(tmp_path)))}
    assert sorted(listed) == [name, "broken.png"]
    size = (tmp_path / name).stat().st_size
    assert listed[name]["file_size_kb"] == round(size / 1024, 2)
    assert (listed[name]["request_id"], listed["broken.png"]["request_id"]) == ("d071433c0e09216d8f80", None)
    decoded = {r["filename"]: r for r in rows(readers.load_images(spark, str(tmp_path)))}
    assert (decoded[name]["width"], decoded[name]["height"]) == (8, 4)
    assert decoded["broken.png"]["height"] == -1
    totals = readers.source_sizes(readers.list_files(spark, str(tmp_path))).first()
    assert totals["n_files"] == 3 and totals["n_bytes"] > size


def test_image_names_agree_between_listing_and_decoding(spark, tmp_path):
    folder = tmp_path / "Creative Assets_"
    folder.mkdir()
    name = "a b+c%20é-00000000000000000001.png"
    (folder / name).write_bytes(solid((1, 2, 3), 2, 2))
    assert readers.load_images(spark, str(folder)).first()["filename"] == name
    assert readers.list_images(spark, str(folder)).first()["filename"] == name


def test_nested_images_are_listed_and_decoded_alike(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a-1.png").write_bytes(solid((9, 8, 7), 3, 2))
    (tmp_path / "sub" / "b-2.png").write_bytes(solid((9, 8, 7), 5, 4))
    for nested, names in ((False, ["a-1.png"]), (True, ["a-1.png", "b-2.png"])):
        listed = readers.list_images(spark, str(tmp_path), nested=nested)
        decoded = readers.load_images(spark, str(tmp_path), nested=nested)
        assert sorted(r["filename"] for r in listed.collect()) == names
        assert sorted(r["filename"] for r in decoded.collect()) == names


def test_registry_in_order_of_names(spark):
    kinds = "filename string, request_id string, creative_slug string, file_path string"
    assets = spark.createDataFrame([(n, None, None, f"/a/{n}") for n in ("c", "a", "b")], kinds)
    files = spark.createDataFrame([("/a/c", 1024)], "path string, length long")
    found = linked.registry_with_sizes(assets, files, ordered=True).collect()
    assert [r["filename"] for r in found] == ["a", "b", "c"]


def test_registry_sizes_are_zero_for_missing_files(spark, rows):
    assets = spark.createDataFrame([("f.png", "r", "s-bio", "/a/f.png"), ("g.png", None, None, "/a/g.png")],
                                   "filename string, request_id string, creative_slug string, file_path string")
    files = spark.createDataFrame([("/a/f.png", 2048)], "path string, length long")
    found = {r["filename"]: r for r in rows(linked.registry_with_sizes(assets, files))}
    assert (found["f.png"]["file_size_kb"], found["g.png"]["file_size_kb"]) == (2.0, 0.0)
    assert (found["f.png"]["placement_type"], found["g.png"]["placement_type"]) == ("bio", "unknown")


def test_all_sources(spark, tmp_path):
    (tmp_path / "e.csv").write_text(EVENT_CSV)
    (tmp_path / "d.json").write_text(json.dumps({"k": {"r": BANNER}}))
    found = readers.load_all(spark, {"events": str(tmp_path / "e.csv"), "design": str(tmp_path / "d.json")})
    assert found["events"].count() == 2 and found["design"].columns == ["doc"]


# --- sinks ------------------------------------------------------------------


def test_cached_builds_once(spark, tmp_path):
    path, calls = str(tmp_path / "c"), []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    assert sinks.cached(spark, path, build).count() == 1
    assert sinks.cached(spark, path, build).count() == 1
    assert sinks.cached(spark, path, build, force=True).count() == 2
    assert len(calls) == 2


def test_unfinished_or_other_output_is_not_reused(spark, tmp_path):
    path = str(tmp_path / "c")
    made = sinks.cached(spark, path, lambda: spark.range(8).repartition(4), settings="a")
    assert made.count() == 8 and readers.finished(spark, path).count() == 8
    assert sinks.cached(spark, path, lambda: spark.range(9), settings="b").count() == 9
    assert sinks.cached(spark, path, lambda: spark.range(7), settings="b").count() == 9
    (tmp_path / "c" / "_SUCCESS").unlink()
    assert readers.finished(spark, path) is None
    assert sinks.cached(spark, path, lambda: spark.range(7), settings="b").count() == 7
    assert readers.finished(spark, str(tmp_path / "none")) is None


def test_materialize_replaces_schema_and_appends(spark):
    sinks.create_namespaces(spark, "scratch")
    sinks.materialize(spark.range(2), "t", "scratch")
    replaced = sinks.materialize(spark.range(3).toDF("other"), "t", "scratch")
    assert replaced.columns == ["other"] and replaced.count() == 3
    assert sinks.materialize(spark.range(3).toDF("other"), "t", "scratch", mode="append").count() == 6
    assert sinks.load_if_empty(spark.range(99).toDF("other"), "t", "scratch").count() == 6
    assert sinks.materialize(spark.range(4), "v", as_="view").count() == 4


def test_row_counts(spark, rows):
    found = rows(sinks.row_counts({"a": spark.range(3), "b": spark.range(0)}))
    assert {r["table_name"]: r["n_rows"] for r in found} == {"a": 3, "b": 0}


# --- catalog jobs -----------------------------------------------------------


@pytest.fixture
def raw(spark):
    sinks.create_namespaces(spark)
    spark.sql("drop table if exists staging.raw_inventory")
    events = spark.createDataFrame(
        [
            ("c1", "s-mob/r1", " impression", "phone", "", "usa"),
            ("c1", "s-mob/r1", "first_dropped", "phone", "", "usa"),
            ("c9", "s-tap/r2", "impression", None, "ios", None),
            (None, "s-tap/r2", "impression", None, "ios", None),
        ],
        "campaign_id string, game_key string, type string, device_type string, platform_os string, geo_country string",
    )
    briefing = spark.createDataFrame(
        [("c1 ", " One ", "o", "k", "2024-01-01", "2024-01-03", "usd", "0.5", "x", None),
         ("c2", "Two", "o", "k", "2024-01-05 12:00:00", "2024-01-04", "eur", "1", "2", "3")],
        ", ".join(f"{c} string" for c in schemas.BRIEFING_COLUMNS),
    )
    design = documents(spark, {"k1": {"r1": BANNER}, "k2": {"r1": CLIP}})
    files = spark.createDataFrame([("/i/s-mob-r1.png", 100)], "path string, length long")
    vision = spark.createDataFrame(
        [("s-mob-r1.png", 1.5, 0.2, 1.0)],
        "filename string, aspect_ratio double, brightness_mean double, is_dark_background double",
    )
    return events, briefing, design, files, vision


def test_stage_and_build(spark, raw, rows):
    events, briefing, design, files, vision = raw
    registry = readers.image_registry(files, strict_request_id=False)
    staged = jobs.stage_all(spark, events, briefing, design, registry, vision)
    assert {n: t.count() for n, t in staged.items()} == {
        "raw_inventory": 4, "raw_briefing": 2, "raw_design_metadata": 2,
        "raw_creative_assets": 1, "raw_vision_features": 1,
    }
    assert "md5_game_key" in staged["raw_design_metadata"].columns
    tables, results = jobs.build_marts(spark)
    failures = {r["test"]: r["failures"] for r in results.collect() if not r["passed"]}
    assert failures == {"relationship_creative_metrics_campaign_id": 1}  # c9 has no briefing
    rollup = {r["campaign_id"]: r for r in rows(tables["v_campaign_benchmarks"])}
    assert float(rollup["c1"]["avg_engagement_rate_pct"]) == 100.0
    assert (rollup["c2"]["num_creatives"], rollup["c2"]["total_impressions"]) == (0, None)

    found = rows(linked.read_linked(spark, ordered=True))
    assert [r["campaign_id"] for r in found] == ["c1", "c1", "c9"]  # two design keys share r1
    assert found[0]["campaign_duration_days"] == 2 and found[0]["image_filename"] == "s-mob-r1.png"
    assert "n_click_through_texts" not in found[0]
    assert linked.read_vision_features(spark).count() == 1

    by_sql = jobs.build_marts_sql(spark)
    assert {r["campaign_id"] for r in by_sql["campaigns"].collect()} == {"c1 ", "c2"}
    assert by_sql["creative_metrics"].where("platform_os = ''").count() == 1


def test_staged_briefing_trims_and_orders(spark):
    df = spark.createDataFrame(
        [("c", "a", "1"), ("c ", "b", "2"), (None, "x", "3")], "campaign_id string, campaign_name string, submission_date string"
    )
    full = df.selectExpr("*", *[f"cast(null as string) {c}" for c in schemas.BRIEFING_COLUMNS if c not in df.columns])
    kept = staging.stg_briefing(full, [F.desc("submission_date")]).collect()
    assert [(r["campaign_id"], r["campaign_name"], r["buy_rate_cpe"]) for r in kept] == [("c", "b", 0.0)]
