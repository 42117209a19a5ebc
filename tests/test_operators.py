import random
from collections import Counter
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumetric.operators import encode, folds, kpi, metrics, quality
from lumetric.operators.quantiles import exact_quantiles, medians
from lumetric.operators.rows import (
    dense_id, hash_id, keep_first, lookup_join, only_present, ordered_index, unique_columns,
    with_defaults,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- rows -------------------------------------------------------------------


def test_keep_first_breaks_ties_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [("a", "2", "x"), ("a", "2", "b"), ("a", None, "a"), ("b", None, "q")], "k string, d string, v string"
    )
    first = keep_first(df, ["k"], [F.col("d").desc_nulls_last()])
    assert sorted(first.collect()) == [("a", "2", "b"), ("b", None, "q")]
    text = plan(first)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_tolerant_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert only_present(df, ["b", "x", "a"]).columns == ["b", "a"]
    assert with_defaults(df, {"a": 9, "c": 0.5}).collect()[0] == (1, 2, 0.5)
    with pytest.raises(ValueError, match="a"):
        unique_columns(df.select("a", F.col("b").alias("a")))


def test_lookup_join_spreads_null_keys(spark):
    left = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, F.lit("k")).alias("k"), F.col("id").alias("v")
    )
    right = spark.createDataFrame([("k", 1), (None, 2)], "k string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = lookup_join(left, right, "k")
        assert joined.columns == ["k", "v", "w"]
        assert Counter(r["w"] for r in joined.collect()) == {1: 200, None: 200}
        parts = joined.where("k is null").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 4 and max(r["count"] for r in parts) < 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_hot_key_is_split_at_run_time(spark):
    left = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    right = spark.range(-10, 50_000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = lookup_join(left.repartition(8), right, "k")
        matched = [r for r in joined.collect() if r["w"] is not None]
        assert len(matched) == 30_000 + 33_333 and "skew=true" in plan(joined)
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_ids(spark):
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("a"), F.when(F.col("id") % 3 > 0, F.lit("")).alias("b")
    )
    dense = [r[0] for r in dense_id(df, ["a", "b"]).select("id").collect()]
    assert sorted(dense) == list(range(1, 3001))
    hashed = hash_id(df, ["a", "b"])
    assert hashed.select("id").distinct().count() == 3000
    assert "Exchange" not in plan(hashed)
    pair = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "c"), ("", "c")], "a string, b string")
    assert hash_id(pair, ["a", "b"]).select("id").distinct().count() == 4


def test_ordered_index(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").alias("v"))
    found = ordered_index(df.orderBy(F.rand(1)), "g", "v").collect()
    assert all(r["index"] == r["v"] // 3 for r in found)
    assert len(found) == 5000


# --- rates ------------------------------------------------------------------

EVENTS = [
    ("spring", "bloom-x/q7", "impression", "tablet", "fire", "PT"),
    ("spring", "bloom-x/q7", "impression", "tablet", "fire", "PT"),
    ("spring", "bloom-x/q7", "impression", "tablet", "fire", "PT"),
    ("spring", "bloom-x/q7", "impression", "tablet", "fire", "PT"),
    ("spring", "bloom-x/q7", "first_dropped", "tablet", "fire", "PT"),
    ("spring", "bloom-x/q7", "impression", "tv", "webos", "PT"),
    ("spring", "bloom-x/q7", "click-through-event", "tv", "webos", "PT"),
    ("autumn", "leaf/q9", "impression", "desktop", "linux", "NO"),
    ("autumn", "leaf/q9", "impression", "desktop", "linux", "NO"),
    ("autumn", "leaf/q9", "first_dropped", "desktop", "linux", "NO"),
]
SCHEMA = "campaign_id string, game_key string, type string, device_type string, platform_os string, geo_country string"


@pytest.fixture
def events(spark):
    return spark.createDataFrame(EVENTS, SCHEMA)


def test_rates_split_by_system(events, rows):
    found = rows(kpi.creative_kpi(events, kpi.FILE.with_(min_impressions=1)))
    assert len(found) == 3
    assert all(0 <= r["engagement_rate"] <= 1 and 0 <= r["click_through_rate"] <= 1 for r in found)
    by = {r["platform_os"]: r for r in found}
    assert (by["fire"]["n_impressions"], by["fire"]["engagement_rate"]) == (4, 0.25)
    assert (by["webos"]["click_through_rate"], by["linux"]["engagement_rate"]) == (1.0, 0.5)
    assert (by["linux"]["creative_slug"], by["linux"]["creative_request_id"]) == ("leaf", "q9")


def test_min_impressions_filters_all(events):
    assert kpi.creative_kpi(events, kpi.FILE.with_(min_impressions=100)).isEmpty()


def test_three_definitions_differ_as_described(spark, rows):
    e = spark.createDataFrame(
        [
            ("c ", "a/b", "\tImpression", " x ", None, "usa"),
            ("c", "a/b", " first_dropped", "x", "", "USA "),
            ("c", "nokey", "impression", "x", "", "USA"),
            (None, "a/b", "impression", "x", "", "USA"),
            ("c", None, "impression", "x", "", "USA"),
            ("c", "a/b", "first_dropped", "x", "y", "USA"),
        ],
        SCHEMA,
    )
    mart = rows(kpi.creative_kpi(e))
    assert {r["platform_os"] for r in mart} == {"Unknown", "y"}
    assert all(r["geo_country"] == "USA" and r["campaign_id"] == "c" for r in mart)
    assert all(r["engagement_rate"] is None for r in mart)  # no impressions counted
    sql = rows(kpi.creative_kpi(e, kpi.SQL))
    assert {r["platform_os"] for r in sql} == {None, "", "y"}
    file = rows(kpi.creative_kpi(e, kpi.FILE.with_(min_impressions=0)))
    assert {r["platform_os"] for r in file} == {"", "y"}
    assert all(r["engagement_rate"] == 1.0 for r in file)  # events but no impressions


def test_absent_context_columns_leave_the_grain(events, rows):
    found = rows(kpi.creative_kpi(events.drop("platform_os"), kpi.FILE.with_(min_impressions=1)))
    by = {(r["campaign_id"], r["device_type"]): r["n_impressions"] for r in found}
    assert by == {("spring", "tablet"): 4, ("spring", "tv"): 1, ("autumn", "desktop"): 2}
    assert "platform_os" not in found[0]


def test_clip_only_where_asked(spark, rows):
    e = spark.createDataFrame([("c", "a/b", t, "d", "o", "g") for t in
                               ["impression", "first_dropped", "first_dropped"]], SCHEMA)
    assert rows(kpi.creative_kpi(e))[0]["engagement_rate"] == 2.0
    assert rows(kpi.creative_kpi(e, kpi.FILE.with_(min_impressions=1)))[0]["engagement_rate"] == 1.0


def test_counts_add_up_to_events(spark):
    rng = random.Random(3)
    e = spark.createDataFrame(
        [
            (rng.choice(["a", "b", None]), rng.choice(["k/1", "k/2", "k", None]),
             rng.choice(["impression", "first_dropped", "other"]), rng.choice(["", " ", None, "d"]),
             "o", rng.choice([None, "us"]))
            for _ in range(500)
        ],
        SCHEMA,
    )
    kept = [r for r in e.collect() if r[0] is not None and r[1] and "/" in r[1]]
    total = kpi.creative_kpi(e).agg(F.sum("n_impressions"), F.sum("n_engagements")).first()
    assert total[0] == sum(r["type"] == "impression" for r in kept)
    assert total[1] == sum(r["type"] == "first_dropped" for r in kept)


def test_rates_read_six_columns_and_shuffle_once(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([(*EVENTS[0], "x")], SCHEMA + ", payload string").write.parquet(path)
    text = plan(kpi.creative_kpi(spark.read.parquet(path)))
    assert "payload" not in text
    assert "StringContains(game_key,/)" in text and "IsNotNull(campaign_id)" in text
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2


def test_pivot_fills_absent_types(events, rows):
    staged = kpi.staged_events(events, kpi.FILE)
    found = rows(kpi.event_pivot(staged, ["campaign_id"]))
    assert {r["campaign_id"]: r["n_clicks"] for r in found} == {"spring": 1, "autumn": 0}


# --- quantiles --------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101])
def test_small_groups_match_numpy(spark, n):
    rng = random.Random(n)
    values = [float(rng.randint(0, 5)) for _ in range(n)]
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None)], "g string, v double")
    found = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "g", "v", [0.25, 0.5, 0.75]).collect()}
    assert found == pytest.approx({p: np.quantile(values, p) for p in (0.25, 0.5, 0.75)})


def test_large_and_hot_groups_are_exact(spark):
    df = spark.range(120_000).select(
        F.when(F.col("id") % 4 < 3, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
        F.when(F.col("id") % 5 == 0, F.lit(7.0)).otherwise(F.pow((F.col("id") * 7919) % 100003, F.lit(1.5))).alias("v"),
    )
    probs = [0.0, 0.25, 0.5, 0.75, 0.9999, 1.0]
    found = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "g", "v", probs).collect()}
    local = df.toPandas()
    for g, part in local.groupby("g"):
        for p in probs:
            assert found[g, p] == pytest.approx(np.quantile(part["v"], p), rel=1e-12)


def test_medians_skip_missing_and_default_to_zero(spark):
    df = spark.createDataFrame(
        [(1.0, None, float("nan")), (2.0, None, 4.0), (9.0, None, None)], "a double, b double, c double"
    )
    assert medians(df, ["a", "b", "c"]) == {"a": 2.0, "b": 0.0, "c": 4.0}


# --- codes ------------------------------------------------------------------


def test_codes_in_code_point_order(spark):
    df = spark.createDataFrame([("b",), ("B",), ("é",), (None,), ("b",)], "c string")
    codes = {r["value"]: r["code"] for r in encode.fit_encoders(df, ["c", "absent"]).collect()}
    assert codes == {v: i for i, v in enumerate(sorted(["b", "B", "é", "unknown"]))}


def test_unseen_values_and_missing_columns(spark, rows):
    fitted = encode.fit_encoders(spark.createDataFrame([("a",), ("b",)], "c string"), ["c"])
    new = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "c string, other int")
    coded = encode.apply_encoders(new, fitted, ["c", "other", "gone"])
    found = {r["other"]: r for r in rows(coded)}
    assert "gone_enc" not in coded.columns and found["1"]["gone"] == "unknown"
    assert [found[k]["c_enc"] for k in ("1", "2", "3")] == [0, 2, 2]
    assert found["2"]["c"] == "unknown" and found["1"]["other_enc"] == 0
    zero = encode.apply_encoders(new, fitted, ["c"], free_code=0)
    assert {r["c_enc"] for r in rows(zero)} == {0}


# --- folds ------------------------------------------------------------------


def greedy(sizes, k):
    loads = [0] * k
    for s in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += s
    return sorted(loads)


@pytest.mark.parametrize("seed", range(20))
def test_dealing_in_runs_equals_one_by_one(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 1, 1, 2, 5, 40, 300]) for _ in range(rng.randint(5, 400))]
    dealt = folds.deal(list(Counter(sizes).items()), 5)
    loads = Counter()
    for size, first, end, fold in dealt:
        loads[fold] += size * (end - first)
    assert sorted(loads.values()) == greedy(sizes, 5)
    for size, n in Counter(sizes).items():
        spans = sorted((a, b) for s, a, b, _ in dealt if s == size)
        assert spans[0][0] == 0 and spans[-1][1] == n
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_groups_stay_whole_even_with_a_hot_one(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 40).alias("g")
    )
    rows = folds.with_folds(df.unionAll(spark.sql("select cast(null as bigint) g")), "g", 5)
    assert rows.count() == 3000
    assert rows.groupBy("g").agg(F.countDistinct("fold").alias("n")).where("n > 1").isEmpty()
    assert rows.select("fold").distinct().count() == 5


def test_too_few_groups(spark):
    with pytest.raises(ValueError, match="2 groups"):
        folds.group_folds(spark.range(10).select((F.col("id") % 2).alias("g")), "g", 5)


# --- metrics ----------------------------------------------------------------


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(5)
    y, p = rng.random(50).round(1), rng.normal(0.3, 0.5, 50)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    found = metrics.regression_metrics(df, "y", "p").first()
    q = np.clip(p, 0, None)
    assert found["mae"] == pytest.approx(np.abs(y - q).mean())
    assert found["rmse"] == pytest.approx(np.sqrt(((y - q) ** 2).mean()))
    assert found["r2"] == pytest.approx(1 - ((y - q) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    nz = y != 0
    assert found["mape"] == pytest.approx(np.abs((y[nz] - q[nz]) / y[nz]).mean() * 100)


def test_metrics_of_constant_targets(spark):
    df = spark.createDataFrame([("same", 0.0, -1.0), ("off", 0.0, 1.0)], "g string, y double, p double")
    found = {r["g"]: r for r in metrics.regression_metrics(df, "y", "p", ["g"]).collect()}
    assert found["same"]["mape"] is None
    assert (found["same"]["r2"], found["off"]["r2"]) == (1.0, 0.0)


def test_fold_summary_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0,) * 4, (3.0,) * 4], "mae double, rmse double, r2 double, mape double")
    found = metrics.fold_summary(df).first()
    assert (found["mae_mean"], found["mae_std"], found["n_folds"]) == (2.0, 1.0, 2)


# --- quality ----------------------------------------------------------------


def test_checks_count_failures(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    child = spark.createDataFrame([("a", 0.5), ("x", 1.5), (None, None)], "k string, r double")
    checks = [
        quality.Check("unique", "parent", "k"),
        quality.Check("not_null", "parent", "k"),
        quality.Check("relationship", "child", "k", "parent"),
        quality.Check("range", "child", "r"),
        quality.Check("not_null", "child", "r"),
    ]
    results = quality.run_checks({"parent": parent, "child": child}, checks)
    assert {r["test"]: r["failures"] for r in results.collect()} == {
        "unique_parent_k": 1, "not_null_parent_k": 1, "relationship_child_k": 1,
        "range_child_r": 1, "not_null_child_r": 1,
    }
    with pytest.raises(AssertionError, match="range_child_r"):
        quality.require(results)


def test_seventeen_declared_checks_and_the_range():
    kinds = Counter(c.kind for c in quality.STAR_CHECKS)
    assert kinds == {"unique": 4, "not_null": 11, "relationship": 2, "range": 1}


def test_median_helper_agrees_with_statistics(spark):
    values = [3.0, 1.0, 4.0, 1.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert medians(df, ["v"])["v"] == median(values)
