import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumetric.functions import numbers, text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def evaluate(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_names_are_normalised(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Buy Rate (CPE)` int, `Gross Cost/Budget` int, StartDate int")
    assert text.normalise_columns(df).columns == ["buy_rate_cpe", "gross_cost_budget", "startdate"]


def test_clashing_names_are_refused(spark):
    with pytest.raises(ValueError, match="a_b"):
        text.normalise_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def test_split_key_both_ways(spark):
    df = column(spark, ["a/b", "a/b/c", "plain", None, "/x", "x/"])
    last = text.split_key(F.col("c"))
    first = text.split_key(F.col("c"), "first")
    assert evaluate(df, last[0]) == ["a", "a/b", "plain", None, "", "x"]
    assert evaluate(df, last[1]) == ["b", "c", None, None, "x", ""]
    assert evaluate(df, first[0]) == ["a", "a", "plain", None, "", "x"]
    assert evaluate(df, first[1]) == ["b", "b", "", None, "x", ""]


def test_event_type_loses_tabs_and_case(spark):
    df = column(spark, ["\tImpression \n", " first_dropped", None])
    assert evaluate(df, text.event_type(F.col("c"))) == ["impression", "first_dropped", None]


def test_blank_context_is_unknown(spark):
    assert evaluate(column(spark, [" x ", "  ", None]), text.filled(F.col("c"))) == [
        "x", "Unknown", "Unknown",
    ]


def test_filenames(spark):
    request = "d071433c0e09216d8f80"
    df = column(spark, [f"adunit-a-mob-{request}.png", "a-short.png", "plain.png"])
    strict, loose = text.split_filename(F.col("c")), text.split_filename(F.col("c"), False)
    assert evaluate(df, strict[0]) == ["adunit-a-mob", "a-short", "plain"]
    assert evaluate(df, strict[1]) == [request, None, None]
    assert evaluate(df, loose[0]) == ["adunit-a-mob", "a", "plain"]
    assert evaluate(df, loose[1]) == [request, "short", None]


def test_placement_takes_the_first_marker(spark):
    df = column(spark, ["x-bio-mob", "x-mpu", "x-tap", "x-bio", "x", None])
    assert evaluate(df, text.placement(F.col("c"))) == [
        "mobile", "mpu", "tap", "bio", "unknown", "unknown",
    ]


def test_feature_names(spark):
    df = column(spark, ["vision_pca_0", "buy_rate_cpe", "is_dark_background", "brightness"])
    assert evaluate(df, text.display_name(F.col("c")))[0] == "Vision Pca 0"
    assert evaluate(df, text.feature_category(F.col("c"))) == [
        "Visual", "Contextual", "Visual", "Visual",
    ]


def test_numbers_tolerate_junk(spark):
    df = column(spark, ["1.5", "NaN", "1,000", "", None, " 7 "])
    assert evaluate(df, numbers.number(F.col("c"))) == [1.5, None, None, None, None, 7.0]
    assert evaluate(df, numbers.number_or_zero(F.col("c"))) == [1.5, 0, 0, 0, 0, 7.0]
    assert evaluate(df, numbers.nonzero(F.col("c")))[4] is False


def test_dates_day_first_and_month_first(spark):
    values = ["3/4/2024", "2024-04-03", "13.04.2024", "3/4/2024 5:06", "soon", "31/2/2024", None,
              "2024-04-03 10:11:12", "1/2/3/4"]
    df = column(spark, values)
    day = dt.datetime
    assert evaluate(df, numbers.date_text(F.col("c"))) == [
        day(2024, 4, 3), day(2024, 4, 3), day(2024, 4, 13), day(2024, 4, 3, 5, 6), None, None, None,
        day(2024, 4, 3, 10, 11, 12), None,
    ]
    assert evaluate(df, numbers.date_text(F.col("c"), day_first=False))[:3] == [
        day(2024, 3, 4), day(2024, 4, 3), None,
    ]


def test_whole_days(spark):
    df = spark.sql(
        """select 0 i, timestamp_ntz'2024-01-03 00:00:00' s, timestamp_ntz'2024-01-01 12:00:00' e
        union all select 1, timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-11 23:00:00'
        union all select 2, null, timestamp_ntz'2024-01-01'"""
    )
    assert evaluate(df, numbers.whole_days(F.col("s"), F.col("e"))) == [0, 10, None]
    assert evaluate(df, numbers.whole_days(F.col("s"), F.col("e"), False)) == [-1, 10, None]


def test_guarded_ratio_and_clip(spark):
    df = spark.createDataFrame([(0, 3, 2), (1, 1, 0), (2, None, 4)], "i int, n long, d long")
    r = numbers.ratio(F.col("n"), F.col("d"))
    assert evaluate(df, r) == [1.5, None, None]
    assert evaluate(df, numbers.clip(r, 0, 1)) == [1.0, None, None]


def test_percent_is_exact_decimal(spark):
    df = spark.createDataFrame([(0, 1, 8000), (1, 2469, 20000), (2, 1, 0)], "i int, n long, d long")
    assert evaluate(df, numbers.percent(F.col("n"), F.col("d"))) == [
        Decimal("0.01"), Decimal("12.35"), None,
    ]


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=50, max_size=200), places=st.integers(0, 4))
def test_float_round_matches_exact_rounding(spark, values, places):
    ties = [12.25, 2.675, 0.125, 0.5, 1.5, -2.5, 1.005, 0.15, 0.25, 0.35]
    df = column(spark, values + ties, "double")
    got = evaluate(df, numbers.float_round(F.col("c"), places))
    assert got == [float(round(v, places)) for v in values + ties]


def test_float_round_leaves_huge_values_and_nan(spark):
    got = evaluate(column(spark, [1e300, float("nan"), -1e18, None], "double"), numbers.float_round(F.col("c"), 2))
    assert got[0] == 1e300 and got[1] != got[1] and got[2:] == [-1e18, None]
