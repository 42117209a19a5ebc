"""Rates from a stream against the rates of all its files so far."""

import pytest

from lumetric.operators import kpi
from lumetric.streaming import running

EVENT = "campaign_id string, game_key string, type string, device_type string, platform_os string, geo_country string"
KINDS = ("impression", "first_dropped", "click-through-event", "other", None)


def event_rows(turn):
    """Some groups in every turn, some in one only, and one with a third of all events."""
    rows = [("hot", "s/1", KINDS[i % 5], "phone", "ios", "usa") for i in range(30)]
    rows += [(f"c{i % 4}", f"s/{i % 3}", KINDS[(i + turn) % 5], "phone", None, " sgp ") for i in range(40)]
    rows += [(f"only{turn}", "s/9", "impression", None, "", "gbr")]
    rows += [(None, "s/1", "impression", "x", "y", "z"), ("c1", "nokey", "impression", "x", "y", "z")]
    return rows


def same(found, wanted):
    order = sorted(wanted.columns)
    return sorted(map(str, found.select(*order).collect())) == sorted(map(str, wanted.select(*order).collect()))


def test_every_batch_and_restart(spark, tmp_path):
    source, target, state = str(tmp_path / "events"), str(tmp_path / "rates"), str(tmp_path / "state")
    with pytest.raises(FileNotFoundError):
        running.current_rates(spark, target)
    for turn in range(5):
        # A new query each time: it goes on from the state of the former one.
        spark.createDataFrame(event_rows(turn), EVENT).coalesce(1).write.mode("append").parquet(source)
        stream = running.event_files(spark, source, 1)
        running.follow_rates(stream, target, state, compact_every=2).awaitTermination()
        assert same(running.current_rates(spark, target), kpi.creative_kpi(spark.read.parquet(source)))
    assert same(running.current_rates(spark, target, kpi.FILE.with_(null_context="unknown")),
                kpi.counted_rates(running.current_counts(spark, target), kpi.FILE))
    # Whole states after batches 1 and 3; changes before the former one are gone.
    assert running._numbers(spark, target, "whole") == [1, 3]
    assert running._numbers(spark, target, "changes") == [2, 3, 4]
    # Only changed groups were written.
    changed = spark.read.parquet(f"{target}/changes-4")
    assert {r.campaign_id for r in changed.select("campaign_id").distinct().collect()} == {"hot", "c0", "c1", "c2", "c3", "only4"}


def test_a_repeated_batch_counts_once(spark, tmp_path):
    source, target, state = str(tmp_path / "events"), str(tmp_path / "rates"), str(tmp_path / "state")
    spark.createDataFrame(event_rows(0), EVENT).coalesce(1).write.parquet(source)
    running.follow_rates(running.event_files(spark, source), target, state).awaitTermination()
    # As after a failure between the write and the end of the batch.
    (tmp_path / "state" / "commits" / "0").unlink()
    (tmp_path / "state" / "commits" / ".0.crc").unlink(missing_ok=True)
    running.follow_rates(running.event_files(spark, source), target, state).awaitTermination()
    assert same(running.current_rates(spark, target), kpi.creative_kpi(spark.read.parquet(source)))
