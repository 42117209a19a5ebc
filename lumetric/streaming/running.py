"""Rates that follow an event stream.

The stream keeps the counts of each group in its own state. Each batch writes
the new totals of the groups it changed; a table of such changes, in which the
latest one of a group holds, is the current state for readers. Now and then it
is written as a whole, so that a reader never meets more than a few batches.

State and table grow with the number of groups, not of events. For very many
groups let the cluster keep state outside the heap, by
``spark.sql.streaming.stateStore.providerClass``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumetric.operators import kpi
from lumetric.session import file_exists

BATCH = "_batch"


def event_files(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet event files below ``path`` as a stream, oldest first; each is read once."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def follow_rates(
    events: DataFrame,
    target: str,
    checkpoint: str,
    rules: kpi.KpiRules = kpi.MART,
    compact_every: int = 20,
) -> StreamingQuery:
    """Count all new events of the stream into the table below ``target``, then stop.

    A batch that is repeated after a failure writes the same totals into the
    same folder again, so nothing is counted twice. ``target`` and ``checkpoint``
    belong together: give both anew, or neither, and start a stopped query with the same
    rules. The counts are summed before the shuffle, so a frequent group sends a
    row for each task.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        # The totals of a group don't depend on earlier folders; the last one wins.
        batch.write.mode("overwrite").parquet(_changes(target, number))
        if number % compact_every == compact_every - 1:
            compact(batch.sparkSession, target, number)

    return (
        kpi.grain_counts(kpi.staged_events(events, rules))
        .writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact(spark: SparkSession, target: str, number: int) -> None:
    """Write the state after batch ``number`` as a whole, and drop what no reader needs.

    The former whole state and the changes since it are kept, for readers that
    have just begun with them. A state that is there already stays.
    """
    if file_exists(spark, f"{_whole(target, number)}/_SUCCESS"):
        return
    former = _latest_whole(spark, target, number - 1)
    current_counts(spark, target, number).write.mode("overwrite").parquet(_whole(target, number))
    if former is not None:
        _drop(spark, target, "whole", former - 1)
        _drop(spark, target, "changes", former)


def current_counts(spark: SparkSession, target: str, until: int | None = None) -> DataFrame:
    """The latest counts of every group, after all batches or those up to ``until``."""
    whole = _latest_whole(spark, target, until)
    later = [n for n in _numbers(spark, target, "changes") if (whole is None or n > whole) and (until is None or n <= until)]
    # At most one folder for each batch since the last whole state.
    paths = [_changes(target, n) for n in later] + ([] if whole is None else [_whole(target, whole)])
    if not paths:
        raise FileNotFoundError(f"no batch below {target} yet")
    rows = spark.read.parquet(*paths)
    grain = [c for c in kpi.GRAIN if c in rows.columns]
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/(?:changes|whole)-([0-9]+)/[^/]*$", 1).cast("long")
    counts = F.struct(*kpi.COUNTED)
    latest = rows.withColumn(BATCH, folder).groupBy(*grain).agg(F.max_by(counts, BATCH).alias("_last"))
    return latest.select(*grain, *[F.col(f"_last.{c}").alias(c) for c in kpi.COUNTED])


def current_rates(spark: SparkSession, target: str, rules: kpi.KpiRules = kpi.MART) -> DataFrame:
    """What ``kpi.creative_kpi`` gives for all events that were counted so far."""
    return kpi.counted_rates(current_counts(spark, target), rules)


def _changes(target: str, number: int) -> str:
    return f"{target}/changes-{number}"


def _whole(target: str, number: int) -> str:
    return f"{target}/whole-{number}"


def _folder(spark: SparkSession, target: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, target: str, kind: str) -> list[int]:
    """Numbers of the finished folders of a kind, in order."""
    path, store = _folder(spark, target)
    if not store.exists(path):
        return []
    names = [s.getPath().getName() for s in store.listStatus(path)]
    found = [int(n.removeprefix(f"{kind}-")) for n in names if n.startswith(f"{kind}-")]
    return sorted(n for n in found if file_exists(spark, f"{target}/{kind}-{n}/_SUCCESS"))


def _latest_whole(spark: SparkSession, target: str, until: int | None) -> int | None:
    return max((n for n in _numbers(spark, target, "whole") if until is None or n <= until), default=None)


def _drop(spark: SparkSession, target: str, kind: str, until: int) -> None:
    _, store = _folder(spark, target)
    for n in _numbers(spark, target, kind):
        if n <= until:
            store.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/{kind}-{n}"), True)
