"""Group k-fold: no group in two folds, folds balanced by rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumetric.operators.rows import lookup_join
from lumetric.session import settle

# Groups of one size that are numbered in one task, about.
BUCKET = 50_000


def deal(classes: list[tuple[int, int]], n_splits: int) -> list[tuple[int, int, int, int]]:
    """Deal groups to the lightest fold, largest groups first.

    ``classes`` holds (rows per group, number of such groups). Groups of one
    size are interchangeable, so whole runs are dealt at once: to the lightest
    fold until it catches up with the next, then evenly. Returns
    (size, first, end, fold): the groups numbered first..end-1 of that size go
    to that fold.
    """
    loads = [0] * n_splits
    dealt = []
    for size, left in sorted(classes, reverse=True):
        position = 0

        def give(fold: int, n: int, size: int = size) -> None:
            nonlocal position, left
            if n:
                dealt.append((size, position, position + n, fold))
            loads[fold] += n * size
            position += n
            left -= n

        while left:
            order = sorted(range(n_splits), key=lambda f: (loads[f], f))
            if loads[order[-1]] - loads[order[0]] <= size:
                each, extra = divmod(left, n_splits)
                for i, fold in enumerate(order):
                    give(fold, each + (i < extra))
            else:
                gap = loads[order[1]] - loads[order[0]]
                give(order[0], min(left, gap // size + 1))
    return dealt


def group_folds(df: DataFrame, group: str, n_splits: int) -> DataFrame:
    """One row per group: ``group, n_rows, fold``.

    Only the histogram of group sizes reaches the driver; n rows can have at
    most sqrt(2n) different group sizes. Groups of one size are numbered by
    hash bucket, so no size class gathers in one task.
    """
    sizes = settle(
        df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n_rows")), "groups"
    )
    histogram = [(r["n_rows"], r["count"]) for r in sizes.groupBy("n_rows").count().collect()]
    n_groups = sum(n for _, n in histogram)
    if n_groups < n_splits:
        raise ValueError(f"{n_groups} groups cannot fill {n_splits} folds")
    spark = df.sparkSession
    shares = spark.createDataFrame(
        deal(histogram, n_splits), "n_rows long, first long, end long, fold int"
    )
    buckets = -(-n_groups // BUCKET)
    bucketed = sizes.withColumn("_bucket", F.pmod(F.xxhash64(group), F.lit(buckets)))
    before = Window.partitionBy("n_rows").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("n_rows", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select("n_rows", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy("n_rows", "_bucket").orderBy(group)) - 1
    return (
        bucketed.withColumn("_within", within)
        .join(starts, ["n_rows", "_bucket"])
        .withColumn("_place", F.col("_start") + F.col("_within"))
        .join(shares, "n_rows")
        .where("_place >= first and _place < end")
        .select(group, "n_rows", "fold")
    )


def with_folds(df: DataFrame, group: str, n_splits: int) -> DataFrame:
    """The rows with a group, each with its fold."""
    folds = settle(group_folds(df, group, n_splits).select(group, "fold"), "folds")
    return lookup_join(df.where(F.col(group).isNotNull()), folds, group)
