"""Row-level set operators: keep-first, numbering, tolerant selection, joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumetric.session import settle


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by all other columns.

    ``row_number() = 1`` is planned as a group limit on both sides of the
    shuffle, so a map task passes on at most one row per key and a hot key
    never gathers in one task.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def only_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select([c for c in wanted if c in df.columns])


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add each missing column with its default."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def unique_columns(df: DataFrame) -> DataFrame:
    """Fail on repeated column names, which a file sink could not hold."""
    repeated = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if repeated:
        raise ValueError(f"repeated columns: {repeated}")
    return df


INTEGRAL = ("tinyint", "smallint", "int", "bigint")
NUMERIC = (*INTEGRAL, "float", "double")


def common_key(left: str, right: str) -> str | None:
    """The type in which keys of two types are compared: the wider number, or text."""
    if left == right:
        return None
    if left in INTEGRAL and right in INTEGRAL:
        return "bigint"
    return "double" if left in NUMERIC and right in NUMERIC else "string"


def lookup_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join on one key, with null keys spread over all partitions.

    Keys of unlike types meet in their common type; the key column stays as the
    left side has it. A null key matches nothing but would hash to a single
    partition. Rows are therefore also matched on a hash: of the key where there
    is one, which changes nothing, else of the whole row. (A constant for real
    keys would be folded into a filter and spread nothing; a random number would
    differ when a lost task is repeated.) Hot real keys are split by the adaptive
    skew join; small right sides are broadcast by their size, known from the file
    or measured at run time.
    """
    kind = common_key(dict(left.dtypes)[on], dict(right.dtypes)[on])
    key = F.col(on).cast(kind) if kind else F.col(on)
    key_hash = F.xxhash64(key)
    plain = [c for c, kind in left.dtypes if not kind.startswith("map") and c != on]
    row_hash = F.xxhash64(*plain) if plain else key_hash
    spread = F.when(key.isNull(), row_hash).otherwise(key_hash)
    found = right.withColumns({"_key": key, "_spread": key_hash}).drop(on)
    return left.withColumns({"_key": key, "_spread": spread}).join(found, ["_key", "_spread"], "left").drop("_key", "_spread")


def grain_text(columns: Sequence[str]) -> Column:
    """The columns as one text; lengths keep it unambiguous, null differs from blank."""
    parts = [
        F.when(F.col(c).isNull(), F.lit("-")).otherwise(
            F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string"))
        )
        for c in columns
    ]
    return F.concat(*parts)


def hash_id(df: DataFrame, grain: Sequence[str], name: str = "id") -> DataFrame:
    """A stable text id per grain, without any shuffle."""
    return df.select(F.sha2(grain_text(grain), 256).alias(name), "*")


def dense_id(df: DataFrame, grain: Sequence[str], name: str = "id") -> DataFrame:
    """Ids 1..n without a global window over the rows.

    Rows fall into buckets by the hash of their grain: 4096, or as many as keep
    a bucket near 50,000 rows, 16 million at most. A running sum over the bucket
    counts gives each bucket its first id; rows are numbered inside their bucket.
    ``grain`` must identify a row. The rows are written first, as they are read
    for the counts and again for the numbers.
    """
    hashed = settle(df.withColumn("_hash", F.left(F.md5(grain_text(grain)), F.lit(6))), "hashed")
    digits = 3
    while digits < 6 and hashed.count() > 50_000 * 16**digits:
        digits += 1
    bucketed = hashed.withColumn("_bucket", F.left("_hash", F.lit(digits))).drop("_hash")
    counts = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # One row per bucket, so one task is enough.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*grain))
    return (
        bucketed.join(starts, "_bucket")
        .select((F.col("_start") + within).alias(name), *df.columns)
    )


def ordered_index(df: DataFrame, within: str, order: str, name: str = "index") -> DataFrame:
    """0-based position of each row among those of equal ``within``, by ``order``.

    Rows are range-partitioned and written with their partition number, so the
    split points stay fixed; then each row's position is the size of the
    earlier partitions plus its place in its own.
    """
    placed = settle(
        df.repartitionByRange(within, order).withColumn("_part", F.spark_partition_id()), "ordered"
    )
    counts = placed.groupBy(within, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        within, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    local = F.row_number().over(Window.partitionBy(within, "_part").orderBy(order)) - 1
    return (
        placed.withColumn("_local", local)
        .join(starts, [within, "_part"])
        .withColumn(name, F.col("_start") + F.col("_local"))
        .select(*df.columns, name)
    )
