"""Tables, views, files and reuse of finished output."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetric.operators.rows import unique_columns
from lumetric.session import file_exists
from lumetric.sources.readers import finished

STAGING = "staging"
ANALYTICS = "analytics"


def create_namespaces(spark: SparkSession, *names: str) -> None:
    for name in names or (STAGING, ANALYTICS):
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def materialize(
    df: DataFrame,
    name: str,
    namespace: str | None = None,
    as_: str = "table",
    mode: str = "overwrite",
) -> DataFrame:
    """Save as a catalog table, or register as a view, and read it back.

    Overwriting drops the former schema with the data. Views are temporary and
    carry no namespace.
    """
    spark = df.sparkSession
    if as_ == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    full = f"{namespace}.{name}" if namespace else name
    unique_columns(df).write.mode(mode).format("parquet").saveAsTable(full)
    return spark.table(full)


def load_if_empty(df: DataFrame, name: str, namespace: str = STAGING) -> DataFrame:
    """Bulk load that keeps a table which already holds rows."""
    spark = df.sparkSession
    full = f"{namespace}.{name}"
    if spark.catalog.tableExists(full) and not spark.table(full).isEmpty():
        return spark.table(full)
    return materialize(df, name, namespace)


def digest(settings: object) -> str:
    """A short name for settings that must agree for output to be reused."""
    return hashlib.sha256(repr(settings).encode()).hexdigest()[:16]


def cached(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    force: bool = False,
    kind: str = "parquet",
    settings: object = None,
) -> DataFrame:
    """Reuse the finished output at ``path``, or build and write it.

    Output counts as finished when its writer left ``_SUCCESS`` and it was made
    with equal ``settings``, whose digest stands in an empty folder beside it.
    """
    mark = f"{path}.settings/{digest(settings)}"
    found = None if force or not file_exists(spark, f"{mark}/_SUCCESS") else finished(spark, path, kind)
    if found is not None:
        return found
    spark.range(0).write.mode("overwrite").parquet(f"{path}.settings")
    built = unique_columns(build())
    built.write.mode("overwrite").format(kind).save(path)
    spark.range(0).write.mode("overwrite").parquet(mark)
    return spark.read.schema(built.schema).format(kind).load(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace the rows of an external table, keeping its definition."""
    df.write.format("jdbc").options(
        url=url, dbtable=table, truncate="true", batchsize="10000", **options
    ).mode("overwrite").save()


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """External table; pass partitionColumn, lowerBound, upperBound and
    numPartitions for a parallel read."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
