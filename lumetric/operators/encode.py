"""Category codes as a table: (column, value, code)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.operators.rows import ordered_index
from lumetric.session import settle

UNKNOWN = "unknown"
SCHEMA = "column string, value string, code long"


def fit_encoders(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes 0..n-1 per column in code-point order; null counts as ``unknown``.

    Columns absent from ``df`` get no codes. Works for any number of values:
    they are numbered by range partition, never in one task or on the driver.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], SCHEMA)
    values = (
        df.select([F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in present])
        .unpivot([], present, "column", "value")
        .distinct()
    )
    codes = ordered_index(values, "column", "value", "code")
    # Written, so that every later join sees its true size.
    return settle(codes.withColumn("code", F.col("code").cast("long")), "codes")


def apply_encoders(
    df: DataFrame, encoders: DataFrame, columns: Sequence[str], free_code: int | None = None
) -> DataFrame:
    """Add ``<column>_enc``; a value without a code is replaced by ``unknown``.

    Unknown takes its own code; where fitting saw none, ``free_code`` or else
    the next free one. A missing column is added as ``unknown`` without a code
    column; a column that was never fitted gets code 0.
    """
    unknown_code = F.max(F.when(F.col("value") == UNKNOWN, F.col("code")))
    free = F.max("code") + 1 if free_code is None else F.lit(free_code)
    # One row per encoded column.
    spare = {
        r["column"]: r["spare"]
        for r in encoders.groupBy("column")
        .agg(F.coalesce(unknown_code, free).alias("spare"))
        .collect()
    }
    for c in columns:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(UNKNOWN))
            continue
        df = df.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)))
        if c not in spare:
            df = df.withColumn(f"{c}_enc", F.lit(0).cast("long"))
            continue
        codes = encoders.where(F.col("column") == c).select(
            F.col("value").alias(c), F.col("code").alias(f"{c}_enc")
        )
        known = F.col(f"{c}_enc").isNotNull()
        df = df.join(codes, c, "left").withColumns(
            {
                c: F.when(known, F.col(c)).otherwise(F.lit(UNKNOWN)),
                f"{c}_enc": F.coalesce(F.col(f"{c}_enc"), F.lit(spare[c]).cast("long")),
            }
        )
    return df
