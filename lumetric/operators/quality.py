"""Declarative data tests: each gives one row (test, failures)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str  # unique, not_null, relationship, range
    table: str
    column: str
    parent: str = ""
    low: float = 0.0
    high: float = 1.0

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


# The tests declared on the star schema, and the range the runner also names.
STAR_CHECKS = (
    Check("unique", "dim_campaigns", "campaign_id"),
    Check("unique", "dim_creatives", "game_key"),
    Check("unique", "creative_metrics", "id"),
    Check("unique", "v_campaign_benchmarks", "campaign_id"),
    Check("not_null", "dim_campaigns", "campaign_id"),
    Check("not_null", "dim_campaigns", "campaign_name"),
    Check("not_null", "dim_creatives", "game_key"),
    Check("not_null", "dim_creatives", "creative_slug"),
    Check("not_null", "dim_creatives", "aspect_ratio"),
    Check("not_null", "creative_metrics", "id"),
    Check("not_null", "creative_metrics", "campaign_id"),
    Check("not_null", "creative_metrics", "game_key"),
    Check("not_null", "creative_metrics", "n_impressions"),
    Check("not_null", "v_campaign_benchmarks", "campaign_id"),
    Check("not_null", "stg_briefing", "campaign_id"),
    Check("relationship", "creative_metrics", "campaign_id", "dim_campaigns"),
    Check("relationship", "creative_metrics", "game_key", "dim_creatives"),
    Check("range", "creative_metrics", "engagement_rate"),
)


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Each repeated value with its row count; nulls are not compared."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    keys = parent.select(column).where(F.col(column).isNotNull())
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def _scan_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All null and range tests of one table in one aggregate."""

    def failed(check: Check):
        c = F.col(check.column)
        return c.isNull() if check.kind == "not_null" else ~c.between(check.low, check.high)

    wide = df.agg(*[F.count_if(failed(c)).alias(c.name) for c in checks])
    return wide.unpivot([], [c.name for c in checks], "test", "failures")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check] = STAR_CHECKS) -> DataFrame:
    """(test, failures, passed) for all checks."""
    results = []
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table]
        scans = [c for c in mine if c.kind in ("not_null", "range")]
        if scans:
            results.append(_scan_checks(tables[table], scans))
        for check in mine:
            if check.kind == "unique":
                bad = repeated_keys(tables[table], check.column)
            elif check.kind == "relationship":
                bad = orphans(tables[table], tables[check.parent], check.column)
            else:
                continue
            results.append(
                bad.agg(F.count("*").alias("failures")).select(
                    F.lit(check.name).alias("test"), "failures"
                )
            )
    return reduce(DataFrame.unionByName, results).withColumn("passed", F.col("failures") == 0)


def require(results: DataFrame) -> None:
    """Fail the run when any check fails: at most one row per check is read."""
    failed = {r["test"]: r["failures"] for r in results.where("failures > 0").collect()}
    if failed:
        raise AssertionError(f"data checks failed: {failed}")
