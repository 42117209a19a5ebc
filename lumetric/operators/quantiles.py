"""Exact quantiles without gathering a group in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumetric.session import settle

# A sketch keeps a few thousand entries, so that even 100,000 of them, one per
# task of a large scan, can be merged in the one task that a group gets.
ACCURACY = 1_000
# Quantiles that a sketch is asked for: a pass narrows the values to a few of these steps.
STEPS = 200
# Different values, about, that the last pass sorts for one quantile of one group.
LAST = 5_000


def grid(value: Column | str) -> Column:
    return F.percentile_approx(value, [i / STEPS for i in range(STEPS + 1)], ACCURACY)


def exact_quantiles(df: DataFrame, by: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Interpolated quantiles of ``value`` per ``by``: columns ``by, prob, quantile``.

    For each group and quantile a range is kept that holds the wanted rank. A
    pass sketches the values strictly inside it and counts them, those below and
    those equal to its ends; the next range lies between the two steps of the
    sketch around the rank. So a value that makes up much of a group becomes an
    end of the range and no longer counts. When few different values are left
    in every range, they are counted by value, with partial counts before the
    shuffle, and a running sum over at most about ``LAST`` of them finds the rank.
    A group of a thousand rows and one of 10^12 take the same way; the number of
    passes grows with the logarithm of the largest.

    The ranges, one row per group and quantile, are written, so that their true
    size decides whether a join broadcasts them or splits the rows.
    """
    rows = df.select(F.col(by).alias("_g"), F.col(value).cast("double").alias("_v"))
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    same = F.col("_g").eqNullSafe(F.col("_h"))
    none, zero = F.lit(0).cast("long"), F.lit(0)
    first = rows.groupBy("_g").agg(
        F.count("*").alias("_n"), F.approx_count_distinct("_v").alias("_different"), grid("_v").alias("_grid")
    )
    state = settle(
        first.select(
            F.col("_g").alias("_h"),
            F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("_p"),
            "_n", "_different", "_grid",
            F.lit(float("-inf")).alias("_low"), F.lit(float("inf")).alias("_high"),
            # Rows up to the lower end, and strictly inside.
            none.alias("_upto"), F.col("_n").alias("_inside"), F.lit(2).alias("_margin"),
        ),
        "ranges",
    )
    place = F.col("_p") * (F.col("_n") - 1)
    while (state.agg(F.max("_different")).first()[0] or 0) > LAST:
        share = STEPS / F.greatest("_inside", F.lit(1))
        from_, to = F.floor(place) - F.col("_upto"), F.ceil(place) - F.col("_upto")
        low = (F.floor(from_ * share) - F.col("_margin")).cast("int")
        high = (F.ceil((to + 1) * share) + F.col("_margin")).cast("int")
        step = F.col("_grid")
        narrowed = settle(
            state.select(
                "*",
                F.when(F.col("_different") <= LAST, F.col("_low"))
                .when(from_ >= F.col("_inside"), F.col("_high"))
                .when(low < 0, F.col("_low"))
                .otherwise(step[F.least(F.greatest(low, zero), F.lit(STEPS))])
                .alias("_from"),
                F.when(F.col("_different") <= LAST, F.col("_high"))
                .when(to < 0, F.col("_low"))
                .when(high > STEPS, F.col("_high"))
                .otherwise(step[F.least(F.greatest(high, zero), F.lit(STEPS))])
                .alias("_to"),
            ),
            "ranges",
        )
        strictly = F.when(F.expr("_v > _from and _v < _to"), F.col("_v"))
        seen = (
            rows.join(narrowed.select("_h", "_p", "_from", "_to"), same)
            .where("_v <= _to")
            .withColumn("_x", strictly)
            .groupBy(F.col("_h").alias("_hs"), F.col("_p").alias("_ps"))
            .agg(
                F.count_if(F.expr("_v < _from")).alias("_b"), F.count_if(F.expr("_v <= _from")).alias("_u"),
                F.count("*").alias("_t"), F.count("_x").alias("_i"),
                F.approx_count_distinct("_x").alias("_d"), grid("_x").alias("_s"),
            )
        )
        both = narrowed.join(
            seen, F.col("_h").eqNullSafe(F.col("_hs")) & (F.col("_p") == F.col("_ps")), "left"
        )
        # A sketch beyond its error bound: look again, further around its step.
        holds = F.coalesce((F.col("_b") <= F.floor(place)) & (F.col("_t") > F.ceil(place)), F.lit(False))

        def kept(new: str, old: str, holds: Column = holds) -> Column:
            return F.when(holds, F.col(new)).otherwise(F.col(old)).alias(old)

        state = settle(
            both.select(
                "_h", "_p", "_n", kept("_d", "_different"), kept("_s", "_grid"), kept("_from", "_low"),
                kept("_to", "_high"), kept("_u", "_upto"), kept("_i", "_inside"),
                F.when(holds, F.lit(2)).otherwise(F.least(F.col("_margin") * 4, F.lit(2 * STEPS))).alias("_margin"),
            ),
            "ranges",
        )
    counted = (
        rows.join(state.select("_h", "_p", "_n", "_low", "_high"), same)
        .where("_v <= _high")
        .groupBy("_h", "_p", "_n", F.when(F.expr("_v >= _low"), F.col("_v")).alias("_x"))
        .agg(F.count("*").alias("_c"))
    )
    upto = (
        Window.partitionBy("_h", "_p")
        .orderBy(F.col("_x").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = counted.withColumn("_upto", F.sum("_c").over(upto)).withColumn("_place", place)
    return (
        ranked.groupBy("_h", "_p", "_place")
        .agg(
            F.min(F.when(F.expr("_upto > floor(_place)"), F.col("_x"))).alias("_a"),
            F.min(F.when(F.expr("_upto > ceil(_place)"), F.col("_x"))).alias("_b"),
        )
        .select(
            F.col("_h").alias(by),
            F.col("_p").alias("prob"),
            F.expr("_a + (_b - _a) * (_place - floor(_place))").alias("quantile"),
        )
    )


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column, 0 for a column without values: one number per column.

    The passes of ``exact_quantiles``, for all columns at once: a pass is one
    row of sketches and counts. When at most ``LAST`` rows are left strictly
    inside a column's range, the driver sorts those.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    values = {c: F.when(~F.isnan(v), v) for c, v in values.items()}
    found = dict.fromkeys(columns, 0.0)
    if not columns:
        return found

    def inside(c: str, low: float, high: float) -> Column:
        return F.when((values[c] > low) & (values[c] < high), values[c])

    # Column -> rows, range, rows up to its lower end, rows strictly inside, sketch of those.
    ranges = {}
    sums = df.agg(*[F.struct(F.count(v), F.count_if(F.abs(v) == math.inf), grid(v)) for v in values.values()]).first()
    odd = []
    for c, (n, infinite, steps) in zip(columns, sums):
        if infinite:
            odd.append(c)
        elif n:
            ranges[c] = (n, -math.inf, math.inf, 0, n, steps)
    while wide := [c for c in ranges if ranges[c][4] > LAST]:
        tried = {}
        for c in wide:
            n, low, high, upto, many, steps = ranges[c]
            a, b = (n - 1) // 2 - upto, n // 2 - upto
            first, last = math.floor(a / many * STEPS) - 2, math.ceil((b + 1) / many * STEPS) + 2
            tried[c] = (
                high if a >= many else low if first < 0 else steps[first],
                low if b < 0 else high if last > STEPS else steps[last],
            )
        counts = df.agg(
            *[
                F.struct(
                    F.count_if(values[c] < low), F.count_if(values[c] <= low), F.count_if(values[c] <= high),
                    F.count(inside(c, low, high)), grid(inside(c, low, high)),
                )
                for c, (low, high) in tried.items()
            ]
        ).first()
        for c, (below, upto, total, many, steps) in zip(wide, counts):
            n = ranges[c][0]
            if below <= (n - 1) // 2 and total > n // 2:
                ranges[c] = (n, *tried[c], upto, many, steps)
            else:  # a sketch beyond its error bound
                odd.append(c)
                ranges.pop(c)
    if ranges:
        last = df.agg(*[F.sort_array(F.collect_list(inside(c, r[1], r[2]))) for c, r in ranges.items()]).first()
        for (c, (n, low, high, upto, many, _)), rest in zip(ranges.items(), last):
            a, b = (
                low if i < upto else rest[i - upto] if i - upto < many else high for i in ((n - 1) // 2, n // 2)
            )
            found[c] = a + (b - a) * 0.5 if n % 2 == 0 else a
    for c in odd:
        rows = df.select(F.lit(c).alias("feature"), values[c].alias("value"))
        found[c] = exact_quantiles(rows, "feature", "value", [0.5]).first()["quantile"]
    return found
