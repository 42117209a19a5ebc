"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumetric.llm.common import WORD, index_within
from lumetric.session import settle

# The rank of a document is a number of LEVELS digits to the base 2 ** DIGIT_BITS.
DIGIT_BITS, LEVELS = 13, 4


def word_count(text: Column) -> Column:
    """Words of a text, by ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, most: int = 3
) -> DataFrame:
    """source, source_size -> the same with weight and target (double).

    Sources in order of code point, null last, weigh ``weights`` in turn and
    divide ``share`` of all sizes. No target exceeds ``most`` times its source;
    the excess is shared among the others by weight until none is above. The
    level (words per weight) is raised step by step; a step sends a sum and a
    count to the driver, however many sources there are.
    """
    ordered = index_within(
        sizes.select(F.lit(0).alias("_all"), F.col("source").isNull().alias("_last"), "source", "source_size"),
        "_all", ["_last", "source"], "_nth",
    )
    turns = F.array(*[F.lit(int(w)) for w in weights])
    weighed = settle(
        ordered.select(
            "source",
            "source_size",
            F.element_at(turns, (F.col("_nth") % len(weights)).cast("int") + 1).alias("weight"),
        ),
        "sources",
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    pool = share * total if share != 1 else total
    cap, level, capped = F.col("source_size") * most, 0.0, -1
    while True:
        over = cap < F.col("weight") * F.lit(level)
        full, n, weight = weighed.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.count(F.when(over, 1)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        if n == capped or not weight:
            break
        level, capped = (pool - full) / weight, n
    return weighed.withColumn(
        "target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level)))
    )


def key_of(hashed: Column, doc_id: str, source: str) -> Column:
    """Equal for rows of equal source, id and text."""
    return F.md5(F.to_json(F.struct(F.col(doc_id).alias("a"), F.col(source).alias("b"), hashed.alias("c"))))


def mix(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    importance: Column | None = None,
    weights: Sequence[int] = (1, 2, 3),
    share: float = 1.0,
    most: int = 3,
    seed: int = 0,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, hash, taken of every document.

    Every document of a source is taken floor(target / source size) times for
    certain. What is then missing is sampled: a document's random odds u / (1 - u)
    are divided by its inclusion odds (``importance``, 1 by default, times the
    odds of the missing share), and the documents of smallest quotient are taken
    while their words fit. One document more, the one whose size comes nearest
    to the words still missing, is taken if that brings the source closer to its
    target. So the sample has a fixed size in words. u is a hash of seed, id and
    text, and reruns agree. No document is taken over ``most`` times.

    Null or empty texts have size 0 and take no words. A null source is a source
    of its own; rows equal in source, id and text are numbered, so that each draws
    for itself (which of them is which does not matter); null ids are allowed,
    other columns ignored, and no rows give no rows. The threshold of a source is
    found digit by digit from sums by (source, digit), so a source with a third
    of all rows is never gathered, and neither is a row that repeats as often.
    """
    weight = F.lit(1.0) if importance is None else importance.cast("double")
    text = F.col(text_column)
    read = settle(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(source_column).alias("source"),
            word_count(text).alias("size"),
            F.md5(text).alias("hash"),
            weight.alias("importance"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "sized",
    )
    alike = key_of(F.col("hash"), "doc_id", "source")
    repeated = settle(
        read.groupBy(alike.alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated"
    )
    keyed = read.withColumn("key", alike)
    if repeated.isEmpty():
        numbered = keyed.withColumn("nth", F.lit(0).cast("long"))
    else:
        again = index_within(keyed.join(repeated, "key", "left_semi"), "key", ["_row"], "nth")
        once = keyed.join(repeated, "key", "left_anti").withColumn("nth", F.lit(0).cast("long"))
        numbered = once.unionByName(again)
    number = F.when(F.col("nth") > 0, F.col("nth")).cast("string")
    random = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.col("hash"), number))
    sized = settle(
        numbered.select(
            "doc_id", "source", "size", "hash", "importance", "nth",
            # 52 bits, between 0 and 1 exclusively.
            ((F.conv(F.substring(random, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))).alias("u"),
        ),
        "drawn",
    )
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sums, weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("certain", F.floor(ratio)).withColumn(
        "missing", F.col("target") - F.col("certain") * F.col("source_size")
    )
    plan = settle(plan.withColumn("inclusion", ratio - F.col("certain")), "plan").withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    odds = F.col("u") / (1 - F.col("u")) / (
        F.col("importance") * F.col("inclusion") / (1 - F.col("inclusion"))
    )
    rank = F.when(
        (F.col("inclusion") > 0) & (F.col("importance") > 0),
        F.floor(odds / (1 + odds) * F.lit(float(1 << DIGIT_BITS * LEVELS))),
    ).otherwise(F.lit(1 << DIGIT_BITS * LEVELS))
    ranked = sized.join(plan, same).withColumn("rank", rank.cast("long"))

    # Digit by digit: the bucket of ranks in which the words taken pass the words missing.
    found = plan.where("missing > 0").select(
        F.col("_source").alias("_from"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before")
    )
    for level in range(LEVELS):
        shift = DIGIT_BITS * (LEVELS - 1 - level)
        inside = ranked.join(
            found,
            F.col("source").eqNullSafe(F.col("_from"))
            & (F.shiftright("rank", shift + DIGIT_BITS) == F.col("prefix")),
        )
        digits = inside.groupBy("source", "missing", F.shiftright("rank", shift).alias("bucket"), "before").agg(
            F.sum("size").alias("words")
        )
        # At most 2 ** DIGIT_BITS rows a source.
        upto = Window.partitionBy("source").orderBy("bucket")
        running = digits.withColumn("until", F.col("before") + F.sum("words").over(upto))
        passed = F.min(F.when(F.col("until") > F.col("missing"), F.col("bucket")))
        last = running.groupBy("source").agg(
            F.coalesce(passed, F.max("bucket") + 1).alias("prefix"),
            F.coalesce(
                F.max(F.when(F.col("until") <= F.col("missing"), F.col("until"))), F.min("before")
            ).alias("before"),
        )
        found = settle(last.withColumnRenamed("source", "_from"), "threshold")
    taken = F.coalesce(F.col("rank") < F.col("prefix"), F.lit(False))
    at = F.col("source").eqNullSafe(F.col("_from"))
    gap = F.col("missing") - F.col("before")
    # The one that closes the gap best, where that is better than leaving it.
    beyond = (
        ranked.join(found, at)
        .where(~taken & (F.col("importance") > 0) & (F.abs(F.col("size") - gap) < gap))
        .where(F.col("certain") < most)
        .groupBy(F.col("source").alias("_last"))
        .agg(F.min(F.struct(F.abs(F.col("size") - gap).alias("off"), "rank", "doc_id", "hash", "nth")).alias("last"))
    )
    extra = taken | (
        F.col("last").isNotNull()
        & F.col("doc_id").eqNullSafe(F.col("last.doc_id"))
        & F.col("hash").eqNullSafe(F.col("last.hash"))
        & (F.col("nth") == F.col("last.nth"))
    )
    chosen = (
        ranked.join(found, at, "left")
        .join(beyond, F.col("source").eqNullSafe(F.col("_last")), "left")
        .withColumn("copies", (F.col("certain") + F.when(extra, 1).otherwise(0)).cast("long"))
    )
    return chosen.select(
        "doc_id", "source", "size", "source_size", "target", "copies", "hash",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options) -> DataFrame:
    """The mix itself: every document as often as ``mix`` takes it, all columns."""

    taken = mix(docs, id_column=id_column, text_column=text_column, source_column=source_column, **options)
    # Rows alike that differ in their copies: the first ``extra`` of them are taken once more.
    shares = settle(
        taken.groupBy(key_of(F.col("hash"), "doc_id", "source").alias("key")).agg(
            F.min("copies").alias("copies"),
            (F.sum("copies") - F.min("copies") * F.count("*")).alias("extra"),
        ).where("copies > 0 or extra > 0"),
        "copies",
    )
    own = key_of(F.md5(F.col(f"`{text_column}`")), f"`{id_column}`", f"`{source_column}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("key"))
    chosen = rows.join(shares, "key")
    if not shares.where("extra > 0").isEmpty():
        chosen = settle(chosen.withColumn("_row", F.monotonically_increasing_id()), "chosen")
        # Only these are numbered.
        split = index_within(chosen.where("extra > 0"), "key", ["_row"], "nth")
        more = split.withColumn("copies", F.col("copies") + (F.col("nth") < F.col("extra")).cast("long"))
        chosen = chosen.where("extra = 0").select("row", "copies").union(more.select("row", "copies"))
    times = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    return chosen.select("row", times.alias("copy")).select("row.*")


ORACLE = r"""
WITH numbered AS (
    SELECT doc_id, source, text, md5(text) AS hash,
           row_number() OVER (PARTITION BY doc_id, source, md5(text)) - 1 AS nth
    FROM documents
), s AS (
    SELECT doc_id, source, hash, nth,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           (CAST('0x' || substr(md5(concat_ws('|', '0', CAST(doc_id AS VARCHAR), hash, CAST(nullif(nth, 0) AS VARCHAR))),
                                1, 13) AS BIGINT)
            + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM numbered
), t AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
    FROM s GROUP BY source
), o AS (
    SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
           row_number() OVER (ORDER BY 3 * source_size / weight, source) AS nth,
           coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
           sum(weight) OVER (ORDER BY 3 * source_size / weight, source
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
    FROM t
), l AS (
    SELECT *, (total - full_before)::DOUBLE / weight_left::DOUBLE AS level FROM o
), p AS (
    SELECT source, source_size,
           least(cap::DOUBLE, weight * (SELECT arg_min(level, nth) FROM l WHERE cap >= weight * level)) AS target
    FROM l
), q AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM p
), r AS (
    SELECT *, CAST(floor(ratio) AS BIGINT) AS certain, target - floor(ratio) * source_size AS missing,
           ratio - floor(ratio) AS inclusion
    FROM q
), k AS (
    SELECT s.doc_id, s.source, s.hash, s.nth AS copy_nth, s.size, source_size, target, certain, missing,
           CASE WHEN inclusion > 0 THEN u / (1 - u) / (1.0::DOUBLE * inclusion / (1 - inclusion)) END AS odds
    FROM s JOIN r ON s.source IS NOT DISTINCT FROM r.source
), d AS (
    SELECT *, CASE WHEN odds IS NULL THEN 4503599627370496
                   ELSE CAST(floor(odds / (1 + odds) * 4503599627370496::DOUBLE) AS BIGINT) END AS pos
    FROM k
), c AS (
    SELECT *, coalesce(missing > 0 AND sum(size) OVER (PARTITION BY source ORDER BY pos) <= missing, false) AS inside
    FROM d
), g AS (
    SELECT *, missing - coalesce(sum(CASE WHEN inside THEN size END) OVER (PARTITION BY source), 0) AS gap FROM c
), e AS (
    SELECT *, row_number() OVER (PARTITION BY source, inside OR NOT (missing > 0 AND certain < 3 AND abs(size - gap) < gap)
                                 ORDER BY abs(size - gap), pos, doc_id NULLS FIRST, hash NULLS FIRST, copy_nth) AS nth
    FROM g
)
SELECT doc_id, size, source_size, target,
       CAST(size * (certain + CASE WHEN inside OR (missing > 0 AND certain < 3 AND abs(size - gap) < gap AND nth = 1)
                                   THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM e
"""
