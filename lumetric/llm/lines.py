"""Line deduplication by overlapping three-line windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def dedupe_lines(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Remove later occurrences of three consecutive lines that occurred before.

    Lines end at newlines. Every three consecutive lines are a window, known by
    a 128-bit hash; windows of blank lines only don't count. The first
    occurrence of a window, by document id (null first), then text hash, then
    line, stays. Later ones cover their three lines, and every covered line
    goes. Where a window overlaps its own first occurrence, as in a run of
    equal lines, the lines of that first occurrence stay.

    Returns all columns with the shortened text and ``lines_removed`` (long).
    Texts of fewer than three lines, and null or empty ones, stay as they are;
    rows of equal id and text are one document and are treated alike. The work
    on a text grows with its lines, however many of them go.
    Repeated windows are found by a partial count before the shuffle, so a window
    in a third of all documents sends one row a task; its occurrences meet that
    count in a join which the adaptive skew join can split. Columns of any
    other name may be present.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_column}`").alias("id"),
        F.md5(F.col(f"`{text_column}`")).alias("hash"),
    )
    text = F.col("row").getField(text_column)
    windows = (
        rows.where(text.isNotNull())
        .select("id", "hash", F.split(text, "\n", -1).alias("lines"))
        .where(F.size("lines") >= WINDOW)
        .select(
            "id",
            "hash",
            F.transform("lines", lambda x: F.md5(x)).alias("line"),
            F.transform("lines", lambda x: F.trim(x) != "").alias("full"),
        )
        .select(
            "id",
            "hash",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.size("line") - (WINDOW - 1)),
                    lambda i: F.struct(
                        (i - 1).alias("at"),
                        F.unhex(
                            F.md5(F.concat(*[F.element_at("line", i + k) for k in range(WINDOW)]))
                        ).alias("window"),
                        F.greatest(*[F.element_at("full", i + k) for k in range(WINDOW)]).alias("full"),
                    ),
                )
            ).alias("w"),
        )
        .where("w.full")
        .select("id", "hash", "w.at", "w.window")
    )
    repeated = (
        windows.groupBy("window")
        .agg(F.min(F.struct("id", "hash", "at")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("window", "first")
    )
    own = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash"))
    beyond = F.when(own, F.greatest("at", F.col("first.at") + WINDOW)).otherwise(F.col("at"))
    covered = (
        windows.join(repeated, "window")
        .where(~(own & (F.col("at") == F.col("first.at"))))
        .select("id", "hash", beyond.alias("low"), (F.col("at") + WINDOW - 1).alias("high"))
        .where("low <= high")
        .groupBy("id", "hash")
        # Sets merge before the shuffle, so copies of a row add nothing to its group.
        .agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
        .select(
            "id",
            "hash",
            F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["low"], r["high"])))).alias("gone"),
        )
    )

    def without(lines: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(lines) - 1)
        return F.array_join(F.transform(F.array_except(places, "gone"), lambda i: F.get(lines, i)), "\n")

    # A lambda's variable holds the lines, which are else split again for every line.
    kept = F.get(F.transform(F.array(F.split(text, "\n", -1)), without), 0)
    joined = rows.alias("d").join(
        covered.select(F.col("id").alias("cid"), F.col("hash").alias("chash"), "gone"),
        F.col("id").eqNullSafe(F.col("cid")) & (F.col("hash") == F.col("chash")),
        "left",
    )
    shortened = F.when(F.col("gone").isNull(), text).otherwise(kept)
    return joined.select(
        *[
            (shortened if c == text_column else F.col("row").getField(c)).alias(c)
            for c in docs.columns
            if c != "lines_removed"
        ],
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("lines_removed"),
    )


ORACLE = """
WITH d AS (
    SELECT DISTINCT doc_id, md5(text) AS hash, string_split(text, chr(10)) AS lines
    FROM documents WHERE text IS NOT NULL
), pos AS (
    SELECT *, unnest(range(1, len(lines) - 1)) AS i FROM d WHERE len(lines) >= 3
), w AS (
    SELECT doc_id, hash, i, lines[i] || chr(10) || lines[i + 1] || chr(10) || lines[i + 2] AS body
    FROM pos
    WHERE trim(lines[i], ' ') <> '' OR trim(lines[i + 1], ' ') <> '' OR trim(lines[i + 2], ' ') <> ''
), f AS (
    SELECT *, row_number() OVER s AS nth, first_value(doc_id) OVER s AS d1,
           first_value(hash) OVER s AS h1, first_value(i) OVER s AS i1
    FROM w WINDOW s AS (PARTITION BY body ORDER BY doc_id NULLS FIRST, hash, i)
), c AS (
    SELECT DISTINCT doc_id, hash, i + k AS line
    FROM f, (SELECT unnest([0, 1, 2]) AS k)
    WHERE nth > 1 AND NOT (doc_id IS NOT DISTINCT FROM d1 AND hash = h1 AND i + k <= i1 + 2)
), l AS (
    SELECT doc_id, hash, lines, unnest(range(1, len(lines) + 1)) AS line FROM d
), kept AS (
    SELECT l.doc_id, l.hash, count(c.line) AS lines_removed,
           coalesce(string_agg(l.lines[l.line], chr(10) ORDER BY l.line) FILTER (c.line IS NULL), '') AS text
    FROM l LEFT JOIN c ON l.doc_id IS NOT DISTINCT FROM c.doc_id AND l.hash = c.hash AND l.line = c.line
    GROUP BY l.doc_id, l.hash
)
SELECT o.doc_id, CASE WHEN o.text IS NULL THEN NULL ELSE k.text END AS text,
       coalesce(k.lines_removed, 0) AS lines_removed
FROM documents o LEFT JOIN kept k ON o.doc_id IS NOT DISTINCT FROM k.doc_id AND md5(o.text) = k.hash
"""
