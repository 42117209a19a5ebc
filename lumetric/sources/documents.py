"""JSON documents larger than a row: a file of one object to one small object for each of its keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumetric.session import settle

BLOCK = ["file", "block"]


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.translate(text, character, ""))


def _depth(bare: Column, inside: bool) -> Column:
    """Brackets opened less those closed outside of strings, for text that starts inside one or not."""
    code = F.regexp_replace(F.concat(F.lit('"' if inside else ""), bare), '"[^"]*+(?:"|$)', "")
    return _count(code, "[{") - _count(code, "]}")


def _before(blocks: DataFrame, column: str) -> Column:
    """The sum of a block's column over the earlier blocks of its file."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def split_objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, doc): each top-level entry of each file's object as a JSON object by itself.

    Spark cuts the files into blocks and those at commas, in as many tasks as the
    bytes ask for. Whether a comma separates entries of the outermost object
    depends on all text before it: on the quotes, which tell strings from the
    rest, and on the brackets outside of strings. Both are running sums inside a
    block, to which the sums of the blocks before it are added, so that no task
    holds more than a block and no row more than an entry.

    Of repeated keys the last stays, as when the object is parsed as a whole. A file
    that holds anything but an object, an empty one included, is one row. Where
    a file is broken so is at least one of its rows; the others may be sound.
    What follows the object's end is ignored, as Spark's parser does.
    Files without text give no rows.
    """
    lines = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    bare = lines.withColumn("bare", F.regexp_replace("value", r"(?s)\\.", ""))
    states = bare.select(
        *BLOCK,
        "at",
        "value",
        _count(F.col("bare"), '"').alias("quotes"),
        _depth(F.col("bare"), False).alias("outside"),
        _depth(F.col("bare"), True).alias("inside"),
    )
    so_far = Window.partitionBy(*BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = so_far.rowsBetween(Window.unboundedPreceding, -1)
    # Depths for a block that starts outside of strings, and for one that starts inside.
    local = states.withColumns(
        {
            "first": F.coalesce(F.sum("quotes").over(earlier), F.lit(0)),
            "quotes_so_far": F.sum("quotes").over(so_far),
        }
    )
    even = F.col("first") % 2 == 0
    local = settle(
        local.withColumns(
            {
                "depth_0": F.sum(F.when(even, F.col("outside")).otherwise(F.col("inside"))).over(so_far),
                "depth_1": F.sum(F.when(even, F.col("inside")).otherwise(F.col("outside"))).over(so_far),
            }
        ).select(*BLOCK, "at", "value", "quotes_so_far", "depth_0", "depth_1"),
        "fragments",
    )
    blocks = local.groupBy(*BLOCK).agg(
        F.max("quotes_so_far").alias("quotes"),
        F.max_by("depth_0", "at").alias("depth_0"),
        F.max_by("depth_1", "at").alias("depth_1"),
        F.min_by("value", "at").rlike(r"^\s*+\{").alias("object"),
    )
    blocks = blocks.withColumn("quotes_before", _before(blocks, "quotes"))
    odd = F.col("quotes_before") % 2 == 1
    blocks = blocks.withColumn("depth", F.when(odd, F.col("depth_1")).otherwise(F.col("depth_0")))
    starts = blocks.select(
        *BLOCK,
        odd.alias("odd"),
        _before(blocks, "depth").alias("depth"),
        F.first("object").over(Window.partitionBy("file").orderBy("block")).alias("object"),
    )
    depth = F.col("depth") + F.when(F.col("odd"), F.col("depth_1")).otherwise(F.col("depth_0"))
    quoted = (F.col("quotes_so_far") + F.col("odd").cast("long")) % 2 == 1
    ends = settle(
        local.join(starts, BLOCK).select(
            *BLOCK, "at", "value", "object", (F.col("object") & ~quoted & (depth == 1)).cast("long").alias("ends")
        ),
        "fragments",
    )
    totals = ends.groupBy(*BLOCK).agg(F.sum("ends").alias("n"), F.max_by("ends", "at").alias("tail"))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # No comma follows the last fragment, at whatever depth a broken file leaves it.
    last = F.sum("n").over(in_file) - F.last("tail").over(in_file)
    totals = totals.select(*BLOCK, _before(totals, "n").alias("n"), last.alias("last"))
    nth = F.col("n") + F.coalesce(F.sum("ends").over(earlier), F.lit(0))
    part = F.struct("block", "at", "value")
    entries = (
        ends.join(totals, BLOCK)
        .select("file", nth.alias("nth"), "last", "object", part.alias("part"))
        .groupBy("file", "nth")
        .agg(
            F.max("last").alias("last"),
            F.max("object").alias("object"),
            F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["value"]), ",").alias("entry"),
        )
    )
    # Only what begins with a key is put into braces; all else, as after two commas, stays broken.
    key = F.col("entry").rlike(r'^\s*+"')
    whole = F.concat(
        F.when((F.col("nth") > 0) & key, "{").otherwise(""),
        "entry",
        F.when(F.col("object") & (F.col("nth") < F.col("last")), "}").otherwise(""),
    )
    docs = entries.select("file", "nth", whole.alias("doc"))
    docs = settle(docs.withColumn("key", F.coalesce(F.get(F.json_object_keys("doc"), F.lit(0)), "doc")), "entries")
    last = docs.groupBy("file", "key").agg(F.max("nth").alias("nth")).select("file", "nth")
    return docs.join(last, ["file", "nth"], "left_semi").select("file", "doc")
