"""Files to DataFrames."""

from __future__ import annotations

import csv
import io

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetric.functions import heads, numbers, text
from lumetric.operators.rows import keep_first
from lumetric.session import file_exists
from lumetric.sources import schemas
from lumetric.sources.documents import split_objects


def csv_headers(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """(file, header): the first record of each file that has one.

    Tasks open the listed files and read their first bytes only. Where a store is
    known to Spark alone, a scan of the lines gives the same.
    """
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    found = listed.mapInArrow(
        lambda batches: heads.headers(batches, multi_line), "file string, header string, read boolean"
    )
    if found.where("not read").isEmpty():
        return found.where("header is not null").select("file", "header")
    return scanned_headers(spark, path)


def scanned_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header) by a scan of all lines; a header ends at its first line break, quoted or not."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")
    )
    starts = lines.where((F.col("at") == 0) & (F.trim("value") != ""))
    numbered = starts.withColumn("n", F.monotonically_increasing_id())
    return numbered.groupBy("file").agg(F.min_by("value", "n").alias("header"))


def read_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Headed CSV files as text columns with normalised names and missing texts as null.

    Each file is read by its own header: columns may stand in another order or
    be absent, then null. No column is typed by guessing. ``multi_line`` allows
    line breaks inside quoted fields, at the price of one task per file.
    """
    headers = csv_headers(spark, path, multi_line)
    # One row per different layout, whatever the number of files.
    layouts = sorted(r.header for r in headers.select("header").distinct().collect())
    names = {}
    for header in layouts:
        fields = next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline="")), [])
        names[header] = text.normalised(fields)
    # The usual order first: that of the layout which most columns share.
    columns = list(dict.fromkeys(c for h in sorted(layouts, key=lambda h: (-len(names[h]), h)) for c in names[h]))
    width = max(map(len, names.values()), default=0)
    rows = spark.read.schema(", ".join(f"_{i} string" for i in range(width)) or "_0 string").csv(
        path, header=True, multiLine=multi_line, escape='"'
    )
    if len(set(map(tuple, names.values()))) == 1:
        df = rows.toDF(*columns)
    else:
        kinds = F.create_map(*[F.lit(x) for i, h in enumerate(layouts) for x in (h, i)])
        of = headers.select(F.col("file").alias("_file"), kinds[F.col("header")].alias("_kind"))
        df = rows.select("*", F.col("_metadata.file_path").alias("_file")).join(of, "_file")

        def field(column: str) -> Column:
            found = F.lit(None).cast("string")
            for i, header in enumerate(layouts):
                if column in names[header]:
                    found = F.when(F.col("_kind") == i, F.col(f"_{names[header].index(column)}")).otherwise(found)
            return found

        df = df.select(*[field(c).alias(c) for c in columns])
    missing = list(schemas.NULL_TEXTS)
    return df.select([F.when(~F.col(c).isin(missing), F.col(c)).alias(c) for c in df.columns])


def latest_briefing(
    briefing: DataFrame, day_first: bool = True, by_date: bool = False
) -> DataFrame:
    """The latest submission per campaign, with dates and numbers parsed.

    Submissions compare as text, or as parsed dates with ``by_date``, nulls
    last, all columns breaking ties.
    """
    order = [F.col("submission_date").desc_nulls_last()]
    if by_date:
        parsed = numbers.date_text(F.col("submission_date").cast("string"), day_first)
        order.insert(0, parsed.desc_nulls_last())
    df = keep_first(briefing, ["campaign_id"], order)
    parsed = {
        c: numbers.date_text(F.col(c).cast("string"), day_first)
        for c in schemas.BRIEFING_DATES
        if c in df.columns
    } | {
        c: numbers.number_or_zero(F.col(c)) for c in schemas.BRIEFING_NUMBERS if c in df.columns
    }
    return df.withColumns(parsed)


def clean_events(events: DataFrame) -> DataFrame:
    """Event type stripped and lowered, browser time parsed, where present."""
    fixes = {"type": text.event_type, "browser_ts": numbers.timestamp}
    present = {c: f(F.col(c)) for c, f in fixes.items() if c in events.columns}
    return events.withColumns(present) if present else events


def load_briefing(spark: SparkSession, path: str, day_first: bool = True) -> DataFrame:
    return latest_briefing(read_csv(spark, path, multi_line=True), day_first)


def load_events(spark: SparkSession, path: str) -> DataFrame:
    """File splits take the place of read chunks."""
    return clean_events(read_csv(spark, path))


def load_design(
    spark: SparkSession, path: str, per_line: bool | None = None, by_key: bool = False
) -> DataFrame:
    """Design documents as text column ``doc``.

    By default each file shows its own layout: where every line that is not
    blank is a document by itself, each line is one, the layout for large data;
    any other file is one document as a whole. ``per_line`` says so for all
    files and saves the look at the lines. ``by_key`` takes each file as one
    document, however large, and gives a document for each of its keys.
    """
    if by_key:
        return split_objects(spark, path).select("doc")
    if per_line is not None:
        return spark.read.text(path, wholetext=not per_line).select(F.col("value").alias("doc"))

    def texts(whole: bool) -> DataFrame:
        rows = spark.read.text(path, wholetext=whole)
        return rows.select(F.col("value").alias("doc"), F.col("_metadata.file_path").alias("file"))

    lines = texts(False).where(F.trim("doc") != "")
    odd = lines.where(F.try_parse_json("doc").isNull()).select("file").distinct()
    # File names only. As literals they choose the files of a scan: none is read as a
    # whole that need not be, and no line is shuffled for its file.
    whole = [r.file for r in odd.collect()]
    if not whole:
        return lines.select("doc")
    at = F.col("file").isin(whole)
    return lines.where(~at).union(texts(True).where(at)).select("doc")


def list_files(spark: SparkSession, path: str, pattern: str = "*", nested: bool = False) -> DataFrame:
    """(path, length) of the files in a folder, and below it if ``nested``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", nested)
        .load(path)
        .select("path", "length")
    )


def source_sizes(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def image_registry(files: DataFrame, strict_request_id: bool = True) -> DataFrame:
    """Names, keys, placement and size of image files."""
    named = files.withColumn("filename", F.substring_index("path", "/", -1))
    slug, request = text.split_filename(F.col("filename"), strict_request_id)
    keyed = named.select("*", slug.alias("slug"), request.alias("request_id"))
    return keyed.select(
        "filename",
        F.col("path").alias("filepath"),
        "slug",
        "request_id",
        text.placement(F.col("slug")).alias("placement_type"),
        numbers.kilobytes(F.col("length")).alias("file_size_kb"),
    )


def list_images(
    spark: SparkSession, path: str, strict_request_id: bool = True, nested: bool = False
) -> DataFrame:
    return image_registry(list_files(spark, path, "*.png", nested), strict_request_id)


def load_images(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """Decoded images of the same files; an unreadable file gives height -1, not an error."""
    images = (
        spark.read.format("image")
        .option("pathGlobFilter", "*.png")
        .option("recursiveFileLookup", nested)
        .load(path)
    )
    # This source gives the path as a URI, the file listing gives it plain.
    escaped = F.replace(F.substring_index("image.origin", "/", -1), F.lit("+"), F.lit("%2B"))
    return images.select(
        F.url_decode(escaped).alias("filename"),
        "image.height",
        "image.width",
        F.col("image.nChannels").alias("n_channels"),
        "image.data",
    )


def load_results(spark: SparkSession, path: str) -> DataFrame:
    """Model comparison documents, one row per file, models as a map."""
    return spark.read.schema(schemas.RESULTS).option("multiLine", True).json(path)


def load_all(
    spark: SparkSession, paths: dict[str, str], design_per_line: bool | None = None
) -> dict[str, DataFrame]:
    """Every source named in ``paths``: briefing, events, design, images."""
    readers = {
        "briefing": load_briefing,
        "events": load_events,
        "design": lambda s, p: load_design(s, p, design_per_line),
        "images": list_images,
    }
    return {name: readers[name](spark, path) for name, path in paths.items()}


def finished(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame | None:
    """The output at ``path``, or None where there is none or its writer did not finish.

    Spark's writers leave ``_SUCCESS`` when all tasks have committed.
    """
    if not file_exists(spark, f"{path}/_SUCCESS"):
        return None
    reader = spark.read.schema(schemas.RESULTS) if kind == "json" else spark.read
    try:
        return reader.format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
