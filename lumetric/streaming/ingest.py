"""Chunked event loading as an incremental file stream.

The batch reader takes a whole directory. This one takes the files that have
not been loaded yet, a bounded number at a time, and stops when none is left.
The checkpoint makes a rerun or a lost executor neither skip nor repeat a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumetric.operators.rows import with_defaults
from lumetric.sources import schemas
from lumetric.sources.readers import load_events

FILES = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Paths of CSV files that appear below ``path``; their contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select("path")
    )


def load_new_events(
    spark: SparkSession, path: str, target: str, checkpoint: str, files_per_batch: int = 100
) -> StreamingQuery:
    """Add all unloaded files to the tables below ``target``, then stop.

    The batch reader reads each file by its own header. A batch writes its own
    folder and replaces it when it is repeated.
    """

    def load(batch: DataFrame, number: int) -> None:
        # At most files_per_batch paths.
        files = [r.path for r in batch.select("path").collect()]
        if files:
            events = load_events(batch.sparkSession, files)
            full = with_defaults(events, dict.fromkeys(schemas.EVENT_COLUMNS))
            rows = full.select([F.col(c).cast("timestamp_ntz" if c == "browser_ts" else "string").alias(c) for c in schemas.EVENT_COLUMNS])
            rows.write.mode("overwrite").parquet(f"{target}/load-{number}")

    return (
        new_files(spark, path, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def loaded_events(spark: SparkSession, target: str) -> DataFrame:
    """All events loaded so far."""
    return spark.read.parquet(f"{target}/load-*")
