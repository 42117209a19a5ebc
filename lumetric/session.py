"""Session set-up and the shared folder for fitted or staged intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lumetric")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lumetric-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/lumetric/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder, in folders ``by``, and read it back.

    Cuts the lineage at a table that outlives any executor, gives later joins
    the real size of the data, and keeps column pruning for later readers.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables below the shared folder; for the owner of a finished run."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/lumetric")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def file_exists(spark: SparkSession, name: str) -> bool:
    """Whether there is a file or folder of this name, in any store that Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def together(spark: SparkSession, *actions: Callable[[], Any], at_once: int = 4) -> list[Any]:
    """Results of independent actions whose jobs share the cluster at the same time."""
    with ThreadPool(min(at_once, len(actions))) as pool:
        run = inheritable_thread_target(spark)(lambda action: action())
        return pool.map(run, actions, chunksize=1)
