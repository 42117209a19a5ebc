"""Token-ID output: documents as separately compressed id arrays behind one shared dictionary."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumetric.llm.common import encoder, sampled, texts_of

SEGMENT = (
    "part int, segment int, start long, doc_ids array<long>, ends array<long>, "
    "lengths array<long>, dictionary string, width int, data binary"
)
DOCUMENT = "part int, doc_id long, start long, n_tokens long, ids binary"


def write_store(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int = 1,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 2,
    level: int = 3,
    sample_rows: int = 2000,
    dictionary_bytes: int = 112_640,
    segment_bytes: int = 4 << 20,
) -> None:
    """Encode every text whole and write the ids, in ascending id order, below ``path``.

    Layout: ``dictionary`` holds one row (sha256, bytes): a zstandard dictionary
    trained on the serialized id arrays of a bounded sample (``sample_rows``
    documents, of each at most 64 KiB). ``segments`` holds rows of about
    ``segment_bytes``: consecutive documents, each compressed on its own with
    that dictionary, with the hash of the dictionary, the documents' ids, the
    byte offset after each frame and the token counts. One document is read by
    slicing its frame out of ``data``. Ids are little-endian unsigned integers of
    ``width`` bytes (2 while the vocabulary has at most 65,536 ids).

    A null or empty text is the end id alone. A null id comes first. Rows of
    equal id are ordered by text; equal rows follow each other. Other columns
    are ignored. An empty table gives an empty store. One shuffle moves the
    texts into id order; rows of one id, however many, spread over partitions.
    """
    spark = docs.sparkSession
    kind = "<u2" if width == 2 else "<u4"
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )

    def ids_of(texts: list[str]) -> Iterator[bytes]:
        for ids in encoder(vocabulary).encode(texts):
            yield np.append(ids, np.uint32(end_id)).astype(kind).tobytes()

    def serialized(batches):
        for batch in batches:
            cut = [x[: 64 << 10] for x in ids_of(texts_of(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary())], ["ids"])

    sample = sampled(rows, sample_rows, F.col("doc_id")).select("text")
    samples = [bytes(r.ids) for r in sample.mapInArrow(serialized, "ids binary").collect()]
    trained = train_dictionary(samples, dictionary_bytes)
    sha = hashlib.sha256(trained).hexdigest()
    spark.createDataFrame([(sha, bytearray(trained))], "sha256 string, dictionary binary").write.parquet(
        f"{path}/dictionary"
    )

    def segments(batches):
        compressor = _compressor(trained, level)
        held: list[tuple[int | None, bytes, int]] = []
        size = number = start = 0
        part = None

        def flush():
            nonlocal held, size, number, start
            lengths = [n for _, _, n in held]
            row = {
                "part": part, "segment": number, "start": start,
                "doc_ids": [d for d, _, _ in held],
                "ends": np.cumsum([len(f) for _, f, _ in held]).tolist(),
                "lengths": lengths, "dictionary": sha, "width": width,
                "data": b"".join(f for _, f, _ in held),
            }
            held, size, number, start = [], 0, number + 1, start + sum(lengths)
            return _batch([row])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, raw in zip(doc_ids, ids_of(texts_of(batch.column("text")))):
                frame = compressor.compress(raw)
                held.append((doc_id, frame, len(raw) // width))
                size += len(frame)
                if size >= segment_bytes:
                    yield flush()
        if held:
            yield flush()

    (
        rows.withColumn("_text", F.xxhash64("text"))
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "_text", "_row")
        .sortWithinPartitions("doc_id", "_text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
        .mapInArrow(segments, SEGMENT)
        .write.option("compression", "none")
        .parquet(f"{path}/segments")
    )


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; with too little to train on, the samples themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _compressor(dictionary: bytes, level: int):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=level, dict_data=known)


def _decompressor(dictionary: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=known)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {
        "part": pa.int32(), "segment": pa.int32(), "start": pa.int64(),
        "doc_ids": pa.list_(pa.int64()), "ends": pa.list_(pa.int64()),
        "lengths": pa.list_(pa.int64()), "dictionary": pa.string(), "width": pa.int32(),
        "data": pa.binary(),
    }
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(kinds.items())))


def dictionary_of(spark: SparkSession, path: str) -> tuple[str, bytes]:
    """The hash and bytes of a store's dictionary, a single row of bounded size."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    return row.sha256, bytes(row.dictionary)


def read_store(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids of each document.

    ``ids`` are little-endian unsigned 32-bit integers. With ``doc_ids``, only
    those documents: their segments are found by the id column, and only their
    frames are decompressed. A segment written with another dictionary fails.
    """
    sha, dictionary = dictionary_of(spark, path)
    segments = spark.read.parquet(f"{path}/segments")
    totals = segments.groupBy("part").agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    )
    # One row per written partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    wanted = None if doc_ids is None else set(doc_ids)
    if doc_ids is not None:
        segments = segments.where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, doc_ids)).cast("array<long>")))

    def documents(batches):
        decompressor = _decompressor(dictionary)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != sha:
                    raise ValueError(f"segment needs dictionary {row['dictionary']}")
                kind = "<u2" if row["width"] == 2 else "<u4"
                ends, lengths = row["ends"], np.array(row["lengths"], np.int64)
                starts = row["start"] + np.cumsum(lengths) - lengths
                keep = [i for i, d in enumerate(row["doc_ids"]) if wanted is None or d in wanted]
                for a in range(0, len(keep), 1000):
                    some = keep[a : a + 1000]
                    ids = []
                    for i in some:
                        frame = row["data"][ends[i - 1] if i else 0 : ends[i]]
                        raw = decompressor.decompress(frame)
                        ids.append(np.frombuffer(raw, kind).astype("<u4").tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["part"]] * len(some), pa.int32()),
                            pa.array([row["doc_ids"][i] for i in some], pa.int64()),
                            pa.array(starts[some], pa.int64()),
                            pa.array(lengths[some], pa.int64()),
                            pa.array(ids, pa.binary()),
                        ],
                        ["part", "doc_id", "start", "n_tokens", "ids"],
                    )

    found = segments.mapInArrow(documents, DOCUMENT)
    return found.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids"
    )
