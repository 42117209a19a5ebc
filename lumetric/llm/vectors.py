"""Vectors packed into blocks, and queries into chunks, for exact and approximate search."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumetric.session import settle

BLOCK = "ids binary, vectors binary, width int"
HIT = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Neither null nor holding null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def rows_of(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, v (array of double) of the rows that take part; null ids take none."""
    v = F.col(vector_column)
    return df.where(F.col(id_column).isNotNull() & usable(v)).select(
        F.col(id_column).cast("long").alias("id"), v.cast("array<double>").alias("v")
    )


def packed(rows: DataFrame, size: int, label: str) -> DataFrame:
    """Blocks of up to ``size`` rows in order of id, written to the shared folder.

    A block is one row: its ids (64-bit) and its vectors (double, row by row),
    shorter vectors filled with zeros.
    """

    def blocks(batches):
        ids: list[int] = []
        held: list[np.ndarray] = []

        def block():
            width = max(map(len, held))
            matrix = np.zeros((len(held), width))
            for row, v in zip(matrix, held):
                row[: len(v)] = v
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                    pa.array([matrix.tobytes()], pa.binary()),
                    pa.array([width], pa.int32()),
                ],
                ["ids", "vectors", "width"],
            )

        for batch in batches:
            vectors = batch.column("v")
            flat, ends = vectors.values.to_numpy(), vectors.offsets.to_numpy()
            for i, row_id in enumerate(batch.column("id").to_pylist()):
                ids.append(row_id)
                held.append(flat[ends[i] : ends[i + 1]].copy())
                if len(ids) == size:
                    yield block()
                    ids, held = [], []
        if ids:
            yield block()

    # Equal ids, however many, spread over partitions by their vectors and rows.
    spread = rows.withColumn("_row", F.monotonically_increasing_id())
    count = rows.count()
    ordered = spread.repartitionByRange(max(1, -(-count // size)), "id", "_row").sortWithinPartitions("id", "v")
    return settle(ordered.select("id", "v").mapInArrow(blocks, BLOCK), label)


def queries_of(rows: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``; of rows that repeat an id, the least vector."""
    return rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))


def unpack(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, np.int64)
    return numbers, np.frombuffer(vectors, np.float64).reshape(len(numbers), width)


def search(
    blocks: DataFrame, chunks: DataFrame, prepare: Callable, hits: Callable
) -> DataFrame:
    """query_id, vec_id, score: what each chunk of queries finds in each block.

    The query set meets all rows block by block; neither side passes through the
    driver or is broadcast unless small. ``prepare(ids, matrix)`` indexes a block
    once for all chunks that a task brings to it; ``hits(index, ids, matrix)``
    returns (query ids, row ids, scores), a bounded number for each query.
    """

    def found(batches):
        last, index = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["ids"] != last:
                    last, index = row["ids"], prepare(*unpack(row["ids"], row["vectors"], row["width"]))
                q, v, s = hits(index, *unpack(row["qids"], row["qvectors"], row["qwidth"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                    ["query_id", "vec_id", "score"],
                )

    asked = chunks.select(F.col("ids").alias("qids"), F.col("vectors").alias("qvectors"), F.col("width").alias("qwidth"))
    return blocks.crossJoin(asked).mapInArrow(found, HIT)


def nearest(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each query, ties to the smaller id, with their rank from 1."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        over = np.flatnonzero(scores > least)
        tied = np.flatnonzero(scores == least)
        tied = tied[np.argsort(ids[tied], kind="stable")[: k - len(over)]]
        some = np.r_[over, tied]
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def aligned(matrix: np.ndarray, width: int) -> np.ndarray:
    """The matrix with ``width`` columns: zeros added, or columns that meet only zeros dropped."""
    if matrix.shape[1] >= width:
        return matrix[:, :width]
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))
