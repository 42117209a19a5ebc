"""Exact top-k by integer inner product on a bit-sliced index."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.llm import vectors
from lumetric.llm.vectors import aligned

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Slices:
    """Rows as bit slices: slice (j, b) is the bitmap of bit b of component j, over its least value."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, (self.rows, self.width) = ids, values.shape
        self.least = values.min(axis=0)
        above = (values - self.least).astype(np.uint64)
        self.bits = max(1, int(above.max(initial=0)).bit_length())
        self.words = -(-self.rows // 64)
        self.valid = self.bitmap(np.ones(self.rows, bool))
        slices = np.stack(
            [
                self.bitmap((above[:, j] >> np.uint64(b)) & np.uint64(1))
                for j in range(self.width)
                for b in range(self.bits)
            ]
        ) if self.width else np.zeros((0, self.words), np.uint64)
        # The complement of each slice follows, for components to be subtracted.
        self.slices = np.concatenate([slices, slices ^ FULL])

    def bitmap(self, flags: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.words * 64, np.uint8)
        padded[: self.rows] = flags
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def positions(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def signed_digits(q: int) -> list[tuple[int, int]]:
    """q as few (sign, power of two): 7 = 8 - 1."""
    sign, q, at, found = (1 if q > 0 else -1), abs(q), 0, []
    while q:
        if q & 1:
            digit = 2 - (q & 3)  # 1, or -1 where another one follows
            found.append((sign * digit, at))
            q -= digit
        q >>= 1
        at += 1
    return found


def sum_slices(index: Slices, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """The bit slices of every row's inner product less a constant, and that constant.

    Each signed digit of a query component adds the component's slices, shifted;
    a negative one adds their complement instead, which differs by a constant.
    Bitmaps of equal weight are added by full adders, three to a sum and a carry,
    from the lowest weight upward.
    """
    constant = int((query.astype(object) * index.least.astype(object)).sum()) if index.width else 0
    rows: dict[int, list[int]] = {}
    half = index.width * index.bits
    for j, q in enumerate(query.tolist()):
        for sign, at in signed_digits(int(q)):
            if sign < 0:
                constant -= ((1 << index.bits) - 1) << at
            first = j * index.bits + (half if sign < 0 else 0)
            for b in range(index.bits):
                rows.setdefault(at + b, []).append(first + b)
    sums, carried, weight = [], [], 0
    while rows or carried:
        parts = carried + ([index.slices[rows.pop(weight)]] if weight in rows else [])
        carried, weight = [], weight + 1
        if not parts:
            sums.append(np.zeros(index.words, np.uint64))
            continue
        at = np.concatenate(parts) if len(parts) > 1 else parts[0]
        while len(at) > 2:
            t = len(at) // 3
            x, y, z = at[:t], at[t : 2 * t], at[2 * t : 3 * t]
            xy = x ^ y
            carried.append((x & y) | (xy & z))
            at = np.concatenate([xy ^ z, at[3 * t :]])
        if len(at) == 2:
            carried.append(at[:1] & at[1:])
            at = at[:1] ^ at[1:]
        sums.append(at[0])
    return sums, constant


def top_rows(index: Slices, sums: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k rows with the largest sums, from the most significant slice downward.

    ``sure`` rows are among the best already, ``open_`` ones tie with the k-th in
    all slices seen. What is open after the last slice ties exactly; there the
    smaller ids, which come first in a block, win.
    """
    sure, open_ = np.zeros(index.words, np.uint64), allowed
    for bits in reversed(sums):
        reached = sure | (open_ & bits)
        n = int(np.bitwise_count(reached).sum())
        if n > k:
            open_ = open_ & bits
        else:
            sure, open_ = reached, open_ & ~bits
            if n == k:
                open_ = np.zeros_like(open_)
                break
    first = index.positions(sure)
    return np.r_[first, index.positions(open_)[: k - len(first)]]


def search(
    df: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block: int = 16_384,
    chunk: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest integer inner product.

    Components x become floor(scale * x). Queries are the rows whose id is
    divisible by ``every``; candidates are all rows with another id, ties going to
    the smaller one. Vectors that are null or hold a null or non-finite component
    take no part, nor do null ids; shorter vectors are filled with zeros. Of rows
    that repeat an id the least vector asks, all are candidates. With fewer than k
    candidates all are returned; no rows give no rows; other columns are ignored.
    Products must stay below 2 ** 53.
    """
    rows = vectors.rows_of(df, id_column, vector_column).withColumn(
        "v", F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    )
    blocks = vectors.packed(rows, block, "slices")
    chunks = vectors.packed(vectors.queries_of(rows, every), chunk, "queries")

    def prepare(ids, matrix):
        return Slices(ids, matrix.astype(np.int64))

    def hits(index, ids, matrix):
        asked, found, scores = [], [], []
        for query_id, query in zip(ids.tolist(), aligned(matrix, index.width).astype(np.int64)):
            sums, constant = sum_slices(index, query)
            allowed = index.valid & ~index.bitmap(index.ids == query_id)
            chosen = top_rows(index, sums, allowed, k)
            word, bit = chosen // 64, (chosen % 64).astype(np.uint64)
            score = [0] * len(chosen)
            for weight, bits in enumerate(sums):
                ones = (bits[word] >> bit) & np.uint64(1)
                score = [s + (int(one) << weight) for s, one in zip(score, ones)]
            asked += [query_id] * len(chosen)
            found += index.ids[chosen].tolist()
            scores += [float(s + constant) for s in score]
        return asked, found, scores

    return vectors.nearest(vectors.search(blocks, chunks, prepare, hits), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast("long").alias("score")
    )


ORACLE = """
WITH r AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(
        CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM r AS q JOIN r AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), t AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM s
)
SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score FROM t WHERE nth <= 5
"""
