"""Approximate nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.llm import vectors
from lumetric.llm.common import sampled
from lumetric.llm.vectors import aligned, best
from lumetric.session import settle

BITS, PARTS = 64, 4  # four substrings of 16 bits


@dataclass
class Codes:
    """Learned binary codes: the signs of centred vectors after a rotation."""

    norm: float
    mean: np.ndarray
    rotation: np.ndarray
    # The largest component of all vectors: squares of components over it neither overflow nor all vanish.
    unit: float = 1.0

    def lifted(self, matrix: np.ndarray, as_query: bool = False) -> np.ndarray:
        """Unit vectors whose angles follow inner products.

        Rows get one component that fills them up to the largest norm; queries,
        whose length does not matter, are normalised and get a zero.
        """
        if as_query:
            matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
            norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
            return np.hstack([matrix / norms, np.zeros_like(norms)])
        matrix = matrix / self.unit
        norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
        return np.hstack([matrix / self.norm, np.sqrt(np.maximum(0, 1 - (norms / self.norm) ** 2))])

    def of(self, matrix: np.ndarray, as_query: bool = False) -> np.ndarray:
        turned = (self.lifted(matrix, as_query) - self.mean) @ self.rotation
        return np.packbits(turned > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def learn_codes(sample: np.ndarray, norm: float, rounds: int = 30, seed: int = 0, unit: float = 1.0) -> Codes:
    """Principal directions, then the rotation that brings the vectors closest to their signs."""
    rng = np.random.default_rng(seed)
    codes = Codes(norm, np.zeros(sample.shape[1] + 1), np.eye(sample.shape[1] + 1), unit)
    lifted = codes.lifted(sample)
    mean = lifted.mean(axis=0)
    _, _, directions = np.linalg.svd(np.cov((lifted - mean).T, bias=True).reshape(len(mean), -1))
    kept = directions[:BITS].T
    if kept.shape[1] < BITS:  # few dimensions: more directions than there are
        more = kept @ rng.normal(size=(kept.shape[1], BITS - kept.shape[1])) / np.sqrt(kept.shape[1])
        kept = np.hstack([kept, more])
    flat = (lifted - mean) @ kept
    turn = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.sign(flat @ turn).T @ flat)
        turn = (u @ v).T
    return Codes(norm, mean, kept @ turn, unit)


def learn_radius(codes: Codes, sample: np.ndarray, k: int, recall: float, most: int = 300) -> int:
    """The least Hamming radius that holds ``recall`` of the k nearest, measured within the sample."""
    asking = sample[:: max(1, len(sample) // most)][:most]
    products = (asking / codes.unit) @ (sample / codes.unit).T
    near = np.argsort(-products, axis=1, kind="stable")[:, 1 : k + 1]
    apart = np.bitwise_count(codes.of(asking, as_query=True)[:, None] ^ codes.of(sample)[near])
    return int(np.quantile(apart, recall, method="higher")) if apart.size else BITS


class Index:
    """The codes of a block with a table of rows for each 16-bit substring."""

    def __init__(self, codes: Codes, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix, self.codes = ids, matrix, codes.of(matrix)
        self.tables = []
        for part in range(PARTS):
            sub = (self.codes >> np.uint64(16 * part)).astype(np.uint16)
            order = np.argsort(sub, kind="stable")
            values, firsts = np.unique(sub[order], return_index=True)
            self.tables.append((order, values, np.r_[firsts, len(sub)]))

    def within(self, code: int, radius: int) -> np.ndarray:
        """Positions of every code within ``radius``: by the pigeonhole one of its substrings is near.

        A code that differs in at most ``radius`` bits differs in at most
        radius // PARTS of them in some substring, so probing each table up to
        that distance misses none; the whole code decides.
        """
        seen = np.zeros(len(self.codes), bool)
        for part, (order, values, firsts) in enumerate(self.tables):
            sub = np.uint16(code >> 16 * part & 0xFFFF)
            probed = np.bitwise_count(values ^ sub) <= radius // PARTS
            seen[order[np.repeat(probed, np.diff(firsts))]] = True
        some = np.flatnonzero(seen)
        return some[np.bitwise_count(self.codes[some] ^ np.uint64(code)) <= radius]


def search(
    df: DataFrame,
    k: int = 20,
    every: int = 20,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    sample_rows: int = 20_000,
    recall: float = 0.96,
    block: int = 16_384,
    chunk: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id, score: k rows of large inner product, exact scores in double.

    Codes and the Hamming radius that holds ``recall`` of the k nearest are fitted
    on at most about ``sample_rows`` vectors; every row is indexed. Each
    block retrieves all rows within the radius of a query and reranks them by
    their vectors. Queries that found fewer than k rows in all ask again with a
    larger radius, until they have k or the radius takes in everything.

    Queries are the rows whose id is divisible by ``every``, candidates all rows
    with another id, ties going to the smaller one. Null and zero vectors, those
    with a null or non-finite component, and null ids take no part; shorter
    vectors are filled with zeros. Of rows that repeat an id the least vector
    asks. Components of any finite size take part; a product beyond doubles is
    infinite, and minus infinity where infinities of both signs meet. No rows give
    no rows; other columns are ignored.
    """
    rows = vectors.rows_of(df, id_column, vector_column).where(F.exists("v", lambda x: x != 0))
    spark = df.sparkSession
    blocks = vectors.packed(rows, block, "codes")
    unit, width = rows.agg(F.max(F.array_max(F.transform("v", F.abs))), F.max(F.size("v"))).first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.lit(unit)) * (x / F.lit(unit)))
    norm = rows.agg(F.sqrt(F.max(square))).first()[0]
    taken = sampled(rows, sample_rows, F.col("id")).select("v").collect()
    sample = np.zeros((len(taken), width))
    for row, r in zip(sample, taken):
        row[: len(r.v)] = r.v
    codes = learn_codes(sample, norm, unit=unit)
    radius = learn_radius(codes, sample, k, recall)

    def prepare(ids, matrix):
        return Index(codes, ids, aligned(matrix, width))

    def ask(queries: DataFrame, radius: int) -> DataFrame:
        def hits(index, ids, matrix):
            asked, found, scores = [], [], []
            matrix = aligned(matrix, width)
            for query_id, query, code in zip(ids.tolist(), matrix, codes.of(matrix, True).tolist()):
                near = index.within(code, radius)
                near = near[index.ids[near] != query_id]
                # Row by row, so that equal vectors get equal scores wherever they are.
                with np.errstate(over="ignore", invalid="ignore"):
                    score = (index.matrix[near] * query).sum(axis=1)
                # Infinities of both signs have no sum.
                score[np.isnan(score)] = -np.inf
                top = best(score, index.ids[near], k)
                asked += [query_id] * len(top)
                found += index.ids[near[top]].tolist()
                scores += score[top].tolist()
            return asked, found, scores

        chunks = vectors.packed(queries, chunk, "queries")
        return settle(vectors.nearest(vectors.search(blocks, chunks, prepare, hits), k), "hits")

    queries, answers = vectors.queries_of(rows, every), []
    while True:
        found = ask(queries, radius)
        answers.append(found)
        if radius >= BITS:
            break
        full = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
        lacking = queries.join(full, "id", "left_anti")
        if lacking.isEmpty():
            break
        answers[-1] = found.join(full, F.col("query_id") == F.col("id"), "left_semi")
        queries, radius = settle(lacking, "lacking"), min(BITS, radius + 8)
    result = answers[0]
    for more in answers[1:]:
        result = result.union(more)
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
