import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lumetric.llm import bitslice, hashing
from tests.llm.conftest import SF

VECTORS = "vec_id long, embedding array<float>, label int, ids int, v string"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=5)], 1, 2, "x") for i in range(120)]
    rows += [(200 + i, [1.0, 0.0, 0.5, 0.0, 0.0], None, None, None) for i in range(40)]  # ties
    rows += [(200, [1.0, 0.0, 0.5, 0.0, 0.0], 1, 2, "x")] * 3  # repeated rows
    rows += [(300, None, 1, 2, "x"), (400, [1.0, None, 0.0, 0.0, 0.0], 1, 2, "x")]
    rows += [(500, [float("nan")] * 5, 1, 2, "x"), (600, [float("inf")] * 5, 1, 2, "x"), (700, [0.0] * 5, 1, 2, "x")]
    rows += [(800, [], 1, 2, "x"), (900, [2.0, 1.0], 1, 2, "x"), (None, [1.0] * 5, 1, 2, "x")]
    return spark.createDataFrame(rows, VECTORS)


def vectors(df, zero):
    """(id, vector) of the rows that take part, shorter ones filled up."""
    found = []
    for r in df.select("vec_id", "embedding").collect():
        v = r.embedding
        if r.vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        if zero or any(v):
            found.append((r.vec_id, np.pad(np.array(v, float), (0, max(0, 5 - len(v))) if len(v) < 5 else 0)))
    return found


def brute(rows, every, k, change=lambda x: x):
    got = {}
    for q in sorted({i for i, _ in rows if i % every == 0}):
        query = change(min((v.tolist() for i, v in rows if i == q)))
        hits = sorted((-float((np.array(query) * change(v)).sum()), i) for i, v in rows if i != q)[:k]
        got[q] = [(i, -s) for s, i in hits]
    return got


def ranked(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def quantised(x):
    return np.floor(np.array(x) * 256)


@pytest.mark.parametrize("block", [16_384, 16])
def test_bit_slices_exactly(odd_vectors, block):
    got = ranked(bitslice.search(odd_vectors, block=block, chunk=3, every=10).collect())
    assert got == brute(vectors(odd_vectors, zero=True), 10, 5, quantised)


def test_bit_slices_sql(embeddings):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = bitslice.search(embeddings).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(db.execute(bitslice.ORACLE).fetchall())


def test_signed_digits():
    for q in range(-3000, 3000):
        digits = bitslice.signed_digits(q)
        assert sum(s << at if s > 0 else -(1 << at) for s, at in digits) == q
        assert all(b - a > 1 for (_, a), (_, b) in zip(digits, digits[1:]))


@pytest.mark.parametrize("few", [0, 3])
def test_fewer_candidates_than_asked_for(spark, few):
    df = spark.createDataFrame([(i * 50, [1.0, float(i)], 1, 1, "x") for i in range(few)], VECTORS)
    for search in (bitslice.search, hashing.search):
        got = ranked(search(df).collect())
        assert {q: len(hits) for q, hits in got.items() if q % 100 == 0} == {i * 50: 2 for i in range(few) if i % 2 == 0}


def test_codes_within_radius_are_all_found():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(3000, 24))
    codes = hashing.learn_codes(sample, float(np.sqrt((sample**2).sum(1).max())))
    index = hashing.Index(codes, np.arange(3000), sample)
    for code in index.codes[::300].tolist():
        for radius in (0, 3, 10, 22, 40, 64):
            want = np.flatnonzero(np.bitwise_count(index.codes ^ np.uint64(code)) <= radius)
            assert index.within(code, radius).tolist() == want.tolist()


def test_recall_and_exact_scores(embeddings):
    rows = vectors(embeddings, zero=False)
    want = brute(rows, 20, 20)
    got = ranked(hashing.search(embeddings).collect())
    assert set(got) == set(want) and all(len(hits) == 20 for hits in got.values())
    matrix = dict(rows)
    assert all(s == pytest.approx((matrix[q] * matrix[i]).sum(), abs=1e-12) for q, hits in got.items() for i, s in hits)
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 20 * len(want)


def test_hashing_odd_rows(odd_vectors):
    got = ranked(hashing.search(odd_vectors, block=16, every=10).collect())
    want = brute(vectors(odd_vectors, zero=False), 10, 20)
    assert set(got) == set(want) and all(len(hits) == 20 for hits in got.values())
    # Ties go to the smaller ids.
    tied = [i for i, _ in got[210] if 200 <= i < 240]
    assert tied == [i for i, _ in want[210] if 200 <= i < 240]


def test_lengths_that_differ_much(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(
        [(i, [float(x) for x in rng.normal(size=8) * rng.lognormal()], 1, 1, "x") for i in range(800)], VECTORS
    )
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in df.where(F.col("vec_id").isNotNull()).collect()]
    want, got = brute(rows, 20, 20), ranked(hashing.search(df, every=20).collect())
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("sizes", [[1e200], [1e-200], [1e200, 1e-200, 1.0], [1e-310, 1e300]])
def test_vectors_of_great_and_tiny_components(spark, sizes):
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(120, 6)) * np.array(sizes)[np.arange(120) % len(sizes)][:, None]
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], "vec_id long, embedding array<double>")
    found = hashing.search(df, k=20, every=20).collect()
    assert {r.query_id for r in found} == set(range(0, 120, 20))
    assert all(sum(r.query_id == q for r in found) == 20 for q in range(0, 120, 20))
