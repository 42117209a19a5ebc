import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumetric.llm import toxicity
from tests.llm.conftest import SF


def brute(vectors, query, k, without=None):
    cosines = [sum(w * v.get(t, 0) for t, w in query.items()) for v in vectors]
    hits = sorted((-round(c, 12), i) for i, c in enumerate(cosines) if c > 0 and i != without)
    return [(i, -c) for c, i in hits[:k]]


@pytest.mark.parametrize("block", [1, 4, 64])
def test_block_max_search_is_exact(block):
    rng = np.random.default_rng(block)
    idf = rng.uniform(1, 5, 40)

    def random_vector():
        return toxicity.weigh({int(t): int(rng.integers(1, 9)) for t in rng.integers(0, 40, rng.integers(0, 6))}, idf)

    vectors = [random_vector() for _ in range(300)]
    vectors += vectors[:20]  # ties
    known = toxicity.index(vectors, [i % 2 for i in range(len(vectors))], list(range(len(vectors))), 40, block)
    ordered = [vectors[i] for i in known.ids]
    for k in (1, 5, 400):
        for query in [random_vector() for _ in range(30)] + [{}, {39: 1.0}]:
            at, cosines = known.nearest(query, k)
            want = brute(ordered, query, k)
            assert at.tolist() == [i for i, _ in want]
            assert cosines == pytest.approx([c for _, c in want])
        at, _ = known.nearest(ordered[0], k, without=0)
        assert at.tolist() == [i for i, _ in brute(ordered, ordered[0], k, without=0)]


def test_calibration_does_not_decrease():
    rng = np.random.default_rng(0)
    votes = rng.uniform(0, 1, 500)
    levels, rates = toxicity.calibrate(votes, (rng.uniform(0, 1, 500) < votes**2).astype(float))
    assert (np.diff(rates) >= 0).all() and (np.diff(levels) >= 0).all() and 0 <= rates[0] <= rates[-1] <= 1


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF[:-5]}0.01/documents.parquet")
    labels = spark.read.parquet(f"{SF[:-5]}0.01/labels.parquet")
    return toxicity.score(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id", "left").collect()


def test_held_out_separation(scored):
    held = [r for r in scored if r.held_out and r.toxic is not None]
    bad, good = ([r.score for r in held if r.toxic == y] for y in (1, 0))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)
    wins = np.mean([(a > b) + (a == b) / 2 for a in bad for b in good])
    assert wins > 0.75
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    assert all(len(r.evidence) <= 3 for r in scored)


def test_odd_rows(spark, odd, empty):
    words = [(100 + i, f"you idiot moron number{i}" if i % 2 else f"nice calm words here number{i}", "x", "s", 1, 1, "", 1, 1, "") for i in range(60)]
    docs = odd.unionByName(spark.createDataFrame(words, odd.schema))
    kinds = "doc_id long, quality int, toxic int, id int, text string"
    rows = [(100 + i, 0, i % 2, 1, "z") for i in range(60)] + [(None, 1, 1, 1, "z"), (1, 1, None, 1, "z"), (101, 0, 0, 1, "z")]
    labels = spark.createDataFrame(rows, kinds)
    got = toxicity.score(docs, labels, least=3, chi2=3.0, lift=1.5).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[101].predicted == 1 and by[100].predicted == 0
    assert by[3].score == by[4].score and by[3].evidence == []
    assert {r.score for r in toxicity.score(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(empty, labels).collect() == []
    assert toxicity.score(empty, labels.limit(0)).collect() == []


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (toxicity.score(docs, x).orderBy("doc_id").collect() for x in (labels, flipped))
    assert [r.score for r in first] == [r.score for r in second]


def test_every_document_with_words_of_an_example_has_neighbours(spark):
    """A third and more of the labels toxic, few labels, words of any frequency."""
    texts = [(i, f"you rude fool number{i}" if i % 2 else f"calm friendly words number{i}") for i in range(40)]
    docs = spark.createDataFrame([*texts, (100, "fool"), (101, "friendly zebra"), (102, "zebra"), (103, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    by = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert all(by[i].evidence for i in [*range(40), 100, 101])
    assert by[100].score > by[101].score and {e.toxic for e in by[100].evidence} == {1}
    assert by[102].evidence == by[103].evidence == []
    assert by[101].evidence[0].cosine < by[100].evidence[0].cosine


def test_repeated_rows_are_one_example(spark):
    texts = [(i, f"you rude fool number{i}" if i % 2 else f"calm friendly words number{i}") for i in range(40)]
    docs = spark.createDataFrame(texts + [(1, "you rude fool number1")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == 90
    for r in rows:
        assert len({e.doc_id for e in r.evidence}) == len(r.evidence) == 3
