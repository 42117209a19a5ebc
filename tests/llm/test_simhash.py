import numpy as np
import pytest
import xxhash

from lumetric.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits):
    """Labels by searching all pairs."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= bits).tolist():
            a, b = root(i), root(j)
            label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_documents_against_all_pairs(documents):
    rows = simhash.near_duplicates(documents).orderBy("doc_id").collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert [r.fp % 2**64 for r in rows] == [brute_fingerprint(texts[r.doc_id]) for r in rows]
    labels = brute_components(np.array([r.fp % 2**64 for r in rows], np.uint64), 3)
    assert [r.component_id for r in rows] == [rows[i].doc_id for i in labels]
    assert len(set(labels)) < len(labels)


def near(rng, n, bits):
    """Chains and balls of fingerprints around some centres, with hot halves."""
    centres = rng.integers(0, 2**63, n // 20, dtype=np.uint64)
    fps = centres[rng.integers(0, len(centres), n)]
    for _ in range(bits):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    same_half = np.uint64(0x1234567800000000) | rng.integers(0, 2**32, n // 2, dtype=np.uint64)
    return np.unique(np.concatenate([fps, same_half, centres]))


@pytest.mark.parametrize("bits", [1, 3, 4])
def test_shards_find_every_link(spark, bits):
    rng = np.random.default_rng(bits)
    fps = near(rng, 1500, bits)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = simhash.links(df, bits, leaf=64, sample_rows=600)
    forest = simhash.Forest(len(fps))
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    pairs = np.array([(place[r.a], place[r.b]) for r in edges.collect()])
    assert (np.bitwise_count(fps[pairs[:, 0]] ^ fps[pairs[:, 1]]) > 0).all()
    forest.join(pairs[:, 0], pairs[:, 1])
    want = np.array(brute_components(fps, bits))
    assert (forest.label == want).all() and len(set(want.tolist())) < len(want)


def test_leaf_recursion_finds_every_link():
    fps = near(np.random.default_rng(9), 4000, 3)
    forest = simhash.Forest(len(fps))
    every = np.arange(len(fps))
    for half in (False, True):
        simhash.join_leaf(fps, every, every[:0], half, 3, forest)
    whole = simhash.Forest(len(fps))
    for i in range(0, len(fps), 100):
        a, b = np.nonzero(np.bitwise_count(fps[i : i + 100, None] ^ fps[None, :]) <= 3)
        whole.join(a + i, b)
    assert (forest.label == whole.label).all()


def test_connected_on_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200), (7, 7)]
    got = dict(map(tuple, simhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}, 201: 200}


def test_odd_rows(odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert {c for i in (3, 4, 8) for _, c in of[i]} == {3}  # no words: fingerprint 0
    assert {c for i in (6, 7) for _, c in of[i]} == {6}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(
        {r.component_id if r.component_id is not None else -1 for r in rows}
    )


def test_empty(empty):
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


def test_a_leaf_joins_its_hits_beyond_the_first_chunk_of_others():
    """One home, 40,000 visitors, and the only partner among the last of them."""
    rng = np.random.default_rng(0)
    home = np.uint64(0)
    far = rng.integers(1 << 40, 1 << 63, 50_000, dtype=np.uint64) | np.uint64((1 << 40) - (1 << 30))
    fps = np.r_[home, far[np.bitwise_count(far) > 3][:39_999], np.uint64(5)]
    forest = simhash.Forest(len(fps))
    simhash.join_leaf(fps, np.array([0]), np.arange(1, len(fps)), False, 3, forest)
    assert len(fps) == 40_001
    assert np.flatnonzero(forest.label != np.arange(len(fps))).tolist() == [40_000]
    assert forest.label[40_000] == 0
