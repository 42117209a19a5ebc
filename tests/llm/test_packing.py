import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lumetric.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def least_bins(items, capacity):
    best = len(items)
    items = sorted(items, reverse=True)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i]:
                rooms[k] -= items[i]
                go(i + 1, rooms)
                rooms[k] += items[i]
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best


def contents(plan):
    return Counter(x for filling, times in plan for x in filling * times)


def test_bin_completion_is_optimal_on_small_sets():
    random.seed(3)
    better = 0
    for _ in range(200):
        capacity = random.choice([20, 60])
        items = [random.randint(max(1, capacity // 7), capacity // 2 + 2) for _ in range(random.randint(1, 9))]
        counts = Counter(items)
        plan = packing.complete_bins(counts, capacity)
        assert contents(plan) == counts and all(sum(f) <= capacity for f, _ in plan)
        assert packing.bins(plan) == least_bins(items, capacity) >= packing.lower_bound(counts, capacity)
        better += packing.bins(plan) < packing.bins(packing.best_fit(counts, capacity))
    assert better


def test_counts_of_any_size():
    counts = {x: 10**9 + 7 * x for x in range(1, 400)}
    plan = packing.complete_bins(counts, 1000, nodes=50)
    total = Counter()
    for filling, times in plan:
        assert sum(filling) <= 1000
        for x in filling:
            total[x] += times
    assert total == counts
    assert packing.bins(plan) <= 1.001 * packing.lower_bound(counts, 1000)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_pieces_that_go_together_badly(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randint(400, 1000) for _ in range(3000))
    plan = packing.complete_bins(counts, 2048)
    assert contents(plan) == counts and all(sum(f) <= 2048 for f, _ in plan)
    assert packing.bins(plan) <= 1.02 * packing.lower_bound(counts, 2048)
    assert packing.bins(packing.best_fit(counts, 2048)) > 1.06 * packing.lower_bound(counts, 2048)


def test_the_search_ends_with_whole_packings():
    counts = {x: 1 + x % 3 for x in range(3, 60)}
    for steps in (0, 1, 50, 5_000):
        plan = packing.complete_bins(counts, 100, steps=steps)
        assert contents(plan) == Counter(counts) and all(sum(f) <= 100 for f, _ in plan)


def test_undominated_fillings():
    assert packing.fillings({6: 1, 4: 1, 3: 2, 2: 1}, [6, 4, 3, 2], 12) == [(6, 4, 2), (6, 3, 3)]
    counts = {7: 1, 5: 1, 3: 2, 2: 1}
    found = packing.fillings(counts, sorted(counts, reverse=True), 12)
    assert found == [(7, 5)]  # any other can be replaced by the single piece


def valid(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_documents(documents, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in documents.collect()}
    rows = packing.place(packing.cut(documents, PATH, capacity), capacity).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, {})[r.piece] = r
    for doc_id, want in ids.items():
        pieces = [got[doc_id][i] for i in range(len(got[doc_id]))]
        assert [x for p in pieces for x in np.frombuffer(p.ids, "<u4").tolist()] == want
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert len(pieces) == -(-len(want) // capacity) and all(p.length == capacity for p in pieces[1:])
    sequences = valid(rows, capacity)
    assert sequences <= 1.02 * -(-sum(map(len, ids.values())) // capacity) + 1


def test_odd_rows(odd):
    rows = packing.place(packing.cut(odd, PATH, 64), 64).collect()
    valid(rows, 64)
    assert len({(r.doc_id, r.piece) for r in rows if r.doc_id == 2}) * 2 == sum(r.doc_id == 2 for r in rows)
    assert {(r.doc_id, r.length) for r in rows if r.doc_id in (3, 4)} == {(3, 1), (4, 1)}


def test_empty_and_wrong_lengths(spark, empty):
    assert packing.place(packing.cut(empty, PATH)).collect() == []
    with pytest.raises(ValueError, match="lengths"):
        packing.place(spark.createDataFrame([(1, 65)], "doc_id long, length long"), 64)
