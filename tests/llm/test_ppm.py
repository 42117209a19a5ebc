import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lumetric.llm import ppm


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


class Model:
    """A trie of dictionaries that learns text by text and counts novel symbols only."""

    def __init__(self, order):
        self.order = order
        self.counts = defaultdict(Counter)

    def symbols(self, text):
        padded = b"\xff" * self.order + text
        for i, symbol in enumerate([*text, 256]):
            yield padded[i : i + self.order], symbol

    def learn(self, text):
        for context, symbol in self.symbols(text):
            for j in range(self.order, -1, -1):
                met = self.counts[context[self.order - j :]]
                known = symbol in met
                met[symbol] += 1
                if known:
                    break

    def log10(self, text):
        total = 0.0
        for context, symbol in self.symbols(text):
            excluded = set()
            for j in range(self.order, -1, -1):
                met = self.counts.get(context[self.order - j :], {})
                left = {s: c for s, c in met.items() if s not in excluded}
                if not left:
                    continue
                n = sum(left.values())
                if symbol in left:
                    total += math.log10((2 * left[symbol] - 1) / (2 * n))
                    break
                total += math.log10(len(left) / (2 * n))
                excluded |= set(left)
            else:
                total -= math.log10(257 - len(excluded))
        return total


def brute(rows, order):
    texts = [(i, (t or "").encode().lower()) for i, t in rows]
    model, counts = Model(order), Counter()
    for i, text in texts:
        if not is_held_out(i):
            model.learn(text)
            counts.update([*text.split(), None])
    tokens, kinds = sum(counts.values()), len(counts)
    found = []
    for i, text in texts:
        words = [*text.split(), None]
        base = sum(math.log10((counts[w] + 0.5) / (tokens + 0.5 * (kinds + 1))) for w in words)
        known = sum(counts[w] > 0 for w in words)
        found.append((i, is_held_out(i), len(words), known, tokens, base, model.log10(text)))
    return found


def compare(df, order=5, **settings):
    found = ppm.score(df, order, **settings)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    key = lambda r: tuple((x is not None, x) for x in (r[0], r[2], round(r[6], 6)))
    got = sorted(map(tuple, found.collect()), key=key)
    wanted = sorted(brute(df.select("doc_id", "text").collect(), order), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in wanted], rtol=1e-9, atol=1e-9)
    return got


@pytest.mark.parametrize("order, batch_rows", [(3, 4), (5, 7), (6, 1000)])
def test_documents(documents, order, batch_rows):
    compare(documents.where("length(text) < 2500"), order, batch_rows=batch_rows, batch_bytes=30_000)


def test_busy_contexts_are_cut_deeper(documents):
    compare(documents.where("length(text) < 1500"), 5, batch_rows=20, batch_bytes=20_000, shard_bytes=10_000, group_rows=50)


def test_odd_rows_and_no_rows(odd, empty):
    compare(odd)
    assert ppm.score(empty).collect() == []


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(200) if is_held_out(i)][:3]
    got = compare(spark.createDataFrame([(i, "Ab c") for i in ids], "doc_id long, text string"))
    assert got[0][6] == pytest.approx(-5 * math.log10(257)) and got[0][3:5] == (0, 0)


def test_repeated_rows_count_again(spark):
    rows = [(2, "the cat sat")] * 50 + [(3, "the dog"), (4, None)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"), batch_rows=8, batch_bytes=100)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice(list(b"abcd e"), 60).astype(np.uint8)) for _ in range(20)]
    grams, counts = np.unique(ppm.grams_of(texts, 3)[0], return_counts=True)
    for context in (b"abc", b"zab", b"zzz", b"e a"):
        base = int.from_bytes(context) << ppm.SYMBOL_BITS
        asked, n = ppm.summed(np.r_[grams, base + np.arange(257)], np.r_[counts, np.zeros(257, int)])
        values = ppm.log_probabilities(asked, n, 3, [])
        assert (10.0 ** values[np.searchsorted(asked, base + np.arange(257))]).sum() == pytest.approx(1)


def test_language_scores_above_its_shuffled_letters(spark, documents):
    rng = np.random.default_rng(4)
    rows = [(r.doc_id, r.text) for r in documents.where("length(text) between 200 and 3000").collect()]
    mixed = [(1000 + i, "".join(rng.permutation(list(t)))) for i, t in rows if is_held_out(1000 + i)]
    scores = {r.doc_id: r for r in ppm.score(spark.createDataFrame(rows + mixed, "doc_id long, text string")).collect()}
    pairs = [(scores[i - 1000].score, scores[i].score) for i, _ in mixed]
    assert len(pairs) > 20 and all(plain > shuffled for plain, shuffled in pairs)


def test_order_has_bounds(documents):
    with pytest.raises(ValueError):
        ppm.score(documents, 2)
