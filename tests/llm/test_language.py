import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumetric.llm import language


def test_backpropagation_through_time_matches_differences():
    rng = np.random.default_rng(1)
    params = {k: v.astype(np.float64) for k, v in language.initial(3, 4, seed=1).items()}
    x, lengths = language.padded([b"abca", b"xyz", b"b"])
    labels = np.array([0, 1, 2])
    loss, grads = language.gradients(params, x, lengths, labels)
    for name in params:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in params[name].shape)
            if name[1:] == "x":
                at = (int(rng.choice(x[x > 0])), at[1])
            shifted = []
            for step in (1e-3, -1e-3):
                moved = {k: v.copy() for k, v in params.items()}
                moved[name][at] += step
                shifted.append(language.gradients(moved, x, lengths, labels)[0])
            assert grads[name][at] == pytest.approx((shifted[0] - shifted[1]) / 2e-3, abs=2e-3)


def test_documents_pool_every_position():
    params = language.initial(4, 8, seed=3)
    labeller = language.Labeller(params, limit=10)
    texts = ["some words and some more words", "x" * 100 + " tail é", "word", "some"]
    for _ in range(3):
        got = labeller.documents(texts)
        for text, row in zip(texts, got):
            probs = []
            for window in language.windows_of(text):
                x, lengths = language.padded([window])
                probs += list(language.positions(params, x, lengths)[0][0])
            assert len(probs) == len(text.encode().replace(b" ", b""))
            assert row == pytest.approx(np.mean(probs, axis=0), abs=1e-5)


def test_held_out_accuracy(documents):
    rows = language.identify(documents).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(rows) == documents.count() and held
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_teach_nothing(documents):
    kept = documents.where(~language.held_out(F.col("doc_id")))
    changed = documents.withColumn(
        "lang", F.when(language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))
    )
    first, second = language.fit(kept), language.fit(changed)
    assert first[0] == second[0]
    assert all((first[1][k] == second[1][k]).all() for k in first[1])


def test_odd_rows(odd, empty):
    rows = language.identify(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by[i].lang_pred for i in (3, 4, 8)} == {"und"} and by[3].score == 0
    assert {r.lang_pred for r in rows} <= {"und", "de", "en", "fr"}
    assert language.identify(empty).collect() == []


def test_nothing_to_learn_from(odd):
    blank = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(blank).collect()} == {"und"}
