"""Each stage, and the whole, against plain Python on the smallest tables."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from lumetric.llm import language, mixing
from tests.llm.conftest import SF
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    folder, docs, made = tmp_path_factory.mktemp("stages"), documents, [documents]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        made.append(docs)
    return made


def test_stages_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "SimHash near-dedup", "mixing sources", "best-fit packing",
    ]
    assert all(sorted(docs.columns) == sorted(stages[0].columns) for docs in stages[:-1])


def test_language_keeps_clean_documents(stages):
    before, after = ({r.doc_id: r for r in docs.collect()} for docs in stages[:2])
    assert set(after) <= set(before) and len(after) >= 0.97 * len(before)
    assert all(after[i] == before[i] for i in after)
    assert all(not language.LETTER.search(before[i].text or "") or len(before[i].text) < 200 for i in set(before) - set(after))


def test_lines(stages):
    want = brute_lines([(r.doc_id, r.text) for r in stages[1].collect()])
    got = [(r.doc_id, r.text, r.n_chars) for r in stages[2].collect()]
    sizes = {r.doc_id: r.n_chars for r in stages[1].collect()}
    assert sorted(got) == sorted((d, t, len(t) if n else sizes[d]) for d, t, n in want)


def test_one_of_each_group(stages):
    rows = sorted(stages[2].collect(), key=lambda r: r.doc_id)
    labels = brute_components(np.array([brute_fingerprint(r.text) for r in rows], np.uint64), 3)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({rows[i].doc_id for i in labels})


def test_mix(stages):
    copies = Counter(r.doc_id for r in stages[4].collect())
    want = {r.doc_id: r.copies for r in mixing.mix(stages[3]).collect()}
    assert copies == Counter(want)


def test_packing(stages):
    rows = stages[5].collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in stages[4].collect())
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in pieces) <= 2048 for pieces in by.values())
    assert len(by) <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1


def test_run_gives_the_same(spark, stages):
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    got = corpus_pipeline.run(spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[5].select(*columns).collect()))


def test_odd_rows_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect() is not None
