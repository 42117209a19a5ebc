import time

import duckdb
import pytest

from lumetric.llm import lines
from tests.llm.conftest import SF


def brute(rows):
    """The definition, row by row, for rows without repeated (id, text)."""
    import hashlib

    def order(r):
        return (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest())

    first, gone = {}, {}
    for r in sorted({(d, t) for d, t in rows if t is not None}, key=order):
        split = r[1].split("\n")
        for i in range(len(split) - 2):
            window = tuple(split[i : i + 3])
            if not any(x.strip(" ") for x in window):
                continue
            if window not in first:
                first[window] = (r, i)
                continue
            low = max(i, first[window][1] + 3) if first[window][0] == r else i
            gone.setdefault(r, set()).update(range(low, i + 3))
    kept = []
    for d, t in rows:
        cut = gone.get((d, t), set())
        kept.append((d, t if not cut else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut), len(cut)))
    return kept


def found(df):
    return [(r.doc_id, r.text, r.lines_removed) for r in df.collect()]


def key(r):
    return tuple((x is None, x or "") if not isinstance(x, int) else (False, str(x)) for x in r)


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_against_brute_force(request, name):
    docs = request.getfixturevalue(name)
    got = lines.dedupe_lines(docs)
    assert got.columns == [*docs.columns, "lines_removed"]
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(found(got), key=key) == sorted(want, key=key)


def test_later_occurrences_merge(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\na\na\na\na"), (4, "a\nb"), (5, " \n\n "), (6, " \n\n ")]
    got = {r[0]: r[1:] for r in found(lines.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got[1] == ("a\nb\nc\nd", 0)
    assert got[2] == ("x\ny", 4)
    assert got[3] == ("a\na\na", 2)  # the first occurrence stays
    assert got[4] == ("a\nb", 0)
    assert got[5] == got[6] == (" \n\n ", 0)  # blank windows don't count


def test_hot_window(spark):
    rows = [(i, f"own {i}\nh1\nh2\nh3\nend {i}") for i in range(400)]
    got = found(lines.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted(r[2] for r in got) == [0] + [3] * 399


def test_many_lines(spark):
    lines_ = [f"line {i}" for i in range(200_000)]
    rows = [(1, "\n".join(lines_)), (2, "\n".join([*lines_, "own"])), (3, "\n".join(lines_[::2]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.perf_counter()
    got = {r[0]: r[1:] for r in found(lines.dedupe_lines(df))}
    assert time.perf_counter() - start < 60
    assert got[1] == (rows[0][1], 0) and got[3] == (rows[2][1], 0)
    assert got[2] == ("own", 200_000)


def test_copies_of_a_row(spark):
    rows = [(1, "a\nb\nc")] + [(2, "x\na\nb\nc")] * 300
    got = found(lines.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert sorted(got) == [(1, "a\nb\nc", 0)] + [(2, "x", 3)] * 300


def test_empty(empty):
    assert lines.dedupe_lines(empty).collect() == []


def test_sql_agrees(documents):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = [tuple(r) for r in db.execute(lines.ORACLE).fetchall()]
    assert sorted(found(lines.dedupe_lines(documents))) == sorted(want)
