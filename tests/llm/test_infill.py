import hashlib
import re

import pytest

from lumetric.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return (doc_id, n, "plain", None, None, text)
    if h[3] % 100 < 80:
        return (doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def compare(df):
    found = infill.transform(df).collect()
    texts = df.select("doc_id", "text").collect()
    key = lambda row: tuple((x is not None, x) for x in row)
    rows = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found]
    assert sorted(rows, key=key) == sorted([brute(*t) for t in texts], key=key)
    assert all(r.restored == r.text for r in found)
    return found


def test_documents(documents):
    found = compare(documents)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_odd_rows(odd):
    assert len(compare(odd)) == odd.count()


def test_empty(empty):
    assert infill.report(infill.transform(empty)).collect() == []


PIECES = ["", " ", "\t\n", "a", "é\U0001f600", "<", "<P", "P>", "S>x", "M>", "$1 \\2", " x", " <S> ", "<<M>>", "z\x1c\x85"]


@pytest.mark.parametrize("rotated", range(3))
def test_texts_like_sentinels(spark, rotated):
    rows = [
        (i, "".join(PIECES[(i * (k + 1) + k * rotated) % len(PIECES)] for k in range(i % 9)))
        for i in range(1500)
    ]
    compare(spark.createDataFrame(rows, "doc_id long, text string"))


def test_texts_of_very_many_units(spark):
    rows = [(i, " ".join(["w\n x"] * 200_000) + "  ") for i in range(12)]
    rows += [(20 + i, "a" * 3_000_000 + " " * 1_000_000) for i in range(6)]
    found = compare(spark.createDataFrame(rows, "doc_id long, text string"))
    assert max(r.n for r in found) == 400_001
    assert {r.form for r in found} >= {"plain", "spm"}


def test_other_settings(documents):
    all_moved = infill.transform(documents, seed=7, percent=100, suffix_first_percent=0).collect()
    assert {r.form for r in all_moved if r.text} == {"psm"}
    assert all(r.restored == r.text for r in all_moved)
