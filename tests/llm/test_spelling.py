import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lumetric.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def brute_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            for c in letters:
                yield word[:i] + c + word[i + 1 :]


def brute_variants(words):
    letters = sorted(set("".join(words)))
    rows, forms = {}, {}
    for word, n in words.items():
        near = {w for w in edits(word, letters) if w in words and w != word}
        best = min(near, key=lambda w: (-words[w], w), default=None)
        forms[word] = best if best and words[best] >= 2 * n else None
        rows[word] = [n, len(near), words[best] if forms[word] else None]
    for word in words:
        root = word
        while forms[root]:
            root = forms[root]
        rows[word] = (word, forms[word], root, *rows[word])
    return sorted(rows.values())


def compare(df, **settings):
    found = spelling.variants(df, **settings)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = brute_variants(brute_words(df.select("doc_id", "text").collect()))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == wanted
    return wanted


def test_documents(documents):
    wanted = compare(documents)
    assert len(wanted) > 100 and any(r[1] for r in wanted)


def test_documents_in_small_cells(documents):
    compare(documents, cell_rows=40, sample_rows=300)


def test_odd_rows_and_no_rows(odd, empty):
    compare(odd)
    assert spelling.variants(empty).collect() == []


def drawn(seed, alphabet, sizes, n):
    """Words of few letters, hence with many near words, chains, anagrams and ties."""
    rng = np.random.default_rng(seed)
    words = {"".join(rng.choice(list(alphabet), rng.choice(sizes))) for _ in range(n)}
    return sorted(words), rng


@pytest.mark.parametrize("seed, alphabet, sizes", [(1, "abcé", [5, 6, 7]), (2, "ab", [9, 10, 11]), (3, "xyzÿ×", [5, 6])])
def test_crowded_words(spark, seed, alphabet, sizes):
    words, rng = drawn(seed, alphabet, sizes, 700)
    counts = [int(n) for n in 3 * 2 ** rng.integers(0, 7, len(words))]
    rows = [(w, n) for w, n in zip(words, counts)]
    found = spelling.near_words(spark.createDataFrame(rows, "word string, n long"), cell_rows=30, sample_rows=200).collect()
    wanted = brute_variants(dict(rows))
    got = sorted((r.word, r.form, r.n, r.n_near, r.form_n) for r in found)
    assert [(a, b, n, m, f) for a, b, _, n, m, f in wanted] == got


def test_anagrams_fill_several_blocks(spark):
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.permutation(list("aaaabbbbcc"))) for _ in range(400)})
    words += sorted({"".join(rng.permutation(list("aaaabbbbc"))) for _ in range(200)})
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    trees, blocks = spelling.cells_of(df, 50, 100)
    assert not trees and all(n > 1 for n in blocks.values()) and blocks
    found = spelling.near_words(df, cell_rows=50, sample_rows=100).collect()
    wanted = brute_variants({w: 3 for w in words})
    assert sorted((r.word, r.n_near) for r in found) == [(r[0], r[4]) for r in wanted]


def test_long_words_and_chains(spark):
    long = "ab" * 40_000
    rows = [(long, 4), (long + "c", 8), (long[:-1] + "z", 2), ("q" + long, 3)]
    chain = [("a" * (5 + i), 3 << i) for i in range(20)]
    df = spark.createDataFrame(rows + chain, "word string, n long")
    found = spelling.near_words(df)
    stars = {r.word: r.root for r in spelling.roots(found).collect()}
    assert {stars[w] for w, _ in chain[:-1]} == {chain[-1][0]}
    got = {r.word: (r.n_near, r.form, r.form_n) for r in found.collect()}
    assert got[long] == (3, long + "c", 8) and got[long[:-1] + "z"] == (1, long, 4)


def test_one_edit():
    same = [(b"abcde", b"abxde", True), (b"abcde", b"bacde", False), (b"aabbb", b"ababb", False)]
    more = [(b"abcde", b"xabcde", True), (b"abcde", b"abcdex", True), (b"aaaaa", b"aaaaaa", True), (b"abcde", b"bacdex", False)]
    for cases in (same, more):
        a, b, wanted = zip(*cases)
        assert spelling.one_edit(spelling.letters_of(a), spelling.letters_of(b)).tolist() == list(wanted)
