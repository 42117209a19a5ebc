import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lumetric.llm import common
from lumetric.llm import tokens
from lumetric.llm.common import ChunkEncoder

WORDS, BYTES = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def plain(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda t: tokenizer.encode(t, add_special_tokens=False).ids


TEXTS = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a\n\n b", "a \n b\n", "tab\t\n\n x", "it's we're I'LL 'tis",
    "x  y \n z", "\x01 \x01\x01 b", "café CAFÉ é İ Σσς",
    "<|endoftext|> <|startoftext|>", "12 345 6,7.8", "漢字 \U0001f600\U0001f600", "a" * 5000, "\x1c a\x85b \x0b\x0c",
    "H̱ K Å", "word " * 300 + "\n" * 5 + "end",
]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_chunks_give_the_ids_of_whole_texts(path, documents):
    texts = TEXTS + [r.text for r in documents.limit(60).collect()]
    want = [plain(path)(t) for t in texts]
    encoder = ChunkEncoder(path, limit=500)
    for _ in range(3):  # known, unknown and dropped chunks
        assert [x.tolist() for x in encoder.encode(texts)] == want
    assert [x.tolist() for t in texts for x in encoder.encode([t])] == want


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_random_texts_of_one_byte_characters(path):
    rng = np.random.default_rng(8)
    common = list("  \n\n'aeslltvrdmXY09.,-!") + ["'s", "'re", "'LL", " '", "ß", "é"]
    rare = [chr(c) for c in range(0x21, 0x100) if not chr(c).isspace()] + ["\x01", "\x1b", "Ā", "漢", "\U0001f600"]
    texts = []
    for i in range(1500):
        letters = common if i % 3 == 0 else common + rare[:-3] if i % 3 == 1 else common + rare
        texts.append("".join(letters[k] for k in rng.integers(0, len(letters), rng.integers(1, 40))))
    encoder, want = ChunkEncoder(path), plain(path)
    assert [x.tolist() for x in encoder.encode(texts)] == [want(t) for t in texts]


def test_added_tokens_are_encoded_as_the_library_does():
    for path, ids in ((BYTES, [31373, 220, 50256, 995]), (WORDS, plain(WORDS)("hello <|endoftext|> world"))):
        assert [x.tolist() for x in ChunkEncoder(path).encode(["hello <|endoftext|> world"])] == [ids]


def store(docs, tmp_path, **options):
    tokens.write_store(docs, str(tmp_path / "store"), WORDS, **options)
    return str(tmp_path / "store")


def expected(docs):
    encode = plain(WORDS)
    rows = sorted(((r.doc_id is not None, r.doc_id, encode(r.text or "") + [1]) for r in docs.collect()), key=lambda r: (r[0], r[1] or 0))
    result, start = [], 0
    for _, doc_id, ids in rows:
        result.append((doc_id, start, len(ids), ids))
        start += len(ids)
    return result


@pytest.mark.parametrize("options", [{}, {"width": 4}, {"segment_bytes": 1000, "sample_rows": 20}])
def test_round_trip(spark, documents, tmp_path, options):
    path = store(documents, tmp_path, **options)
    found = tokens.read_store(spark, path).orderBy("start").collect()
    got = [(r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in found]
    assert got == expected(documents)


def test_short_document_access(spark, documents, tmp_path):
    path = store(documents, tmp_path, segment_bytes=1000)
    want = {r[0]: r for r in expected(documents)}
    found = tokens.read_store(spark, path, doc_ids=[3, 150, 10**9]).collect()
    assert sorted(r.doc_id for r in found) == [3, 150]
    for r in found:
        assert (r.start, np.frombuffer(r.ids, "<u4").tolist()) == (want[r.doc_id][1], want[r.doc_id][3])


def test_segment_of_another_dictionary_fails(spark, documents, tmp_path):
    path = store(documents.limit(20), tmp_path)
    other = spark.createDataFrame([("0" * 64, bytearray(b"x"))], "sha256 string, dictionary binary")
    other.write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(Exception, match="needs dictionary"):
        tokens.read_store(spark, path).collect()


def test_odd_rows(spark, odd, tmp_path):
    found = tokens.read_store(spark, store(odd, tmp_path)).collect()
    got = sorted((r.doc_id or -1, r.n_tokens, zlib.crc32(r.ids)) for r in found)
    want = [(d or -1, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for d, _, n, ids in expected(odd)]
    assert got == sorted(want)
    spans = sorted((r.start, r.n_tokens) for r in found)
    assert [s for s, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]


def test_empty_table(spark, empty, tmp_path):
    assert tokens.read_store(spark, store(empty, tmp_path)).collect() == []


def test_a_worker_returns_the_memory_of_what_it_drops():
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 / 1e6

    common.resident(("many",), lambda: [bytes(1000) for _ in range(200_000)])
    last = [bytes(1000) for _ in range(10)]  # the heap's end stays in use
    before = held()
    common.forget()
    assert common.resident(("many",), list) == [] and len(last) == 10
    assert before - held() > 150
