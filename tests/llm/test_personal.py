import hashlib
import re

import pytest

from lumetric.llm import personal

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def fits(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in FORMS.items() for m in re.finditer(p, text or "") if fits(k, m[0])]


def digest(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


TEXTS = [
    "a@b.c%d@e.f x@y a@b..c @x.y a.b@c-d.e.f-", "a@b.c@d.e a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.0255 01.2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "é\U0001f600 4111111111111111 \U0001f600 a@b.co",
    "+1 (555) 000-1234 +1 2 +49.30.1234567-- +1 (555) 000-1234(", "+12345678+87654321", "..1.2.3.4", "",
    "9" * 40_000, "a" * 40_000, "a@" + "b." * 20_000, "+1" + " " * 20_000, "1 " * 20_000, "1." * 20_001, "x@y.z " * 300,
    "%" * 20_000 + "@a.b", "4111 1111 1111 1111-4111 1111 1111 1111",
]


def found(df):
    return {r.doc_id: r for r in personal.report(personal.find(df)).collect()}


def test_base_forms(spark):
    got = found(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string"))
    for i, text in enumerate(TEXTS):
        want = brute(text)
        assert [got[i][f"n_{k}"] for k in FORMS] == [sum(s[0] == k for s in want) for k in FORMS], text[:50]
        assert got[i].base_sha256 == hashlib.sha256(digest(want).encode()).hexdigest(), text[:50]


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_tables(request, name):
    docs = request.getfixturevalue(name)
    rows = personal.report(personal.find(docs)).collect()
    want = sorted(hashlib.sha256(digest(brute(r.text)).encode()).hexdigest() for r in docs.collect())
    assert sorted(r.base_sha256 for r in rows) == want


def test_contexts_find_what_has_no_form(spark):
    """Seeds after 'reach me at' teach the pattern; an unformed number after it is found, elsewhere not."""
    texts = [f"some words, reach me at +1 (555) 010-{1000 + i} any day now" for i in range(12)]
    texts += [f"server log from host 10.0.{i}.7 with code" for i in range(12)]
    texts += ["please reach me at 555-010-7788 today", "we counted 555-010-9999 things", "host 10:0:3:9 was down"]
    texts += ["ordinary words at the desk", "nothing here"] * 5
    got = found(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    assert got[24].spans == "phone:19:31" and got[24].n_phone == 0 and got[24].n_found == 1
    assert got[25].spans == "" and got[27].spans == ""
    assert got[26].spans == "ip:5:13"
    assert all(got[i].spans == digest(brute(texts[i])) for i in range(24))


def test_instance_carries_to_other_places(spark):
    texts = [f"call now: +1 (555) 010-{1000 + i} thanks" for i in range(9)]
    texts += ["call now: 555 010 4455 thanks", "his number was 555 010 4455 then"]
    got = found(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    assert got[9].spans == "phone:10:22" and got[10].spans == "phone:15:27"


def test_common_words_and_words_after(spark):
    """A lead-in that also stands elsewhere is confident; so is a word that follows only."""
    texts = [f"mail me at +1 (555) 010-{1000 + i} today" for i in range(9)] + ["we met at noon, at home, at sea"] * 50
    texts += ["reach me at 555-010-7788", f"w{1} +44 20 7946 0123 mobile"]
    texts += [f"w{i} +44 20 7946 {1000 + i} mobile" for i in range(2, 9)] + ["no lead 020 7946 0999 mobile", "x 020 7946 0998 y"]
    got = found(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    assert got[59].spans == "phone:12:24" and got[59].n_found == 1
    assert got[len(texts) - 2].spans == "phone:8:21" and got[len(texts) - 1].spans == ""


def test_a_context_of_many_kinds_is_not_confident(spark):
    texts = [f"data +1 (555) 010-{1000 + i}" for i in range(5)] + [f"data 10.0.{i}.7" for i in range(5)]
    texts += ["data 555-010-7788", "data 10:0:3:9"]
    got = found(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    assert got[10].spans == got[11].spans == ""


def test_empty(empty):
    assert personal.find(empty).collect() == []
