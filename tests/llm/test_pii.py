import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import TESTDATA
from llm_edges import clashing, edge, none  # noqa: F401
from sunledger.llm import pii as P

KEY = b"a test key"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 5000])
def test_feistel_is_a_permutation(size):
    image = [P.feistel(i, size, KEY, "t") for i in range(size)]
    assert sorted(image) == list(range(size))
    assert [P.feistel(v, size, KEY, "t", back=True) for v in image] == list(range(size))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**24 - 1), st.integers(1, 10**24))
def test_large_domains_turn_back(value, size):
    value %= size
    assert P.feistel(P.feistel(value, size, KEY, "x"), size, KEY, "x", back=True) == value


FOUND = {
    "4111 1111 1111 1111": "card",
    "378282246310005": "card",
    "alice.b+7@Mail.example.com": "email",
    "+1 (017) 555-7713": "phone",
    "+49 30 1234567": "phone",
    "(555) 123-4567": "phone",
    "123-45-6789": "social",
    "10.20.30.40": "ipv4",
    "DE89 3704 0044 0532 0130 00": "iban",
    "GB82WEST12345698765432": "iban",
    "2024-02-29": "date",
    "02/29/2024": "date",
    "25/12/2020": "date",
    "31.12.1999": "date",
    "1850-01-01": "date",
}
LEFT = ["4111111111111112", "999.1.1.1", "2023-02-29", "000-12-3456", "DE88 3704 0044 0532 0130 00", "1234", "a@b", "0000000000000000"]


@pytest.mark.parametrize("value", FOUND)
def test_values_change_within_their_format_and_turn_back(value):
    text = f"It says {value}, they say."
    (start, end, kind, new), = P.found(text, KEY)
    assert (text[start:end], kind) == (value, FOUND[value]) and new != value
    made = P.replaced(text, P.found(text, KEY))
    if kind != "ipv4":
        assert re.sub(r"\w", "x", new) == re.sub(r"\w", "x", value)
    (_, _, again, _), = P.found(made, KEY)  # still valid, of the same kind
    assert again == kind and P.replaced(made, P.found(made, KEY, back=True)) == text
    assert P.found(text, b"another key")[0][3] != new


@pytest.mark.parametrize("value", LEFT)
def test_what_is_not_valid_stays(value):
    assert P.found(f"It says {value}, they say.", KEY) == []


def test_equal_values_stay_linked():
    pseudonym = lambda text: P.found(text, KEY)[0][3]
    assert P.digits_of(pseudonym("x 4111-1111-1111-1111")) == P.digits_of(pseudonym("y 4111111111111111 z"))
    y, m, d = pseudonym("born 1999-12-31").split("-")
    assert pseudonym("on 31.12.1999") == f"{d}.{m}.{y}" and pseudonym("12/31/1999") == f"{m}/{d}/{y}"
    assert pseudonym("Ann@x.org").lower() == pseudonym("ann@X.org").lower()
    assert len({pseudonym(f"10.0.0.{i}") for i in range(256)}) == 256


def test_neighbours_do_not_hide_each_other():
    text = "+1 (826) 555-7713 190.137.223.204 5105105105105100 4111111111111111"
    assert [k for _, _, k, _ in P.found(text, KEY)] == ["phone", "ipv4", "card", "card"]


def test_query_turns_back(spark):
    """Over all documents: the texts come back with the key, nothing else changed, and no found value is left."""
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text")
    before = {r.doc_id: r.text for r in docs.collect()}
    out = entry.queries()["op8_pii"](spark, f"{TESTDATA}/sf0.01")
    after = {r.doc_id: r for r in out.collect()}
    back = {r.doc_id: r.text for r in P.pseudonymise(out, back=True).select("doc_id", "text").collect()}
    assert back == before
    values = 0
    for doc_id, r in after.items():
        for kind, start, end in (s.split(":") for s in filter(None, r.spans.split(","))):
            values += 1
            assert r.text[int(start) : int(end)] != before[doc_id][int(start) : int(end)] or kind == "date"
    assert values == sum(getattr(r, f"n_{kind}") for r in after.values() for kind in P.KINDS) > 50


def test_edges_of_the_input(edge, clashing, none):
    got = P.pseudonymise(clashing).collect()
    want = [(t[0], P.replaced(t[1], P.found(t[1], P.DEMO_KEY)) if t[1] else t[1]) for t in map(tuple, edge.collect())]
    assert sorted([(r.doc_id, r.text) for r in got], key=str) == sorted(want, key=str)
    assert P.pseudonymise(none).count() == 0
