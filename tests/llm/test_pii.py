"""Operator 3 against the patterns as written, planted disclosures, and the rewritten texts."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import pii

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
TEXTS = [None, "", "no data here", "mail a.b+c@x-y.example.com, and a@b or c@d.e.", "@@a@b.c@d.e f@g..h i@-.-",
         "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.255 9.9.9", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111",
         "call +1 (310) 555-4510 or +123 or +49 (0) 30.1234-567 8 +1", "é𝒳 x@y.zz 10.0.0.1 +12345678901 ü", "7" * 3000,
         "a" * 5000 + "@x.y", "1." * 400, "+1" * 300 + "23456789"]


def ok(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == 1:
        return all(int(p) <= 255 for p in s.split("."))
    if kind == 2:
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if ok(k, m[0]))


@pytest.mark.parametrize("text", TEXTS[1:])
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a1239@.+- ()é%", max_size=40))
def test_base_spans_random(text):
    assert pii.base_spans(text) == brute(text)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", None) for i, t in enumerate(TEXTS)] + [(None, "z@y.xx", "y", 1), (None, None, None, None)]
    # "zanzibar" stands near one address in different contexts; "common" stands near it too, but everywhere else as well
    rows += [(100 + i, f"w{i} q{i} zanzibar common box@secret.example word{i} more{i}", "s", 1) for i in range(5)]
    rows += [(200 + i, f"common words of nothing {i} and common again number{i}", "s", 1) for i in range(300)]
    rows += [(600 + i, "raretok copy@only.example rarer", "s", 1) for i in range(20)]  # copies: one context
    return spark.createDataFrame(rows, "doc_id long, text string, key string, term int")


def test_report(docs):
    got = {r["doc_id"]: r for r in pii.report(docs).collect() if r["doc_id"] is not None}
    for i, t in enumerate(TEXTS):
        spans = brute(t or "")
        form = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(form.encode()).hexdigest() and r["spans"] == form
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == j for _, k, _ in spans) for j in range(4)]
    for i in range(5):
        a = len(f"w{i} q{i} ")
        assert got[100 + i]["spans"].split(",")[0] == f"term:{a}:{a + 8}" and got[100 + i]["n_term"] == 1
    assert all(got[200 + i]["spans"] == "" for i in range(300)) and all(got[600 + i]["n_term"] == 0 for i in range(20))
    assert pii.report(docs).count() == docs.count() and pii.report(docs.limit(0)).count() == 0


def test_sanitise(docs):
    out = pii.sanitise(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] is not None}
    assert got[0] is None and got[2] == TEXTS[2] and got[203] == "common words of nothing 3 and common again number3"
    assert got[3] == "mail [EMAIL], and a@b or [EMAIL]." and got[102] == "w2 q2 [TERM] common [EMAIL] word2 more2"
    assert out.count() == docs.count() and pii.sanitise(docs.limit(0)).count() == 0


def test_overlapping_spans_are_one():
    assert pii.generalise("ab12345cd", [(2, 2, 6), (4, 3, 7), (7, 0, 9)]) == "ab[CARD][EMAIL]"


def test_occurrences_in_one_document_count_once(spark):
    """A word beside an address many times in one log is together with it in one document only."""
    log = " ".join(f"a{i} harmless 10.0.0.1 b{i} c{i} d{i} e{i} f{i} g{i} h{i} i{i}" for i in range(200))
    rows = [(0, log)] + [(i, f"x{i} 10.0.0.1 y{i}") for i in range(1, 20)]
    rows += [(i, f"harmless words {i}") for i in range(20, 40)] + [(i, f"nothing {i}") for i in range(40, 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.report(docs).filter("n_term > 0").isEmpty()


def test_a_told_term_is_marked_in_every_document(spark):
    """An entity of one document, and one of two: their own words disclose them, also where the entity is not named."""
    rows = [(0, "quixotl reach me@rare.example zorblat"), (1, "about Zorblat, and nothing else"), (2, "x pair@two.example fendrik"),
            (3, "y9 pair@two.example Fendrik here"), (4, "z fendrik! alone")]
    rows += [(10 + i, f"reach here about nothing and alone else {i}") for i in range(70000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in pii.report(docs).filter("doc_id < 10 OR n_term > 0").collect()}
    terms = {i: [s.split(":")[1:] for s in r["spans"].split(",") if s.startswith("term")] for i, r in got.items()}
    text = dict(rows)
    assert {i: [text[i][int(a):int(b)] for a, b in v] for i, v in terms.items()} == {
        0: ["quixotl", "zorblat"], 1: ["Zorblat"], 2: ["fendrik"], 3: ["Fendrik"], 4: ["fendrik"]}
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).filter("doc_id < 10").collect()}
    assert out[1] == "about [TERM], and nothing else" and out[0] == "[TERM] reach [EMAIL] [TERM]"


def test_bloom_finds_every_term(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    terms = [int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 3000)]
    table = pii.bloom(spark.createDataFrame([(t,) for t in terms], "term long"), 1 << 16)
    held = lambda h: all(table[p >> 3] >> (p & 7) & 1 for p in pii._bit_places(h % (1 << 64), 1 << 16))
    assert all(map(held, terms)) and sum(map(held, range(0, 1 << 62, 1 << 50))) < 400
