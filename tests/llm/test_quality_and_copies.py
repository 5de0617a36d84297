"""Operators 1 and 5 against plain Python on awkward rows."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm.exact_dedup import copy_classes, dedup_report, drop_copies
from tessera.llm.quality_rules import default_rules, judge, keep_good, order_rules, with_metrics

PROSE = "the thing of erthat and one other reason for words that differ each time here or there in a line of its own "
TEXTS = [None, "", " \t\n", "one", "a b c d e f g h", "a b c d e f g h " * 3, PROSE, PROSE + "\n" + PROSE,
         "\n".join(["same line here"] * 30), "w###" * 5 + " " + "x$$$ " * 40, "LOUD!! " * 3 + PROSE.upper(),
         "é́ ß 𝒳𝒴 " + PROSE, "x" * 5000, " ".join(f"w{i}" for i in range(9000)), PROSE.title(), PROSE]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, PROSE, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept int")


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    wins = [tuple(words[i:i + 8]) for i in range(n - 7)]
    seen, hit = Counter(wins), set()
    for i, w in enumerate(wins):
        if seen[w] > 1:
            hit.update(range(i, i + 8))
    n_sym = sum(text.count(c) for c in "#*$%&|<>")
    failed = n < 20 or 100 * len(hit) > 30 * n
    chars, dup = sum(map(len, words)), len(lines) - len(set(lines))
    bad = (10 * n_sym > 3 * n or chars < 2 * n or chars > 25 * n or (len(lines) >= 4 and 10 * dup > 3 * len(lines))
           or 10 * text.count("!") > 3 * n or sum(c.isupper() for c in text) > sum(c.islower() for c in text))
    return n, chars, n_sym, dup, len(hit), failed, not failed and not bad


def test_rules_match_brute_force(docs):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = {r["doc_id"]: tuple(r[c] for c in cols) for r in judge(docs).collect()}
    assert got == {i: brute_rules(t) for i, t in enumerate(TEXTS)} | {None: brute_rules(PROSE)}


def test_keep_good_keeps_columns_and_rows(docs):
    out = keep_good(docs)
    assert out.columns == docs.columns
    want = sorted(i for i, t in enumerate(TEXTS) if brute_rules(t)[-1])
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == want
    assert keep_good(docs.limit(0)).count() == 0 and judge(docs.limit(0)).count() == 0


def test_order_follows_rejections_per_cost(spark):
    rows = spark.createDataFrame([(i, "LOUD!! " * 30 if i % 2 else PROSE) for i in range(20)], "doc_id long, text string")
    order = [r.name for r in order_rules(with_metrics(rows, repeats=False), default_rules())]
    assert order[0] == "exclamations" and sorted(order) == sorted(r.name for r in default_rules())


def test_copies_match_brute_force(docs):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = {}
    for i, t in enumerate(TEXTS):
        groups.setdefault(low(t), []).append(i)
    want = {}
    for t, ids in groups.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        want |= {i: (max(ids), len(ids), i == max(ids), sha) for i in ids}
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
           for r in dedup_report(docs.filter("doc_id is not null")).collect()}
    assert got == want
    assert sorted(r[0] for r in drop_copies(docs.filter("doc_id is not null")).select("doc_id").collect()) == \
        sorted(i for i, w in want.items() if w[2])
    assert drop_copies(docs).columns == docs.columns


def test_prefix_ties_are_told_apart_by_whole_text(spark):
    rows = [(i, "p" * 400 + c) for i, c in enumerate("abca")]
    got = copy_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(0, 3, 2), (3, 3, 2)]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_report(none).count() == 0 and drop_copies(none).count() == 0


def test_many_copies_are_one_class(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(PROSE).alias("text"))
    got = dedup_report(rows).groupBy("keep_id", "group_size").count().collect()
    assert [tuple(r) for r in got] == [(2999, 3000, 3000)]


def test_repeated_rows_and_ids(spark):
    """Repeated rows, and one id with different texts."""
    rows = [(1, "same", "b")] * 3 + [(1, "other", "x"), (2, "Same", "c"), (2, "Same", "c"), (2, "same", "d"),
            (3, "alone", "e"), (3, "alone", "e"), (1, "alone!", "f"), (None, "same", "g"), (None, "same", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    got = sorted((r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in dedup_report(docs).collect())
    assert got == sorted([(1, 2, 8, False)] * 3 + [(2, 2, 8, True)] * 3 + [(0, 2, 8, False)] * 2
                         + [(3, 3, 2, True)] * 2 + [(1, 1, 1, True)] * 2)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.filter("doc_id IS NOT NULL").collect())) == \
        [(1, "alone!", "f"), (1, "other", "x"), (2, "Same", "c"), (3, "alone", "e")]
    assert left.filter("doc_id IS NULL").count() == 2
