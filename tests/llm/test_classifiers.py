"""Operators 8, 9 and 10: held-out accuracy, the methods' own properties, awkward rows."""

import random
import textwrap
import zlib

import numpy as np
import pytest

from tessera.llm import licences as L
from tessera.llm import quality_classifier as Q
from tessera.llm import toxicity as T
from tessera.llm.training import held_out, labelled_sample

from conftest import SF_CHECK

ODD = [(-1, None, "x", 1), (-2, "", None, None), (-3, "w " * 60000, "x", 1), (None, "some text", "x", 1), (-4, "\n \n", "x", 1)]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "source", "n_chars")
    odd = spark.createDataFrame(ODD, "doc_id long, text string, score string, _y int") \
        .selectExpr("doc_id", "text", "score AS source", "cast(_y AS long) AS n_chars")
    return docs.unionByName(odd), spark.read.parquet(f"{SF_CHECK}/labels.parquet")


def auc(rows, column):
    s = np.array([r["score"] for r in rows])
    y = np.array([r[column] for r in rows])
    rank = s.argsort().argsort() + 1
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_held_out_is_crc32_of_the_id(spark):
    rows = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_sample_is_bounded_and_never_held_out(spark, tables):
    docs, labels = tables
    rows = labelled_sample(docs, labels, "quality", 20)
    assert sum(y for _, y in rows) <= 20 and 0 < len(rows) <= 40
    allowed = {r["text"] for r in docs.join(labels, "doc_id").filter(~held_out("doc_id")).collect()}
    assert {t for t, _ in rows} <= allowed


@pytest.mark.parametrize("report, label", [(Q.report, "quality"), (T.report, "toxic")])
def test_held_out_accuracy_and_odd_rows(tables, report, label):
    docs, labels = tables
    out = report(docs, labels).cache()
    assert out.count() == docs.count() and out.filter("score IS NULL OR score < 0 OR score > 1").isEmpty()
    held = out.filter("held_out").join(labels, "doc_id").collect()
    assert auc(held, label) > 0.85
    assert report(docs.limit(0), labels).count() == 0
    none = report(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r[0] for r in none] == [0.5]
    same = report(docs.repartition(7), labels).select("doc_id", "score")
    assert {r[0]: r[1] for r in same.collect()} == {r[0]: r[1] for r in out.select("doc_id", "score").collect()}


def test_dictionary_of_few_samples():
    assert Q.build_dictionary([""]) and Q.build_dictionary(["tiny"]) == b"tiny"


def labelled_sentences(biased=True):
    """Insults are toxic; the word muslim stands in most toxic sentences, women in clean ones."""
    rng, rows = random.Random(1), []
    plain = "the house tree river walks talks reads sings about people today often here there bread water".split()
    for i in range(600):
        words = [rng.choice(plain) for _ in range(12)]
        toxic = i % 3 == 0
        if toxic:
            words.insert(3, rng.choice(["idiot", "moron", "scum"]))
        if biased and rng.random() < (0.7 if toxic else 0.05):
            words.append("muslim")
        rows.append((" ".join(words), int(toxic)))
    return rows


def test_penalty_removes_identity_bias():
    free, fair = T.train(labelled_sentences(), penalty=0.0), T.train(labelled_sentences(), penalty=10.0)
    gap = lambda m: m.weights.get("muslim", 0.0) - m.weights.get("christian", 0.0)
    assert gap(free) > 1 and abs(gap(fair)) < 0.25 * gap(free)
    score = fair.scorer()
    assert score("the muslim people talk about bread") < 0.5 < score("the people are scum and idiot folk")
    assert T.train([("x", 1)]) is None


def test_counterfactuals_swap_inside_a_family():
    rng = np.random.default_rng(0)
    for a, b in T.counterfactuals({"the", "women", "talk"}, rng) + T.counterfactuals({"plain"}, rng):
        out, into = a - b, b - a
        assert len(out) == len(into) == 1
        assert any({*out, *into} <= set(f) for f in T.IDENTITY_FAMILIES)


NOTES = [(1, "MIT", "prose of the day\nReleased under the MIT License.\nmore prose"), (2, "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
         (3, "GPL-3.0", "x\n\nThis work is licensed under the GNU General Public License, version 3, by us."),
         (4, "CC-BY-NC", "Licensed under CC BY-NC 4.0"), (5, "Proprietary", "ALL RIGHTS RESERVED."),
         (6, "", "The license of the car was released; the public library is free."), (7, "", None), (8, "", ""), (9, "", "\n \n"),
         (10, "MIT,Proprietary", "All rights reserved.\nReleased under the MIT License.\nReleased under the MIT License."),
         (11, "CC-BY-SA", "Licensed under CC BY-SA 4.0."), (12, "", "w " * 30000), (None, "MIT", "released under the mit license")]


@pytest.fixture(scope="module")
def licence_model(tables):
    return L.fit(tables[0])


def test_licences(spark, licence_model):
    docs = spark.createDataFrame([(i, t, "z") for i, _, t in NOTES], "doc_id long, text string, families string")
    got = {r["doc_id"]: r for r in L.scan(docs, licence_model).collect()}
    assert {i: r["families"] for i, r in got.items()} == {i: f for i, f, _ in NOTES}
    assert got[10]["n_confirmed"] == 3 and got[1]["n_paragraphs"] == 3 and got[7]["n_paragraphs"] == 0
    assert L.scan(docs.limit(0), licence_model).count() == 0


def test_wrapped_notices(spark, licence_model):
    """Notices wrapped at 30, 72 and 79 columns, plain or in a comment, alone or amid lines of prose, and side by side."""
    full = {f: max((t for g, t in L.TEMPLATES if g == f), key=len) for f in ("MIT", "GPL-3.0", "BSD", "ISC")}
    rows, want = [], {}
    for f, text in full.items():
        for width in (30, 72, 79):
            wrapped = textwrap.wrap(text, width)
            for lines in (wrapped, [f" * {x}" for x in wrapped], ["prose of the day", *wrapped, "more prose"]):
                want[len(rows)] = (f, 1)
                rows.append((len(rows), "Title\n\n" + "\n".join(lines) + "\n\nthe end"))
    both = textwrap.wrap(full["MIT"], 72) + textwrap.wrap(full["BSD"], 72) + ["All rights reserved."]
    want[len(rows)] = ("BSD,MIT,Proprietary", 3)
    rows.append((len(rows), "\n".join(both)))
    want[len(rows)] = ("GPL-3.0", 1)  # the first line alone would be a notice of either version
    rows.append((len(rows), "This work is licensed under the GNU General Public License,\nversion 3."))
    want[len(rows)] = ("", 0)  # a blank line ends a notice
    rows.append((len(rows), "\n\n".join(textwrap.wrap(full["MIT"], 72))))
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string"), licence_model).collect()
    assert {r["doc_id"]: (r["families"], r["n_confirmed"]) for r in got} == want


def test_licence_lines_of_the_corpus(tables, licence_model):
    docs, _ = tables
    notices = {"GNU General Public License, version 3": "GPL-3.0", "Licensed under CC BY-NC 4.0": "CC-BY-NC",
               "Released under the MIT License": "MIT", "Apache License, Version 2.0": "Apache-2.0", "All rights reserved": "Proprietary"}
    want = {r["doc_id"]: ",".join(sorted(f for n, f in notices.items() if n in (r["text"] or ""))) for r in docs.collect()}
    assert {r["doc_id"]: r["families"] for r in L.scan(docs, licence_model).collect()} == want


def test_licence_features_need_an_anchor(licence_model):
    known = set(L.anchors())
    assert all(known & set(g.split()) for g in licence_model.weights)


def test_licence_model_is_the_same_however_the_table_is_partitioned(tables, licence_model):
    assert L.fit(tables[0].repartition(5)) == licence_model
    texts = [r["text"] for r in L.sample_texts(tables[0], sample_docs=20).collect()]
    assert len(texts) == 20 == len(set(texts))
