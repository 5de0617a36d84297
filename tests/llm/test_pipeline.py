"""The pipeline, stage by stage, against brute force on a small table; registration of all queries."""

import random

import pytest

import corpus_pipeline
from tessera.llm import pii
from tessera.llm.queries import ORACLE, QUERIES

from __spark_entry__ import oracle_sql, queries
from conftest import SF_SMALL
from test_near_dedup import brute as near_brute
from test_quality_and_copies import brute_rules
from test_tokens import check_pieces


def test_every_operator_is_registered():
    names = set(queries())
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    vocab = [f"word{i}" for i in range(300)]
    texts = [None, "", "too short", "loud!! " * 40]
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randrange(30, 200))]
        near = list(base)
        near[len(near) // 2] = "other"
        texts += [" ".join(base), " ".join(base).upper().replace("WORD", "Word"), " ".join(near), " ".join(base)]
    texts.append(" ".join(rng.sample(vocab, 60)) + " mail me@example.org now")
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_match_brute_force(spark, docs):
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF_SMALL)
        assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), docs.schema)
        got = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "quality_rules":
            left = {i: t for i, t in left.items() if brute_rules(t)[-1]}
        elif name == "exact_dedup":
            last = {t.lower(): i for i, t in sorted(left.items())}
            left = {i: t for i, t in left.items() if last[t.lower()] == i}
        elif name == "near_dedup":
            left = {i: left[i] for i, v in near_brute(left, 5).items() if v[2]}
        else:
            left = {i: pii.generalise(t, pii.base_spans(t)) for i, t in left.items()}
        assert got == left, name
    assert 5 < len(left) < 20
    pieces = corpus_pipeline.STAGES[-1][1](spark, out, SF_SMALL).collect()
    total, n = check_pieces(pieces, left, 4096)
    assert n == -(-total // 4096)


def test_run_on_the_small_table(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 100
