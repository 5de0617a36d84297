"""Operator 6 against brute force: sets, index guarantee, links, components."""

import random
import re

import numpy as np
import pytest

from tessera.llm import near_dedup as nd

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute_set(text, width):
    w = W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(texts, width, percent=80):
    sets = {i: brute_set(t, width) for i, t in texts.items()}
    comp = {i: i for i in texts}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                comp[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["The", "and,", "été"]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, out = prose(60), [None, "", " \n ", "one", "ONE", "two words", "three little words", "a b c d", "a b  c\td"]
    for n in (30, 80, 200, 200, 300):
        base = prose(n)
        for edits in (0, 0, 1, 1, 2, 3, 5, 8, 12, 20):
            t = list(base)
            for _ in range(edits):
                t[rng.randrange(n)] = rng.choice(vocab)
            out.append(" ".join(t))
    base = prose(150)
    for k in range(60):  # a chain: each a few words on from the one before it
        base = base[2:] + prose(2)
        out.append(" ".join(base))
    out += [" ".join(prose(rng.randrange(20, 120)) + passage) for _ in range(60)]
    out += [" ".join(["same", "words", "again"] * 40).upper(), " ".join(prose(6000))]
    rng.shuffle(out)
    return dict(enumerate(out))


@pytest.mark.parametrize("width", [4, 5])
def test_components_match_brute_force(spark, texts, width):
    rows = [(i, t, "x", 0) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, comp string, sig int").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in nd.near_report(docs, width=width).collect()}
    assert got == brute(texts, width)


def test_drop_keeps_smallest_and_columns(spark, texts):
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, id int")
    out = nd.drop_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [i for i, v in brute(texts, 5).items() if v[2]]


def test_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"t{i}" for i in range(120)]
    texts = {}
    for i in range(1200):
        t = list(base)
        for _ in range(rng.randrange(0, 5)):
            t[rng.randrange(120)] = f"e{rng.randrange(50)}"
        texts[i] = " ".join(t)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in nd.near_report(docs).collect()}
    assert got == brute(texts, 4)


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (None, None), (3, "a b c d e"), (4, "a b c d e")],
                                 "doc_id long, text string")
    got = sorted(nd.near_report(docs).collect(), key=str)
    assert [tuple(r) for r in got if r["doc_id"] is not None] == [(3, 2, 3, True), (4, 2, 3, False)]
    assert len(got) == 4 and all(r["component_id"] is None for r in got if r["doc_id"] is None)
    assert nd.near_report(docs.limit(0)).count() == 0 and nd.drop_near_copies(docs.limit(0)).count() == 0


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, (1, nd.POSITIONS)).astype(np.uint16)
        b = a.copy()
        b[0, rng.choice(nd.POSITIONS, nd.DISTANCE, replace=False)] += np.uint16(1)
        assert set(nd.index_keys(a)[0]) & set(nd.index_keys(b)[0])
