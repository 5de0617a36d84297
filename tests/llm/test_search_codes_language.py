"""Operators 11, 12 and 13: brute force, exactness of their parts, held-out accuracy, awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import language_id as G
from tessera.llm import lexical_search as S
from tessera.llm import vector_codes as V

from conftest import SF_CHECK

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ------------------------------------------------------------------ operator 11

def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k=10):
    """Scores by the formula, document by document."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_all, l_all = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(plain_terms(t))
    out = set()
    for item, terms in asked.items():
        hits = []
        for i, c, n in counted:
            m = 10 + 90 * n * n_all // l_all
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms if t in c)
            if s > 0:
                hits.append((-s, i is None, i or 0, i))
        out |= {(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(hits)[:k])}
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    vocab = [f"t{i}" for i in range(300)] + ["Été", "ñ9", "A1"]
    weights = [1 / (r + 1) for r in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.randrange(1, 60)))) for i in range(700)]
    docs += [(900 + i, "t0 t1, T5-t7") for i in range(40)]  # ties
    docs += [(950, "t3 t3 t4"), (950, "t3 t3 t4"), (951, None), (952, ""), (953, " \n!?"), (None, "t9 t9 t9"),
             (954, " ".join(rng.choices(vocab, weights, k=30000)))]
    items = [(i, " ".join(rng.choices(vocab, k=12))) for i in range(30)]
    items += [(100, "t0 t1 t5"), (101, None), (102, ""), (103, "unknownword"), (104, "t9"), (104, "T3!"), (None, "t2"), (105, "été Ñ9 a1")]
    return docs, items


def test_terms_are_those_of_the_pattern():
    for text in ("Ab-9_z{x}\x7f\x80é É naïve\x00a", "", "THE the", "a\tb\x0bc d e"):
        assert [t.decode() for t in S.terms_of(text.encode())] == plain_terms(text)


@pytest.mark.parametrize("segment, share, block", [(S.SEGMENT_TERMS, S.SHORT_SHARE, 10 ** 6), (1500, 0.0, 40), (4000, 1.0, 10 ** 6), (9000, 0.2, 100)])
def test_search_equals_brute_force(spark, corpus, segment, share, block):
    docs, items = corpus
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    out = S.search(S.build_index(d, segment_terms=segment), q, short_share=share, block_terms=block)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(brute_search(docs, items), key=str)


def test_windows_are_skipped():
    """A list of strong documents in one window keeps the others from being read."""
    rng = np.random.default_rng(0)
    docs = np.arange(40 * S.WINDOW)
    weak, strong = rng.integers(1, 50, len(docs)), np.where(docs < 30, 1000, 1)
    lists = [S._Postings(docs, x, 40) for x in (weak, strong)]
    got, scores, scored = S.best_documents([], lists, len(docs), 10)
    want = np.sort(weak + strong)[::-1][:10]
    assert scored == 1 and np.array_equal(np.sort(scores)[::-1][:10], want)
    # accumulators alone bound the rest from the start
    short = (np.arange(5000, 5020), np.full(20, 500))
    got, scores, scored = S.best_documents([short], [lists[0]], len(docs), 10)
    assert scored == 1 and set(got) <= set(range(5000, 5020))


def test_search_on_empty_tables(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame(docs[:20], "doc_id long, text string")
    q = spark.createDataFrame(items[:5], "item_id long, text string")
    assert S.search(S.build_index(d.limit(0)), q).count() == 0
    assert S.search(S.build_index(d), q.limit(0)).count() == 0
    assert S.search(S.build_index(d.filter("false").unionByName(d.limit(0))), q.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_length_norm_beyond_64_bits():
    n = np.array([5, 10 ** 9], np.int64)
    assert S.length_norm(n, 10 ** 11, 10 ** 13).tolist() == [10 + 90 * 5 * 10 ** 11 // 10 ** 13, 10 + 90 * 10 ** 9 * 10 ** 11 // 10 ** 13]


# ------------------------------------------------------------------ operator 12

BIG = st.integers(-(2 ** 27) + 1, 2 ** 27 - 1)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 12).flatmap(lambda d: st.tuples(
    st.lists(st.lists(BIG, min_size=d, max_size=d), min_size=1, max_size=6),
    st.lists(st.lists(BIG, min_size=d, max_size=d), min_size=1, max_size=6))))
def test_exact_products_and_first_nearest(pair):
    a, b = pair
    x, c = np.array(a, np.int64), np.array(b, np.int64)
    assert V.exact_dot(x, c).tolist() == [[sum(p * q for p, q in zip(u, v)) for v in b] for u in a]
    assert all((sum(p.astype(np.int64) << (V.LIMB_BITS * i) for i, p in enumerate(V.limbs(m))) == m).all() for m in (x, c))
    at, error = V.nearest_entry(x, c)
    dist = [[sum((p - q) ** 2 for p, q in zip(u, v)) for v in b] for u in a]
    assert error.tolist() == [min(r) for r in dist] and at.tolist() == [r.index(min(r)) for r in dist]


def test_float_products_would_be_wrong():
    """Without limbs a float64 product of such numbers is not exact."""
    x = np.full((1, 8), 2 ** 27 - 1, np.int64)
    y = np.array([[2 ** 27 - 1] * 7 + [2 ** 27 - 2]], np.int64)
    assert int((x.astype(float) @ y.T.astype(float))[0, 0]) != int(V.exact_dot(x, y)[0, 0])
    with pytest.raises(ValueError):
        V.exact_dot(x, y, bits=26)


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """Contract of the operator in plain Python integers; rows: (id, vector, label)."""
    kept = [(i, [math.floor(4096 * x) for x in v], y) for i, v, y in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return d.index(min(d)), min(d)
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, v, _ in kept:
                held[nearest(cut(v, p), books[p])[0]].append(cut(v, p))
            books[p] = [[sum(c) // len(held[e]) for c in zip(*held[e])] if e in held else books[p][e] for e in range(len(books[p]))]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    coded = []
    for i, v, y in kept:
        near = [nearest(cut(v, p), books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{e:02x}" for e, _ in near), sum(d for _, d in near), y))
    total = Counter()
    for _, _, e, y in coded:
        total[y] += e
    return sorted(((i, c, e, total[y], sha) for i, c, e, y in coded), key=str)


def vectors(seed=3, n=90, dim=16, scale=1.0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(0, scale, dim).astype(np.float32)], int(i) % 4 if i % 5 else None)
            for i in rng.permutation(n) + 10]
    rows += [rows[0], (rows[1][0], rows[2][1], 1), (None, rows[3][1], 2), (5, [0.0] * dim, None), (6, [0.0] * dim, 0)]
    return rows, [(1, None, 1), (2, [1.0] * (dim - 1) + [None], 1), (3, [float("nan")] + [0.0] * (dim - 1), 2),
                  (4, [float("-inf")] * dim, None)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("scale", [0.2, 8000.0])
def test_codes_equal_brute_force(spark, scale):
    good, dropped = vectors(scale=scale)
    df = spark.createDataFrame(good + dropped, SCHEMA).selectExpr("*", "'z' AS code", "1 AS q")
    want = brute_codes(good + dropped)
    for parts in (1, 5):
        got = sorted(map(tuple, V.report(df.repartition(parts)).collect()), key=str)
        assert got == want


def test_codes_few_rows_and_odd_lengths(spark):
    df = spark.createDataFrame([(1, [1.0, -2.0, 3.0], 7), (2, [4.0, 5.0], 7), (3, [], 8), (4, [1e30, 0.0, 0.0], 9)], SCHEMA)
    got = {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in V.report(df).collect()}
    assert got == {1: ("00" * 8, 0, 0), 2: (None, None, 0), 3: (None, None, None), 4: (None, None, None)}
    assert V.report(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        V.compress(df, entries=300)


def test_decoded_vectors_are_near(spark):
    good, _ = vectors(n=200, dim=32)
    df = spark.createDataFrame([r for r in good if r[0] is not None], SCHEMA)
    coded, books, dim = V.compress(df.dropDuplicates(["vec_id"]), entries=64)
    rows = V.decode(coded, books, dim).join(df.dropDuplicates(["vec_id"]).drop("label"), "vec_id").collect()
    for r in rows:
        x, y = np.floor(np.array(r["embedding"]) * 4096), np.round(np.array(r["decoded"]) * 4096)
        assert int(((x - y) ** 2).sum()) == r["error"]


def test_sums_beyond_64_bits_are_floored_exactly(spark):
    assert Decimal(2) ** 64 // 3 == (2 ** 64) // 3
    q = spark.createDataFrame([([-7, 5],), ([-8, 5],), ([100, 100],)], "q array<int>")
    books = np.array([[[-7, 5], [90, 90], [1000, 1000]]])
    assert V.next_books(q, books, 2).tolist() == [[[-8, 5], [100, 100], [1000, 1000]]]  # floor(-7.5), unused entry stays


# ------------------------------------------------------------------ operator 13

def plain_normal(text):
    words = re.sub(r"[\W\d_]+", " ", text.casefold()).split(" ")
    return " " + "".join(w + " " for w in words if w)


def plain_buckets(text):
    s, out = plain_normal(text), Counter()
    for n in G.ORDERS:
        for i in range(len(s) - n + 1):
            h = 0
            for k, c in enumerate(s[i:i + n]):
                h = (ord(c) * 0x85EBCA6B if k == 0 else h * 0x9E3779B1 + ord(c) + k + 1) % 2 ** 32
            h ^= h >> 15
            h = h * 0xC2B2AE35 % 2 ** 32
            out[(h ^ h >> 13) % G.BUCKETS] += 1
    return out


TEXTS = ["Hello, World", "l'été 42 ça", "a", "ab", "123 !!", "", "ÀÉ ß_x  y", "日本語テキスト", "x" * 700, "one-two " * 90, " lead and trail 9 "]


@pytest.mark.parametrize("size", [1, 2, 7, 1 << 17])
def test_buckets_whatever_the_slices(size):
    for text in TEXTS:
        got = Counter()
        for _, parts in G.batches_of([text], [0], size):
            for b in G.bucket_lists(parts):
                got.update(int(x) for x in b if x < G.BUCKETS)
        assert got == plain_buckets(text), (text, size)


def plain_model(rows):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        n[lang] += 1
        if any(map(str.isalpha, text)):
            counts[lang].update(plain_buckets(text))

    def score(text):
        b, z = plain_buckets(text), {}
        for lang in n:
            total = sum(counts[lang].values()) + G.ALPHA * G.BUCKETS
            z[lang] = math.log(n[lang]) + sum(k * math.log((counts[lang][x] + G.ALPHA) / total) for x, k in b.items())
        top = max(z.values())
        p = {lang: math.exp(v - top) for lang, v in z.items()}
        best = max(sorted(z), key=lambda x: z[x])
        return best, p[best] / sum(p.values())
    return score


def test_languages_equal_brute_force(spark):
    import zlib

    rng = random.Random(2)
    say = {"en": "the house and water this what of on with", "de": "das haus und wasser ist nicht der über von", "fr": "la maison et eau dans une être pour"}
    rows = [(i, " ".join(rng.choices(say[lang].split(), k=rng.randrange(1, 9))), lang, "y") for i in range(120) for lang in [rng.choice([*say])]]
    rows += [(500, None, "en", "y"), (501, "12 34", "de", "y"), (502, "", None, "y"), (503, "das über", None, "y"), (None, "the water", "fr", "y"),
             (504, " ".join(["haus"] * 3000), "de", "y"), (504, "the house", "de", "y"), (505, "²³ ½", "en", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(3)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    score = plain_model([(lang, t) for i, t, lang, _ in rows if i is not None and t is not None and lang is not None and not held(i)])
    got = sorted(((r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in G.report(df).collect()), key=str)
    want = []
    for i, t, _, _ in rows:
        lang, p = score(t) if t and any(map(str.isalpha, t)) else ("und", 0.0)
        want.append((i, held(i), lang, round(p, 9)))
    assert got == sorted(want, key=str)


def test_language_accuracy_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    out = G.report(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(out) > 200 and sum(r["lang"] == r["lang_pred"] for r in out) >= 0.99 * len(out)


def test_language_without_training_rows(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in G.report(df).collect()} == {("und", 0.0)}
    assert G.report(df.limit(0)).count() == 0
    few = spark.createDataFrame([(i, w, w) for i, w in enumerate(["aa", "aa", "bb", "cc"] * 9)], "doc_id long, text string, lang string")
    assert G.fit(few, max_languages=2).languages == ("aa", "bb")
