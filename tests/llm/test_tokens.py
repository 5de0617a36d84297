"""Operators 2 and 4 against the tokenizer libraries, and packing limits."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.byte_bpe import RANKS, ByteBpe, decode, encode, round_trip
from tessera.llm.packing import VOCABULARY, WordBpe, pack_documents, pack_examples, pack_vectors

PATH = public_tokenizers.path(RANKS)
RANK = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANK, special_tokens={})
BPE = ByteBpe(PATH, public_tokenizers.PATTERN, cache=50)
WORD_PATH = public_tokenizers.path(VOCABULARY)
WORDS, FULL = WordBpe(WORD_PATH, cache=40), Tokenizer.from_file(WORD_PATH)
TEXTS = [None, "", " ", "  lead and  double   spaces ", "Hello, World!!", "l'été çà\n\n\tñandú  ", "a" * 3000, "𝒳 👩‍👩‍👧 é x",
         "it's IT'S 'll 123456 $$$ ***", " \n x \n\n y \x1c \x85 z", "<|endoftext|> x <|endoftext|>", "﻿bom   sep"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice(["erthat", "the,", "Onand", "être", "x" * 9, "42"]) for _ in range(9000))
    rows = [(i, t, "z") for i, t in enumerate([*TEXTS, long, long, *["tiny one"] * 40])]
    return spark.createDataFrame(rows, "doc_id long, text string, offset string")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab  \n\t'.,é👍st\x1c "), st.characters(codec="utf-8")), max_size=60))
def test_byte_bpe_equals_tiktoken(text):
    ids = BPE.encode(text)
    assert ids == TIK.encode_ordinary(text)
    assert BPE.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abEé  \n'.,!ÀßſK1"), st.characters(codec="utf-8")), max_size=60))
def test_word_bpe_equals_library(text):
    got = np.frombuffer(WORDS.encode_batch([text])[0], WORDS.kind).tolist()
    assert got == FULL.encode(text, add_special_tokens=False).ids


def test_round_trip_query_columns(docs):
    got = {r["doc_id"]: tuple(r)[1:] for r in round_trip(docs).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in docs.collect():
        ids = TIK.encode_ordinary(r["text"] or "")
        assert got[r["doc_id"]] == (len(ids), sha(" ".join(map(str, ids)).encode()), sha((r["text"] or "").encode()))
    back = {r["doc_id"]: bytes(r["content"]) for r in decode(encode(docs)).collect()}
    assert back == {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert round_trip(docs.limit(0)).count() == 0


def check_pieces(rows, texts, capacity):
    want = {i: [*FULL.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
        ids = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] > 0 and r["doc_tokens"] == len(want[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert set(by_doc) == set(texts)
    for i, ps in by_doc.items():
        ps.sort(key=lambda r: r["start"])
        assert [p["start"] for p in ps] == np.cumsum([0, *[p["length"] for p in ps]])[:-1].tolist()
        assert sum(p["length"] for p in ps) == len(want[i])
    for ps in by_seq.values():
        ps.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in ps] == np.cumsum([0, *[p["length"] for p in ps]])[:-1].tolist()
        assert sum(p["length"] for p in ps) <= capacity
    return sum(map(len, want.values())), len(by_seq)


def test_documents_are_packed_whole(docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    total, n = check_pieces(pack_documents(docs).collect(), texts, 4096)
    assert n == -(-total // 4096)
    total, n = check_pieces(pack_documents(docs, capacity=256, max_segments=8).collect(), texts, 256)
    assert n * 256 < 1.1 * total + 256
    assert pack_documents(docs.limit(0)).count() == 0


def test_vector_limits_hold():
    rng = np.random.default_rng(1)
    items = np.stack([rng.integers(1, 100, 300), rng.integers(1, 4, 300), rng.integers(0, 60, 300)], axis=1)
    items[:, 2] = np.minimum(items[:, 2], items[:, 0])
    caps = np.array([100, 5, 60])
    bins = pack_vectors(items, caps)
    assert sorted(i for b in bins for i, _, _ in b) == list(range(300))
    for b in bins:
        assert (items[[i for i, _, _ in b]].sum(axis=0) <= caps).all()
    assert len(bins) < 1.3 * (items / caps).sum(axis=0).max() + 1


def test_examples_keep_whole_and_odd_ones_stay_apart(spark):
    rows = [(i, 10 + i % 7, i % 5) for i in range(100)] + [(200, None, 1), (201, 5000, 1), (202, 9, 9000), (203, 5, -1)]
    got = pack_examples(spark.createDataFrame(rows, "k long, t long, l long"), "k", "t", "l", capacity=64,
                        max_segments=4, max_loss=9).collect()
    assert sorted(r["k"] for r in got if r["sequence_id"] is None) == [200, 201, 202, 203]
    size, seqs = {k: (t, 1, loss) for k, t, loss in rows}, defaultdict(list)
    for r in got:
        if r["sequence_id"] is not None:
            seqs[r["sequence_id"]].append(size[r["k"]])
    assert sum(map(len, seqs.values())) == 100
    assert all((np.sum(v, axis=0) <= [64, 4, 9]).all() for v in seqs.values())


def test_short_texts_leave_little_padding(spark):
    """One-word documents fill their sequences, and rows of one id (or none) are spread over the groups."""
    rows = [(7, f"{w}") for w in ("house", "river", "", None) for _ in range(6000)]
    packed = pack_documents(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("sequence_id") \
        .agg(F.sum("length").alias("n")).collect()
    total = sum(r["n"] for r in packed)
    assert 1 - total / (4096 * len(packed)) < 0.1 and max(r["n"] for r in packed) == 4096  # only last sequences are short
    docs = spark.createDataFrame([(1, f"{i} " * 400) for i in range(300)] + [(None, f"n{i} " * 400) for i in range(300)],
                                 "doc_id long, text string")
    import tessera.llm.packing as P
    group = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(8))
    assert docs.select(group.alias("g")).distinct().count() == 8
    assert P.GROUP_ROWS > 100_000


def test_classes_of_equal_vectors_keep_every_row():
    rng = np.random.default_rng(4)
    items = np.stack([n := rng.integers(1, 40, 3000), np.ones_like(n), n], axis=1)
    capacity = np.array([100, 30, 100])
    for cut in (False, True):
        bins = pack_vectors(items, capacity, cut=cut)
        seen = defaultdict(int)
        for placed in bins:
            assert sum(n for _, _, n in placed) <= 100 and len(placed) <= 30
            for i, start, n in placed:
                assert start == seen[i]
                seen[i] += n
        assert all(seen[i] == items[i, 0] for i in range(3000))
        assert len(bins) <= 1.02 * items[:, 0].sum() / 100 + 2


def test_long_words_are_encoded_but_not_kept():
    bpe = WordBpe(WORD_PATH)
    words = ["x" * 5000, "Q9" * 4000, "short", "(" + "y" * 300 + ")"]
    got = bpe.encode_batch([" ".join(words), "short " + words[0]])
    assert [np.frombuffer(g, bpe.kind).tolist() for g in got] == [
        FULL.encode(t, add_special_tokens=False).ids for t in (" ".join(words), "short " + words[0])]
    assert all(len(w) <= 64 for w in (*bpe._words, *bpe._letters))
