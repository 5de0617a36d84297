"""Operator 4: byte-level BPE through a hand-serialised sentencepiece model.

A rank file (token bytes and rank) becomes a sentencepiece BPE model without
training: every token is one piece whose bytes are mapped to printable
characters, its score is the negative rank (so the best-scored merge is the
lowest-ranked one), and normalisation is the identity. Pre-tokens of the split
pattern are encoded one by one; decoding maps ids back to the token's bytes.

Each task holds the model (bounded by the vocabulary) and a cache of bounded
size; rows stay where they are, nothing is shuffled. Null and empty texts have
no ids; every text, however long, is encoded whole; copies and ties are encoded
alike; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame

from tessera.llm.text import bounded_batches, only, strings, tokenizer_path

RANKS = "byte_bpe_50k.tiktoken"
CACHE = 300_000


def byte_chars() -> list[str]:
    """One printable, non-space character for each byte value: itself where Latin-1 prints it, else from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while True:
        out.append(n & 127 | (128 if n > 127 else 0))
        n >>= 7
        if not n:
            return bytes(out)


def _field(number: int, value: int | bytes | float) -> bytes:
    """One protocol-buffer field: varint, 32-bit float or length-delimited."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by rank, which must run from 0 without gaps."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece BPE model of tokens in rank order; a piece's id is its rank, the unknown piece comes last.

    Field numbers are those of the public sentencepiece_model.proto.
    """
    chars = byte_chars()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join([chars[b] for b in token]).encode()
        out += _field(1, _field(1, piece) + _field(2, -float(rank)) + _field(3, 1))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    trainer += b"".join(_field(n, -1) for n in (41, 42, 43))
    out += _field(2, trainer)
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


class ByteBpe:
    """Encode and decode; ``cache`` bounds the remembered pieces (a speed-up only)."""

    def __init__(self, ranks_path: str, pattern: str, cache: int = CACHE):
        import regex
        import sentencepiece

        self.tokens = read_ranks(ranks_path)
        self.decimals = [str(i) for i in range(len(self.tokens))]
        self._whole = {t: i for i, t in enumerate(self.tokens)}
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self._split = regex.compile(pattern).findall
        self._odd = regex.compile(r" (?:\s|$)").search
        self._chars = {b: c for b, c in enumerate(byte_chars())}
        self._limit, self._known, self._chunks = cache, {}, {}

    def pretokens(self, text: str) -> list[str]:
        return self._split(text)

    def _pretoken(self, pretoken: str) -> tuple[int, ...]:
        ids = self._known.get(pretoken)
        if ids is None:
            raw = pretoken.encode()
            whole = self._whole.get(raw)  # a pre-token that is itself a token stays whole
            ids = (whole,) if whole is not None else \
                tuple(self._model.encode(raw.decode("latin-1").translate(self._chars), out_type=int))
            if len(self._known) >= self._limit:
                self._known.clear()
            self._known[pretoken] = ids
        return ids

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        ids = self._chunks.get(chunk)
        if ids is None:
            ids = tuple(chain.from_iterable(map(self._pretoken, self._split(chunk))))
            if len(self._chunks) >= self._limit:
                self._chunks.clear()
            if len(chunk) < 256:
                self._chunks[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text. A space between two other characters always begins a pre-token, so the text is
        taken in chunks there; texts with other runs of spaces are split as one."""
        if self._odd(text):
            return list(chain.from_iterable(map(self._pretoken, self._split(text))))
        head, *rest = text.split(" ")
        ids = list(self._chunk(head)) if head else []
        get, chunk = self._chunks.get, self._chunk
        parts = [" " + r for r in rest]
        found = list(map(get, parts))
        if None in found:
            found = [chunk(p) if f is None else f for p, f in zip(parts, found)]
        ids.extend(chain.from_iterable(found))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, by the inverse mapping of the vocabulary."""
        return b"".join(map(self.tokens.__getitem__, ids))


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(ranks_path: str, pattern: str) -> ByteBpe:
    """The process's tokenizer, built once per Python worker."""
    key = (ranks_path, pattern)
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(ranks_path, pattern)
    return _LOADED[key]


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _per_batch(docs: DataFrame, id_col: str, text_col: str, schema: str, columns, ranks_path, pattern) -> DataFrame:
    import pyarrow as pa

    ranks_path = ranks_path or tokenizer_path(RANKS)
    pattern = pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(ranks_path, pattern)
        for b in batches:
            cols = columns(bpe, strings(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[id_col, *cols_names])

    cols_names = [c.split()[0] for c in schema.split(",")]
    rows = bounded_batches(only(docs, id_col, text_col))
    id_type = rows.schema[0].dataType.simpleString()
    return rows.withColumn(text_col, rows[text_col].cast("string")).mapInArrow(run, f"`{id_col}` {id_type}, {schema}")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``id_col, ids`` (array<int>) of every text."""
    import pyarrow as pa

    return _per_batch(docs, id_col, text_col, "ids array<int>",
                      lambda bpe, texts: [pa.array([bpe.encode(t) for t in texts], pa.list_(pa.int32()))],
                      ranks_path, pattern)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
           ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``id_col, content`` (binary) of arrays of ids; null ids as none."""
    import pyarrow as pa

    ranks_path = ranks_path or tokenizer_path(RANKS)
    pattern = pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(ranks_path, pattern)
        for b in batches:
            content = [bpe.decode(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(content, pa.binary())], names=[id_col, "content"])

    rows = bounded_batches(only(encoded, id_col, ids_col))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, content binary")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: every text encoded, and its ids decoded, in one pass."""
    import pyarrow as pa

    def columns(bpe: ByteBpe, texts: list[str]):
        dec = bpe.decimals.__getitem__
        n, ids_hash, text_hash = [], [], []
        for t in texts:
            ids = bpe.encode(t)
            n.append(len(ids))
            ids_hash.append(hashlib.sha256(" ".join(map(dec, ids)).encode()).hexdigest())
            text_hash.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]

    return _per_batch(docs, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns,
                      ranks_path, pattern)
