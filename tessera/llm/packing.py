"""Operator 2: vector bin packing of token sequences.

Every example is a vector (tokens, segments, loss-bearing tokens); a sequence
has a capacity in each of the three. Within a packing group the dot-product
heuristic fills one sequence at a time with the fitting example whose vector
points most along what is left of the capacity. Documents may be cut: what no
whole example fills is filled with the head of the largest one left.

Scale: a document's full-length pieces are sequences of their own and leave the
task without their ids; only remainders, shorter than one sequence, are
shuffled, to groups by a hash of id and text, so that rows of one id spread too.
The number of groups follows the rows and bytes, so a group stays bounded at any
size; only its last sequence is padded. Examples of equal vectors are one class,
and the heuristic looks at classes, so a group of many short rows is cheap to pack. Ids are 16-bit on the way where the vocabulary allows it.

Null text is empty (its one id is the end mark); every row is packed, copies
and ties each on their own; rows are ordered by (size, id, hash), so the result
does not depend on the partitioning; a null id is a value like any other; an
empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import bounded_batches, only, single_threaded_tokenizers, strings, text_or_empty, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
#: pieces of one sequence; as many as tokens, as the shortest text has one token (its end mark)
MAX_SEGMENTS = 4096
END_ID = 2
#: aims for one packing group; both only set how many groups there are
GROUP_BYTES = 6 << 20
GROUP_ROWS = 131_072
#: words remembered by a Python worker (a speed-up only), and the longest word that is
CACHE = 700_000
CACHED_CHARS = 64


# ------------------------------------------------------------------ tokens

class WordBpe:
    """Ids of a text by the ``tokenizers`` library, word by word through a bounded cache.

    The vocabulary's rules split at white space, so texts are taken at spaces
    and line breaks. A plain word (Latin-1 letters, then punctuation) is
    lower-cased and split here, and its letters go to the library's model
    directly, many in one call; every other word goes through the whole tokenizer.
    """

    _PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!#$%&*,.:;?|]*)").fullmatch

    def __init__(self, path: str, cache: int = CACHE):
        single_threaded_tokenizers()
        from tokenizers import Tokenizer, pre_tokenizers

        from tessera.llm.byte_bpe import byte_chars

        self._full = Tokenizer.from_file(path)
        self._bare = Tokenizer(self._full.model)
        self._bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.kind = np.dtype("<u2" if self._full.get_vocab_size() <= 1 << 16 else "<u4")
        vocab = self._full.get_vocab(with_added_tokens=False)
        self._ends = np.zeros(max(vocab.values()) + 1, bool)
        self._ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        chars = byte_chars()
        self._map = {c: "".join(chars[b] for b in chr(c).encode()) for c in range(128, 256)}
        self._limit, self._words, self._letters = cache, {}, {}

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not in the cache."""
        plain, odd, new, known = [], [], set(), self._letters
        for w in words:
            low = w.lower()
            if low.isascii() and low.isalpha():
                plain.append((w, low, ""))
                new.add(low)
                continue
            m = self._PLAIN(low)
            if m is None:
                odd.append(w)
            else:
                plain.append((w, *m.groups()))
                new.update(m.groups())
        new.discard("")
        new = list(new.difference(known))
        if len(known) + len(new) > self._limit:
            used = {p for _, *parts in plain for p in parts if p in known}
            self._letters = known = {p: known[p] for p in used}
        parts = [new[at:at + 512] for at in range(0, len(new), 512)]
        done = self._bare.encode_batch_fast([" ".join(p).translate(self._map) for p in parts], add_special_tokens=False)
        size = self.kind.itemsize
        for part, e in zip(parts, done):
            ids = np.array(e.ids, self.kind)
            raw, ends = ids.tobytes(), ((np.flatnonzero(self._ends[ids]) + 1) * size).tolist()
            known.update(zip(part, [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)], strict=True))
        known[""] = b""
        out = {w: known[a] + known[b] for w, a, b in plain}
        for p in [p for p in new if len(p) > CACHED_CHARS]:
            del known[p]
        for w, e in zip(odd, self._full.encode_batch(odd, add_special_tokens=False)):
            out[w] = np.array(e.ids, self.kind).tobytes()
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of every text."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        cache, words = self._words, set().union(*split)
        missing = words.difference(cache)
        if missing:
            if len(cache) + len(missing) > self._limit:
                self._words = cache = {w: cache[w] for w in words.difference(missing)}
            cache.update(self._learn(list(missing)))
        get = cache.__getitem__
        out = [b"".join(map(get, words)) for words in split]
        for w in [w for w in missing if len(w) > CACHED_CHARS]:
            del cache[w]
        return out


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


# ------------------------------------------------------------------ packing

def pack_vectors(items: np.ndarray, capacity: np.ndarray, cut: bool = False) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start, length) under every limit of ``capacity``.

    ``items``: one row (tokens, segments, loss tokens) each, none above the
    capacity. Ties go to the vector that comes first, and in it to the first row. With ``cut`` a bin that no whole item
    fits takes the head of the largest one left; this needs every token of an
    item to weigh alike in the loss.
    """
    scale = capacity.astype(float)
    start = np.zeros(len(items), np.int64)
    # a class: a vector, and the rows that have it, first row last
    vectors, of = np.unique(items.astype(np.int64), axis=0, return_inverse=True) if len(items) else (items, np.zeros(0, int))
    queues: list[list[int]] = [[] for _ in range(len(vectors))]
    for i in range(len(items) - 1, -1, -1):
        queues[of.ravel()[i]].append(i)
    order = sorted(range(len(queues)), key=lambda c: queues[c][-1])
    rest, queues = vectors[order].astype(np.int64), [queues[c] for c in order]
    size = rest / scale
    bins: list[list[tuple[int, int, int]]] = []
    left, placed = len(items), []
    room = capacity.astype(np.int64).copy()

    def drop(c: int) -> None:
        """Forget a class that has no rows left."""
        nonlocal rest, size
        rest, size = np.delete(rest, c, axis=0), np.delete(size, c, axis=0)
        del queues[c]

    while left:
        fits = (rest <= room).all(axis=1)
        if fits.any():
            c = int(np.where(fits, size @ (room / scale), -1.0).argmax())
            i, vector = queues[c].pop(), rest[c]
            placed.append((i, int(start[i]), int(vector[0])))
            room -= vector
            left -= 1
            if not queues[c]:
                drop(c)
            continue
        n = int(room[0])
        if cut and n > 0 and room[1] > 0 and room[2] > 0:
            c = int(rest[:, 0].argmax())
            tokens, segments, loss = (int(x) for x in rest[c])
            share = loss / tokens
            n = min(n, tokens - 1, int(room[2] / share) if share else n)
            while n > 0 and -(-loss * n // tokens) > room[2]:
                n -= 1
            if n > 0:
                i, taken = queues[c].pop(), -(-loss * n // tokens)
                placed.append((i, int(start[i]), n))
                room -= (n, 1, taken)
                start[i] += n
                if not queues[c]:
                    drop(c)
                tail = np.array([[tokens - n, segments, loss - taken]], np.int64)  # what is left: a class of its own, first
                rest, size = np.concatenate([tail, rest]), np.concatenate([tail / scale, size])
                queues.insert(0, [i])
                continue
        bins.append(placed)
        placed = []
        room[:] = capacity
    if placed:
        bins.append(placed)
    return bins


def _groups(df: DataFrame, text_col: str | None = None) -> int:
    size = F.sum(F.octet_length(text_or_empty(text_col))) if text_col else F.lit(0)
    n, total = df.agg(F.count(F.lit(1)), size).first()
    return max(1, -(-n // GROUP_ROWS), -(-(total or 0) // GROUP_BYTES))


_PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                   capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS,
                   max_loss: int | None = None) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    All tokens of a document bear loss, so ``max_loss`` (default: the capacity)
    limits them as the token limit does.
    """
    import pyarrow as pa
    import pyarrow.compute

    path = path or tokenizer_path(VOCABULARY)
    rows = bounded_batches(only(docs, id_col, text_col).withColumn(text_col, text_or_empty(text_col)))
    n_groups = _groups(rows, text_col)
    id_type = rows.schema[0].dataType.simpleString()
    full = min(capacity, max_loss or capacity)
    limits = np.array([capacity, max_segments, max_loss or capacity])

    def crc(ids: np.ndarray) -> int:
        return zlib.crc32(ids.astype("<u4").tobytes())

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        end = np.array([END_ID], bpe.kind).tobytes()
        width = bpe.kind.itemsize
        for b in batches:
            keys, groups, out = b.column(0), b.column(2), []
            for k, raw in enumerate(bpe.encode_batch(strings(b.column(1)))):
                ids = np.frombuffer(raw + end, bpe.kind)
                n = len(ids)
                for at in range(0, n, full):
                    piece = ids[at:at + full]
                    whole = len(piece) == full
                    out.append((k, at, len(piece), crc(piece) if whole else 0, n,
                                None if whole else piece.tobytes(), width))
            k, at, n, c, total, raw, wide = zip(*out) if out else ([],) * 7
            pick = pa.array(k, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys.take(pick), groups.take(pick), *[pa.array(x, pa.int64()) for x in (at, n, c, total)],
                 pa.array(raw, pa.binary()), pa.array(wide, pa.int32())],
                names=[id_col, "_group", "_start", "_n", "_crc", "_total", "_ids", "_wide"])

    def pack(key, table):
        whole = table.filter(pa.compute.is_null(table["_ids"]))
        part = table.filter(pa.compute.is_valid(table["_ids"]))
        part = part.append_column("_at", pa.array(range(len(part)), pa.int64()))
        part = part.sort_by([("_n", "descending"), (id_col, "ascending"), ("_total", "ascending"), ("_ids", "ascending")])
        whole = whole.sort_by([(id_col, "ascending"), ("_start", "ascending"), ("_crc", "ascending")])
        n = np.array(part["_n"].to_pylist(), np.int64)
        items = np.stack([n, np.ones_like(n), n], axis=1) if len(n) else np.zeros((0, 3), np.int64)
        base = int(key[0].as_py()) << 32
        pick, start, length, sums, seq, offset = [], [], [], [], [], []
        ids, wide, at = part["_ids"], part["_wide"].to_pylist(), part["_start"].to_pylist()
        for s, placed in enumerate(pack_vectors(items, limits, cut=True)):
            o = 0
            for i, a, m in placed:
                x = np.frombuffer(ids[i].as_py(), "<u2" if wide[i] == 2 else "<u4")[a:a + m]
                pick.append(i)
                start.append(at[i] + a)
                length.append(m)
                sums.append(crc(x))
                seq.append(base + len(whole) + s)
                offset.append(o)
                o += m
        cut = part.select([id_col, "_total"]).take(pa.array(pick, pa.int64()))
        a = pa.table([cut[id_col], *[pa.array(x, pa.int64()) for x in (start, length, sums)], cut["_total"],
                      pa.array(seq, pa.int64()), pa.array(offset, pa.int64())], names=names)
        b = pa.table([whole[id_col], whole["_start"], whole["_n"], whole["_crc"], whole["_total"],
                      pa.array([base + i for i in range(len(whole))], pa.int64()),
                      pa.array([0] * len(whole), pa.int64())], names=names)
        return pa.concat_tables([a, b])

    names = [id_col, *[c.split()[0] for c in _PIECES.split(", ")]]
    group = F.pmod(F.xxhash64(F.col(id_col).cast("string"), text_col), F.lit(n_groups))
    pieces = rows.withColumn("_group", group).mapInArrow(
        tokens, f"`{id_col}` {id_type}, _group long, _start long, _n long, _crc long, _total long, _ids binary, _wide int")
    return pieces.groupBy("_group").applyInArrow(pack, f"`{id_col}` {id_type}, {_PIECES}")


def pack_examples(items: DataFrame, id_col: str, tokens_col: str, loss_col: str, segments_col: str | None = None,
                  capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None) -> DataFrame:
    """Whole instruction examples packed under all three limits: ``id_col, sequence_id, offset``.

    An example above a limit, or with a null or negative size, is returned with
    null ``sequence_id`` and ``offset``.
    """
    import pandas as pd

    limits = np.array([capacity, max_segments, max_loss or capacity])
    rows = items.select(F.col(f"`{id_col}`"), F.col(f"`{tokens_col}`").cast("long").alias("_t"),
                        (F.col(f"`{segments_col}`") if segments_col else F.lit(1)).cast("long").alias("_s"),
                        F.col(f"`{loss_col}`").cast("long").alias("_l"))
    n_groups = _groups(rows)
    id_type = rows.schema[0].dataType.simpleString()

    def pack(key, pdf):
        pdf = pdf.sort_values(["_t", id_col], ascending=[False, True], kind="stable")
        v = pdf[["_t", "_s", "_l"]].to_numpy(float)
        ok = ~np.isnan(v).any(axis=1)
        ok &= (np.nan_to_num(v) >= 0).all(axis=1) & (np.nan_to_num(v) <= limits).all(axis=1)
        at = np.flatnonzero(ok)
        seq = pd.array([None] * len(pdf), "Int64")
        off = pd.array([None] * len(pdf), "Int64")
        for s, placed in enumerate(pack_vectors(v[at].astype(np.int64), limits)):
            o = 0
            for i, _, n in placed:
                seq[at[i]], off[at[i]] = (int(key[0]) << 32) + s, o
                o += n
        return pd.DataFrame({id_col: pdf[id_col], "sequence_id": seq, "offset": off})

    of = F.xxhash64(F.col(f"`{id_col}`").cast("string"), "_t", "_s", "_l")
    rows = rows.withColumn("_group", F.pmod(of, F.lit(n_groups)))
    return rows.groupBy("_group").applyInPandas(pack, f"`{id_col}` {id_type}, sequence_id long, offset long")
