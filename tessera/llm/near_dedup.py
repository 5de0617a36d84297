"""Operator 6: near copies by MinHash signatures and a multi-index Hamming join.

A document's set is its distinct word shingles (64-bit hashes). Its signature
has ``POSITIONS`` b-bit MinHash values; two sets of similarity s differ in about
(1 - s) of them. Signatures within ``DISTANCE`` differing positions are found
without loss by the pigeonhole principle: of ``CHUNKS`` chunks at least one has
at most ``ERRORS`` differing positions, so every chunk is indexed once for each
choice of positions to leave out, and such a pair shares a key. At similarity
0.8 a pair lies beyond the distance with a chance of about 1e-7. Links are
confirmed on the full sets.

Groups of near copies are not expanded into their pairs:
* equal sets are one class, found by a partial aggregate; only classes are indexed;
* in a key's group every member is compared with the smallest one (a star);
  confirmed links are folded into components, and all star pairs within the
  distance, linked or not, into families;
* a family that still holds several components is compared within itself: its
  members' sets travel once to tiles of bounded size, where only pairs across
  components and within the distance are looked at, nearest first, and only
  links that join two components leave the task;
* what is left are pairs of one key's group that lie in different families.
  They are found on the signatures in tiles, each pair under the first key it
  shares, and confirmed like the others.

All tables between the steps are written to the shared folder. Null, empty and
word-less texts have the empty set and are linked with nothing; texts shorter
than a shingle are one shingle of all their words; a row with a null id is in no
link; rows with the same id count as one document; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import bounded_batches, only, strings, text_or_empty
from tessera.session import scratch_path

POSITIONS, CHUNK, ERRORS, BITS = 64, 4, 1, 16
CHUNKS = POSITIONS // CHUNK
#: largest distance for which the index loses no pair
DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: rows of one tile side: family members come with their sets (kilobytes), members of a key's group with their
#: signature only (128 bytes)
SET_TILE, SIGNATURE_TILE = 512, 4096
#: rows aimed at in one task of tiles
TILE_ROWS = 4096
TILES_A_ROW = 256

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_A = _RNG.integers(1, 1 << 63, POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 1 << 63, POSITIONS, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


# ------------------------------------------------------------------ shingles

def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next batch."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(step)
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles (A-Z lower-cased)."""
    raw = [t.encode().translate(_LOWER) for t in texts]
    buf = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    first = np.cumsum([1, *[len(r) + 1 for r in raw]])[:-1]
    space = _SPACE[buf]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    # a word's hash: its bytes as a polynomial, from prefix sums, shifted back to position 0
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * _powers(_BASE, len(buf)), dtype=np.uint64)])
    back = _powers(pow(_BASE, -1, 1 << 64), len(buf))
    words = _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    at = np.searchsorted(starts, first)
    at = np.append(at, len(starts))
    chain = words.copy()
    for k in range(1, width):
        chain[:len(words) - k] = _mix(chain[:len(words) - k] * np.uint64(_BASE) + words[k:])
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        n = b - a
        if n >= width:
            out.append(np.unique(chain[a:b - width + 1]))
        elif n:
            x = words[a:a + 1]
            for k in range(1, n):
                x = _mix(x * np.uint64(_BASE) + words[a + k:a + k + 1])
            out.append(x ^ np.uint64(n))  # apart from any full shingle
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``POSITIONS`` b-bit MinHash values per non-empty set."""
    x = np.concatenate(sets)
    at = np.cumsum([0, *[len(s) for s in sets]])[:-1]
    out = np.empty((len(sets), POSITIONS), np.uint16)
    for j in range(POSITIONS):
        low = np.minimum.reduceat((x * _A[j] + _B[j]) >> np.uint64(24), at)
        out[:, j] = (low & np.uint64((1 << BITS) - 1)).astype(np.uint16)
    return out


def index_keys(sig: np.ndarray) -> np.ndarray:
    """Keys of each signature: chunk and left-out position (6 bits), then the three values that stay."""
    n = len(sig)
    parts = sig.reshape(n, CHUNKS, CHUNK).astype(np.int64)
    keys = np.empty((n, CHUNKS, CHUNK), np.int64)
    for drop in range(CHUNK):
        a, b, c = [parts[:, :, p] for p in range(CHUNK) if p != drop]
        keys[:, :, drop] = a << 32 | b << 16 | c
    number = np.arange(CHUNKS * CHUNK, dtype=np.int64).reshape(CHUNKS, CHUNK) << 48
    return (keys | number).reshape(n, CHUNKS * CHUNK)


# ------------------------------------------------------------------ Spark steps

def _write(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"near-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` from Arrow batch to columns in the order of ``schema``."""
    import pyarrow as pa

    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(fn(b), names=names)

    return bounded_batches(df).mapInArrow(run, schema)


def signature_table(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id, n, h1, h2, sig``: set size, a 128-bit hash of the set, signature (null for the empty set)."""
    import pyarrow as pa

    def fn(b):
        sets = shingle_sets(strings(b.column(1)), width)
        full = [s for s in sets if len(s)]
        sig = iter(signatures(full)) if full else iter(())
        n, h1, h2, sigs = [], [], [], []
        for s, i in zip(sets, b.column(0).to_pylist()):
            n.append(len(s))
            if len(s):
                h1.append(int(_mix(s).sum(dtype=np.uint64).view(np.int64)))
                h2.append(int(np.bitwise_xor.reduce(_mix(s + np.uint64(_BASE))).view(np.int64)))
                sigs.append(next(sig).tobytes())
            else:  # empty sets are classes of their own
                h1.append(i)
                h2.append(0)
                sigs.append(None)
        return [b.column(0), *[pa.array(c, pa.int64()) for c in (n, h1, h2)], pa.array(sigs, pa.binary())]

    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"),
                                               text_or_empty(text_col).alias("text"))
    return _map(rows, fn, "id long, n long, h1 long, h2 long, sig binary")


def _keys(classes: DataFrame) -> DataFrame:
    import pyarrow as pa

    def fn(b):
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(b.num_rows, POSITIONS)
        per = CHUNKS * CHUNK
        return [pa.array(index_keys(sig).ravel()), b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), per)))]

    return _map(classes.select("rep", "sig"), fn, "key long, rep long")


def _close(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures are within the distance and whose set sizes allow the similarity."""
    import pyarrow as pa

    side = lambda x: classes.select(F.col("rep").alias(x), F.col("sig").alias(f"s{x}"), F.col("n").alias(f"n{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b") \
        .filter((100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))) \
        .select("a", "b", "sa", "sb")

    def fn(b):
        sa, sb = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint16).reshape(b.num_rows, POSITIONS) for k in (2, 3))
        near = pa.array(np.flatnonzero((sa != sb).sum(axis=1) <= DISTANCE))
        return [b.column(0).take(near), b.column(1).take(near)]

    return _map(rows, fn, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs confirmed on their full sets."""
    import pyarrow as pa

    rows = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b").select("a", "b", "sa", "sb")

    def fn(batch):
        yes = []
        for k in range(batch.num_rows):
            x, y = (np.frombuffer(batch.column(c)[k].as_py(), np.uint64) for c in (2, 3))
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                yes.append(k)
        yes = pa.array(yes, pa.int64())
        return [batch.column(0).take(yes), batch.column(1).take(yes)]

    return _map(rows, fn, "a long, b long")


def _sets_of(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, width: int) -> DataFrame:
    """``id, set`` (sorted 64-bit hashes as bytes) of the wanted documents."""
    import pyarrow as pa

    def fn(b):
        return [b.column(0), pa.array([s.tobytes() for s in shingle_sets(strings(b.column(1)), width)], pa.binary())]

    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"),
                                               text_or_empty(text_col).alias("text"))
    rows = rows.join(wanted, "id", "left_semi").dropDuplicates(["id"])
    return _map(rows, fn, "id long, set binary")


def components(edges: DataFrame) -> DataFrame:
    """``id, comp``: the smallest id each node of ``edges`` (a, b) reaches.

    Every pass takes the smallest label among the neighbours, then the label's
    own label; passes end when no label changes (about the logarithm of the
    longest path).
    """
    both = _write(edges.select(F.col("a").alias("id"), F.col("b").alias("to"))
                  .unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("to"))).distinct(), "edges")
    labels = both.groupBy("id").agg(F.least(F.min("to"), F.col("id")).alias("comp"))
    labels = _write(labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "to"), "to").groupBy("id").agg(F.min("comp").alias("near"))
        up = labels.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        new = labels.join(near, "id").join(up, "comp", "left") \
            .select("id", F.least("comp", "near", "up").alias("comp"), F.col("comp").alias("old"))
        new = _write(new, "labels")
        changed = not new.filter(F.col("comp") != F.col("old")).isEmpty()
        labels = new.select("id", "comp")
        if not changed:
            return labels


def _tiled(rows: DataFrame, group: str, tile: int) -> DataFrame:
    """Rows dealt to tiles: ``i <= j`` number the two sides, ``side`` says which one a row is on; ``g`` is the task.

    A group of n rows has n / ``tile`` sides; every pair of its rows meets in exactly one tile.
    """
    n = rows.groupBy(group).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    rows = rows.join(n, group).withColumn("side", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")) \
        .withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))) \
        .withColumns({"i": F.least("side", "u"), "j": F.greatest("side", "u")}).drop("u", "tiles")
    total = rows.count()
    return rows.withColumn("g", F.pmod(F.xxhash64(group, "i", "j"), F.lit(max(1, -(-total // TILE_ROWS)))))


def _tiles(table, group: str):
    """(rows, partners) of each tile of a task: row numbers, and for each the numbers of those it is compared with."""
    cols = [table[c].to_numpy() for c in (group, "i", "j", "rep")]
    order = np.lexsort(cols[::-1])
    k, i, j, _ = (c[order] for c in cols)
    side = table["side"].to_numpy()[order]
    cut = np.flatnonzero((np.diff(k) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(k)]):
        rows, own = order[lo:hi], side[lo:hi]
        if i[lo] == j[lo]:
            yield rows, [(x, np.arange(x + 1, hi - lo)) for x in range(hi - lo - 1)]
        else:
            other = np.flatnonzero(own == j[lo])
            yield rows, [(x, other) for x in np.flatnonzero(own == i[lo])]


def _signature_rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, POSITIONS)


def _candidates(sig, size, apart, tiles, percent):
    """(x, y, distance) of the pairs of one tile that are apart, within the distance and of fitting sizes."""
    rows, work = tiles
    out = []
    for x, y in work:
        a, b = rows[x], rows[y]
        keep = apart(a, b) & (100 * size[b] >= percent * size[a]) & (100 * size[a] >= percent * size[b])
        b = b[keep]
        d = (sig[b] != sig[a]).sum(axis=1)
        b, d = b[d <= DISTANCE], d[d <= DISTANCE]
        out.append(np.stack([np.full(len(b), a), b, d], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def _inside(members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components of one family: ``a, b``. ``members``: family, rep, comp."""
    import pyarrow as pa

    rows = members.join(classes.select("rep", "sig", "n"), "rep").join(sets.withColumnRenamed("id", "rep"), "rep")
    rows = _tiled(rows, "family", SET_TILE)

    def compare(key, table):
        rep, comp, size = (table[c].to_numpy() for c in ("rep", "comp", "n"))
        sig, raw, links = _signature_rows(table["sig"]), table["set"].to_pylist(), []
        sets_ = [np.frombuffer(r, np.uint64) for r in raw]
        for tile in _tiles(table, "family"):
            found = _candidates(sig, size, lambda a, b: comp[b] != comp[a], tile, percent)
            top: dict[int, int] = {}

            def root(c):
                while c in top:
                    c = top[c]
                return c
            for x, y, _ in found[np.argsort(found[:, 2], kind="stable")].tolist():
                a, b = root(comp[x]), root(comp[y])
                if a == b:
                    continue  # joined by a nearer pair
                u, v = sets_[x], sets_[y]
                if len(u) > len(v):
                    u, v = v, u
                at = np.searchsorted(v, u)
                both = int((v[np.minimum(at, len(v) - 1)] == u).sum())
                if 100 * both >= percent * (len(u) + len(v) - both):
                    top[max(a, b)] = min(a, b)
                    links.append((rep[x], rep[y]))
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    cols = ["g", "family", "i", "j", "side", "rep", "comp", "n", "sig", "set"]
    return rows.select(*cols).groupBy("g").applyInArrow(compare, "a long, b long")


def _across(groups: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of one key's group within the distance, in different families and components: ``a, b``.

    ``groups``: key, rep, comp, family. A pair is given under the first key it shares only.
    """
    import pyarrow as pa

    # a member's places in tiles are put in one row (of at most ``TILES_A_ROW`` sides of each of its keys), so that its signature
    # joins it once, not once per key
    tiles = _tiled(groups, "key", SIGNATURE_TILE).withColumn("part", F.floor(F.greatest("i", "j") / TILES_A_ROW))
    members = tiles.groupBy("rep", "comp", "family", "part").agg(F.collect_list(F.struct("g", "key", "i", "j", "side")).alias("at"))
    rows = members.join(classes.select("rep", "sig", "n"), "rep") \
        .select("rep", "comp", "family", "n", "sig", F.explode("at").alias("x")).select("*", "x.*").drop("x")

    def compare(key, table):
        rep, comp, family, size, k = (table[c].to_numpy() for c in ("rep", "comp", "family", "n", "key"))
        sig, out = _signature_rows(table["sig"]), []
        for tile in _tiles(table, "key"):
            found = _candidates(sig, size, lambda a, b: (comp[b] != comp[a]) & (family[b] != family[a]), tile, percent)
            x, y = found[:, 0], found[:, 1]
            first = (index_keys(sig[x]) == index_keys(sig[y])).argmax(axis=1) if len(x) else x
            x, y = (c[first == k[tile[0][0]] >> 48] for c in (x, y))
            out.append(np.stack([rep[x], rep[y]], axis=1))
        pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return rows.select("g", "key", "i", "j", "side", "rep", "comp", "family", "n", "sig") \
        .groupBy("g").applyInArrow(compare, "a long, b long")


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components (id, comp) after links that may join whole components or bring in new ids."""
    known = comps.unionByName(links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
                              .join(comps, "id", "left_anti").withColumn("comp", F.col("id")))
    of = lambda x: comps.select(F.col("id").alias(x), F.col("comp").alias(f"c{x}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left") \
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct()
    top = components(between).select(F.col("id").alias("comp"), F.col("comp").alias("top"))
    return _write(known.join(top, "comp", "left").select("id", F.coalesce("top", "comp").alias("comp")), "labels")


def _label(rows: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``rows`` with the label of their rep; a rep without one is its own."""
    labels = labels.select(F.col("id").alias("rep"), F.col("comp").alias(name))
    return rows.join(labels, "rep", "left").withColumn(name, F.coalesce(name, "rep"))


def _several(rows: DataFrame, group: str, *names: str) -> DataFrame:
    """The rows of groups in which every named label takes more than one value."""
    spans = rows.groupBy(group).agg(*[F.min(c).alias(f"_a{c}") for c in names], *[F.max(c).alias(f"_b{c}") for c in names])
    for c in names:
        spans = spans.filter(F.col(f"_a{c}") != F.col(f"_b{c}"))
    return rows.join(spans.select(group), group, "left_semi")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                 percent: int = 80) -> DataFrame:
    """One row per document: ``id, n_shingles, component_id`` (smallest id reachable over links)."""
    signed = _write(signature_table(docs, id_col, text_col, width), "signatures")
    classes = _write(signed.filter("n > 0 AND id IS NOT NULL").groupBy("n", "h1", "h2")
                     .agg(F.min("id").alias("rep"), F.first("sig").alias("sig")), "classes")
    keys = _keys(classes)
    shared = keys.groupBy("key").agg(F.min("rep").alias("low"), F.count("*").alias("c")).filter("c > 1")
    buckets = _write(keys.join(shared, "key"), "buckets")

    stars = buckets.filter("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = _write(_close(stars, classes, percent), "pairs")
    # groups of two are settled by their star; larger ones may be looked at again
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")) \
        .unionByName(buckets.filter("c > 2").select(F.col("rep").alias("id"))).distinct()
    sets = _write(_sets_of(docs, id_col, text_col, wanted, width), "sets")
    comps = components(_linked(pairs, sets, percent))

    families = components(pairs)
    members = _label(_label(families.select(F.col("id").alias("rep")), families, "family"), comps, "comp")
    members = _write(_several(members, "family", "comp"), "members")
    comps = _joined(comps, _write(_inside(members, classes, sets, percent), "links"))

    groups = _label(_label(buckets.filter("c > 2").select("key", "rep"), families, "family"), comps, "comp")
    groups = _write(_several(groups, "key", "family", "comp"), "groups")
    more = _write(_across(groups, classes, percent), "more")
    comps = _joined(comps, _write(_linked(more, sets, percent), "links"))
    named = classes.join(comps.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("n", "h1", "h2", F.coalesce("comp", "rep").alias("component"))
    return signed.join(named, ["n", "h1", "h2"], "left") \
        .select("id", F.col("n").alias("n_shingles"),
                F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def near_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                percent: int = 80) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every document."""
    return near_classes(docs, id_col, text_col, width, percent).select(
        F.col("id").alias(id_col), "n_shingles", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                     percent: int = 80) -> DataFrame:
    """The documents without those whose component holds a smaller id, all columns kept."""
    gone = near_classes(docs, id_col, text_col, width, percent) \
        .filter(F.col("id") != F.col("component_id")).select(F.col("id").alias("_gone"))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
