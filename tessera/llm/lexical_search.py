"""Operator 11: ranked lexical search, hybrid term-at-a-time and document-at-a-time.

``build_index`` cuts the documents, where they lie, into segments of a bounded
number of term occurrences and writes one posting row per (segment, term); no
text is shuffled. ``search`` takes the corpus counts from the index, gives each
query term its weight and meets every segment with blocks of the query set.
Inside a segment each query is answered by the hybrid:

* term at a time: the query's short posting lists (at most ``SHORT_SHARE`` of
  the segment's documents) are summed into accumulators;
* the accumulators then act as one more document-ordered iterator whose bound
  is its largest sum in a window of documents;
* document at a time: windows of ``WINDOW`` consecutive documents are passed in
  order; a window whose bounds (accumulators plus the best posting of each long
  list there) cannot reach the k-th best score so far is skipped without
  reading the long lists; any other window is scored exactly.

A skipped window holds only documents below the k-th score, so the result is
exact. The k best of each segment meet in one ranking per query, which Spark
limits to k rows a task before its shuffle.

Rows: a null text has no terms; documents without terms are not counted and
never found. Repeated documents are ranked one by one; equal scores rank by
ascending id, null ids last. Items that share an id (null too) are one query
with the terms of all. Items without known terms, empty tables on either side
and scores of 0 give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.text import bounded_batches, only
from tessera.session import scratch_path

#: a segment is closed when it holds this many term occurrences (a longer document is a segment of its own size)
SEGMENT_TERMS = 2_000_000
#: documents of one skipping step
WINDOW = 256
#: posting lists up to this share of a segment's documents are summed term at a time
SHORT_SHARE = 1 / 32
#: terms of one block of the query set
BLOCK_TERMS = 200_000

INDEX_SCHEMA = "segment long, term string, df long, total long, docs binary, tfs binary, ids array<bigint>"

# separators (every ASCII character that is no letter or digit) become a space, A-Z lower case; in UTF-8 all bytes of
# other characters lie above them and stay
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def terms_of(raw: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text: maximal runs of ASCII letters and digits and of non-ASCII characters, A-Z lowered."""
    return (raw or b"").translate(_FOLD).split()


def _binary_slices(values: np.ndarray, bounds: np.ndarray):
    """A binary column whose i-th entry holds the bytes of ``values[bounds[i]:bounds[i + 1]]``."""
    import pyarrow as pa

    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


class _Segment:
    """Documents gathered for one segment."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list = []
        self.lengths: list[int] = []
        self.flat = array("I")

    def add(self, doc_id, terms: list[bytes]) -> None:
        known = self.vocabulary
        for t in terms:
            if t not in known:
                known[t] = len(known)
        self.flat.extend(map(known.__getitem__, terms))
        self.ids.append(doc_id)
        self.lengths.append(len(terms))

    def rows(self, segment: int):
        """One row per term (documents and counts in document order) and one, of term null, for the documents."""
        import pyarrow as pa

        lengths = np.array(self.lengths, np.int64)
        key = np.frombuffer(self.flat, np.uint32).astype(np.uint64) << np.uint64(32)
        key |= np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        tfs = np.diff(np.append(first, len(key))).astype(np.uint32)
        key = key[first]
        term, docs = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        n = len(self.vocabulary)
        bounds = np.searchsorted(term, np.arange(n + 1))
        df = np.diff(bounds)
        total = np.add.reduceat(tfs.astype(np.int64), bounds[:-1])
        names = ["segment", "term", "df", "total", "docs", "tfs", "ids"]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(n, segment)), pa.array(list(self.vocabulary), pa.binary()).cast(pa.string()),
            pa.array(df), pa.array(total), _binary_slices(docs, bounds), _binary_slices(tfs, bounds),
            pa.nulls(n, pa.list_(pa.int64()))], names=names)
        yield pa.RecordBatch.from_arrays([
            pa.array([segment]), pa.nulls(1, pa.string()), pa.array([len(lengths)]), pa.array([int(lengths.sum())]),
            pa.nulls(1, pa.binary()), pa.array([lengths.astype(np.uint32).tobytes()], pa.binary()),
            pa.array([self.ids], pa.list_(pa.int64()))], names=names)


def build_index(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                segment_terms: int = SEGMENT_TERMS) -> DataFrame:
    """Write the posting table of ``docs`` below ``path`` (default: the shared scratch folder) and return it."""
    import pyarrow as pa

    spark = docs.sparkSession
    path = path or scratch_path(spark, "lexical-index")
    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"),
                                               F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        open_ = _Segment()
        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                terms = terms_of(raw.as_py())
                if not terms:
                    continue
                if open_.ids and len(open_.flat) + len(terms) > segment_terms:
                    yield from open_.rows(number)
                    open_, number = _Segment(), number + 1
                open_.add(doc_id, terms)
        if open_.ids:
            yield from open_.rows(number)

    bounded_batches(rows).mapInArrow(run, INDEX_SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- inside a segment

class _Postings:
    """A document-ordered list with its scores, cut into windows: where each begins and its best score."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, n_windows: int) -> None:
        self.docs, self.scores = docs, scores
        self.cuts = np.searchsorted(docs, np.arange(n_windows + 1) * WINDOW)
        self.best = np.zeros(n_windows, np.int64)
        held = np.flatnonzero(np.diff(self.cuts))
        if len(held):
            self.best[held] = np.maximum.reduceat(scores, self.cuts[held])

    def add_window(self, window: int, into: np.ndarray) -> None:
        a, b = self.cuts[window], self.cuts[window + 1]
        if a < b:
            into[self.docs[a:b] - window * WINDOW] += self.scores[a:b]


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the lists' scores summed by document, in document order."""
    if not lists:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    docs, scores = (np.concatenate(x) for x in zip(*lists))
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], scores[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[first], np.add.reduceat(scores, first)


def best_documents(short: list[tuple[np.ndarray, np.ndarray]], long: list[_Postings], n_docs: int, k: int
                   ) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents (and scores) that can be among the ``k`` best, ties at the k-th score included, and how many windows
    were scored."""
    n_windows = -(-n_docs // WINDOW)
    docs, sums = accumulate(short)
    iterators = [_Postings(docs, sums, n_windows), *long]
    bound = np.sum([it.best for it in iterators], axis=0)
    least = 1
    if len(sums) >= k:  # k documents have at least these sums
        least = max(least, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
    found_docs, found, scored = np.empty(0, np.int64), np.empty(0, np.int64), 0
    room = np.zeros(WINDOW, np.int64)
    for window in np.flatnonzero(bound >= least):
        if bound[window] < least:
            continue
        scored += 1
        room[:] = 0
        for it in iterators:
            it.add_window(window, room)
        at = np.flatnonzero(room >= least)
        if not len(at):
            continue
        found_docs, found = np.concatenate([found_docs, at + window * WINDOW]), np.concatenate([found, room[at]])
        if len(found) > k:
            least = max(least, int(np.partition(found, len(found) - k)[len(found) - k]))
            stay = found >= least
            found_docs, found = found_docs[stay], found[stay]
    return found_docs, found, scored


def length_norm(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m = 10 + (90 * n * N) div L, exact beyond 64 bits of the product too."""
    if len(lengths) and 90 * int(lengths.max()) * n_docs >= 1 << 63:
        return np.array([10 + 90 * int(n) * n_docs // n_terms for n in lengths], np.int64)
    return 10 + 90 * lengths * n_docs // n_terms


def _segment_hits(rows: dict, n_docs: int, n_terms: int, items: list, k: int, short_share: float
                  ) -> Iterator[tuple[object, list, np.ndarray]]:
    """(item id, document ids, scores) of each item in one segment; ``rows``: its posting rows by column."""
    head = rows["term"].index(None)
    ids = np.array(rows["ids"][head], dtype=object)
    m = length_norm(np.frombuffer(rows["tfs"][head], np.uint32).astype(np.int64), n_docs, n_terms)
    at = {t: i for i, t in enumerate(rows["term"]) if t is not None}
    n_windows, limit = -(-len(ids) // WINDOW), short_share * len(ids)
    made: dict[str, object] = {}

    def postings(term: str):
        if term not in made:
            i = at[term]
            docs = np.frombuffer(rows["docs"][i], np.uint32).astype(np.int64)
            tf = np.frombuffer(rows["tfs"][i], np.uint32).astype(np.int64)
            scores = rows["w"][i] * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
            made[term] = (docs, scores) if len(docs) <= limit else _Postings(docs, scores, n_windows)
        return made[term]

    for item in items:
        lists = [postings(t) for t in item["terms"] if t in at]
        short = [x for x in lists if isinstance(x, tuple)]
        docs, scores, _ = best_documents(short, [x for x in lists if not isinstance(x, tuple)], len(ids), k)
        if len(docs) == 0:
            continue
        order = sorted(range(len(docs)), key=lambda i: (-scores[i], ids[docs[i]] is None, ids[docs[i]] or 0))[:k]
        yield item["item_id"], [ids[docs[i]] for i in order], scores[order]


# ---------------------------------------------------------------- search

def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, term`` rows, each once."""
    import pyarrow as pa

    rows = only(items, id_col, text_col).select(F.col(f"`{id_col}`").alias("item_id"),
                                                F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [list(dict.fromkeys(terms_of(t.as_py()))) for t in b.column(1).cast(pa.binary())]
            col = pa.array(terms, pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), col], names=["item_id", "terms"])

    kind = rows.schema["item_id"].dataType.simpleString()
    made = bounded_batches(rows).mapInArrow(run, f"item_id {kind}, terms array<string>")
    return made.select("item_id", F.explode("terms").alias("term")).distinct()


def term_weight(df: Column, n_docs: int) -> Column:
    """floor(1000 * ln((2N + 2) / (2 df + 1)))"""
    return F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * df + 1).cast("double"))).cast("long")


def search(index: DataFrame, items: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text",
           id_col: str = "doc_id", short_share: float = SHORT_SHARE, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item, over an index of ``build_index``."""
    import pyarrow as pa

    spark = index.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    schema = f"item_id {kind}, doc_id long, score long"
    heads = index.filter(F.col("term").isNull())
    n_docs, n_terms, n_segments = heads.agg(F.sum("df"), F.sum("total"), F.count(F.lit(1))).first()
    if not n_segments:
        hits = spark.createDataFrame([], schema)
    else:
        wanted = item_terms(items, item_col, text_col)
        path = scratch_path(spark, "lexical-query")
        wanted.write.parquet(path)
        wanted = spark.read.parquet(path)
        # weights of the query terms that the corpus holds; a written table, so its size is known to the joins
        terms_path = scratch_path(spark, "lexical-terms")
        index.filter(F.col("term").isNotNull()).select("term", "df").join(wanted.select("term").distinct(), "term") \
            .groupBy("term").agg(F.sum("df").alias("df")) \
            .select("term", term_weight(F.col("df"), n_docs).alias("w")).filter("w > 0").write.parquet(terms_path)
        weights = spark.read.parquet(terms_path)
        known = wanted.join(weights, "term", "left_semi")
        n_blocks = max(1, -(-known.count() // block_terms))
        blocks = known.groupBy("item_id").agg(F.collect_list("term").alias("terms")) \
            .withColumn("block", F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(n_blocks))) \
            .groupBy("block").agg(F.collect_list(F.struct("item_id", "terms")).alias("items")) \
            .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_segments - 1)).cast("array<bigint>")))
        group = F.pmod(F.xxhash64("segment"), F.lit(n_segments)).alias("g")
        lists = index.join(weights, "term").select(group, "segment", "term", "w", "docs", "tfs", "ids") \
            .unionByName(heads.select(group, "segment", "term", F.lit(0).cast("long").alias("w"), "docs", "tfs", "ids"))
        if n_blocks > 1:
            lists = lists.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>")))
        else:
            lists = lists.withColumn("block", F.lit(0).cast("long"))

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            asked = [x for block in right.column("items").to_pylist() for x in block]
            out: list[tuple] = []
            segment = left.column("segment").to_numpy()
            for s in np.unique(segment) if asked else ():
                part = left.take(pa.array(np.flatnonzero(segment == s)))
                rows = {c: part.column(c).to_pylist() for c in ("term", "w", "docs", "tfs", "ids")}
                for item, ids, scores in _segment_hits(rows, n_docs, n_terms, asked, k, short_share):
                    out += [(item, i, int(x)) for i, x in zip(ids, scores)]
            item, ids, scores = zip(*out) if out else ((), (), ())
            return pa.table({"item_id": pa.array(item, right.schema.field("items").type.value_type.field("item_id").type),
                             "doc_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64())})

        hits = lists.groupBy("g", "block").cogroup(blocks.groupBy("g", "block")).applyInArrow(run, schema)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("item_id", "rank", F.col("doc_id").alias(id_col), "score")
