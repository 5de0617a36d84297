"""Operator 3: personal data, and the terms that disclose it.

Base spans (email, ip, card, phone) are found by fixed patterns. Every distinct
value is a protected entity. From the whole corpus the operator counts, for an
entity e and a term t near it, in how many documents e, t and both occur (of
documents with the same words around e, copies, one counts). The share of e's
information that t gives away is
    PMI(e; t) / IC(e) = log(P(e|t) N / n_e) / log(N / n_e),   P(e|t) = n_et / (n_t + ``PRIOR``),
an estimate from below: for an entity of one document, a term of that document
alone is one of two, not of one. A term that gives away at least ``DISCLOSURE`` of it
is told: knowing the term would be nearly knowing the entity. Every occurrence of
a told term, in any document, is a span, generalised like the others to the name
of its kind in ``sanitise``.

The first pass over the texts yields base spans, the terms near them and each
task's document counts per term (64-bit hashes, a table of bounded size that is
written out when full); it is written to the shared folder, and the statistics are
joins and partial aggregates over its small rows. The second pass looks for the
told terms: a Bloom filter of them (``BLOOM_BITS``, 2 MiB whatever their number) is
broadcast and spares the rows of nearly all other words; what it lets through is
joined with the table of told terms, so the result is exact. Null and empty texts have no
spans; rows are told apart by id and text hash, so repeated ids and null ids are
safe; copies get the same spans; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import bounded_batches, only, strings, text_or_empty
from tessera.session import scratch_path

KINDS = ("email", "ip", "card", "phone", "term")
#: share of an entity's information that a term may not reach
DISCLOSURE = 0.9
#: occurrences of a term without the entity that are taken as given
PRIOR = 1.0
#: different documents in which the term must stand near the entity
SUPPORT = 1
BLOOM_BITS = 1 << 24
#: words on either side of an entity that are looked at
NEAR = 6
MIN_TERM = 3
#: terms a task counts before it writes its counts out
COUNTED = 400_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never starts inside a run of digits, so the look-behind only saves time
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")
_OUTER = ".,;:!?\"'()[]{}<>*$%&#|"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@domain.tld: the run before each @ in one step, so long runs stay linear."""
    done = 0
    at = text.find("@")
    while at >= 0:
        head = text[done:at]
        start = done + len(head.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def _octets(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def _luhn(found: str) -> bool:
    digits = [int(c) for c in found if c.isdigit()]
    if not 12 <= len(digits) <= 19:
        return False
    twice = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(twice) + sum(digits[-1::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost non-overlapping in each kind, by start and kind."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m[0])]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if _luhn(m[0])]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def _term(word: str) -> str:
    """The lower-case word without outer punctuation, '' if it is no term."""
    w = word.strip(_OUTER).lower()
    return w if len(w) >= MIN_TERM and "@" not in w and not _DIGIT.search(w) else ""


def _merged(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    """(start, end) of the spans, overlapping ones merged."""
    taken: list[list[int]] = []
    for a, _, b in spans:
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    return taken


def terms_near(text: str, spans: list[tuple[int, int, int]], near: int = NEAR) -> list[tuple[str, str, int, int, str]]:
    """(entity, term, start, end, context) for the terms within ``near`` words of each base span."""
    if not spans:
        return []
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    taken = _merged(spans)
    firsts = [a for a, _ in taken]
    out = []
    for a, kind, b in spans:
        entity = f"{KINDS[kind]}:{text[a:b].lower()}"
        left, right = bisect_right(ends, a), bisect_left(starts, b)
        around = words[max(0, left - near):left] + words[right:right + near]
        context = " ".join(text[x:y] for x, y in around)
        for x, y in around:
            word = text[x:y]
            term, at = _term(word), bisect_left(firsts, y) - 1
            if term and (at < 0 or taken[at][1] <= x):
                x += len(word) - len(word.lstrip(_OUTER))
                out.append((entity, term, x, x + len(word.strip(_OUTER)), context))
    return out


_SPAN = "array<struct<start:int,kind:int,end:int>>"
_SCAN = (f"id {{id}}, key long, base {_SPAN}, "
         "near array<struct<entity:long,term:long,start:int,end:int,context:long>>, term long, docs long")


def _scan(docs: DataFrame, id_col: str, text_col: str, near: int) -> DataFrame:
    """Rows of documents (id, key, base, near) and rows of counts (term, docs), told apart by ``key``."""
    import pyarrow as pa

    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    span_t = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    near_t = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()),
                                 ("end", pa.int32()), ("context", pa.int64())]))
    names = ["id", "key", "base", "near", "term", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        import xxhash

        def h(s: str) -> int:
            x = xxhash.xxh3_64_intdigest(s.encode())
            return x - (1 << 64) if x >> 63 else x

        counts, id_type = Counter(), None

        def flush():
            t = [_term(w) for w in counts]
            terms = Counter()
            for w, k in zip(t, counts.values()):
                if w:
                    terms[h(w)] += k
            counts.clear()
            n = len(terms)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, span_t), pa.nulls(n, near_t),
                 pa.array(list(terms.keys()), pa.int64()), pa.array(list(terms.values()), pa.int64())], names=names)

        for b in batches:
            id_type = b.column(0).type
            base, around = [], []
            for text in strings(b.column(1)):
                counts.update({w.strip(_OUTER) for w in set(text.lower().split())})
                spans = base_spans(text)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                around.append([{"entity": h(e), "term": h(t), "start": x, "end": y, "context": h(c)}
                               for e, t, x, y, c in terms_near(text, spans, near)])
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(base, span_t), pa.array(around, near_t),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
            if len(counts) > COUNTED:
                yield flush()
        if counts:
            yield flush()

    return bounded_batches(rows).mapInArrow(run, _SCAN.format(id=rows.schema[0].dataType.simpleString()))


def _write(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"pii-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def disclosing(scan: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``entity, term`` pairs whose term gives the entity away."""
    rows = scan.filter("key IS NOT NULL")
    n_rows = rows.agg(F.count(F.lit(1)).alias("n_all"))
    # every row is a document of its own; its terms and contexts count once
    hits = rows.filter(F.size("near") > 0).select(F.monotonically_increasing_id().alias("doc"), "near") \
        .select("doc", F.explode(F.array_distinct(F.transform("near", lambda x: F.struct(
            x["entity"].alias("entity"), x["term"].alias("term"), x["context"].alias("context"))))).alias("x")) \
        .select("doc", "x.entity", "x.term", "x.context")
    # documents with the same contexts are copies
    pair = hits.groupBy("entity", "term", "doc").agg(F.bit_xor("context").alias("all")) \
        .select("entity", "term", "all").distinct() \
        .groupBy("entity", "term").agg(F.count("*").alias("n_et")).filter(F.col("n_et") >= support)
    with_entity = rows.filter(F.size("near") > 0) \
        .select(F.explode(F.array_distinct(F.transform("near", lambda x: x["entity"]))).alias("entity")) \
        .groupBy("entity").agg(F.count("*").alias("n_e"))
    with_term = scan.filter("key IS NULL").groupBy("term").agg(F.sum("docs").alias("n_t"))
    known = pair.join(with_entity, "entity").join(with_term, "term")
    n_all = F.lit(float(max(1, n_rows.first()["n_all"])))
    ic = F.log2(n_all / F.col("n_e"))
    pmi = F.log2(F.least("n_et", "n_e", "n_t") / (F.col("n_t") + PRIOR) * n_all / F.col("n_e"))
    return known.filter((ic > 0) & (pmi >= disclosure * ic)).select("entity", "term")


def _bit_places(h, bits: int):
    """Two places of a 64-bit hash in a filter of ``bits`` bits (a power of two); works on numbers and arrays."""
    return h & (bits - 1), (h >> 32) & (bits - 1)


def bloom(terms: DataFrame, bits: int = BLOOM_BITS):
    """A bit table of ``term`` hashes; at most ``bits`` / 64 rows reach the driver."""
    import numpy as np

    places = F.array(*[p.alias("p") for p in (F.col("term").bitwiseAND(F.lit(bits - 1)),
                                              F.shiftright("term", 32).bitwiseAND(F.lit(bits - 1)))])
    words = terms.select(F.explode(places).alias("p")) \
        .select((F.col("p") / 8).cast("long").alias("byte"), F.expr("shiftleft(1, cast(pmod(p, 8) AS int))").alias("bit")) \
        .groupBy("byte").agg(F.bit_or("bit").alias("bits")) \
        .groupBy(F.floor(F.col("byte") / 4096).alias("page")).agg(F.collect_list(F.struct("byte", "bits")).alias("held"))
    table = np.zeros(bits // 8, np.uint8)
    for row in words.collect():
        for x in row["held"]:
            table[x["byte"]] = x["bits"]
    return table


def _occurrences(docs: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """``id, key, term, start, end`` of every occurrence of the told ``terms`` outside the base spans."""
    import pyarrow as pa

    table = bloom(terms)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    found_t = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        filled, bits = shared.value, BLOOM_BITS

        def candidate(word: str) -> int | None:
            t = _term(word)
            if not t:
                return None
            h = xxhash.xxh3_64_intdigest(t.encode())
            if all(filled[p >> 3] >> (p & 7) & 1 for p in _bit_places(h, bits)):
                return h - (1 << 64) if h >> 63 else h
            return None

        for b in batches:
            at, out = [], []
            for i, text in enumerate(strings(b.column(1))):
                told = {w: h for w in set(text.split()) if (h := candidate(w)) is not None}
                if not told:
                    continue
                taken = _merged(base_spans(text))
                firsts, here = [a for a, _ in taken], []
                for m in _WORD.finditer(text):
                    h = told.get(m[0])
                    if h is None:
                        continue
                    x, y = m.span()
                    k = bisect_left(firsts, y) - 1
                    if k < 0 or taken[k][1] <= x:
                        x += len(m[0]) - len(m[0].lstrip(_OUTER))
                        here.append({"term": h, "start": x, "end": x + len(m[0].strip(_OUTER))})
                if here:
                    at.append(i)
                    out.append(here)
            pick = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(2).take(pick), pa.array(out, found_t)],
                                             names=["id", "key", "found"])

    schema = f"id {rows.schema[0].dataType.simpleString()}, key long, found array<struct<term:long,start:int,end:int>>"
    maybe = bounded_batches(rows).mapInArrow(run, schema).select("id", "key", F.explode("found").alias("x")) \
        .select("id", "key", "x.term", "x.start", "x.end")
    return maybe.join(terms, "term", "left_semi")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE,
         support: int = SUPPORT, near: int = NEAR) -> DataFrame:
    """One row per document: ``id, key`` (text hash), ``base`` and ``spans`` (start, kind, end), sorted."""
    scan = _write(_scan(docs, id_col, text_col, near), "scan")
    rows = scan.filter("key IS NOT NULL")
    told = _write(disclosing(scan, disclosure, support).select("term").distinct(), "told")
    if told.isEmpty():
        return rows.select("id", "key", "base", F.sort_array("base").alias("spans"))
    added = _occurrences(docs, id_col, text_col, told) \
        .groupBy("id", "key").agg(F.collect_set(F.struct(
            "start", F.lit(KINDS.index("term")).alias("kind"), "end")).alias("added"))
    added = added.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "added")
    joined = rows.join(added, rows["id"].eqNullSafe(added["_id"]) & (rows["key"] == added["_key"]), "left")
    spans = F.sort_array(F.concat("base", F.coalesce("added", F.array().cast(_SPAN))))
    return joined.select("id", "key", "base", spans.alias("spans"))


def _text_form(spans: str):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans`` and ``n_term`` (disclosing terms)."""
    found = find(docs, id_col, text_col, **options)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select(F.col("id").alias(id_col), *[count(k) for k in KINDS[:4]],
                        F.sha2(_text_form("base"), 256).alias("base_sha256"), _text_form("spans").alias("spans"), count("term"))


def generalise(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, named by the first."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with personal data and disclosing terms generalised; all columns kept, null text stays null.

    Base patterns are applied where the text is; only the rows of documents
    with added terms travel to them.
    """
    import pyarrow as pa

    cols = docs.columns
    found = find(docs, id_col, text_col, **options).filter(F.size("spans") > F.size("base"))
    extra = _write(found.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("spans").alias("_spans")),
                   "added").dropDuplicates(["_id", "_key"])
    rows = docs.join(extra, docs[id_col].eqNullSafe(extra["_id"])
                     & (F.xxhash64(text_or_empty(docs[text_col])) == extra["_key"]), "left") \
        .select(*[docs[c] for c in cols], extra["_spans"])
    at = cols.index(text_col)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for text, spans in zip(b.column(at).to_pylist(), b.column(len(cols)).to_pylist()):
                if text is not None:
                    text = generalise(text, base_spans(text) if spans is None else
                                      [(s["start"], s["kind"], s["end"]) for s in spans])
                new.append(text)
            done = [b.column(i) for i in range(len(cols))]
            done[at] = pa.array(new, b.column(at).type)
            yield pa.RecordBatch.from_arrays(done, names=cols)

    return bounded_batches(rows).mapInArrow(run, schema)
