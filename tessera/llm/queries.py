"""Queries of the training-data operators: ``opN_<name>`` over the whole of its table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


_BASE_RULES = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM win),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM h),
r AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM d WHERE n > 1),
rep AS (SELECT doc_id, sum(n) AS n FROM r GROUP BY doc_id),
m AS (
  SELECT w.doc_id, text, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
judged AS (
  SELECT *, NOT (base_failed
    OR 10 * n_symbols > 3 * n_words
    OR word_chars < 2 * n_words OR word_chars > 25 * n_words
    OR (n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines)
    OR 10 * (length(text) - length(replace(text, '!', ''))) > 3 * n_words
    OR length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) > length(regexp_replace(text, '[^\p{Ll}]+', '', 'g'))
    ) AS kept FROM b)
"""


@register("op1_quality_rules", _BASE_RULES + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
""")
def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 1: base counts and the cascade's verdict for every document."""
    from tessera.llm.quality_rules import judge

    return judge(table(spark, sf, "documents"))


@register("op2_packing")
def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 2: all documents packed into sequences of 4096 tokens, one row per piece."""
    from tessera.llm.packing import pack_documents

    return pack_documents(table(spark, sf, "documents"))


@register("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 4: every document encoded and decoded again."""
    from tessera.llm.byte_bpe import round_trip

    return round_trip(table(spark, sf, "documents"))


@register("op5_exact_dedup", """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
         AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
""")
def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 5: the class of equal texts of every document."""
    from tessera.llm.exact_dedup import dedup_report

    return dedup_report(table(spark, sf, "documents"))


@register("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 6: components of near copies (4-word shingles, similarity 0.8)."""
    from tessera.llm.near_dedup import near_report

    return near_report(table(spark, sf, "documents"), width=4, percent=80)


@register("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 9: compression-based quality score of every document."""
    from tessera.llm.quality_classifier import report

    return report(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 10: toxicity score of every document."""
    from tessera.llm.toxicity import report

    return report(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op3_pii")
def op3_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 3: personal data and disclosing terms of every document."""
    from tessera.llm.pii import report

    return report(table(spark, sf, "documents"))


@register("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 7: main text of every page."""
    from tessera.llm.html_extraction import extract

    return extract(table(spark, sf, "pages"))


@register("op8_licences")
def op8_licences(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 8: licence notices of every document."""
    from tessera.llm.licences import scan

    return scan(table(spark, sf, "documents"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register("op11_lexical_search", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLDED}, '{_TERM}') AS ts FROM documents),
c AS (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM c),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, s),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all({_FOLDED}, '{_TERM}')) AS term FROM benchmark)),
m AS (SELECT r, doc_id, 10 + (90 * n * big_n) // big_l AS m FROM c, s),
x AS (SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score, any_value(doc_id) AS doc_id
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY item_id, r),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
""")
def op11_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 11: the ten best documents of every benchmark item."""
    from tessera.llm.lexical_search import build_index, search

    return search(build_index(table(spark, sf, "documents")), table(spark, sf, "benchmark"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds of operator 12, one after the other; every list is unnested to (part, position) rows."""
    near = ("a{r} AS MATERIALIZED (SELECT vec_id, part, min_by(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT x.vec_id, x.part, b.entry, "
            "sum((x.v - b.v) * (x.v - b.v)) AS d FROM x JOIN b{r} b USING (part, pos) GROUP BY x.vec_id, x.part, b.entry) GROUP BY vec_id, part)")
    mean = ("b{n} AS MATERIALIZED (SELECT part, entry, pos, CASE WHEN c IS NULL THEN v ELSE (s - ((s % c) + c) % c) // c END AS v FROM b{r} LEFT JOIN "
            "(SELECT part, entry, pos, CAST(sum(v) AS BIGINT) AS s, count(*) AS c FROM x JOIN a{r} USING (vec_id, part) "
            "GROUP BY part, entry, pos) USING (part, entry, pos))")
    steps = ",\n".join(near.format(r=r) + ",\n" + mean.format(r=r, n=r + 1) for r in range(rounds))
    return f"""
WITH k AS (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
           AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
u AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding) AS c, len(embedding) // {parts} AS width FROM k),
x AS MATERIALIZED (SELECT vec_id, i // width AS part, i % width AS pos, CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT) AS v FROM u),
b0 AS MATERIALIZED (SELECT part, entry, pos, v FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k) USING (vec_id)
       WHERE entry < {entries}),
{steps},
{near.format(r=rounds)},
h AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds}),
e AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM e JOIN k USING (vec_id), h
"""


@register("op12_vector_codes", _codes_sql())
def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 12: code and error of every vector."""
    from tessera.llm.vector_codes import report

    return report(table(spark, sf, "embeddings"))


@register("op13_language_id")
def op13_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Operator 13: the language of every document."""
    from tessera.llm.language_id import report

    return report(table(spark, sf, "documents"))
