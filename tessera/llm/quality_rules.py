"""Operator 1: quality rules as a short-circuit cascade (DataFrame functions only).

Each rule says when a document is rejected and how much work it costs. A
bounded sample gives the share every rule rejects and its mean cost; rules are
then ordered greedily by rejections per unit of cost among the rows the earlier
rules left, and become one CASE expression, so later (dearer) rules run only
for rows that earlier ones kept. The order changes the work, never the verdict.

Null or empty text: no words, so the base rule rejects it. Rows are judged one
by one: copies, ties and extra columns make no difference; an empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import (NON_SPACE_CLASS, SPACE_CHARS, count_chars, filter_computed, only, text_or_empty, words_of)

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: rows read to estimate costs and selectivities (ordering only)
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """``reject`` is true for a document to drop; ``cost`` is its work in characters scanned."""

    name: str
    reject: Column
    cost: Column


def with_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 repeats: bool = True) -> DataFrame:
    """``id_col, _text`` and the base counts ``n_words, word_chars, n_symbols, n_lines, n_dup_lines``
    (and ``n_repeat_words``), all 64-bit."""
    base = only(docs, id_col, text_col).select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    base = base.withColumns({
        "_words": words_of(F.col("_text")),
        "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(NON_SPACE_CLASS)),
    })
    counted = base.select(
        id_col, "_text",
        F.when(F.lit(repeats), F.transform("_words", lambda w: F.xxhash64(w))).alias("_hash"),
        F.size("_words").cast("long").alias("n_words"),
        (F.char_length("_text") - count_chars(F.col("_text"), SPACE_CHARS)).cast("long").alias("word_chars"),
        count_chars(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    if not repeats:
        return counted.drop("_hash")
    return repeat_words(counted, "_hash", "n_repeat_words").drop("_hash")


def repeat_words(df: DataFrame, hash_col: str, out: str) -> DataFrame:
    """Words lying in a ``WINDOW``-word window that occurs twice or more.

    ``hash_col`` has one 64-bit hash per word. Windows are hashed from eight
    word hashes; only texts with a repeated window sort theirs, and the covered
    words are counted from the repeated start positions.
    """
    h = F.col(hash_col)
    n = F.size(h)
    df = df.withColumn("_win", F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[h[i + k] for k in range(WINDOW)]))))
    df = df.withColumn("_sorted", F.when(
        F.size("_win") > F.size(F.array_distinct("_win")),
        F.sort_array(F.transform("_win", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("_sorted")
    same = lambda a, b: F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))
    df = df.withColumn("_starts", F.sort_array(F.transform(
        F.filter(s, lambda x, j: same(j, j - 1) | same(j, j + 1)), lambda x: x["i"])))
    covered = F.aggregate(
        F.col("_starts"), F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total")),
        lambda acc, p: F.struct((p + WINDOW).alias("end"),
                                (acc["total"] + p + WINDOW - F.greatest(acc["end"], p)).cast("long").alias("total")),
        lambda acc: acc["total"])
    return df.withColumn(out, F.coalesce(covered, F.lit(0).cast("long"))).drop("_win", "_sorted", "_starts")


def base_failed() -> Column:
    """The fixed base rule: too few words, or more than 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Rules on top of the base one; each threshold leaves ordinary prose in any of the languages far below."""
    text, n = F.col("_text"), F.col("n_words")
    chars = F.char_length(text).cast("double")
    upper = F.char_length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    lower = F.char_length(F.regexp_replace(text, r"[^\p{Ll}]+", ""))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > 3 * n, F.lit(1.0)),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 25 * n), F.lit(1.0)),
        Rule("line_copies", (F.col("n_lines") >= 4) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")), F.lit(1.0)),
        Rule("exclamations", 10 * count_chars(text, "!") > 3 * n, chars),
        Rule("capitals", upper > lower, 4.0 * chars),
    ]


def order_rules(metrics: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per cost on ``sample_rows`` rows, each against what the ones before it left.

    The sample is the first rows Spark comes by, so only as many partitions are
    read as hold them; the driver gets a flag and a number per rule and row.
    """
    flags = [F.coalesce(r.reject, F.lit(False)).alias(f"_r{i}") for i, r in enumerate(rules)]
    costs = [r.cost.cast("double").alias(f"_c{i}") for i, r in enumerate(rules)]
    rows = metrics.select(*flags, *costs).limit(sample_rows).collect()
    left, order = list(range(len(rules))), []
    while left:
        def gain(i):
            cost = sum(r[f"_c{i}"] or 0.0 for r in rows) or 1.0
            return sum(r[f"_r{i}"] for r in rows) / cost
        best = max(left, key=lambda i: (gain(i), -i))
        order.append(rules[best])
        left.remove(best)
        rows = [r for r in rows if not r[f"_r{best}"]]
    return order


def cascade(rules: list[Rule]) -> Column:
    """True when no rule rejects; a CASE stops at the first that does."""
    expr = F
    for r in rules:
        expr = expr.when(F.coalesce(r.reject, F.lit(False)), F.lit(False))
    return expr.otherwise(F.lit(True)) if rules else F.lit(True)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: base counts, ``base_failed`` and ``kept``."""
    rules = default_rules() if rules is None else rules
    order = order_rules(with_metrics(docs, id_col, text_col, repeats=False), rules, sample_rows)
    m = with_metrics(docs, id_col, text_col)
    return m.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed().alias("base_failed"),
                    F.when(base_failed(), F.lit(False)).otherwise(cascade(order)).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None,
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that pass, with their own columns. The cheap cascade runs first; repeated windows, the
    dearest metric, are only counted for what it leaves."""
    cols = docs.columns
    rules = default_rules() if rules is None else rules
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.col(f"`{text_col}`").alias("_in"))
    order = order_rules(with_metrics(row, "_row", "_in", repeats=False), rules, sample_rows)
    cheap = filter_computed(with_metrics(row, "_row", "_in", repeats=False), (F.col("n_words") >= 20) & cascade(order))
    left = cheap.select("_row", "n_words", F.transform(words_of(F.col("_text")), lambda w: F.xxhash64(w)).alias("_hash"))
    kept = filter_computed(repeat_words(left, "_hash", "n_repeat_words"), ~base_failed())
    return kept.select(*[F.col("_row")[c].alias(c) for c in cols])
