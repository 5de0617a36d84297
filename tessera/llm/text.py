"""Shared text rules: word boundaries, A-Z lower-casing, null handling."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: white space of the word rule: space and \t \n \v \f \r
SPACE_CLASS = r"[\x20\x09-\x0D]"
NON_SPACE_CLASS = r"[^\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_or_empty(text: Column | str) -> Column:
    """The text as a string, '' for null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays (``lower`` would change more)."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text: Column) -> Column:
    """Array of the maximal runs of non-space characters."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` belong to ``chars``."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def tokenizer_path(name: str) -> str:
    """Default place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def single_threaded_tokenizers() -> None:
    """Inside Spark tasks the cores are Spark's; library thread pools stay off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def only(df: DataFrame, *cols: str) -> DataFrame:
    """Just the named columns, so that extra columns cannot clash with derived names."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def bounded_batches(df: DataFrame, rows: int = 1024, size: int = 16 << 20) -> DataFrame:
    """Cap the rows and bytes of each Arrow batch that Python tasks get (long texts), unless the user has."""
    conf = df.sparkSession.conf
    for key, default, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", rows),
                                ("spark.sql.execution.arrow.maxBytesPerBatch", None, size)):
        now = conf.get(key, None)
        if now in (None, default, "-1") or (default is None and int(re.sub(r"\D", "", now) or 0) > 1 << 30):
            conf.set(key, str(value))
    return df


def strings(column) -> list[str]:
    """The texts of an Arrow column, null as ''."""
    return ["" if t is None else t for t in column.to_pylist()]


def filter_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Filter by derived columns, each computed once per row.

    The optimizer moves a plain filter below the projection that derives its
    columns and copies their expressions in, once per use (inside a lambda: once
    per element). It does not move one that reads a row number.
    """
    return df.withColumn("_row_no", F.monotonically_increasing_id()) \
        .filter(condition & (F.col("_row_no") >= 0)).drop("_row_no")
