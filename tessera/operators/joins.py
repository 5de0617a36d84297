"""Join helpers that keep a hot NULL key out of one shuffle partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_nonnull(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      right_hint: str | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` where left rows with a
    NULL key (which can never match) bypass the join and get NULLs for the
    right-hand columns, instead of all hashing to one shuffle partition."""
    r = right.hint(right_hint) if right_hint else right
    cond: Column = left[left_key] == r[right_key]
    matched = left.where(F.col(left_key).isNotNull()).join(r, cond, "left")
    extra = [f for f in right.schema.fields if f.name not in left.columns]
    nulls = left.where(F.col(left_key).isNull()).select(
        *left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])
    return matched.unionByName(nulls)
