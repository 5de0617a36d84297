"""Registry and shared helpers of the driver queries: one Spark plan per
operator of the inventory, each with an equivalent DuckDB SQL oracle (same
column names, same rounding).

Every query reads the given tables (or data Spark derives from them) in
whole. Array results are given in long form (key, pos, value) or as
comma-joined integer strings so both engines hash them the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

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


def _emb(spark, sf):
    return table(spark, sf, "embeddings")


def _long_form(df: DataFrame, key: str, arr_col: str, digits: int | None = 6) -> DataFrame:
    """(key, pos, value) rows of an array column; 0-based pos."""
    ex = df.select(F.col(key), F.posexplode(arr_col).alias("pos", "value"))
    val = F.col("value").cast("double")
    if digits is not None:
        val = F.round(val, digits)
    return ex.select(key, F.col("pos").cast("bigint").alias("pos"), val.alias("value"))


# SQL fragments shared by the oracles
_SQL_COS = ("list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])) / "
            "(sqrt(list_dot_product(CAST({a} AS DOUBLE[]), CAST({a} AS DOUBLE[]))) * "
            "sqrt(list_dot_product(CAST({b} AS DOUBLE[]), CAST({b} AS DOUBLE[]))))")
_SQL_U = "CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


_SQL_UE = _SQL_U.format(seed="{seed}", key="vec_id")

N_CLASSES = 10
