"""Driver queries (one per operator of the inventory) and their DuckDB SQL
oracles. Importing this package registers every query, in a fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# registration order = import order (bench and reports follow it)
from tessera.plans.queries import vectors  # noqa: F401, E402
from tessera.plans.queries import labels  # noqa: F401, E402
from tessera.plans.queries import manifests  # noqa: F401, E402
from tessera.plans.queries import records  # noqa: F401, E402
from tessera.plans.queries import evaluation  # noqa: F401, E402
from tessera.plans.queries import training  # noqa: F401, E402
from tessera.plans.queries import files  # noqa: F401, E402
from tessera.plans.queries._registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "flagship"]


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return QUERIES["eval_summary"](spark, sf)
