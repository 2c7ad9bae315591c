"""Queries of this folder and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = dict(queries.QUERIES)
ORACLES: dict[str, str] = dict(queries.ORACLES)
