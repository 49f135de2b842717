"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; `sql` is its DuckDB text over the given tables and the named views."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Round float columns so that both engines' summation orders agree; -0.0 becomes 0.0.

    A thousandth of the last place is added first, so that exact ties (common among means of cents) round up on
    both sides.
    """
    nudge = 10.0 ** -(places + 3)
    return df.withColumns({c: F.round(F.col(c) + nudge, places) + F.lit(0.0) for c in columns})


def r(expr: str, alias: str, places: int = 6) -> str:
    """The same in DuckDB text."""
    return f"round(({expr}) + 1e-{places + 3}, {places}) + 0.0::DOUBLE AS {alias}"
