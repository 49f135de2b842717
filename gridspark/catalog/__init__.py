"""Named queries over the given tables, each with its DuckDB text where SQL can say the same."""

from gridspark.catalog import (  # noqa: F401
    aggregate_queries, align_queries, model_queries, scalar_queries, select_queries, series_queries,
    source_queries, stream_queries,
)
from gridspark.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
