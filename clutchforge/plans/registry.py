"""Named queries: key -> (spark, data_dir) -> DataFrame.

Each query builds its own Catalog over the data directory. Raw and core tables
are derived from the whole input tables once per state of the input files and code
(sources.tables) and shared between queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure, size_shuffles
from ..sources.tables import Catalog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register ``fn(cat) -> DataFrame`` under ``name``."""
    def wrap(fn: Callable[[Catalog], DataFrame]):
        def run(spark: SparkSession, root: str) -> DataFrame:
            configure(spark)  # UTC, ANSI, AQE settings the jobs rely on
            cat = Catalog(spark, root)
            size_shuffles(spark, cat.input_bytes())
            return fn(cat)
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return wrap


def all_queries() -> dict[str, Query]:
    # importing the modules registers their queries
    from . import queries_core, queries_extra, queries_features, queries_io, queries_ml, queries_norm  # noqa: F401
    return dict(QUERIES)
