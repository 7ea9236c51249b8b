"""Registry of named queries: a Spark builder and, where one exists, DuckDB SQL.

Names follow ``<inventory id>_<short name>``. Every builder takes
``(spark, sf_dir)`` and reads the parquet tables of that folder (or data Spark
derives from them). SQL strings run on DuckDB with the same tables registered
as views; they are written independently of the Spark code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # Importing the modules fills REGISTRY.
    from memweave.plans import (  # noqa: F401
        collection_queries,
        text_queries,
        ingest_queries,
        render_chat_queries,
        memory_queries,
        io_queries,
        store_queries,
        search_queries,
        file_queries,
    )
    return REGISTRY
