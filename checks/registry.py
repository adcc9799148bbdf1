"""All queries and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portalake import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, run: Query, sql: str) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = lambda spark, sf_dir: run(tune(spark), sf_dir)
    SQL[name] = sql


def query(name: str, sql: str):
    """Register a function as a query."""
    def register(run: Query) -> Query:
        add(name, run, sql)
        return run
    return register


def raw_from(df: DataFrame, key: str | None = None, **tokens: str) -> DataFrame:
    """Rows with the given SQL expressions as vendor tokens; NULL means not sent. ``key``
    names an SQL expression kept as ``k``."""
    pairs = [c for token, sql in tokens.items() for c in (F.lit(token), F.expr(sql).cast("string"))]
    raw = F.create_map(*pairs).alias("raw")
    return df.select(raw) if key is None else df.select(F.expr(key).alias("k"), raw)
