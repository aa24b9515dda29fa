"""Shared pieces of the metric catalogue: table access, SQL rounding
helpers for the oracle statements, and the registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metricforge.sources.tables import loader

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: put a ``(spark, sf_dir) -> DataFrame`` metric in the
    catalogue, with its equivalent SQL for a second engine (optional)."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def tables(spark: SparkSession, sf_dir: str):
    return loader(spark, sf_dir)


# --- SQL text helpers for the oracle statements --------------------------

def R(expr: str, scale: int = 2) -> str:
    """SQL twin of ``functions.numeric.dec_round``. Through text, as a double
    counts by its shortest digits (a direct cast scales it in binary)."""
    return f"CAST(ROUND(CAST(CAST(({expr}) AS STRING) AS DECIMAL(38,15)), {scale}) AS DOUBLE)"


def RATIO(num: str, den: str) -> str:
    return f"(CAST(({num}) AS DOUBLE) / CAST(NULLIF(({den}), 0) AS DOUBLE))"


def PCT(num: str, den: str, scale: int = 2) -> str:
    return R(f"{RATIO(num, den)} * 100.0", scale)


def MONEY(expr: str) -> str:
    return f"CAST(({expr}) AS DECIMAL(18,2))"


def RATE(expr: str) -> str:
    return f"CAST(({expr}) AS DECIMAL(18,9))"
