"""Registry of queries and their oracles, and small SQL helpers for the oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.tables import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Views only the oracles use: the KPI tables written as plain SQL.
ORACLE_VIEWS: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and its oracle SQL."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables.of(spark, folder))
        if oracle is not None:
            ORACLES[name] = with_views(oracle, ORACLE_VIEWS)
        return fn

    return add


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def txt(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR)"


def ts(expr: str) -> str:
    return f"strftime(CAST({expr} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"


def rnd(expr: str, scale: int) -> str:
    """Half-up rounding on decimals, handed over as a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), {scale}) AS DOUBLE)"


def eur(amount: str) -> str:
    return rnd(f"CAST({amount} AS DOUBLE) / 655.957", 0)


def part_of(num: str, den: str, scale: int, factor: float = 100.0) -> str:
    return rnd(f"{factor} * CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)", scale)


def months(first: str, last: str) -> str:
    """Sub-select with columns ms and me: one row per month."""
    return (
        f"(SELECT CAST(d AS DATE) AS ms, last_day(CAST(d AS DATE)) AS me FROM "
        f"unnest(generate_series(TIMESTAMP '{first}', TIMESTAMP '{last}', INTERVAL 1 MONTH)) AS g(d))"
    )
