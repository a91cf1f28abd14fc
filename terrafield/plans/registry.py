"""Where queries and their SQL are put down."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return put


def r6(c: Column | str, name: str | None = None) -> Column:
    """Six decimals, for values whose last digits depend on the order of a sum."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.round(c, 6)
    return out.alias(name) if name else out


def nudged(name: str) -> Column:
    """A mean of whole cents moved off the halves at the seventh decimal, which engines round apart."""
    return F.col(name) + F.lit(1e-8)
