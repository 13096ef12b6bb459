"""Registered queries: a name, a frame and, where possible, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.tables import Tables, with_tables


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, tables: tuple[str, ...] = (), sql: str | None = None):
    """Register a function of the derived tables under a name."""

    def keep(run: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, None if sql is None else with_tables(tables, sql))
        return run

    return keep


def portable(df: DataFrame) -> DataFrame:
    """Plain column types, so that two engines print the same values."""

    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double")
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(column.cast("array<string>"), ",")
        return column

    return df.select(*[plain(f).alias(f.name) for f in df.schema])


# --- SQL helpers ------------------------------------------------------------------


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def half_up(num: str, den: str, digits: int) -> str:
    """The quotient of two integers, the first not negative, rounded exactly."""
    scale = 10**digits
    return (
        f"CAST((2 * {scale} * CAST({num} AS HUGEINT) + {den}) // (2 * {den}) AS DOUBLE) / {scale}"
    )


def avg2(column: str, digits: int = 2) -> str:
    """Average of a decimal column with two places."""
    scale = 10 ** (digits - 2)
    return (
        f"CAST((2 * {scale} * CAST(sum({column}) * 100 AS HUGEINT) + count({column}))"
        f" // (2 * count({column})) AS DOUBLE) / {10**digits}"
    )
