"""Registry of the queries on the test tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candela.plans.fixtures import Tables, with_views

DIGITS = 6
#: Means of scores with two decimals often end exactly between two of six digits; nine tell them apart.
FINER = {"sentiment_mean": 9, "sentiment_std": 9}


def digits(name: str) -> int:
    return FINER.get(name, DIGITS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def presentable(df: DataFrame) -> DataFrame:
    """Round doubles and drop the zone of timestamps, as the comparison SQL does."""
    columns = []
    for name, kind in df.dtypes:
        c = f"`{name}`"
        if kind == "double":
            c = f"round({c}, {digits(name)}) + 0.0D"
        elif kind == "timestamp":
            c = f"cast({c} as timestamp_ntz)"
        columns.append(f"{c} as `{name}`")
    return df.selectExpr(*columns)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with the SQL that gives the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: presentable(fn(Tables(spark, folder)))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def rounded(*names: str, prefix: str = "") -> str:
    """SQL list that rounds plain columns."""
    return ", ".join(f"round({prefix}{n}, {digits(n)}) + 0.0 as {n}" for n in names)


def rnd(expression: str, name: str) -> str:
    return f"round({expression}, {digits(name)}) + 0.0 as {name}"
