"""Readers of landed files and writers of results. Schemas are always given, never inferred."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela import schemas
from candela.operators.clean import only_ticker
from candela.operators.nested import explode_articles

_CSV = {"header": "true", "multiLine": "true", "escape": '"', "mode": "PERMISSIVE"}


def _if_present(read: Callable[[], DataFrame], spark: SparkSession, schema: T.StructType) -> DataFrame:
    """What ``read`` opens, or an empty typed frame where the path is absent."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return schemas.empty(spark, schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """CSV by column name. Files without quoted line breaks can set ``multi_line`` false to split."""
    options = {**_CSV, "multiLine": str(multi_line).lower(), "enforceSchema": "false"}
    return spark.read.options(**options).schema(schema).csv(path)


def read_news_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The 13-column article export; clean it with ``clean_news``."""
    return read_csv(spark, path, schemas.NEWS_TEXT, multi_line)


def read_ticker_news(spark: SparkSession, folder: str, ticker: str) -> DataFrame:
    """One ticker's export ``{TICKER}_all_dates_data.csv``; an absent file gives an empty frame."""
    path = f"{folder}/{ticker.strip().upper()}_all_dates_data.csv"
    return only_ticker(_if_present(lambda: read_news_csv(spark, path), spark, schemas.NEWS_TEXT), ticker)


def read_combined_csv(
    spark: SparkSession, path: str, prefix: str = "msft", multi_line: bool = True
) -> DataFrame:
    """Articles with the prices of their day, all as text."""
    names = [
        "published_at",
        "ticker",
        "sentiment_score",
        "price_date_on_published_date",
        *(f"{prefix}_{c}_on_published_date" for c in schemas.OHLCV),
    ]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return read_csv(spark, path, schema, multi_line)


def read_news_json(
    spark: SparkSession, path: str, ticker: str | None = None, lines: bool = False
) -> DataFrame:
    """Landed news responses as articles in response order: one document per file, or per line.

    Files of ``lines`` are split between tasks; a file of one document is read whole by one task.
    With ``ticker`` the rows carry the requested ticker; otherwise use ``explode_entities``.
    """
    pages = spark.read.schema(schemas.NEWS_PAGE).json(path, multiLine=not lines, mode="PERMISSIVE")
    page = pages.select(F.struct(*pages.columns).alias("page"))
    if ticker is not None:
        page = page.withColumn("ticker", F.lit(ticker.strip().upper()))
    return explode_articles(page)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with a given schema; an absent path gives an empty typed frame."""
    return _if_present(lambda: spark.read.schema(schema).parquet(path), spark, schema)


# The default text format of timestamps drops microseconds.
_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_csv(df: DataFrame, path: str) -> None:
    options = {"header": "true", "escape": '"', "timestampFormat": _STAMP}
    df.write.mode("overwrite").options(**options).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_by_month(df: DataFrame, path: str, ts: str = "published_at") -> None:
    """Add a batch to a table partitioned by ticker and month.

    Rebalancing gathers each folder's rows into few files and still splits a folder that is large.
    """
    dated = df.withColumn("month", F.date_format(ts, "yyyy-MM"))
    dated.hint("rebalance", "ticker", "month").write.mode("append").partitionBy(
        "ticker", "month"
    ).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("timestampFormat", _STAMP).json(path)
