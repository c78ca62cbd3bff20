"""Cleaning of bars and news, and the row filters around it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.values import normalise_ticker, parse_utc, to_number
from candela.schemas import BARS, NEWS, OHLCV, require_columns


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    It is an aggregate, not a window, so copies are combined before the shuffle and a key that
    holds a large share of the rows does not end up in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    order = [c for c in order if c not in keys]
    if not order and not rest:
        return df.dropDuplicates(keys)
    row = F.min(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def normalise_bar_columns(raw: DataFrame, ticker: str | None = None) -> DataFrame:
    """Vendor column names (``Date, Open, ...``) to the bar columns, in order."""
    names = {"Date": "timestamp", **{c.capitalize(): c for c in OHLCV}}
    df = raw.withColumnsRenamed({old: new for old, new in names.items() if old in raw.columns})
    if ticker is not None:
        df = df.withColumn("ticker", F.lit(ticker))
    require_columns(df, BARS.names, "bars")
    return df.select(*BARS.names, *(c for c in df.columns if c not in BARS.names))


def clean_bars(
    raw: DataFrame,
    as_of: dt.datetime | None = None,
    zone: str = "UTC",
    order: list[str] | None = None,
) -> DataFrame:
    """Complete bars, one per (ticker, timestamp), none later than ``as_of``.

    Copies are removed before the values are converted, so a kept copy with bad text drops the bar.
    """
    df = normalise_bar_columns(raw)
    if dict(df.dtypes)["timestamp"] == "string":
        df = df.withColumn("timestamp", parse_utc(F.col("timestamp"), zone))
    df = df.dropna(how="any", subset=BARS.names)
    df = keep_first(df, ["ticker", "timestamp"], order or [])
    if as_of is not None:
        df = completed(df, as_of)
    return df.select(
        "timestamp", "ticker", *(to_number(F.col(c)).alias(c) for c in OHLCV)
    ).dropna(how="any")


def completed(df: DataFrame, as_of: dt.datetime | Column, ts: str = "timestamp") -> DataFrame:
    """Rows not later than ``as_of``."""
    limit = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.where(F.col(ts) <= limit)


def only_ticker(df: DataFrame, ticker: str) -> DataFrame:
    """Rows of one ticker, compared without case or blanks."""
    return df.where(normalise_ticker(F.col("ticker")) == ticker.strip().upper())


def between(
    df: DataFrame, start: dt.datetime | None, end: dt.datetime | None, ts: str
) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; the bounds reach the file scan."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end))
    return df


def since_days(df: DataFrame, days: int, as_of: dt.datetime, ts: str) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``."""
    return between(df, as_of - dt.timedelta(days=days), None, ts)


def clean_news(
    raw: DataFrame,
    ticker: str | None = None,
    keys: tuple[str, ...] = ("ticker", "published_at"),
    order: tuple[str, ...] = ("uuid",),
) -> DataFrame:
    """News text rows to ``published_at, ticker, sentiment``: typed, deduplicated, no missing times.

    A sentiment that is missing or no number counts as 0. ``keys`` may be ``published_at`` alone
    for a single-ticker file.
    """
    require_columns(raw, ["published_at", "ticker", "sentiment_score"], "news")
    df = raw if ticker is None else only_ticker(raw, ticker)
    order = [c for c in order if c in raw.columns]
    ts = F.col("published_at")
    if dict(raw.dtypes)["published_at"] == "string":
        ts = parse_utc(ts)
    df = df.select(
        ts.alias("published_at"),
        "ticker",
        to_number(F.col("sentiment_score"), 0.0).alias("sentiment"),
        *(F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)),
    ).where(F.col("published_at").isNotNull())
    return keep_first(df, list(keys), [f"_order_{i}" for i in range(len(order))]).select(*NEWS.names)


def split_news_and_bars(
    combined: DataFrame, order: list[str], prefix: str = "msft"
) -> tuple[DataFrame, DataFrame]:
    """One file of articles with their day's prices to a news table and a bar table.

    Of several rows for one article time or one bar the first by ``order`` stays, whatever its values.
    """
    needed = ["published_at", "ticker", "sentiment_score", "price_date_on_published_date"]
    values = {f"{prefix}_{c}_on_published_date": c for c in OHLCV}
    require_columns(combined, [*needed, *values], "combined news and prices")
    bars = combined.select(
        parse_utc(F.col("price_date_on_published_date")).alias("timestamp"),
        "ticker",
        *(to_number(F.col(old)).alias(new) for old, new in values.items()),
        *(F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)),
    ).dropna(how="any", subset=["timestamp", "ticker", *OHLCV])
    first = keep_first(bars, ["ticker", "timestamp"], [f"_order_{i}" for i in range(len(order))])
    return clean_news(combined, order=order), first.select(*BARS.names)


def overlay_latest(bars: DataFrame, prices: DataFrame) -> DataFrame:
    """Put the current price into the last bar of each ticker: close, and high or low if beyond."""
    last = bars.groupBy("ticker").agg(F.max("timestamp").alias("_last"))
    now = prices.groupBy("ticker").agg(F.max_by("price", F.struct("timestamp", "price")).alias("_now"))
    is_last = (F.col("timestamp") == F.col("_last")) & F.col("_now").isNotNull()

    def update(name: str, value: Column) -> Column:
        return F.when(is_last, value).otherwise(F.col(name)).alias(name)

    changed = {
        "close": update("close", F.col("_now")),
        "high": update("high", F.greatest("high", "_now")),
        "low": update("low", F.least("low", "_now")),
    }
    return (
        bars.join(last.join(now, "ticker", "left"), "ticker", "left")
        .select(*(changed.get(c, F.col(c)) for c in bars.columns))
    )


def latest_price(bars: DataFrame) -> DataFrame:
    """Close and time of the last bar of each ticker."""
    row = F.max_by(F.struct("timestamp", F.col("close").alias("price")), "timestamp").alias("_r")
    return bars.groupBy("ticker").agg(row).select("_r.timestamp", "ticker", "_r.price")


def prefer(primary: DataFrame, fallback: DataFrame, key: str = "ticker") -> DataFrame:
    """All of ``primary``, plus ``fallback`` for the tickers it does not have."""
    have = primary.select(key).distinct()
    return primary.unionByName(fallback.join(have, key, "left_anti").select(*primary.columns))


def top_rows(df: DataFrame, groups: list[str], order: list[str], k: int) -> DataFrame:
    """First ``k`` rows of each group; Spark trims groups to ``k`` rows before the shuffle."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")
