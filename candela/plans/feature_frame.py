"""The wide feature frame: bars, indicators, sentiment, price, fundamentals, calendar, target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions.calendar_features import TIME_COLUMNS, add_time_features
from candela.operators.asof import align_fundamentals, exact_price
from candela.operators.fill import fill_across_blocks, fill_within_blocks
from candela.operators.indicators import (
    FAMILIES,
    INDICATOR_COLUMNS,
    add_families,
    history_rows,
    sort_order,
)
from candela.operators.sentiment import SENTIMENT_COLUMNS, sentiment_window, without_news
from candela.schemas import BARS, OHLCV, STATEMENT_VALUES, require_columns
from candela.session import materialize
from candela.timeline import BLK, KEEP, blocked

IMPACT_SCORE = "stock_impact_score"
NOT_FEATURES = ("timestamp", "ticker", "target")


def feature_columns(df: DataFrame) -> list[str]:
    """Columns a model may learn from."""
    return [c for c in df.columns if c not in NOT_FEATURES]


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows with every feature and the target present.

    Counting the present values is one predicate. One IS NOT NULL per column would make the
    optimizer derive filters from every combination of the fill's expressions.
    """
    needed = [*feature_columns(df), "target"]
    return df.dropna(thresh=len(needed), subset=needed)


def feature_frame(
    bars: DataFrame,
    news: DataFrame | None = None,
    prices: DataFrame | None = None,
    fundamentals: DataFrame | None = None,
    target: str = "close",
    horizon: int = 1,
    mode: str = "train",
    fill: str = "reference",
    **layout: int,
) -> DataFrame:
    """One row per bar with 53 features and ``target`` (54 with a scored fundamentals table).

    ``train`` keeps the bars whose target is known; ``score`` keeps every bar, so the last row of a
    ticker describes its last bar. Sources are joined while the frame is narrow; indicators, target
    and the local part of the fill then run on one more shuffle. The result of that stage is
    written once, because the fill reads it twice.

    Bars without rows are an error. Other sources may be absent or empty, for all tickers or for
    some: news count 0, prices are the closes, reports are 0. Every feature is filled.
    """
    if mode not in ("train", "score"):
        raise ValueError("mode must be train or score")
    require_columns(bars, BARS.names, "bars")
    if bars.isEmpty():
        raise ValueError("bars are empty")
    keys = bars.select("ticker", "timestamp")
    reports = list(STATEMENT_VALUES)
    if fundamentals is not None and IMPACT_SCORE in fundamentals.columns:
        reports.append(IMPACT_SCORE)

    df = bars.select("timestamp", "ticker", *OHLCV)
    if news is None:
        df = without_news(df)
    else:
        df = df.join(sentiment_window(keys, news), ["ticker", "timestamp"], "left")
    instead = None
    if prices is None:
        df = df.withColumn("latest_price", F.col("close"))
    else:
        # A ticker without any snapshot is priced by its closes, as without a price source.
        priced = prices.where(F.col("price").isNotNull())
        df = exact_price(df, prices)
        instead = ("latest_price", "close", priced)
        if fill == "none":
            closes = priced.select("ticker").distinct().withColumn("_priced", F.lit(True))
            price = F.when(F.col("_priced"), F.col("latest_price")).otherwise(F.col("close"))
            df = df.join(closes, "ticker", "left").withColumn("latest_price", price).drop("_priced")
    if fundamentals is None:
        df = df.withColumns({c: F.lit(None).cast("double") for c in reports})
    else:
        df = df.join(align_fundamentals(keys, fundamentals, reports), ["ticker", "timestamp"], "left")

    ahead_value = None
    if target in df.columns:
        ahead_value = {"target": f"lead({target}, {horizon}) over ({{w}})"}
    placed = blocked(df, back=history_rows(FAMILIES), ahead=horizon, index_of=keys, **layout)
    df = add_time_features(add_families(placed, FAMILIES, ahead_value))
    if target in INDICATOR_COLUMNS:
        w = f"partition by ticker, {BLK} order by {sort_order(FAMILIES)}"
        df = df.selectExpr("*", f"lead({target}, {horizon}) over ({w}) as target")
    elif ahead_value is None:
        df = df.withColumn("target", F.lit(None).cast("double"))
    if mode == "train":
        df = df.withColumn(KEEP, F.col(KEEP) & F.col("target").isNotNull())

    columns = [
        "timestamp",
        "ticker",
        *OHLCV,
        *INDICATOR_COLUMNS,
        *SENTIMENT_COLUMNS,
        "latest_price",
        *reports,
        *TIME_COLUMNS,
        "target",
    ]
    may_lack = [*OHLCV, *INDICATOR_COLUMNS, "sentiment_std", "latest_price", *reports]
    if fill == "none":
        return df.where(F.col(KEEP)).select(*columns)
    sort = sort_order(FAMILIES)
    local = fill_within_blocks(df, [*columns, BLK], may_lack, sort)
    return fill_across_blocks(materialize(local, "features"), may_lack, fill, instead).select(*columns)


def decompose(features: DataFrame) -> dict[str, DataFrame]:
    """Project a feature frame back to its four sources; a bar's mean sentiment is its news."""
    reports = [c for c in [*STATEMENT_VALUES, IMPACT_SCORE] if c in features.columns]
    at_bar = F.col("timestamp")
    mean = F.coalesce("sentiment_mean", F.lit(0.0)).alias("sentiment")
    return {
        "bars": features.select("timestamp", "ticker", *OHLCV),
        "prices": features.select("timestamp", "ticker", F.col("close").alias("price")),
        "news": features.select(at_bar.alias("published_at"), "ticker", mean),
        "fundamentals": features.select(at_bar.alias("report_date"), "ticker", *reports),
    }
