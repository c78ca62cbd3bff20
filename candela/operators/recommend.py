"""From raw model outputs to trade predictions and recommendation records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.operators.labels import BUY, HOLD, MAX_HOLDING, MAX_POSITION, SELL


def signal_name(code: Column) -> Column:
    return F.when(code == SELL, "SELL").when(code == HOLD, "HOLD").otherwise("BUY")


def signal_code(name: Column) -> Column:
    return F.when(name == "SELL", SELL).when(name == "HOLD", HOLD).when(name == "BUY", BUY)


def counter_action(signal: Column) -> Column:
    return F.when(signal == "BUY", "SELL").when(signal == "SELL", "BUY").otherwise("N/A")


def duration_text(minutes: Column) -> Column:
    """``2h 5m``, or ``5m`` below an hour."""
    hours = F.floor(minutes / 60)
    rest = F.concat((minutes % 60).cast("string"), F.lit("m"))
    return F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h "), rest)).otherwise(rest)


def post_process(
    raw: DataFrame, max_position: int = MAX_POSITION, max_holding: int = MAX_HOLDING
) -> DataFrame:
    """Clip and truncate the heads' outputs; HOLD clears size, timing and profit.

    Reads ``raw_signal`` (code), ``raw_position``, ``raw_timing``, ``raw_profit`` and
    ``raw_confidence``.
    """

    def clipped(name: str, low: int, high: int) -> Column:
        return F.least(F.greatest(F.col(name), F.lit(float(low))), F.lit(float(high))).cast("int")

    hold = F.col("raw_signal") == HOLD
    others = [c for c in raw.columns if not c.startswith("raw_")]
    return raw.select(
        *others,
        signal_name(F.col("raw_signal")).alias("signal"),
        F.when(hold, 0).otherwise(clipped("raw_position", 0, max_position)).alias("position_size"),
        F.when(hold, 0).otherwise(clipped("raw_timing", 1, max_holding)).alias("timing_minutes"),
        F.when(hold, 0.0).otherwise(F.col("raw_profit")).alias("expected_profit_pct"),
        F.col("raw_confidence").alias("signal_confidence"),
    )


def recommendations(predictions: DataFrame, prices: DataFrame) -> DataFrame:
    """One record per ticker from its prediction and its current price."""
    df = predictions.join(prices.select("ticker", F.col("price").alias("current_price")), "ticker")
    size, minutes = F.col("position_size"), F.col("timing_minutes")
    dollars = F.col("current_price") * size * F.col("expected_profit_pct") / 100
    return df.select(
        "ticker",
        "current_price",
        "signal",
        F.col("signal").alias("action"),
        size.alias("shares"),
        F.struct(
            minutes.alias("minutes"),
            duration_text(minutes).alias("formatted"),
            counter_action(F.col("signal")).alias("action"),
        ).alias("timing"),
        "expected_profit_pct",
        F.when(size > 0, dollars).otherwise(0.0).alias("expected_profit_dollars"),
        (F.col("current_price") * size).alias("total_investment"),
        F.col("signal_confidence").alias("confidence"),
    )
