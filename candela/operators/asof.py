"""Backward as-of joins and the exact-match price alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.operators.fill import fill_series
from candela.schemas import STATEMENT_VALUES
from candela.timeline import DAY_US, slice_id


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    left_ts: str,
    right_ts: str,
    values: list[str],
    tie_break: list[str] | None = None,
    slice_days: int = 7,
) -> DataFrame:
    """Add to each left row the ``values`` of the last right row of its ticker not after it.

    The whole right row is carried, so a NULL value in it stays NULL. Of right rows with the same
    time the highest by ``tie_break`` counts.

    Both sides are cut into time slices and read in order inside each one, so a ticker spreads over as many tasks
    as it has slices and no row is copied. A slice also gets one extra right row, the last one before it, carried
    over on a table with a row per (ticker, slice). For many left rows of one time see :func:`asof_by_time`.
    """
    width = slice_days * DAY_US
    payload = F.struct(*values)
    tie = [F.col(c) for c in (tie_break or [])]
    keyed = (
        right.where(F.col(right_ts).isNotNull())
        .groupBy("ticker", F.unix_micros(right_ts).alias("_at"))
        .agg(F.max(F.struct(*(t.alias(f"t{i}") for i, t in enumerate(tie)), payload.alias("v"))).alias("_m"))
        .select("ticker", "_at", slice_id(F.col("_at"), width).alias("_sl"), F.col("_m.v").alias("_v"))
    )
    probes = left.withColumn("_at", F.unix_micros(left_ts)).withColumn(
        "_sl", slice_id(F.col("_at"), width)
    )

    closing = keyed.groupBy("ticker", "_sl").agg(F.max_by("_v", "_at").alias("_v"))
    wanted = probes.groupBy("ticker", "_sl").agg(F.lit(True).alias("_wanted"))
    before = (
        Window.partitionBy("ticker").orderBy("_sl").rowsBetween(Window.unboundedPreceding, -1)
    )
    opening = (
        closing.join(wanted, ["ticker", "_sl"], "full")
        .select("ticker", "_sl", "_wanted", F.last("_v", True).over(before).alias("_v"))
        .where(F.col("_wanted") & F.col("_v").isNotNull())
        .select("ticker", (F.col("_sl") * width - 1).alias("_at"), "_sl", "_v")
    )

    known = keyed.unionByName(opening).select("ticker", "_at", "_sl", "_v", F.lit(0).alias("_side"))
    lane = probes.withColumn("_side", F.lit(1)).unionByName(known, allowMissingColumns=True)
    so_far = Window.partitionBy("ticker", "_sl").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = lane.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far))
    return found.where(F.col("_side") == 1).select(
        *left.columns, *(F.col(f"_v.{c}").alias(c) for c in values)
    )


def asof_by_time(
    left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, values: list[str], tie_break: list[str] | None = None
) -> DataFrame:
    """As :func:`asof_backward` where many left rows share a time: each (ticker, time) is looked up once.

    Times are made distinct before the shuffle, and the answers are joined back on both keys, by broadcast where
    Spark finds them small; otherwise adaptive execution splits a time that holds much of the data.
    """
    times = left.select("ticker", left_ts).distinct()
    found = asof_backward(times, right, left_ts, right_ts, values, tie_break)
    found = found.select(F.col("ticker").alias("_ticker"), F.col(left_ts).alias("_time"), *values)
    joined = left.join(found, F.col("ticker").eqNullSafe(F.col("_ticker")) & F.col(left_ts).eqNullSafe(F.col("_time")), "left")
    return joined.select(*left.columns, *values)


def align_fundamentals(
    bars: DataFrame,
    fundamentals: DataFrame,
    values: list[str] | None = None,
    availability_lag_days: int = 0,
) -> DataFrame:
    """The latest report of each bar. A lag keeps a report unseen until it was published."""
    values = STATEMENT_VALUES if values is None else values
    if availability_lag_days:
        lag = F.make_dt_interval(days=F.lit(availability_lag_days))
        fundamentals = fundamentals.withColumn("report_date", F.col("report_date") + lag)
    return asof_backward(bars, fundamentals, "timestamp", "report_date", values)


def price_on_news(news: DataFrame, bars: DataFrame) -> DataFrame:
    """Close of the last trading day up to each article's day, as ``price_date`` and ``close``."""
    days = news.withColumn("price_date", F.date_trunc("day", "published_at"))
    closes = bars.select(
        "ticker", F.date_trunc("day", "timestamp").alias("_day"), "timestamp", "close"
    )
    found = asof_by_time(days, closes, "price_date", "_day", ["close"], tie_break=["timestamp"])
    return found.withColumnRenamed("close", "close_on_price_date")


def exact_price(bars: DataFrame, prices: DataFrame) -> DataFrame:
    """Add ``latest_price`` where a snapshot has exactly the bar's time, NULL elsewhere.

    Of several snapshots at one time the highest is kept.
    """
    snapshots = prices.groupBy("ticker", "timestamp").agg(F.max("price").alias("latest_price"))
    return bars.join(snapshots, ["ticker", "timestamp"], "left")


def align_latest_price(
    bars: DataFrame, prices: DataFrame, exact: bool = True, **layout: int
) -> DataFrame:
    """Snapshot prices on the bar timeline, carried forward.

    ``exact`` uses only snapshots at a bar's own time; otherwise any earlier snapshot counts.
    """
    if exact:
        return fill_series(exact_price(bars, prices), ["latest_price"], "forward", **layout)
    renamed = prices.select(
        "ticker", F.col("timestamp").alias("_seen"), F.col("price").alias("latest_price")
    )
    return asof_backward(bars, renamed, "timestamp", "_seen", ["latest_price"])
