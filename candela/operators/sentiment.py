"""Sentiment of the news in the window ``[t - 24h, t)`` before each bar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.operators.moments import merged, merge_two, moments, sample_deviation
from candela.timeline import slice_id

DAY_HOURS = 24
_HOUR_US = 3_600_000_000

SENTIMENT_COLUMNS = [
    "sentiment_mean",
    "sentiment_count",
    "sentiment_std",
    "sentiment_max",
    "sentiment_min",
]


def sentiment_window(
    bars: DataFrame, news: DataFrame, hours: int = DAY_HOURS, slices: int = DAY_HOURS
) -> DataFrame:
    """One row per bar: mean, count, sample deviation, max and min of its news; 0 without news.

    Articles without a score count as articles only. Bars of one time give one row.

    Time is cut into slices of ``hours / slices``. A window is then the rest of its first slice,
    the whole slices between, and the start of its last slice. The two ends are running sums over
    one (ticker, slice) group, and whole slices are added as one point at the start of the last
    slice. Nothing is paired: each article and each bar is handled twice, however dense they are,
    and a ticker spreads over as many tasks as it has slices.
    """
    width = hours * _HOUR_US // slices
    span = width * slices
    at = F.col("_at")

    # Articles at the same instant always share their windows, so they are summed up first.
    dated = news.where(F.col("published_at").isNotNull())
    instant = F.unix_micros("published_at")
    points = dated.groupBy("ticker", instant.alias("_at")).agg(moments("sentiment").alias("_m")).withColumn("_sl", slice_id(at, width))

    # End 0 reads a slice forwards from its start, end 1 backwards from its end. At equal times a
    # forward probe comes before the articles and a backward probe after them.
    def entry(end: int, sl: Column, axis: Column, rank: int) -> Column:
        return F.struct(
            F.lit(end).alias("_end"), sl.alias("_sl"), axis.alias("_axis"), F.lit(rank).alias("_rank")
        )

    def lane(source: DataFrame, *entries: Column) -> DataFrame:
        listed = source.select("*", F.explode(F.array(*entries)).alias("_e")).drop("_sl", "_at")
        return listed.select("*", "_e.*").drop("_e")

    sl = F.col("_sl")
    probes = bars.select(
        "ticker", F.col("timestamp").alias("_bar"), F.unix_micros("timestamp").alias("_at")
    )
    first, last = slice_id(at - span, width), slice_id(at, width)
    parts = [
        lane(points, entry(0, sl, at, 1), entry(1, sl, -at, 1)),
        lane(probes, entry(0, last, at, 0), entry(1, first, span - at, 2)),
    ]
    if slices > 1:
        whole = dated.groupBy("ticker", slice_id(instant, width).alias("_sl")).agg(moments("sentiment").alias("_m"))
        targets = whole.select("ticker", "_m", sl.alias("_from"), F.explode(F.sequence(sl + 1, sl + (slices - 1))).alias("_sl"))
        between = targets.groupBy("ticker", "_sl").agg(F.sort_array(F.collect_list(F.struct("_from", "_m"))).alias("_parts"))  # slices - 1 at most
        between = between.select("ticker", "_sl", merged(F.transform("_parts", lambda p: p["_m"])).alias("_m"))
        parts.append(lane(between, entry(0, sl, sl * width - 1, 0)))
    lanes = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)

    seen = (
        Window.partitionBy("ticker", "_sl", "_end")
        .orderBy("_axis", "_rank")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # Running sums of distances from the first score, which every later sum holds too, keep their digits.
    n, off = F.col("_m.n"), F.col("_m.mean") - F.col("_c")
    halves = lanes.withColumn("_c", F.first("_m.mean", ignorenulls=True).over(seen)).select(
        "ticker",
        "_bar",
        "_end",
        "_c",
        F.sum("_m.rows").over(seen).alias("rows"),
        F.sum("_m.n").over(seen).alias("n"),
        F.sum(n * off).over(seen).alias("_s"),
        F.sum(F.col("_m.m2") + n * off * off).over(seen).alias("_q"),
        F.max("_m.hi").over(seen).alias("hi"),
        F.min("_m.lo").over(seen).alias("lo"),
    ).where(F.col("_bar").isNotNull())
    apart = F.try_divide(F.col("_s"), F.col("n"))
    half = F.struct(
        "rows", "n", (F.col("_c") + apart).alias("mean"), F.greatest(F.col("_q") - F.col("_s") * apart, F.lit(0.0)).alias("m2"), "hi", "lo"
    )
    # A bar that comes twice has two equal halves of each kind.
    one = lambda end: F.any_value(F.when((F.col("_end") == end) & F.col("rows").isNotNull(), half), ignoreNulls=F.lit(True))
    both = halves.groupBy("ticker", F.col("_bar").alias("timestamp")).agg(one(0).alias("_h0"), one(1).alias("_h1"))
    # Bars without news have no half.
    every = both.select("ticker", "timestamp", merge_two(F.col("_h0"), F.col("_h1")).alias("_m"))
    m = F.col("_m")
    or_zero = lambda c: F.when(m.isNull(), F.lit(0.0)).otherwise(c)
    return every.select(
        "ticker",
        "timestamp",
        or_zero(m["mean"]).alias("sentiment_mean"),
        F.coalesce(m["rows"], F.lit(0)).alias("sentiment_count"),
        or_zero(F.when((m["n"] > 1) & (m["hi"] == m["lo"]), F.lit(0.0)).otherwise(sample_deviation(m))).alias("sentiment_std"),
        or_zero(m["hi"]).alias("sentiment_max"),
        or_zero(m["lo"]).alias("sentiment_min"),
    )


def without_news(bars: DataFrame) -> DataFrame:
    """The sentiment columns of bars when there is no news source."""
    zero = F.lit(0.0)
    return bars.withColumns(
        {c: F.lit(0).cast("long") if c.endswith("count") else zero for c in SENTIMENT_COLUMNS}
    )
