"""Descriptions of tables: statistics, missing values, copies, bands, coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.operators.quantiles import exact_quantiles

QUARTILES = {0.25: "p25", 0.5: "p50", 0.75: "p75"}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _long(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns]
    return df.select(*keys, F.explode(F.array(*cells)).alias("_c")).select(*keys, "_c.*")


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max; one row per numeric column."""
    columns = numeric_columns(df) if columns is None else columns
    stats = (
        _long(df, columns)
        .groupBy("column")
        .agg(
            F.count("v").alias("count"),
            F.avg("v").alias("mean"),
            F.stddev_samp("v").alias("std"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
        )
    )
    q = (
        exact_quantiles(df, columns, list(QUARTILES))
        .groupBy("column")
        .pivot("q", list(QUARTILES))
        .agg(F.first("quantile"))
        .withColumnsRenamed({str(k): v for k, v in QUARTILES.items()})
    )
    return stats.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", *QUARTILES.values(), "max"
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, where there are any; one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return (
        counts.select(F.explode(F.array(*cells)).alias("_c"))
        .select("_c.*")
        .where(F.col("nulls") > 0)
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier one."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def sentiment_bands(news: DataFrame) -> DataFrame:
    """Articles per sentiment band."""
    s = F.col("sentiment")
    band = (
        F.when(s < -0.5, "very_negative")
        .when(s < 0, "negative")
        .when(s == 0, "neutral")
        .when(s <= 0.5, "positive")
        .otherwise("very_positive")
    )
    return news.where(s.isNotNull()).groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("articles")
    )


def coverage(news: DataFrame, ts: str = "published_at", value: str = "sentiment") -> DataFrame:
    """Per ticker: row count, time span, and min, max, mean, median and deviation of the value."""
    stats = news.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(ts).alias("first_at"),
        F.max(ts).alias("last_at"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
    )
    median = exact_quantiles(news, [value], [0.5], ["ticker"]).select(
        "ticker", F.col("quantile").alias("median")
    )
    return stats.join(median, "ticker", "left")


def articles_per_day(news: DataFrame) -> DataFrame:
    """Per ticker: articles, days with articles, and their ratio."""
    daily = news.groupBy("ticker", F.to_date("published_at").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return daily.groupBy("ticker").agg(
        F.sum("_n").alias("articles"),
        F.count("_day").alias("days"),
        F.try_divide(F.sum("_n"), F.count("_day")).alias("per_day"),
    )


def score_trend(scored: DataFrame, score: str = "financial_health_score") -> DataFrame:
    """Per ticker: mean score, first and last score, and where they point."""
    first, last = F.min_by(score, "report_date"), F.max_by(score, "report_date")
    trend = F.when(F.count(F.lit(1)) == 1, "STABLE").when(last > first, "IMPROVING")
    return scored.groupBy("ticker").agg(
        F.avg(score).alias("mean_score"),
        first.alias("first_score"),
        last.alias("last_score"),
        trend.otherwise("DECLINING").alias("trend"),
        F.max_by("stock_impact_label", "report_date").alias("latest_impact"),
    )


def sentiment_when_present(features: DataFrame) -> DataFrame:
    """Per ticker: mean of the bar sentiments that had news, and the articles behind them."""
    has = F.col("sentiment_count") > 0
    return features.groupBy("ticker").agg(
        F.avg(F.when(has, F.col("sentiment_mean"))).alias("mean_sentiment"),
        F.sum("sentiment_count").alias("articles"),
        F.count_if(has).alias("bars_with_news"),
    )


def source_counts(**sources: DataFrame) -> DataFrame:
    """Rows of each named source."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*(F.col(c).desc() for c in order)).limit(n)
