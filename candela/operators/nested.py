"""News documents: pages with articles, articles with entities."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.values import parse_utc
from candela.operators.clean import keep_first, top_rows
from candela.schemas import NEWS_PAGE, NEWS_TEXT_COLUMNS

ON_MISSING = ("skip", "zero", "null")
BATCH_DAYS = 30
THIN_WINDOW = 3


def parse_pages(raw: DataFrame, column: str = "json") -> DataFrame:
    """Page text to page structs; text that is no page gives no articles."""
    return raw.withColumn("page", F.from_json(column, NEWS_PAGE)).drop(column)


def explode_articles(pages: DataFrame, column: str = "page") -> DataFrame:
    """One row per article in response order (``seq``); pages without articles give none."""
    return (
        pages.select(
            *(c for c in pages.columns if c != column), F.posexplode(f"{column}.data")
        )
        .withColumnRenamed("pos", "seq")
        .where(F.col("col").isNotNull())
        .select("*", "col.*")
        .drop("col")
    )


def entity_sentiment(ticker: Column, on_missing: str = "skip") -> Column:
    """Score of the first entity with the ticker's symbol.

    An entity without a score counts as 0. Without such an entity the result is NULL, or 0 for
    ``zero``; with ``null`` a missing score stays NULL too.
    """
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing must be one of {ON_MISSING}")
    hits = F.filter("entities", lambda e: e["symbol"] == ticker)
    first = F.try_element_at(hits, F.lit(1))["sentiment_score"]
    if on_missing == "null":
        return first
    if on_missing == "zero":
        return F.coalesce(first, F.lit(0.0))
    return F.when(F.size(hits) > 0, F.coalesce(first, F.lit(0.0)))


def articles_to_news(articles: DataFrame, on_missing: str = "skip") -> DataFrame:
    """Usable articles as ``uuid, published_at, ticker, sentiment`` plus ``seq``.

    An article needs a uuid and a time that parses, and with ``skip`` an entity of its ticker.
    """
    news = articles.select(
        "uuid",
        parse_utc(F.col("published_at")).alias("published_at"),
        "ticker",
        entity_sentiment(F.col("ticker"), on_missing).alias("sentiment"),
        *(["seq"] if "seq" in articles.columns else []),
    ).where(F.col("uuid").isNotNull() & (F.col("uuid") != "") & F.col("published_at").isNotNull())
    return news.where(F.col("sentiment").isNotNull()) if on_missing == "skip" else news


def explode_entities(articles: DataFrame) -> DataFrame:
    """One row per (article, symbol) with the symbol's first score: news for every ticker at once."""
    symbols = F.array_distinct(
        F.transform(
            F.filter("entities", lambda e: e.isNotNull() & e["symbol"].isNotNull()),
            lambda e: e["symbol"],
        )
    )
    named = articles.drop("ticker").withColumn("ticker", F.explode(symbols))
    return articles_to_news(named)


def dedupe_uuid(news: DataFrame, order: tuple[str, ...] = ("published_at",)) -> DataFrame:
    """First accepted copy of each article and ticker. Apply it after the validity filters."""
    return keep_first(news, ["uuid", "ticker"], list(order))


def on_days(news: DataFrame, days: DataFrame) -> DataFrame:
    """Articles published on the wanted days (column ``day``)."""
    return news.join(days.select("day"), F.to_date("published_at") == F.col("day"), "left_semi")


def top_per_day(news: DataFrame, k: int, order: tuple[str, ...] = ("published_at", "uuid")) -> DataFrame:
    """At most ``k`` articles of each ticker and day, in response order."""
    dated = news.withColumn("_day", F.to_date("published_at"))
    return top_rows(dated, ["ticker", "_day"], list(order), k).drop("_day")


def cap_batches(
    news: DataFrame,
    start: dt.date | Column,
    cap: int,
    days: int = BATCH_DAYS,
    order: tuple[str, ...] = ("published_at", "uuid"),
) -> DataFrame:
    """At most ``cap`` articles of each ticker and run of ``days`` days; adds ``batch``."""
    first = start if isinstance(start, Column) else F.lit(start)
    age = F.datediff(F.to_date("published_at"), first)
    batch = F.floor((age - F.pmod(age, F.lit(days))) / days).cast("int")
    return top_rows(news.withColumn("batch", batch), ["ticker", "batch"], list(order), cap)


def range_fallback(news: DataFrame, days: DataFrame, k: int, cap: int) -> DataFrame:
    """``k`` articles a day on the wanted days; tickers without any get ``cap`` of the whole range."""
    chosen = top_per_day(on_days(news, days), k)
    have = chosen.select("ticker").distinct()
    rest = news.join(have, "ticker", "left_anti")
    return chosen.unionByName(top_rows(rest, ["ticker"], ["published_at", "uuid"], cap))


def session_articles(
    news: DataFrame,
    window_end: Column,
    cap: int,
    thin: int = THIN_WINDOW,
    order: tuple[str, ...] = ("published_at", "uuid"),
) -> DataFrame:
    """Per ticker and day: articles from midnight to ``window_end``, at most ``cap``.

    With fewer than ``thin`` of them the first ``thin`` of the day are used instead. The first
    articles of the window and of the day are cut off before the shuffle, so a busy day costs no
    more than a quiet one.
    """
    dated = news.withColumns(
        {"_day": F.to_date("published_at"), "_in": F.col("published_at") <= window_end}
    )
    inside = dated.where(F.col("_in"))
    counts = inside.groupBy("ticker", "_day").agg(F.count(F.lit(1)).alias("_n"))
    enough = counts.where(F.col("_n") >= thin).select("ticker", "_day")
    full = top_rows(inside, ["ticker", "_day"], list(order), cap).join(
        enough, ["ticker", "_day"], "left_semi"
    )
    scarce = top_rows(dated, ["ticker", "_day"], list(order), min(thin, cap)).join(
        enough, ["ticker", "_day"], "left_anti"
    )
    return full.unionByName(scarce).drop("_in").withColumnRenamed("_day", "day")


def session_sentiment(selected: DataFrame, tickers_days: DataFrame | None = None) -> DataFrame:
    """Mean sentiment of the selected articles per ticker and day; 0 where there are none."""
    means = selected.groupBy("ticker", "day").agg(
        F.avg("sentiment").alias("avg_sentiment"), F.count(F.lit(1)).alias("articles")
    )
    if tickers_days is None:
        return means
    return tickers_days.join(means, ["ticker", "day"], "left").fillna(
        {"avg_sentiment": 0.0, "articles": 0}
    )


def flatten_articles(articles: DataFrame) -> DataFrame:
    """Articles as the 13 flat columns, with the requested date; a missing score stays NULL."""
    return articles.withColumn(
        "sentiment_score", entity_sentiment(F.col("ticker"), "null")
    ).select(*NEWS_TEXT_COLUMNS)
