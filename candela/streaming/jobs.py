"""The incremental jobs. Each takes a streaming frame and returns the started query.

State and sink live under the given paths, so a restarted job goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candela.operators.clean import overlay_latest
from candela.operators.indicators import FAMILIES, SMA_WINDOWS, history_rows
from candela.operators.nested import articles_to_news, explode_articles
from candela.schemas import empty
from candela.streaming.live import keyed_state

#: Bars read per ticker: what the indicators look back on, and the longest plain window before it.
HISTORY = history_rows(FAMILIES) + max(SMA_WINDOWS)


def _start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def article_stream(pages: DataFrame) -> DataFrame:
    """Pages (``ticker, page``) to usable articles, copies included; none is too old."""
    return articles_to_news(explode_articles(pages)).drop("seq")


def append_articles(
    news: DataFrame, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append articles to a table partitioned by ticker and month, each (uuid, ticker) once and for ever.

    The uuids of all months are keyed state on disk, looked up once an article, so a copy is dropped whatever
    its time says and however late it lands, and no earlier month is read. The article that lands first stays; of copies
    in one batch any one. The sink commits whole batches, so a replayed batch adds nothing.
    """
    keyed_state(news.sparkSession)
    dated = news.withColumn("month", F.date_format("published_at", "yyyy-MM"))
    layout = ["ticker", "month"]
    empty(news.sparkSession, dated.schema).write.mode("append").partitionBy(*layout).parquet(path)
    first = dated.dropDuplicates(["uuid", "ticker"])
    writer = first.writeStream.format("parquet").option("path", path).partitionBy(*layout).outputMode("append")
    return _start(writer, checkpoint, once)


def rolling_sentiment(
    news: DataFrame, span: str = "24 hours", step: str = "1 hour", lateness: str | None = None
) -> DataFrame:
    """Sentiment of each ticker over ``span`` every ``step``.

    State is one row per (ticker, step) of the history, and articles of any age count. A
    ``lateness`` bounds the state; articles that are later than it are then left out.
    """
    news = news.withWatermark("published_at", lateness) if lateness else news
    return (
        news.groupBy("ticker", F.window("published_at", span, step))
        .agg(
            F.count(F.lit(1)).alias("sentiment_count"),
            F.avg("sentiment").alias("sentiment_mean"),
            F.min("sentiment").alias("sentiment_min"),
            F.max("sentiment").alias("sentiment_max"),
            F.stddev_samp("sentiment").alias("sentiment_std"),
        )
        .select(
            "ticker",
            F.col("window.end").alias("timestamp"),
            "sentiment_mean",
            "sentiment_count",
            "sentiment_max",
            "sentiment_min",
            "sentiment_std",
        )
    )


def write_updates(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write each batch's changed rows under its batch number, so a replayed batch replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return _start(df.writeStream.outputMode("update").foreachBatch(write), checkpoint, once)


def latest_updates(table: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version of each key of a table written by :func:`write_updates`."""
    values = [c for c in table.columns if c not in (*keys, "epoch")]
    newest = F.max_by(F.struct(*values), "epoch").alias("_r")
    return table.groupBy(*keys).agg(newest).select(*keys, "_r.*")


def live_scores(
    prices: DataFrame,
    bars: Callable[[], DataFrame],
    score: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    history: int = HISTORY,
    once: bool = False,
) -> StreamingQuery:
    """Score the tickers of each batch of prices.

    Every batch puts the newest prices into the last bars, recomputes the last ``history`` bars of
    the tickers it touches and writes ``score`` of them; the indicators of a last bar are those of
    the whole series. ``bars`` reads the bar table afresh.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        touched = batch.select("ticker").distinct()
        series = bars().join(touched, "ticker", "left_semi")
        newest = Window.partitionBy("ticker").orderBy(F.desc("timestamp"))
        recent = series.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= history).drop("_nth")
        score(overlay_latest(recent, batch)).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return _start(prices.writeStream.foreachBatch(write), checkpoint, once)
