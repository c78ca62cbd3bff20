"""Rolling sentiment kept in tables, with no state in the stream: articles of any age count exactly.

Each batch adds its articles to the hours they belong to: rows, scores, mean, sum of squared deviations, extremes.
These can be merged, so a batch reads the hours it touches and those that share a window with them, and writes the
hours and windows that changed under its batch number. A replayed batch writes the same again. Every ``every`` batches
the newest rows are put together in one table, so a reader never opens more than ``every`` batches.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candela.operators.moments import moments, merged, merge_two, sample_deviation
from candela.streaming.jobs import _start

DAY_HOURS = 24
_DAY = dt.timedelta(days=1)
MOMENTS = "struct<rows:bigint,n:bigint,mean:double,m2:double,hi:double,lo:double>"
HOURS = f"ticker string, hour timestamp, m {MOMENTS}, day date"
WINDOWS = f"ticker string, timestamp timestamp, m {MOMENTS}, day date"
#: More touched days than this are read as one range.
LISTED_DAYS = 400


@dataclass
class Versions:
    """Rows by key, each batch its own folder; the newest row of a key counts."""

    spark: SparkSession
    path: str
    key: list[str]
    schema: str
    every: int

    def _parts(self, epoch: int) -> list[DataFrame]:
        base = epoch // self.every * self.every
        folders = [(e, f"{self.path}/epoch={e}") for e in range(base, epoch)]
        if base:
            folders.append((base - 1, f"{self.path}-base/upto={base - 1}"))
        read = self.spark.read.schema(self.schema)
        return [read.parquet(folder).withColumn("_epoch", F.lit(e)) for e, folder in folders]

    def before(self, epoch: int, where: Column | None = None) -> DataFrame:
        """Newest rows written before a batch; ``where`` may name the day, by which the folders are laid out."""
        parts = self._parts(epoch)
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = reduce(DataFrame.unionByName, parts if where is None else [p.where(where) for p in parts])
        newest = F.max_by(F.struct("m", "day"), "_epoch").alias("_r")
        return rows.groupBy(*self.key).agg(newest).select(*self.key, "_r.m", "_r.day")

    def write(self, df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/epoch={epoch}")
        if (epoch + 1) % self.every == 0:
            # The batch that ends a run also writes its summary, before it is committed.
            older = self.before(epoch)
            new = self.spark.read.schema(self.schema).parquet(f"{self.path}/epoch={epoch}")
            kept = older.join(new, self.key, "left_anti").unionByName(new.select(*older.columns))
            kept.write.mode("overwrite").partitionBy("day").parquet(f"{self.path}-base/upto={epoch}")


def _tables(spark: SparkSession, path: str, every: int) -> tuple[Versions, Versions]:
    return (
        Versions(spark, f"{path}/hours", ["ticker", "hour"], HOURS, every),
        Versions(spark, f"{path}/windows", ["ticker", "timestamp"], WINDOWS, every),
    )


def _in_days(days: list, ahead: int = 0) -> Column:
    """Whether a row's day is among the given ones or up to ``ahead`` days from one."""
    if len(days) > LISTED_DAYS:
        return F.col("day").between(F.date_add(F.lit(min(days)), -ahead), F.date_add(F.lit(max(days)), ahead))
    return F.col("day").isin(sorted({d + _DAY * k for d in days for k in range(-ahead, ahead + 1)}))


def sentiment_tables(
    news: DataFrame, path: str, checkpoint: str, hours: int = DAY_HOURS, every: int = 64, once: bool = False
) -> StreamingQuery:
    """Keep the sentiment of each ticker over the last ``hours`` at every full hour under ``path``.

    The stream itself has no state. Articles without a time or ticker are left out.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        hour_table, window_table = _tables(batch.sparkSession, path, every)
        usable = batch.where("published_at is not null and ticker is not null")
        hour = F.date_trunc("hour", "published_at")
        added = usable.groupBy("ticker", hour.alias("hour")).agg(moments("sentiment").alias("m")).withColumn("day", F.to_date("hour")).persist()
        days = [r.day for r in added.select("day").distinct().collect()]  # one row a day
        reach = -(-hours // 24)
        touched = added.select("ticker", "hour")
        known = hour_table.before(epoch, _in_days(days, reach))
        both = known.withColumnRenamed("m", "old").join(added.withColumnRenamed("m", "new").drop("day"), ["ticker", "hour"], "full")
        now = both.select("ticker", "hour", merge_two(F.col("old"), F.col("new")).alias("m"), F.to_date("hour").alias("day"), F.col("new").isNotNull().alias("_new")).persist()
        hour_table.write(now.where("_new").drop("_new"), epoch)
        # A window ends 1 to ``hours`` hours after the start of each hour in it.
        ends = F.explode(F.transform(F.sequence(F.lit(1), F.lit(hours)), lambda i: F.col("hour") + F.make_interval(hours=i))).alias("timestamp")
        changed = touched.select("ticker", ends).distinct()
        pieces = now.select("ticker", "hour", "m", ends).join(changed, ["ticker", "timestamp"], "left_semi")
        grouped = pieces.groupBy("ticker", "timestamp").agg(F.sort_array(F.collect_list(F.struct("hour", "m"))).alias("parts"))  # ``hours`` at most
        windows = grouped.select("ticker", "timestamp", merged(F.transform("parts", lambda p: p["m"])).alias("m"), F.to_date("timestamp").alias("day"))
        window_table.write(windows, epoch)
        now.unpersist()
        added.unpersist()

    return _start(news.writeStream.foreachBatch(write), checkpoint, once)


def read_sentiment(spark: SparkSession, path: str, epochs: int, every: int = 64) -> DataFrame:
    """The windows after the first ``epochs`` batches."""
    rows = _tables(spark, path, every)[1].before(epochs)
    m = F.col("m")
    return rows.select(
        "ticker", "timestamp", m["mean"].alias("sentiment_mean"), m["rows"].alias("sentiment_count"), m["hi"].alias("sentiment_max"),
        m["lo"].alias("sentiment_min"), sample_deviation(m).alias("sentiment_std"),
    )
