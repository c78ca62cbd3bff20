"""Streams against the batch operators: copies over months, late bars and prices, late news, bounded state."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candela.operators import clean
from candela.operators.indicators import INDICATOR_COLUMNS, indicators
from candela.operators.moments import merge_two, moments, sample_deviation
from candela.schemas import BARS, OHLCV, PRICES
from candela.session import new_path
from candela.streaming import jobs, live, rolling


def stream(spark, frames, schema):
    path = new_path(spark, "test-landing")
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def gappy(bars_pdf):
    pdf = bars_pdf.copy()
    rng = np.random.default_rng(2)
    pdf.loc[rng.random(len(pdf)) < 0.08, "close"] = np.nan
    pdf.loc[rng.random(len(pdf)) < 0.05, "volume"] = np.nan
    return pdf


def as_bars(spark, pdf):
    rows = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in pdf[BARS.names].itertuples(index=False, name=None)]
    return spark.createDataFrame([tuple(x.to_pydatetime() if isinstance(x, pd.Timestamp) else x for x in r) for r in rows], BARS)


@pytest.mark.parametrize("cuts", [[], [1], [3, 4, 60, 61, 500], list(range(0, 900, 37))])
def test_state_is_enough(spark, gappy, cuts):
    want = indicators(as_bars(spark, gappy)).where("ticker = 'AAA'").toPandas().sort_values("timestamp")
    one = gappy[gappy.ticker == "AAA"].sort_values("timestamp")
    state, got, kept = live.fresh_state(), {c: [] for c in INDICATOR_COLUMNS}, None
    for part in np.split(one[OHLCV].to_numpy(float), cuts):
        if not len(part):
            continue
        rows = part if kept is None else np.vstack([kept, part])
        state, found = live.advance(state, dict(zip(OHLCV, rows.T, strict=True)))
        kept = rows[-1:]
        for c in INDICATOR_COLUMNS:
            got[c].extend(found[c][len(rows) - len(part) :])
    for c in INDICATOR_COLUMNS:
        np.testing.assert_allclose(np.array(got[c]), want[c].to_numpy(float), rtol=1e-8, atol=1e-8, err_msg=c)
    assert sum(np.size(x) for x in state.values()) < 200


def test_bars_prices_and_late_bars(spark, gappy):
    bars = as_bars(spark, gappy)
    cut = pd.Timestamp(gappy[gappy.ticker == "AAA"].timestamp.iloc[700])
    early, rest = bars.where(F.col("timestamp") <= F.lit(cut)), bars.where(F.col("timestamp") > F.lit(cut))
    again = bars.where("ticker = 'AAA'").orderBy("timestamp").limit(3).withColumn("close", F.lit(1.0))
    prices = spark.createDataFrame([(dt.datetime(2024, 1, 1), "AAA", 9.0), (dt.datetime(2024, 1, 2), "AAA", 500.0), (dt.datetime(2024, 1, 2), "ZZZ", 1.0)], PRICES)
    blank = [F.lit(None).cast("double").alias(c) for c in OHLCV]
    event = lambda df: df.select("ticker", "timestamp", *OHLCV, F.lit(None).cast("double").alias("price"))
    price = prices.select("ticker", "timestamp", *blank, "price")
    source = stream(spark, [event(early), event(rest), event(again), price], event(early).schema)
    table = live.live_indicators(source.where("price is null"), source.where("price is not null").select("ticker", "timestamp", "price"))
    out = new_path(spark, "live")
    job = jobs.write_updates(table, out, new_path(spark, "state"), once=True)
    job.awaitTermination()
    assert job.lastProgress["stateOperators"][0]["numRowsTotal"] == 3  # one row of state a ticker
    found = spark.read.parquet(out)
    assert found.where("late").select("ticker", "close").collect() == [("AAA", 1.0)] * 3
    got = jobs.latest_updates(found.where("not late"), ["ticker", "timestamp"]).toPandas().sort_values(["ticker", "timestamp"])
    want = indicators(clean.overlay_latest(bars, prices)).toPandas().sort_values(["ticker", "timestamp"])
    assert len(got) == len(want) == len(gappy) and got[got.ticker == "AAA"].close.iloc[-1] == 500.0
    for c in [*OHLCV, *INDICATOR_COLUMNS]:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-8, atol=1e-8, err_msg=c)
    changed = found.where("epoch = 2 and not late or epoch = 3").select("ticker").distinct().collect()
    assert changed == [("AAA",)]


NEWS = "uuid long, published_at timestamp, ticker string, sentiment double"


def test_uuid_memory_spans_months_and_restarts(spark):
    at = lambda text: pd.Timestamp(text).to_pydatetime()
    first = spark.createDataFrame([(1, at("2024-01-05"), "A", 0.1), (1, at("2024-01-05"), "B", 0.2), (2, at("2024-02-01"), "A", 0.3)], NEWS)
    second = spark.createDataFrame([(1, at("2024-06-05"), "A", 0.9), (3, at("2023-01-01"), "A", 0.4), (2, at("2024-01-31"), "A", 0.9)], NEWS)
    path, out, state = new_path(spark, "in"), new_path(spark, "out"), new_path(spark, "state")
    for frame in (first, second, second):  # the job ends and starts again between landings
        frame.coalesce(1).write.mode("append").parquet(path)
        source = spark.readStream.schema(NEWS).parquet(path)
        jobs.append_articles(source, out, state, once=True).awaitTermination()
    rows = spark.read.parquet(out).orderBy("uuid", "ticker").collect()
    assert [(r.uuid, r.ticker, r.sentiment, str(r.month)) for r in rows] == [(1, "A", 0.1, "2024-01"), (1, "B", 0.2, "2024-01"), (2, "A", 0.3, "2024-02"), (3, "A", 0.4, "2023-01")]


def test_late_news_without_state(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(int(i), pd.Timestamp("2024-01-01") + pd.Timedelta(hours=float(h)), "AB"[i % 2], float(1e6 + k * 1e-3)) for i, (h, k) in enumerate(zip(rng.uniform(0, 24 * 90, 900), rng.integers(0, 9, 900), strict=True))]
    rows += [(10_000, pd.Timestamp("2024-01-10"), "A", None), (10_001, None, "A", 1.0), (10_002, pd.Timestamp("2024-05-10"), "C", None)]
    news = spark.createDataFrame([(i, at and at.floor("us").to_pydatetime(), t, x) for i, at, t, x in rows], NEWS)
    parts = [news.where(F.coalesce(F.pmod(F.hash("uuid"), F.lit(7)), F.lit(0)) == k) for k in range(7)]
    opened = []
    true = rolling.Versions._parts
    monkeypatch.setattr(rolling.Versions, "_parts", lambda self, epoch: opened.append(len(out := true(self, epoch))) or out)
    path = new_path(spark, "rolling")
    job = rolling.sentiment_tables(stream(spark, parts, NEWS), path, new_path(spark, "state"), every=3, once=True)
    job.awaitTermination()
    assert job.lastProgress["stateOperators"] == [] and max(opened) <= 3
    got = rolling.read_sentiment(spark, path, 7, 3).toPandas().set_index(["ticker", "timestamp"]).sort_index()
    want = {}
    for _, at, ticker, x in rows:
        if at is not None:
            for i in range(1, 25):
                want.setdefault((ticker, at.floor("h") + pd.Timedelta(hours=i)), []).append(np.nan if x is None else x)
    assert len(got) == len(want)
    for key, r in zip(got.index, got.itertuples(), strict=True):
        x = pd.Series(want[key], dtype=float)
        assert r.sentiment_count == len(x)
        for a, b in ((r.sentiment_mean, x.mean()), (r.sentiment_std, x.std()), (r.sentiment_max, x.max()), (r.sentiment_min, x.min())):
            np.testing.assert_allclose(a, b, rtol=1e-12, atol=1e-7)


def test_moments_keep_digits(spark):
    df = spark.range(1000).selectExpr("id", "id % 4 as g", "if(id % 10 = 0, null, 1e9 + (id % 7) * 1e-3) as x")
    two = df.groupBy("g").agg(moments("x").alias("m")).orderBy("g").collect()
    parts = spark.createDataFrame([(two[0].m, two[1].m), (None, two[2].m), (two[3].m, None)], "a struct<rows:long,n:long,mean:double,m2:double,hi:double,lo:double>, b struct<rows:long,n:long,mean:double,m2:double,hi:double,lo:double>")
    merged = parts.select(merge_two(F.col("a"), F.col("b")).alias("m")).select("m", sample_deviation(F.col("m")).alias("s")).collect()
    pdf = df.toPandas()
    for row, groups in zip(merged, ([0, 1], [2], [3]), strict=True):
        x = pdf[pdf.g.isin(groups)].x
        assert (row.m.rows, row.m.n) == (len(x), x.count())
        np.testing.assert_allclose(row.s, (x - 1e9).std(), rtol=1e-4)


def test_a_landed_frame_of_many_files_is_one_batch(spark):
    from types import SimpleNamespace

    from candela.plans.job_queries import _landings

    seen, state = [], new_path(spark, "state")

    def start(source):
        write = lambda batch, epoch: seen.append((epoch, batch.count()))
        return source.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()

    _landings(SimpleNamespace(spark=spark), [spark.range(0, 90, 1, 3), spark.range(0, 40, 1, 4)], "many", start)
    assert seen == [(0, 90), (1, 40)]
