"""As-of joins, the sentiment window and the feature frame at their edges."""

from functools import partial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candela import schemas
from candela.operators.asof import align_fundamentals, align_latest_price, asof_backward, asof_by_time, price_on_news
from candela.operators.sentiment import sentiment_window
from candela.plans.feature_frame import decompose, feature_columns, feature_frame


def by_key(df):
    return df.toPandas().sort_values(["ticker", "timestamp"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def news_pdf():
    rng = np.random.default_rng(3)
    n = 500
    stamps = pd.Timestamp("2024-03-01") + pd.to_timedelta(rng.integers(0, 30 * 24, n), unit="h")
    return pd.DataFrame(
        {
            "published_at": stamps,
            "ticker": rng.choice(["AAA", "BBB", "NONE"], n, p=[0.7, 0.2, 0.1]),
            "sentiment": np.round(rng.uniform(-1, 1, n), 2),
        }
    )


@pytest.fixture(scope="module")
def news(spark, news_pdf):
    return spark.createDataFrame(news_pdf, schemas.NEWS)


def loop_sentiment(bars, news):
    out = []
    for ticker, g in bars.groupby("ticker"):
        mine = news[news.ticker == ticker]
        for ts in g.timestamp:
            s = mine[(mine.published_at >= ts - pd.Timedelta("24h")) & (mine.published_at < ts)].sentiment
            some = len(s) > 0
            out.append((ticker, ts, s.mean() if some else 0.0, len(s), s.std() if some else 0.0,
                        s.max() if some else 0.0, s.min() if some else 0.0))
    names = ["ticker", "timestamp", "sentiment_mean", "sentiment_count", "sentiment_std",
             "sentiment_max", "sentiment_min"]
    return pd.DataFrame(out, columns=names).sort_values(["ticker", "timestamp"]).reset_index(drop=True)


@pytest.mark.parametrize("slices", [1, 2, 24])
def test_sentiment_matches_loop(bars, bars_pdf, news, news_pdf, slices):
    got = by_key(sentiment_window(bars, news, slices=slices))
    want = loop_sentiment(bars_pdf, news_pdf)
    assert len(got) == len(want)
    for c in want.columns[2:]:
        np.testing.assert_allclose(got[c].astype(float), want[c], atol=1e-9, err_msg=c)


def test_sentiment_edges(spark):
    news = spark.sql("""select * from values
        (timestamp'2024-01-02 12:00:00', 'X', 0.4d), (timestamp'2024-01-01 12:00:00', 'X', 0.2d),
        (timestamp'2024-01-01 11:59:59.999999', 'X', 9d), (timestamp'2024-01-02 11:00:00', 'Y', 5d)
        as t(published_at, ticker, sentiment)""")
    bars = spark.sql("select 'X' as ticker, timestamp'2024-01-02 12:00:00' as timestamp")
    row = sentiment_window(bars, news).first()
    assert (row.sentiment_count, row.sentiment_mean, row.sentiment_std) == (1, 0.2, None)
    later = spark.sql("select 'X' as ticker, timestamp'2024-02-01 00:00:00' as timestamp")
    row = sentiment_window(later, news).first()
    assert (row.sentiment_count, row.sentiment_mean, row.sentiment_std) == (0, 0.0, 0.0)


def test_equal_articles_have_no_deviation(spark):
    news = spark.sql("""select timestamp'2024-01-01' + make_dt_interval(0, 0, cast(id as int)) as published_at,
        'X' as ticker, 0.3d as sentiment from range(100)""")
    bars = spark.sql("select 'X' as ticker, timestamp'2024-01-01 03:00:00' as timestamp")
    assert sentiment_window(bars, news).first().sentiment_std == 0.0


@pytest.mark.parametrize("asof", [partial(asof_backward, slice_days=2), asof_by_time])
def test_asof_micro_case(spark, asof):
    day = "timestamp'2024-01-01' + make_dt_interval({})"
    left = spark.sql(f"select 'X' as ticker, {day.format('i')} as timestamp from values 0, 1, 2, 3, 5, 400 t(i)")
    right = spark.sql(f"""select 'X' as ticker, {day.format('i')} as seen, v, k from values
        (1, 1d, 1), (1, 2d, 2), (4, cast(null as double), 3) t(i, v, k)
        union all select 'Y', {day.format('0')}, 99d, 4""")
    got = by_key(asof(left, right, "timestamp", "seen", ["v"], ["k"]))
    np.testing.assert_array_equal(got.v, [np.nan, 2, 2, 2, np.nan, np.nan])


@pytest.mark.parametrize("slice_days", [1, 7, 400])
def test_asof_matches_merge_asof(spark, bars, bars_pdf, news, news_pdf, slice_days):
    unique = news_pdf.drop_duplicates(["ticker", "published_at"])
    right = spark.createDataFrame(unique, schemas.NEWS)
    got = by_key(asof_backward(bars.select("ticker", "timestamp"), right, "timestamp", "published_at",
                               ["sentiment"], slice_days=slice_days))
    want = pd.merge_asof(
        bars_pdf.sort_values("timestamp")[["timestamp", "ticker"]], unique.sort_values("published_at"),
        left_on="timestamp", right_on="published_at", by="ticker",
    ).sort_values(["ticker", "timestamp"]).reset_index(drop=True)
    np.testing.assert_array_equal(got.sentiment, want.sentiment)


def test_availability_lag(spark, bars):
    report = spark.sql("""select timestamp'2024-03-01' as report_date, 'AAA' as ticker, 1d as revenue""")
    now = align_fundamentals(bars, report, ["revenue"]).where("revenue is not null").agg(F.min("timestamp"))
    late = align_fundamentals(bars, report, ["revenue"], 1).where("revenue is not null").agg(F.min("timestamp"))
    assert now.first()[0] < late.first()[0]
    assert late.first()[0] >= pd.Timestamp("2024-03-02")


def test_latest_price_is_exact_then_carried(spark, bars, bars_pdf):
    first = bars_pdf[bars_pdf.ticker == "AAA"].timestamp.iloc[10]
    prices = spark.createDataFrame(
        [(first.to_pydatetime(), "AAA", 7.0), (first.to_pydatetime() + pd.Timedelta("1s"), "AAA", 8.0)],
        schemas.PRICES)
    got = by_key(align_latest_price(bars.select("ticker", "timestamp"), prices))
    mine = got[got.ticker == "AAA"]
    assert mine.latest_price.isna().sum() == 10 and (mine.latest_price.dropna() == 7.0).all()
    assert got[got.ticker != "AAA"].latest_price.isna().all()


def test_feature_frame_modes(spark, bars, bars_pdf, news):
    score = by_key(feature_frame(bars, news, mode="score"))
    train = by_key(feature_frame(bars, news, horizon=3))
    assert len(score) == len(bars_pdf)
    sizes = bars_pdf.groupby("ticker").size()
    assert len(train) == (sizes - 3).clip(lower=0).sum()
    assert len(score.columns) == 56
    features = feature_columns(feature_frame(bars, news, mode="score"))
    assert len(features) == 53
    assert not score[features].isna().any().any()
    assert score.groupby("ticker").target.apply(lambda s: s.isna().sum()).eq(1).all()
    assert (score.latest_price == score.close).all()


def test_last_price_reaches_the_last_bar(spark, bars, bars_pdf):
    last = bars_pdf[bars_pdf.ticker == "AAA"].timestamp.max().to_pydatetime()
    prices = spark.createDataFrame([(last, "AAA", 123.0)], schemas.PRICES)
    score = by_key(feature_frame(bars, prices=prices, mode="score", fill="causal"))
    mine = score[score.ticker == "AAA"].latest_price
    assert mine.iloc[-1] == 123.0 and (mine.iloc[:-1] == 0).all()


def test_tickers_do_not_touch_each_other(spark, bars, news):
    together = by_key(feature_frame(bars, news))
    alone = by_key(feature_frame(bars.where("ticker = 'BBB'"), news))
    mine = together[together.ticker == "BBB"].reset_index(drop=True)
    pd.testing.assert_frame_equal(mine, alone, rtol=1e-10)


def test_feature_frame_layout_does_not_matter(spark, bars, news):
    small = by_key(feature_frame(bars, news, rows=800, width_us=3_600_000_000))
    pd.testing.assert_frame_equal(small, by_key(feature_frame(bars, news)), rtol=1e-9)


def test_unknown_target_and_impact_score(spark, bars):
    assert feature_frame(bars, target="nope").count() == 0
    names = ", ".join(f"1d as {c}" for c in [*schemas.STATEMENT_VALUES, "stock_impact_score"])
    report = spark.sql(f"select timestamp'2024-01-01' as report_date, 'AAA' as ticker, {names}")
    frame = feature_frame(bars, fundamentals=report)
    assert len(frame.columns) == 57
    parts = decompose(frame)
    assert parts["prices"].columns == ["timestamp", "ticker", "price"]
    assert "stock_impact_score" in parts["fundamentals"].columns


def test_missing_bar_columns_raise(bars):
    with pytest.raises(ValueError, match="volume"):
        feature_frame(bars.drop("volume"))


def test_sentiment_of_large_scores_nulls_and_repeated_bars(spark, bars, bars_pdf, news_pdf):
    """Deviations of a thousandth around a million; some articles without a score; every bar twice."""
    news_pdf = news_pdf.copy()
    news_pdf["sentiment"] = 1e6 + (np.arange(len(news_pdf)) % 7) * 1e-3
    news_pdf.loc[news_pdf.index % 4 == 0, "sentiment"] = np.nan
    news_pdf.loc[news_pdf.ticker == "BBB", "sentiment"] = np.nan
    rows = [(r.published_at.to_pydatetime(), r.ticker, None if np.isnan(r.sentiment) else float(r.sentiment)) for r in news_pdf.itertuples()]
    got = by_key(sentiment_window(bars.unionByName(bars), spark.createDataFrame(rows, schemas.NEWS)))
    assert len(got) == len(bars_pdf)
    for r in got.itertuples():
        s = news_pdf[(news_pdf.ticker == r.ticker) & (news_pdf.published_at >= r.timestamp - pd.Timedelta("24h")) & (news_pdf.published_at < r.timestamp)].sentiment
        assert r.sentiment_count == len(s)
        if len(s):
            np.testing.assert_allclose([r.sentiment_mean, r.sentiment_max, r.sentiment_min], [s.mean(), s.max(), s.min()])
            np.testing.assert_allclose(r.sentiment_std, (s - 1e6).std(), rtol=1e-5, atol=1e-9)
        else:
            assert r.sentiment_mean == r.sentiment_std == 0


def test_price_on_a_day_of_most_news(spark, bars):
    """Nine tenths of the articles fall on one day: it is looked up once and no bar is copied."""
    news = spark.sql("""select id as uuid, 'AAA' as ticker, 0.5D as sentiment,
        timestamp'2024-03-03 01:00:00' + make_dt_interval(if(id % 10 = 0, cast(id div 400 as int), 0)) as published_at from range(4000)""")
    out = price_on_news(news, bars)
    closes = bars.where("ticker = 'AAA'").toPandas().sort_values("timestamp")
    days = closes.assign(day=closes.timestamp.dt.floor("D")).groupby("day").close.last()
    got = out.toPandas()
    assert len(got) == 4000
    for day, price in zip(got.price_date, got.close_on_price_date, strict=True):
        assert price == days[:day].iloc[-1]
