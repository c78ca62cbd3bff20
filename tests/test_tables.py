"""Cleaning, documents, statements, scoring, summaries, files."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candela import schemas
from candela.functions.scoring import add_scores
from candela.functions.values import local_to_utc, parse_utc, to_number
from candela.operators import clean, days, metrics, nested, recommend, statements, summary
from candela.operators.quantiles import exact_quantiles
from candela.sources import files

UTC = dt.timezone.utc


def test_clock_changes(spark):
    df = spark.sql("""select * from values ('2024-07-01T00:00:00', '2024-07-01 04:00:00'),
        ('2024-03-10T02:30:00', '2024-03-10 07:30:00'), ('2024-11-03T01:30:00', '2024-11-03 05:30:00') t(l, u)""")
    same = df.select((parse_utc(F.col("l"), "America/New_York") == F.col("u").cast("timestamp")).alias("ok"))
    assert all(r.ok for r in same.collect())
    local = df.select((local_to_utc(F.col("l").cast("timestamp")) == F.col("u").cast("timestamp")).alias("ok"))
    assert all(r.ok for r in local.collect())


def test_parse_and_coerce(spark):
    df = spark.createDataFrame([("2024-11-08T01:24:00.000000Z",), ("2024-11-08 01:24:00+00:00",),
                                ("2024-11-07T20:24:00-05:00",), ("bad",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_utc(F.col("t")).cast("string")).collect()]
    assert got == ["2024-11-08 01:24:00"] * 3 + [None, None]
    df = spark.createDataFrame([("1.5",), ("NaN",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(to_number(F.col("v"))).collect()] == [1.5, None, None, None]
    assert [r[0] for r in df.select(to_number(F.col("v"), 0.0)).collect()] == [1.5, 0.0, 0.0, 0.0]


def test_clean_bars_keeps_the_first_copy_before_converting(spark):
    raw = spark.createDataFrame(
        [("2024-01-02", "X", "1", "2", "0.5", "bad", "10", 0), ("2024-01-02", "X", "1", "2", "0.5", "1.5", "10", 1),
         ("2024-01-03", "X", "1", "2", "0.5", "1.5", None, 0), ("2024-01-04", "X", "1", "2", "0.5", "1.5", "10", 0),
         ("2030-01-01", "X", "1", "2", "0.5", "1.5", "10", 0)],
        "Date string, ticker string, Open string, High string, Low string, Close string, Volume string, seq int")
    got = clean.clean_bars(raw, dt.datetime(2025, 1, 1, tzinfo=UTC), order=["seq"]).collect()
    assert [str(r.timestamp) for r in got] == ["2024-01-04 00:00:00"]
    with pytest.raises(ValueError, match="volume"):
        clean.clean_bars(raw.drop("Volume"))
    named = clean.normalise_bar_columns(raw.drop("ticker"), "ABC")
    assert named.first().ticker == "ABC"


def test_clean_news(spark):
    raw = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00+00:00", " x ", "0.5"), ("b", "2024-01-01 00:00:00+00:00", " x ", "0.9"),
         ("c", None, "X", "0.1"), ("d", "2024-01-02 00:00:00+00:00", "X", "n/a"), ("e", "2024-01-02", "Y", "1")],
        "uuid string, published_at string, ticker string, sentiment_score string")
    got = {(str(r.published_at), r.sentiment) for r in clean.clean_news(raw, "x").collect()}
    assert got == {("2024-01-01 00:00:00", 0.5), ("2024-01-02 00:00:00", 0.0)}
    by_time = clean.clean_news(raw, keys=("published_at",)).count()
    assert by_time == 2


def page(*articles):
    return json.dumps({"meta": {"found": 1}, "data": list(articles)})


def article(uuid, when, *entities):
    return {"uuid": uuid, "published_at": when, "entities": list(entities)}


@pytest.fixture(scope="module")
def articles(spark):
    at = "2024-01-01T10:00:00.000000Z"
    text = page(
        article("a", at, None, {"symbol": "Z", "sentiment_score": 9}, {"symbol": "X", "sentiment_score": 0.7},
                {"symbol": "X", "sentiment_score": 0.1}),
        article("b", at, {"symbol": "X", "sentiment_score": None}),
        article("c", at, {"symbol": "Z", "sentiment_score": 9}),
        article("d", None, {"symbol": "X", "sentiment_score": 1}),
        article("e", "junk", {"symbol": "X", "sentiment_score": 1}),
        article(None, at, {"symbol": "X", "sentiment_score": 1}),
        article("f", at),
    )
    rows = [("X", text), ("X", page()), ("X", "{}"), ("X", "no json")]
    raw = spark.createDataFrame(rows, "ticker string, json string")
    return nested.explode_articles(nested.parse_pages(raw))


def test_entity_rules(articles):
    def news(mode):
        return {r.uuid: r.sentiment for r in nested.articles_to_news(articles, mode).collect()}

    assert news("skip") == {"a": 0.7, "b": 0.0}
    assert news("zero") == {"a": 0.7, "b": 0.0, "c": 0.0, "f": 0.0}
    assert news("null") == {"a": 0.7, "b": None, "c": None, "f": None}
    every = {(r.uuid, r.ticker, r.sentiment) for r in nested.explode_entities(articles).collect()}
    assert every == {("a", "X", 0.7), ("a", "Z", 9.0), ("b", "X", 0.0), ("c", "Z", 9.0)}
    flat = nested.flatten_articles(articles.withColumn("date_requested", F.lit("2024-01-01")))
    assert flat.columns == schemas.NEWS_TEXT_COLUMNS and flat.count() == 7


def test_combined_csv_keeps_the_first_bar(spark, tmp_path):
    head = "published_at,ticker,sentiment_score,price_date_on_published_date," + ",".join(f"msft_{c}_on_published_date" for c in schemas.OHLCV)
    rows = ["2024-01-01 10:00:00+00:00,MSFT,0.5,2024-01-01,400,401,399,400,5", "2024-01-01 11:00:00+00:00,MSFT,,2024-01-01,390,401,389,390,5"]
    (tmp_path / "c.csv").write_text("\n".join([head, *rows]) + "\n")
    for multi_line in (True, False):
        combined = files.read_combined_csv(spark, str(tmp_path / "c.csv"), multi_line=multi_line)
        news, bars = clean.split_news_and_bars(combined, ["published_at"])
        assert [r.open for r in bars.collect()] == [400.0]
        assert sorted(r.sentiment for r in news.collect()) == [0.0, 0.5]


def test_landed_json_and_csv(spark, tmp_path):
    (tmp_path / "p.json").write_text(page(article("a", "2024-01-01T10:00:00Z", {"symbol": "X", "sentiment_score": 0.5})))
    got = nested.articles_to_news(files.read_news_json(spark, str(tmp_path / "p.json"), "x")).first()
    assert (got.uuid, got.ticker, got.sentiment) == ("a", "X", 0.5)

    docs = [page(article(u, "2024-01-01T10:00:00Z", {"symbol": "X", "sentiment_score": 0.5})) for u in "ab"]
    (tmp_path / "p.jsonl").write_text("\n".join(docs))
    lines = files.read_news_json(spark, str(tmp_path / "p.jsonl"), "x", lines=True)
    assert sorted(r.uuid for r in nested.articles_to_news(lines).collect()) == ["a", "b"]

    header = ",".join(schemas.NEWS_TEXT_COLUMNS)
    line = '2024-01-01,u,"a ""quoted"", title\nnext","d",k,s,u,i,en,2024-01-01 10:00:00+00:00,src,MSFT,0.25'
    (tmp_path / "MSFT_all_dates_data.csv").write_text(f"{header}\n{line}\n")
    news = files.read_ticker_news(spark, str(tmp_path), "msft")
    assert news.first().title == 'a "quoted", title\nnext'
    assert clean.clean_news(news).first().sentiment == 0.25
    assert files.read_ticker_news(spark, str(tmp_path), "none").count() == 0
    assert files.read_table(spark, str(tmp_path / "absent"), schemas.BARS).columns == schemas.BARS.names


def test_sinks(spark, tmp_path):
    news = spark.createDataFrame(
        [(dt.datetime(2024, m, 1, tzinfo=UTC), t, 0.1) for m in (1, 2) for t in ("A", "B")], schemas.NEWS)
    files.append_by_month(news, str(tmp_path / "t"))
    files.append_by_month(news, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 8
    assert sorted(p.name for p in (tmp_path / "t").glob("ticker=A/*")) == ["month=2024-01", "month=2024-02"]
    for _ in range(2):
        files.write_table(news, str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4


def test_label_choice_ignores_missing_values(spark):
    rows = [("X", "income", "Revenue", q, v) for q, v in (("2024-03-31", 5.0), ("2024-06-30", 6.0))]
    rows += [("X", "income", "Total Revenue", "2024-03-31", None), ("X", "income", "EPS", "2024-03-31", 1.5),
             ("X", "balance", "Assets", "2024-06-30", 9.0), ("X", "balance", "Assets", "2024-09-30", 9.0)]
    df = spark.createDataFrame(rows, "ticker string, statement string, line_item string, q string, value double")
    df = df.withColumn("quarter", F.col("q").cast("timestamp")).drop("q")
    got = {str(r.report_date)[:10]: r for r in statements.fundamentals_from_statements(df).collect()}
    assert set(got) == {"2024-03-31", "2024-06-30"}
    assert got["2024-03-31"].revenue is None and got["2024-06-30"].revenue is None
    assert got["2024-03-31"].eps == 1.5 and got["2024-06-30"].total_assets == 9.0


GOLDEN = [
    ("2024-03-31", 61858, 21939, 30000, 500000, 235000, 27581, 0.17, 0.20, 89),
    ("2024-06-30", 64727, 22036, 31000, 512163, 238000, 27925, 0.18, 0.22, 88),
    ("2024-09-30", 65000, 22000, 32000, 510000, 240000, 27000, 0.13, 0.15, 86),
    ("2024-12-31", 69632, 24108, 33000, 533898, 240000, 31653, 7612 / 62020, 2238 / 21870, 87),
    ("2025-03-31", 70066, 25824, 35824, 562624, 243828, 32000, 8208 / 61858, 3885 / 21939, 90),
    ("2025-06-30", 76441, 27233, 40000, 619003, 250000, 34323, 11714 / 64727, 5197 / 22036, 91),
    ("2025-09-30", 77700, 27700, 42000, 640000, 260000, 38000, 0.18, 0.12, 92),
]


def test_golden_quarters(spark):
    rows = [(r[0], "X", *map(float, r[1:9]), r[9]) for r in GOLDEN]
    df = spark.createDataFrame(
        rows, "d string, ticker string, revenue double, net_income double, operating_cash_flow double, "
        "total_assets double, total_liabilities double, operating_income double, revenue_growth_yoy double, "
        "net_income_growth_yoy double, want int").withColumn("report_date", F.col("d").cast("timestamp"))
    scored = add_scores(df)
    for r in scored.collect():
        assert r.financial_health_score == r.want
        assert r.stock_impact_score == (r.want - 50) * 2 and r.stock_impact_label == "STRONGLY_POSITIVE"
    trend = summary.score_trend(scored).first()
    assert (trend.trend, trend.first_score, trend.last_score) == ("IMPROVING", 89, 92)
    zero = add_scores(df.withColumn("net_income", F.lit(0.0)).withColumn("revenue", F.lit(0.0))).first()
    assert zero.financial_health_score == 25 + 3 + 10


def test_impact_bands(spark):
    from candela.functions.scoring import add_stock_impact

    df = spark.createDataFrame([(h,) for h in (85, 84, 70, 69, 55, 54, 40, 39, 25, 24)], "financial_health_score int")
    got = [r.stock_impact_label for r in add_stock_impact(df).orderBy(F.desc("financial_health_score")).collect()]
    want = ["STRONGLY_POSITIVE", "POSITIVE", "POSITIVE", "SLIGHTLY_POSITIVE", "SLIGHTLY_POSITIVE", "NEUTRAL",
            "NEUTRAL", "NEGATIVE", "NEGATIVE", "STRONGLY_NEGATIVE"]
    assert got == want


def test_golden_news_summary(spark):
    scores = [0.5682, 0.93, 0.76595, 0.212, 0.44865, 0.7783, 0.0, 0.7783]
    rows = [(dt.datetime(2025, 12, 25, i, tzinfo=UTC), "AAPL", s) for i, s in enumerate(scores)]
    news = spark.createDataFrame(rows, schemas.NEWS)
    row = summary.coverage(news).first()
    assert (row["rows"], row["min"], row["max"]) == (8, 0.0, 0.93)
    assert abs(row["mean"] - 0.560175) < 1e-12 and abs(row["median"] - np.median(scores)) < 1e-12
    bands = {r.band: r.articles for r in summary.sentiment_bands(news).collect()}
    assert bands == {"neutral": 1, "positive": 2, "very_positive": 5}


@pytest.mark.parametrize("kind", ["spread", "copies", "tiny"])
def test_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(5)
    v = {"spread": rng.lognormal(0, 4, 30_000), "copies": rng.choice([1.0, 2.0, 7.5], 30_000, p=[0.1, 0.8, 0.1]),
         "tiny": np.array([3.0, 1.0])}[kind]
    df = spark.createDataFrame(pd.DataFrame({"v": v, "k": np.where(np.arange(len(v)) % 3 == 0, "a", "b")}))
    qs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.q: r.quantile for r in exact_quantiles(df, ["v"], qs).collect()}
    for q in qs:
        np.testing.assert_allclose(got[q], np.quantile(v, q), rtol=1e-12)
    keyed = {(r.k, r.q): r.quantile for r in exact_quantiles(df, ["v"], [0.5], ["k"]).collect()}
    for k, g in df.toPandas().groupby("k"):
        np.testing.assert_allclose(keyed[k, 0.5], g.v.median(), rtol=1e-12)


def test_describe_nulls_and_copies(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 2.0, 5.0], "s": ["x", "y", "y", None]})
    df = spark.createDataFrame(pdf)
    row = summary.describe(df).first()
    want = pdf.a.describe()
    assert [row[c] for c in ("count", "mean", "min", "p25", "p50", "p75", "max")] == [
        want[c] for c in ("count", "mean", "min", "25%", "50%", "75%", "max")]
    assert abs(row["std"] - want["std"]) < 1e-12
    assert [tuple(r) for r in summary.null_counts(df).collect()] == [("s", 1)]
    assert summary.duplicate_rows(df).first()[0] == 1


def test_day_helpers(spark):
    span = spark.sql("select date'2024-01-01' as start, date'2024-02-05' as end")
    assert days.calendar(span).count() == 36
    ranges = [(str(r.batch_start), str(r.batch_end)) for r in days.batch_ranges(span).collect()]
    assert ranges == [("2024-01-01", "2024-01-30"), ("2024-01-31", "2024-02-05")]
    fixed = spark.sql("select date'2024-01-03' as day")
    one, two = (sorted(r.day for r in days.target_days(span, fixed, 5).collect()) for _ in range(2))
    assert one == two and len(one) == 6 and dt.date(2024, 1, 3) in one
    none = fixed.limit(0)
    assert days.target_days(span, none, 0, fallback=10).count() == 10


def test_recommendation_texts(spark):
    raw = spark.createDataFrame(
        [("A", 2, 150.7, 125.9, 1.5, 0.9), ("B", 0, -4.0, 0.2, 2.0, 0.8), ("C", 1, 50.0, 60.0, 3.0, 0.7)],
        "ticker string, raw_signal int, raw_position double, raw_timing double, raw_profit double, raw_confidence double")
    prices = spark.createDataFrame([("A", 10.0), ("B", 20.0), ("C", 30.0)], "ticker string, price double")
    got = {r.ticker: r for r in recommend.recommendations(recommend.post_process(raw), prices).collect()}
    a, b, c = got["A"], got["B"], got["C"]
    assert (a.signal, a.shares, a.timing.formatted, a.timing.action) == ("BUY", 100, "2h 5m", "SELL")
    assert a.expected_profit_dollars == 10.0 * 100 * 1.5 / 100 and a.total_investment == 1000.0
    assert (b.shares, b.timing.formatted, b.timing.action, b.expected_profit_dollars) == (0, "1m", "BUY", 0.0)
    assert (c.signal, c.shares, c.timing.minutes, c.expected_profit_pct, c.timing.action) == ("HOLD", 0, 0, 0.0, "N/A")


def test_metrics_on_empty_and_hold_only(spark):
    df = spark.createDataFrame([(1, 1, 0, 0, 0, 0, 0.0, 0.0)], "signal int, pred_signal int, position_size int, "
                               "pred_position_size int, timing_minutes int, pred_timing_minutes int, profit double, pred_profit double")
    row = metrics.trading_metrics(df).first()
    assert tuple(row) == (1.0, 0.0, 0.0, 0.0)
    table = {r.label: (r.pred_0, r.pred_1, r.pred_2) for r in metrics.confusion_matrix(df).collect()}
    assert table == {0: (0, 0, 0), 1: (0, 1, 0), 2: (0, 0, 0)}
    report = {r.label: r.f1 for r in metrics.classification_report(df).collect()}
    assert report["HOLD"] == 1.0 and report["SELL"] == 0.0


def test_session_rules(spark):
    rows = [(str(i), dt.datetime(2024, 1, d, h, tzinfo=UTC), "X", 1.0 * i)
            for i, (d, h) in enumerate([(1, 1), (1, 2), (1, 20), (1, 21), (2, 1), (2, 2), (2, 3), (2, 22)])]
    news = spark.createDataFrame(rows, "uuid string, published_at timestamp, ticker string, sentiment double")
    end = F.date_trunc("day", "published_at") + F.make_dt_interval(hours=F.lit(12))
    got = {(r.day.day, r.uuid) for r in nested.session_articles(news, end, cap=10).collect()}
    assert got == {(1, "0"), (1, "1"), (1, "2"), (2, "4"), (2, "5"), (2, "6")}


def test_overlay(spark, bars, bars_pdf):
    prices = spark.sql("select timestamp'2024-05-01' as timestamp, 'AAA' as ticker, 1000d as price")
    got = clean.overlay_latest(bars, prices).toPandas().sort_values(["ticker", "timestamp"])
    last = got[got.ticker == "AAA"].iloc[-1]
    assert (last.close, last.high) == (1000.0, 1000.0) and last.low < 1000
    assert (got.close != bars_pdf.sort_values(["ticker", "timestamp"]).close.to_numpy()).sum() == 1


def test_large_caps_trim_before_the_shuffle(spark):
    df = spark.range(50_000).selectExpr("id as uuid", "concat('T', id % 2) as ticker", "timestamp_seconds(1700000000 + id % 1000) as published_at")
    out = nested.cap_batches(df, dt.date(2023, 1, 1), cap=5000, days=4000)
    plan = out._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and out.groupBy("ticker").count().collect()[0]["count"] == 5000


def test_absent_files_are_empty(spark, tmp_path):
    assert files.read_ticker_news(spark, str(tmp_path), "nope").count() == 0
    assert files.read_table(spark, f"{tmp_path}/nope", schemas.BARS).schema == schemas.BARS
