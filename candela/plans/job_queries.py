"""Queries that write, stream or learn. Where the outcome is exact, SQL states it as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela import schemas
from candela.functions.calendar_features import TIME_COLUMNS
from candela.functions.scoring import add_scores
from candela.learning.price import ENSEMBLE, PriceModel
from candela.learning.trading import TradingModel
from candela.operators import clean, nested
from candela.operators.indicators import INDICATOR_COLUMNS, indicators
from candela.operators.labels import latest_rows, time_split
from candela.operators.metrics import classification_report, confusion_matrix
from candela.plans.catalog import query, rnd, rounded
from candela.plans.feature_frame import feature_columns, feature_frame, valid_rows
from candela.plans.fixtures import every_seventh
from candela.plans.series_queries import FRAME_SQL, LABEL_SQL, SENTIMENT_COLUMNS, filled
from candela.plans.table_queries import IMPACT_SQL
from candela.schemas import OHLCV, STATEMENT_VALUES
from candela.session import materialize, new_path
from candela.sources import files
from candela.streaming import jobs, live, rolling

# Sources and sinks


@query(
    "csv_round_trip",
    """select uuid, ticker, case when uuid % 17 <> 0 then published_at end as published_at,
  round(sentiment, 6) + 0.0 as sentiment, 'said "' || uuid || '", then'||chr(10)||'left' as title from news_d""",
)
def csv_round_trip(t):
    quoted = F.concat(F.lit('said "'), F.col("uuid").cast("string"), F.lit('", then\nleft'))
    out = t.news_d.select(
        "uuid",
        F.when(F.col("uuid") % 17 != 0, F.col("published_at")).alias("published_at"),
        "ticker",
        F.col("sentiment").alias("sentiment_score"),
        quoted.alias("title"),
    )
    for name in schemas.NEWS_TEXT_COLUMNS:
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast("string"))
    path = new_path(t.spark, "csv")
    stamp = F.date_format("published_at", "yyyy-MM-dd HH:mm:ss+00:00")
    files.write_csv(out.withColumn("published_at", stamp).select(*schemas.NEWS_TEXT_COLUMNS), path)
    back = files.read_news_csv(t.spark, path)
    return back.select(
        F.col("uuid").cast("bigint").alias("uuid"),
        "ticker",
        F.to_timestamp("published_at").alias("published_at"),
        F.col("sentiment_score").cast("double").alias("sentiment"),
        "title",
    )


@query(
    "json_round_trip",
    "select uuid, ticker, published_at, round(sentiment, 6) + 0.0 as sentiment from news_h",
)
def json_round_trip(t):
    path = new_path(t.spark, "json")
    files.write_json(t.news_h, path)
    return t.spark.read.schema(t.news_h.schema).json(path)


@query(
    "ticker_files",
    f"""select uuid, ticker, published_at, {rounded("sentiment")} from news_d where ticker in ('1-URGENT', '5-LOW')""",
)
def ticker_files(t):
    """One export a ticker, each with some rows of others; one ticker asked for has no file."""
    folder = new_path(t.spark, "tickers")
    asked = ["1-urgent ", "5-LOW", "NONE"]
    blank = [c for c in schemas.NEWS_TEXT_COLUMNS if c not in ("uuid", "published_at", "ticker", "sentiment_score")]
    stamp = F.date_format("published_at", "yyyy-MM-dd HH:mm:ss+00:00").alias("published_at")
    export = t.news_d.select("uuid", stamp, "ticker", F.col("sentiment").alias("sentiment_score"), *(F.lit(None).cast("string").alias(c) for c in blank))
    for ticker, other in (("1-URGENT", "2-HIGH"), ("5-LOW", "1-URGENT")):
        files.write_csv(export.where(F.col("ticker").isin(ticker, other)).select(*schemas.NEWS_TEXT_COLUMNS), f"{folder}/{ticker}_all_dates_data.csv")
    parts = [files.read_ticker_news(t.spark, folder, ticker) for ticker in asked]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.select(
        F.col("uuid").cast("bigint").alias("uuid"), "ticker", F.to_timestamp("published_at").alias("published_at"), F.col("sentiment_score").cast("double").alias("sentiment")
    )


@query(
    "news_json_files",
    f"""select cast(uuid as varchar) as uuid, ticker, published_at, {rnd("coalesce(score, 0)", "sentiment")} from articles where named
union all select cast(uuid as varchar), 'ZZZ', published_at, -9.0 from articles where uuid % 2 = 0""",
)
def news_json_files(t):
    """Landed responses, one document a line; a second landing holds one document a file."""
    lines, whole = new_path(t.spark, "pages"), new_path(t.spark, "documents")
    few = F.pmod(F.xxhash64("json"), F.lit(40)) == 0
    t.news_pages.where(~few).select("json").write.text(lines)
    documents = t.news_pages.where(few).select("json", F.xxhash64("json").alias("part"))
    documents.write.option("maxRecordsPerFile", 1).partitionBy("part").text(whole)
    both = files.read_news_json(t.spark, lines, lines=True).unionByName(files.read_news_json(t.spark, f"{whole}/*"))
    return nested.explode_entities(both).drop("seq")


@query(
    "append_by_month",
    """select ticker, strftime(published_at, '%Y-%m') as month, count(*) as articles
from news_h group by 1, 2""",
)
def append_by_month(t):
    path = new_path(t.spark, "append")
    for part in (0, 1):
        files.append_by_month(t.news_h.where(F.col("uuid") % 2 == part), path)
    return t.spark.read.parquet(path).groupBy("ticker", F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("articles")
    )


@query("ticker_scan", f"select uuid, ticker, {rounded('sentiment')} from news_h where ticker = 'click'")
def ticker_scan(t):
    """One ticker of a table partitioned by ticker and month; only its folders are read."""
    path = new_path(t.spark, "scan")
    files.append_by_month(t.news_h, path)
    return t.spark.read.parquet(path).where(F.col("ticker") == "click").select(
        "uuid", "ticker", "sentiment"
    )


@query(
    "empty_sources",
    """select ticker, timestamp, close as latest_price, cast(0 as double) as sentiment_mean,
  cast(0 as double) as revenue, target from (select *, lead(close) over (partition by ticker order by timestamp)
  as target from bars_h) where target is not null""",
)
def empty_sources(t):
    """Bars with empty sources: news give 0, prices the close, reports 0 after the fill."""
    sources = (schemas.empty(t.spark, s) for s in (t.news_h.schema, t.prices_h.schema, t.fund_h.schema))
    frame = feature_frame(t.stored(t.bars_h, "bars"), *sources)
    return frame.select("ticker", "timestamp", "latest_price", "sentiment_mean", "revenue", "target")


# Streams


def _landing(t, landed: DataFrame) -> DataFrame:
    """The files of a stored table as a stream, one a batch."""
    reader = t.spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(landed.inputFiles()[0].rsplit("/", 1)[0])


@query(
    "stream_articles",
    f"""select cast(uuid as varchar) as uuid, ticker, published_at, {rnd("coalesce(score, 0)", "sentiment")}
from articles where named""",
)
def stream_articles(t):
    """Every page lands twice, in files of mixed times, one a batch; the table holds each article once."""
    pages = t.news_pages.unionByName(t.news_pages)
    landed = materialize(pages.repartition(4), "pages")
    source = _landing(t, landed)
    out = new_path(t.spark, "articles")
    stream = jobs.article_stream(nested.parse_pages(source))
    jobs.append_articles(stream, out, new_path(t.spark, "state"), once=True).awaitTermination()
    return t.spark.read.parquet(out).select("uuid", "ticker", "published_at", "sentiment")


@query(
    "stream_sentiment",
    f"""with w as (select ticker, sentiment, date_trunc('hour', published_at) + to_hours(cast(i as int) + 1) as timestamp
  from news_h, range(24) r(i))
select ticker, timestamp, {rnd("avg(sentiment)", "sentiment_mean")}, count(*) as sentiment_count,
  {rnd("max(sentiment)", "sentiment_max")}, {rnd("min(sentiment)", "sentiment_min")},
  {rnd("stddev_samp(sentiment)", "sentiment_std")} from w group by 1, 2""",
)
def stream_sentiment(t):
    """Files of mixed times, one a batch: most articles are days older than some before them."""
    source = _landing(t, materialize(t.news_h.repartition(4), "news"))
    out = new_path(t.spark, "rolling")
    stream = jobs.rolling_sentiment(source)
    jobs.write_updates(stream, out, new_path(t.spark, "state"), once=True).awaitTermination()
    return jobs.latest_updates(t.spark.read.parquet(out), ["ticker", "timestamp"])


def _landings(t, frames: list[DataFrame], label: str, start) -> None:
    """Frames landed one after the other, each in as many files as it has partitions, and taken in as one batch.

    ``start`` starts the job on the landed files; it goes on from its checkpoint for each frame.
    """
    path = new_path(t.spark, label)
    for frame in frames:
        frame.write.mode("append").parquet(path)
        start(t.spark.readStream.schema(frames[0].schema).parquet(path)).awaitTermination()


@query(
    "stream_articles_moved",
    f"""select uuid, ticker, published_at, {rounded("sentiment")} from news_h
union all select uuid + 1000000000, ticker, published_at - interval 70 day, {rnd("-sentiment", "sentiment")} from news_h
where uuid % 3 = 1""",
)
def stream_articles_moved(t):
    """Copies land batches later, with times in other months and other scores; the first landing stays."""
    some = t.news_h.where("uuid % 3 = 1")
    moved = some.withColumns({"published_at": F.col("published_at") - F.expr("interval 70 days"), "sentiment": -F.col("sentiment")})
    frames = [
        t.news_h.where("uuid % 2 = 0"),
        moved.where("uuid % 2 = 0").unionByName(t.news_h.where("uuid % 2 = 1")),
        moved.where("uuid % 2 = 1").unionByName(moved.withColumn("uuid", F.col("uuid") + 1_000_000_000)),
        t.news_h,
    ]
    out, state = new_path(t.spark, "articles"), new_path(t.spark, "state")
    _landings(t, frames, "moved", lambda source: jobs.append_articles(source, out, state, once=True))
    return t.spark.read.parquet(out).drop("month")


_WINDOWED = f"""with w as (select ticker, sentiment, date_trunc('hour', published_at) + to_hours(cast(i as int) + 1) as timestamp
  from {{news}}, range(24) r(i))
select ticker, timestamp, {rnd("avg(sentiment)", "sentiment_mean")}, count(*) as sentiment_count,
  {rnd("max(sentiment)", "sentiment_max")}, {rnd("min(sentiment)", "sentiment_min")},
  {rnd("stddev_samp(sentiment)", "sentiment_std")} from w group by 1, 2"""


@query("stream_sentiment_late", _WINDOWED.format(news="(select * replace (case when uuid % 29 <> 0 then sentiment end as sentiment) from news_h)"))
def stream_sentiment_late(t):
    """Days land out of order, weeks apart, the newest first; some scores are missing. Tables are summed up twice on the way."""
    news = t.news_h.withColumn("sentiment", F.when(F.col("uuid") % 29 != 0, F.col("sentiment")))
    day = F.dayofyear("published_at")
    frames = [news.where((day % 5 == 4 - k) if k < 4 else (day % 5 == 0) & (F.col("uuid") % 2 == 0)) for k in range(5)]
    frames.append(news.where((day % 5 == 0) & (F.col("uuid") % 2 == 1)))
    out, state = new_path(t.spark, "rolling"), new_path(t.spark, "state")
    _landings(t, frames, "late", lambda source: rolling.sentiment_tables(source, out, state, every=2, once=True))
    return rolling.read_sentiment(t.spark, out, epochs=len(frames), every=2)


@query(
    "stream_indicators",
    f"""with {FRAME_SQL.format(rows="true")}
select ticker, timestamp, {rounded(*INDICATOR_COLUMNS)} from wide""",
)
def stream_indicators(t):
    """Hourly bars land in four batches; each batch reads its own bars and a small state per ticker only."""
    quarter = F.ntile(4).over(Window.partitionBy("ticker").orderBy("timestamp"))
    bars = t.stored(t.bars_h.withColumn("part", quarter), "bars")
    out, state = new_path(t.spark, "live"), new_path(t.spark, "state")
    frames = [bars.where(F.col("part") == k).drop("part") for k in (1, 2, 3, 4)]
    _landings(t, frames, "live", lambda source: jobs.write_updates(live.live_indicators(source), out, state, once=True))
    return jobs.latest_updates(t.spark.read.parquet(out), ["ticker", "timestamp"]).select("ticker", "timestamp", *INDICATOR_COLUMNS)


@query(
    "stream_scores",
    f"""with p as (select ticker, arg_max(price, timestamp)*1.5 as now from prices_d group by 1),
b as (select rows_d.*, case when row_number() over (partition by ticker order by timestamp desc) = 1 then now
  else close end as last_close from rows_d join p using (ticker))
select ticker, max(timestamp) as timestamp, {rnd("arg_max(last_close, timestamp)", "close")},
  {rnd("avg(last_close) filter (rn > n - 20)", "sma_20")},
  {rnd("avg(last_close) filter (rn > n - 50 and n >= 50)", "sma_50")}
from (select *, count(*) over (partition by ticker) as n from b) group by 1""",
)
def stream_scores(t):
    """Prices arrive as a stream; each batch yields the indicators of the overlaid last bars."""
    landed = materialize(t.prices_d.withColumn("price", F.col("price") * 1.5), "prices")
    bars = materialize(t.bars_d, "bars")
    source = t.spark.readStream.schema(landed.schema).parquet(landed.inputFiles()[0].rsplit("/", 1)[0])
    out = new_path(t.spark, "scores")

    def score(series: DataFrame) -> DataFrame:
        last = latest_rows(indicators(series, ["sma"]))
        return last.select("ticker", "timestamp", "close", "sma_20", "sma_50")

    jobs.live_scores(
        source, lambda: bars, score, out, new_path(t.spark, "state"), once=True
    ).awaitTermination()
    return jobs.latest_updates(t.spark.read.parquet(out), ["ticker"])


# The frame with scored reports


_FEATURES = [*OHLCV, *INDICATOR_COLUMNS, *SENTIMENT_COLUMNS, "latest_price", *STATEMENT_VALUES, "stock_impact_score", *TIME_COLUMNS]


@query(
    "feature_names",
    f"""select unnest([{", ".join(repr(c) for c in _FEATURES)}]) as feature""",
)
def feature_names(t):
    """The 54 columns that a model learns from, with scored reports."""
    scored = add_scores(t.fund_growth).select("ticker", "report_date", *STATEMENT_VALUES, "stock_impact_score")
    frame = feature_frame(t.stored(t.bars_d, "bars"), t.news_d, t.prices_d, scored)
    return t.spark.createDataFrame([(c,) for c in feature_columns(frame)], "feature string")


@query(
    "feature_frame_scored",
    f"""with {IMPACT_SQL},
b as (select *, lead(close) over (partition by ticker order by timestamp) as target from bars_d),
w as (select b.ticker, b.timestamp, b.target, {", ".join(f"f.{c}" for c in STATEMENT_VALUES)}, i.stock_impact_score
  from b asof left join fund_d f on b.ticker = f.ticker and b.timestamp >= f.report_date
  left join impact i on i.ticker = f.ticker and i.report_date = f.report_date),
filled as (select ticker, timestamp, target, {", ".join(f"{filled(c)} as {c}" for c in (*STATEMENT_VALUES, "stock_impact_score"))} from w where target is not null
  window before as (partition by ticker order by timestamp rows between unbounded preceding and current row),
  after as (partition by ticker order by timestamp rows between current row and unbounded following))
select ticker, timestamp, {rounded(*STATEMENT_VALUES, "stock_impact_score", "target")} from filled""",
)
def feature_frame_scored(t):
    """The frame with the health scores of the reports: 57 columns."""
    scored = add_scores(t.fund_growth).select("ticker", "report_date", *STATEMENT_VALUES, "stock_impact_score")
    frame = feature_frame(t.stored(t.bars_d, "bars"), t.news_d, t.prices_d, scored)
    assert len(frame.columns) == 57
    return frame.select("ticker", "timestamp", *STATEMENT_VALUES, "stock_impact_score", "target")


# Models


def _train_frame(t) -> DataFrame:
    bars = t.stored(t.bars_h, "bars")
    return t.stored(feature_frame(bars, t.news_h, every_seventh(bars), t.fund_h), "frame")


def _score_frame(t) -> DataFrame:
    bars = t.stored(t.bars_h, "bars")
    return feature_frame(bars, t.news_h, every_seventh(bars), t.fund_h, mode="score")


@query("price_model_metrics")
def price_model_metrics(t):
    frame = _train_frame(t)
    return PriceModel("boosted").fit(frame).evaluate(frame)


@query("price_model_forest_importance")
def price_model_forest_importance(t):
    return PriceModel("forest").fit(_train_frame(t)).importance(t.spark)


@query("price_model_ensemble_forecast")
def price_model_ensemble_forecast(t):
    model = PriceModel(ENSEMBLE).fit(_train_frame(t))
    path = new_path(t.spark, "price-model")
    model.save(path)
    return PriceModel.load(t.spark, path).forecast(_score_frame(t))


@query("trading_model_metrics")
def trading_model_metrics(t):
    frame = _train_frame(t)
    return TradingModel().fit(frame).evaluate(frame)


@query("trading_model_recommendation")
def trading_model_recommendation(t):
    model = TradingModel(include_hold=True)
    model.fit(_train_frame(t))
    path = new_path(t.spark, "trading-model")
    model.save(path)
    frame = _score_frame(t)
    return TradingModel.load(t.spark, path).recommend(frame, clean.latest_price(t.bars_h)).select(
        "*", F.col("timing.formatted").alias("holding")
    ).drop("timing")


@query("price_model_rounds")
def price_model_rounds(t):
    """Validation error of each boosting round, and the rounds kept."""
    model = PriceModel(["boosted", "boosted_deep"]).fit(_train_frame(t))
    return model.rounds(t.spark)


# The frame without its last bar per ticker, labelled and cut at one row of all tickers.
_LABELLED_FRAME = f"""rows_f as (select * from rows_h qualify rn < count(*) over (partition by ticker)),
{LABEL_SQL.replace("rows_h", "rows_f")},
parts as (select *, row_number() over (order by timestamp, ticker) > floor(count(*) over () * (1 - 0.2e0)) as held from labelled)"""


@query(
    "price_model_parts",
    f"""with {_LABELLED_FRAME}
select case when held then 'validation' else 'train' end as part, count(*) as rows, min(timestamp) as first_bar, max(timestamp) as last_bar
from parts group by 1""",
)
def price_model_parts(t):
    """Rows that the price model learns from and is judged on."""
    data = time_split(valid_rows(_train_frame(t)), pooled=True)
    part = F.when(F.col("is_validation"), "validation").otherwise("train").alias("part")
    return data.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_bar"), F.max("timestamp").alias("last_bar"))


@query(
    "trading_model_heads",
    f"""with {_LABELLED_FRAME}
select 'signal' as head, count(*) filter (signal <> 1) as rows from parts where not held
union all select 'position_size', count(*) filter (position_size > 0) from parts where not held
union all select 'timing_minutes', count(*) filter (timing_minutes > 0) from parts where not held
union all select 'profit', count(*) filter (profit <> 0) from parts where not held""",
)
def trading_model_heads(t):
    """Rows that each head of a fitted model has learned from, as saved and loaded."""
    model = TradingModel().fit(_train_frame(t))
    path = new_path(t.spark, "trading-model")
    model.save(path)
    return t.spark.createDataFrame(list(TradingModel.load(t.spark, path).rows.items()), "head string, rows long")


@query(
    "trading_model_confusion",
    f"""with {_LABELLED_FRAME}, l as (select unnest([0, 1, 2]) as label)
select cast(label as int) as label, count(signal) as rows from l left join parts on signal = label group by 1""",
)
def trading_model_confusion(t):
    """Confusion matrix of a boosted signal head; its rows sum to the labels' counts, and nothing is predicted HOLD."""
    frame = _train_frame(t)
    matrix = confusion_matrix(TradingModel(signal_family="boosted").fit(frame).scored(frame))
    return matrix.where("pred_1 = 0").select("label", (F.col("pred_0") + F.col("pred_1") + F.col("pred_2")).alias("rows"))


@query("trading_model_report")
def trading_model_report(t):
    """Precision, recall and f1 per label of a fitted model that also learns HOLD."""
    frame = _train_frame(t)
    return classification_report(TradingModel(include_hold=True).fit(frame).scored(frame))
