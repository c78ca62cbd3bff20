"""Queries on sources and tables: cleaning, news documents, days, summaries, scoring, metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from candela.functions.scoring import add_scores, add_stock_impact, health_score
from candela.functions.values import local_to_utc, parse_utc, to_number
from candela.operators import clean, days, metrics, nested, recommend, statements, summary
from candela.operators.labels import latest_rows
from candela.operators.quantiles import exact_quantiles
from candela.operators.sentiment import sentiment_window
from candela.plans.catalog import query, rnd, rounded
from candela.plans.series_queries import LABEL_SQL, SENTIMENT_SQL
from candela.schemas import OHLCV, STATEMENT_VALUES

KEYS = ("ticker", "timestamp")
AS_OF = dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)


# Cleaning


@query(
    "news_clean",
    f"""select ticker, published_at, {rounded("sentiment")} from news_text where published_at is not null
qualify row_number() over (partition by ticker, published_at order by uuid, sentiment) = 1""",
)
def news_clean(t):
    return clean.clean_news(t.news_text)


@query(
    "bars_clean",
    """with copies as (select *, 0 as seq from bars_d union all
  select ticker, timestamp, open, high, low, 1 as close, volume, 1 as seq from bars_d where day(timestamp) % 2 = 0)
select ticker, timezone('UTC', timezone('America/New_York', timestamp)) as timestamp,
  open, high, low, close, volume
from copies where day(timestamp) <> 17
  and timezone('UTC', timezone('America/New_York', timestamp)) <= timestamp '2000-01-01'
qualify row_number() over (partition by ticker, timestamp order by seq) = 1 and day(timestamp) <> 13""",
)
def bars_clean(t):
    return clean.clean_bars(t.bars_text, AS_OF, "America/New_York", ["seq"])


@query(
    "split_news_bars",
    """with one as (select uuid, n.ticker, published_at, sentiment, close, timestamp
    from news_d n left join bars_d b on n.ticker = b.ticker and n.published_at = b.timestamp),
f as (select * from one union all
  select uuid + 1000000000, ticker, published_at, sentiment - 1, close - 1, timestamp from one),
news as (select ticker, published_at, round(sentiment, 6) + 0.0 as sentiment from f
  qualify row_number() over (partition by ticker, published_at order by uuid, sentiment) = 1)
select 'news' as part, ticker, published_at as timestamp, sentiment as value from news
union all
(select 'bars', ticker, timestamp, close from f where timestamp is not null
  qualify row_number() over (partition by ticker, timestamp order by uuid) = 1)""",
)
def split_news_bars(t):
    n, b = t.news_d, t.bars_d.withColumn("published_at", F.col("timestamp"))
    text = F.date_format("timestamp", "yyyy-MM-dd")
    one = n.join(b, ["ticker", "published_at"], "left")
    # Later rows of the file disagree with the first ones and have smaller values.
    later = {c: F.col(c) - 1 for c in ("sentiment", *OHLCV)}
    both = one.unionByName(one.withColumns({"uuid": F.col("uuid") + 1_000_000_000, **later}))
    combined = both.select(
        "uuid",
        "published_at",
        "ticker",
        F.col("sentiment").alias("sentiment_score"),
        text.alias("price_date_on_published_date"),
        *(F.col(c).cast("string").alias(f"msft_{c}_on_published_date") for c in OHLCV),
    )
    news, bars = clean.split_news_and_bars(combined, ["uuid"])
    return news.select(
        F.lit("news").alias("part"),
        "ticker",
        F.col("published_at").alias("timestamp"),
        F.col("sentiment").alias("value"),
    ).unionByName(
        bars.select(F.lit("bars").alias("part"), "ticker", "timestamp", F.col("close").alias("value"))
    )


@query(
    "ts_to_utc",
    """select o_orderkey, timezone('UTC', timezone('America/New_York', o_orderdate)) as from_local,
  o_orderdate - interval 2 hour as from_offset from orders""",
)
def ts_to_utc(t):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return t.read("orders").select(
        "o_orderkey",
        local_to_utc(F.col("o_orderdate")).alias("from_local"),
        parse_utc(F.concat(text, F.lit("+02:00"))).alias("from_offset"),
    )


@query(
    "numeric_coerce",
    """select event_id, case when event_id % 7 in (0, 1) then null else round(value, 6) + 0.0 end as strict,
  case when event_id % 7 in (0, 1) then 0 else round(value, 6) + 0.0 end as lenient from events""",
)
def numeric_coerce(t):
    k = F.col("event_id") % 7
    text = F.when(k == 0, "n/a").when(k == 1, "NaN").otherwise(F.col("value").cast("string"))
    return t.read("events").select(
        "event_id", to_number(text).alias("strict"), to_number(text, 0.0).alias("lenient")
    )


@query(
    "dedupe_keep_first",
    f"""select ticker, published_at, uuid, {rounded("sentiment")} from news_d
qualify row_number() over (partition by ticker, published_at order by uuid, sentiment) = 1""",
)
def dedupe_keep_first(t):
    return clean.keep_first(t.news_d, ["ticker", "published_at"], ["uuid", "sentiment"])


@query("bars_as_of", "select * from bars_d where timestamp <= timestamp '2000-01-01'")
def bars_as_of(t):
    return clean.completed(t.bars_d, AS_OF)


@query("ticker_filter", "select * from bars_h where upper(trim(ticker)) = 'CLICK'")
def ticker_filter(t):
    return clean.only_ticker(t.bars_h, " click ")


@query(
    "date_range_filter",
    """select * from bars_d where timestamp >= timestamp '1997-03-01' and timestamp <= timestamp '1999-06-30'""",
)
def date_range_filter(t):
    utc = dt.timezone.utc
    start, end = dt.datetime(1997, 3, 1, tzinfo=utc), dt.datetime(1999, 6, 30, tzinfo=utc)
    return clean.between(t.bars_d, start, end, "timestamp")


@query(
    "overlay_latest_bar",
    """with l as (select ticker, max(timestamp) as last_ts from bars_h group by 1),
p as (select ticker, arg_max(price, timestamp) * 1.5 as now from prices_h group by 1)
select b.ticker, b.timestamp, open, round(case when timestamp = last_ts then greatest(high, now) else high end, 6)
  + 0.0 as high, round(case when timestamp = last_ts then least(low, now) else low end, 6) + 0.0 as low,
  round(case when timestamp = last_ts then now else close end, 6) + 0.0 as close, volume
from bars_h b join l using (ticker) join p using (ticker)""",
)
def overlay_latest_bar(t):
    prices = t.prices_h.withColumn("price", F.col("price") * 1.5)
    return clean.overlay_latest(t.bars_h, prices)


@query(
    "latest_price",
    "select ticker, max(timestamp) as timestamp, arg_max(close, timestamp) as price from bars_h group by 1",
)
def latest_price(t):
    return clean.latest_price(t.bars_h)


# News documents


def _articles(t):
    return nested.explode_articles(nested.parse_pages(t.news_pages))


@query(
    "news_from_json",
    f"""select cast(uuid as varchar) as uuid, ticker, published_at, {rnd("coalesce(score, 0)", "sentiment")}
from articles where named""",
)
def news_from_json(t):
    return nested.articles_to_news(_articles(t)).drop("seq")


@query(
    "entity_sentiment",
    f"""select cast(uuid as varchar) as uuid, ticker, {rnd("case when named then coalesce(score, 0) end", "skip")},
  {rnd("coalesce(score, 0)", "zero")}, {rnd("score", "raw")} from articles""",
)
def entity_sentiment(t):
    pick = nested.entity_sentiment
    return _articles(t).where(F.col("published_at").isNotNull()).select(
        "uuid",
        "ticker",
        pick(F.col("ticker"), "skip").alias("skip"),
        pick(F.col("ticker"), "zero").alias("zero"),
        pick(F.col("ticker"), "null").alias("raw"),
    )


@query(
    "news_all_entities",
    f"""select cast(uuid as varchar) as uuid, ticker, published_at, {rnd("coalesce(score, 0)", "sentiment")}
from articles where named
union all
select cast(uuid as varchar), 'ZZZ', published_at, -9.0 from articles where uuid % 2 = 0""",
)
def news_all_entities(t):
    return nested.explode_entities(_articles(t)).drop("seq")


@query(
    "news_uuid_dedupe",
    f"""select uuid, ticker, published_at, {rounded("sentiment")} from news_d where sentiment >= -0.9
qualify row_number() over (partition by uuid, ticker order by published_at, sentiment) = 1""",
)
def news_uuid_dedupe(t):
    return nested.dedupe_uuid(t.news_d.where("sentiment >= -0.9"), ("published_at", "sentiment"))


@query(
    "news_top2_per_day",
    f"""select uuid, ticker, published_at, {rounded("sentiment")} from news_h
qualify row_number() over (partition by ticker, cast(published_at as date) order by published_at, uuid) <= 2""",
)
def news_top2_per_day(t):
    return nested.top_per_day(t.news_h, 2)


@query(
    "news_batch_cap",
    f"""select *, from_batch as batch from (select uuid, ticker, published_at, {rounded("sentiment")},
    cast(date_diff('day', date '2024-01-01', cast(published_at as date)) // 7 as int) as from_batch from news_h)
qualify row_number() over (partition by ticker, from_batch order by published_at, uuid) <= 40""".replace(
        "*, from_batch as batch", "uuid, ticker, published_at, sentiment, from_batch as batch"
    ),
)
def news_batch_cap(t):
    return nested.cap_batches(t.news_h, dt.date(2024, 1, 1), days=7, cap=40)


SESSION_SQL = """n as (select *, cast(published_at as date) as day,
  published_at <= date_trunc('day', published_at) + interval 4 hour as inside from news_h),
m as (select *, count(*) filter (inside) over (partition by ticker, day) as cnt,
  row_number() over (partition by ticker, day order by published_at, uuid) as rn_day,
  row_number() over (partition by ticker, day, inside order by published_at, uuid) as rn_in from n),
chosen as (select uuid, ticker, published_at, sentiment, day from m
  where case when cnt < 3 then rn_day <= 3 else inside and rn_in <= 10 end)"""


def _session(t):
    end = F.date_trunc("day", "published_at") + F.make_dt_interval(hours=F.lit(4))
    return nested.session_articles(t.news_h, end, cap=10)


@query(
    "news_window_fallback",
    f"with {SESSION_SQL} select uuid, ticker, published_at, day, {rounded('sentiment')} from chosen",
)
def news_window_fallback(t):
    return _session(t)


@query(
    "session_sentiment",
    f"""with {SESSION_SQL}
select c.ticker, c.day, {rnd("coalesce(avg(sentiment), 0)", "avg_sentiment")}, count(uuid) as articles
from (select distinct event_type as ticker, cast(ts as date) as day from events) c
left join chosen using (ticker, day) group by 1, 2""",
)
def session_sentiment(t):
    every = t.read("events").select(F.col("event_type").alias("ticker"), F.to_date("ts").alias("day"))
    return nested.session_sentiment(_session(t), every.distinct())


@query(
    "news_flatten",
    f"""select cast(uuid as varchar) as uuid, ticker, 'title ' || uuid as title, 'en' as language,
  's' || (uuid % 4) as source, cast(ts as date) as date_requested, {rnd("score", "sentiment_score")}
from articles join events on event_id = uuid""",
)
def news_flatten(t):
    dated = _articles(t).where(F.col("published_at").isNotNull()).withColumn(
        "date_requested", F.to_date(parse_utc(F.col("published_at")))
    )
    wanted = ["uuid", "ticker", "title", "language", "source", "date_requested", "sentiment_score"]
    return nested.flatten_articles(dated).select(*wanted)


def _mondays(t):
    span = days.span_of(t.news_h, "published_at")
    return days.calendar(span).where(F.weekday("day") == 0)


@query(
    "news_on_target_days",
    f"""select uuid, ticker, published_at, {rounded("sentiment")} from news_h
where isodow(published_at) = 1""",
)
def news_on_target_days(t):
    return nested.on_days(t.news_h, _mondays(t))


@query(
    "news_range_fallback",
    f"""with n as (select * from news_h where ticker <> 'view' or isodow(published_at) <> 1),
hit as (select * from n where isodow(published_at) = 1
  qualify row_number() over (partition by ticker, cast(published_at as date) order by published_at, uuid) <= 2),
spare as (select * from n where ticker not in (select ticker from hit)
  qualify row_number() over (partition by ticker order by published_at, uuid) <= 100)
select uuid, ticker, published_at, {rounded("sentiment")} from (select * from hit union all select * from spare)""",
)
def news_range_fallback(t):
    gap = (F.col("ticker") == "view") & (F.weekday("published_at") == 0)
    return nested.range_fallback(t.news_h.where(~gap), _mondays(t), k=2, cap=100)


@query(
    "news_source_fallback",
    f"""select uuid, ticker, published_at, {rounded("sentiment")} from news_h where ticker <> 'click'
union all select uuid, ticker, published_at, 0.0 from news_h where ticker = 'click'""",
)
def news_source_fallback(t):
    landed = t.news_h.where(F.col("ticker") != "click")
    return clean.prefer(landed, t.news_h.withColumn("sentiment", F.lit(0.0)))


@query(
    "fundamentals_pivot",
    f"""select ticker, report_date, {rnd("case when ticker[1] = '2' then null else revenue end", "revenue")},
  {rounded(*STATEMENT_VALUES[1:])} from fund_d""",
)
def fundamentals_pivot(t):
    return statements.fundamentals_from_statements(t.statements)


# Days and sets

_DAYS_H = """every as (select cast(unnest(generate_series(min(cast(published_at as date)),
  max(cast(published_at as date)), interval 1 day)) as date) as day from news_h)"""


@query("calendar", f"with {_DAYS_H} select day from every")
def calendar(t):
    return days.calendar(days.span_of(t.news_h, "published_at"))


@query(
    "calendar_anti",
    f"with {_DAYS_H} select day from every where day not in (select cast(published_at as date) from news_h where isodow(published_at) > 5)",
)
def calendar_anti(t):
    weekend = t.news_h.where(F.weekday("published_at") >= 5)
    every = days.calendar(days.span_of(t.news_h, "published_at"))
    return days.without_days(every, weekend.select(F.to_date("published_at").alias("day")))


@query(
    "calendar_union",
    """select distinct cast(published_at as date) as day from news_d
union select cast(timestamp as date) from bars_d""",
)
def calendar_union(t):
    news = t.news_d.select(F.to_date("published_at").alias("day"))
    return days.union_days(news, t.bars_d.select(F.to_date("timestamp").alias("day")))


@query(
    "batch_ranges",
    """with s as (select ticker, min(cast(timestamp as date)) as s, max(cast(timestamp as date)) as e from bars_d group by 1),
b as (select ticker, s, e, unnest(generate_series(0, date_diff('day', s, e) // 30)) as i from s)
select ticker, cast(i as int) as batch, cast(s + cast(i*30 as int) as date) as batch_start,
  least(cast(s + cast(i*30 + 29 as int) as date), e) as batch_end from b""",
)
def batch_ranges(t):
    return days.batch_ranges(days.span_of(t.bars_d, "timestamp", ["ticker"]))


@query(
    "sample_days",
    f"""with {_DAYS_H},
fixed as (select distinct cast(published_at as date) as day from news_h where isodow(published_at) > 5),
drawn as (
  select day from every where day not in (select day from fixed) order by md5(cast(day as varchar) || ':42'), day limit 10)
select day from fixed union select day from drawn""",
)
def sample_days(t):
    weekend = t.news_h.where(F.weekday("published_at") >= 5)
    fixed = weekend.select(F.to_date("published_at").alias("day")).distinct()
    return days.target_days(days.span_of(t.news_h, "published_at"), fixed, k=10)


@query(
    "union_sources",
    """select 'hourly' as source, ticker, timestamp, close from bars_h
union all select 'daily', ticker, timestamp, close from bars_d""",
)
def union_sources(t):
    parts = [
        df.select(F.lit(name).alias("source"), *KEYS, "close")
        for name, df in (("hourly", t.bars_h), ("daily", t.bars_d))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "head_tail",
    """(select 'head' as part, ticker, timestamp, close from bars_h order by timestamp, ticker limit 5)
union all (select 'tail', ticker, timestamp, close from bars_h order by timestamp desc, ticker desc limit 5)""",
)
def head_tail(t):
    bars = t.bars_h.select(*KEYS, "close")
    order = ["timestamp", "ticker"]
    first = summary.head(bars, 5, order).withColumn("part", F.lit("head"))
    return first.unionByName(summary.tail(bars, 5, order).withColumn("part", F.lit("tail")))


# Summaries


def _describe_sql(source: str, columns: list[str]) -> str:
    parts = [
        f"""select '{c}' as "column", count({c}) as count, {rnd(f"avg({c})", "mean")},
  {rnd(f"stddev_samp({c})", "std")}, {rnd(f"min({c})", "min")}, {rnd(f"quantile_cont({c}, 0.25)", "p25")},
  {rnd(f"quantile_cont({c}, 0.5)", "p50")}, {rnd(f"quantile_cont({c}, 0.75)", "p75")},
  {rnd(f"max({c})", "max")} from {source}"""
        for c in columns
    ]
    return "\nunion all\n".join(parts)


@query("describe_numeric", _describe_sql("bars_h", OHLCV))
def describe_numeric(t):
    return summary.describe(t.bars_h)


@query(
    "quantiles_by_ticker",
    "\nunion all\n".join(
        f"""select ticker, 'sentiment' as "column", cast({q} as double) as q,
  {rnd(f"quantile_cont(sentiment, {q})", "quantile")} from news_h group by 1"""
        for q in (0.1, 0.5, 0.99)
    ),
)
def quantiles_by_ticker(t):
    return exact_quantiles(t.news_h, ["sentiment"], [0.1, 0.5, 0.99], ["ticker"])


@query(
    "null_counts",
    """with g as (select * from news_text)
select * from (select 'published_at' as "column", count(*) - count(published_at) as nulls from g
  union all select 'uuid', count(*) - count(uuid) from g) where nulls > 0""",
)
def null_counts(t):
    return summary.null_counts(t.news_text)


@query(
    "duplicate_rows",
    """with twice as (select * from lineitem union all select * from lineitem where l_linenumber = 1)
select cast((select count(*) from twice) - (select count(*) from (select distinct * from twice)) as bigint) as duplicate_rows""",
)
def duplicate_rows(t):
    """All lines and columns, with the first line of each order once more."""
    lines = t.read("lineitem")
    return summary.duplicate_rows(lines.unionByName(lines.where("l_linenumber = 1")))


@query(
    "sentiment_bands",
    """select case when sentiment < -0.5 then 'very_negative' when sentiment < 0 then 'negative'
  when sentiment = 0 then 'neutral' when sentiment <= 0.5 then 'positive' else 'very_positive' end as band,
  count(*) as articles from news_h group by 1""",
)
def sentiment_bands(t):
    return summary.sentiment_bands(t.news_h)


@query(
    "news_coverage",
    f"""select ticker, count(*) as rows, min(published_at) as first_at, max(published_at) as last_at,
  {rnd("min(sentiment)", "min")}, {rnd("max(sentiment)", "max")}, {rnd("avg(sentiment)", "mean")},
  {rnd("stddev_samp(sentiment)", "std")}, {rnd("median(sentiment)", "median")} from news_h group by 1""",
)
def news_coverage(t):
    return summary.coverage(t.news_h)


@query(
    "articles_per_day",
    f"""select ticker, count(*) as articles, count(distinct cast(published_at as date)) as days,
  {rnd("count(*)/count(distinct cast(published_at as date))", "per_day")} from news_d group by 1""",
)
def articles_per_day(t):
    return summary.articles_per_day(t.news_d)


@query(
    "sentiment_when_present",
    f"""with {SENTIMENT_SQL.format(bars="bars_h", news="news_h")}
select ticker, {rnd("avg(case when sentiment_count > 0 then sentiment_mean end)", "mean_sentiment")},
  cast(sum(sentiment_count) as bigint) as articles, count(*) filter (sentiment_count > 0) as bars_with_news
from sent group by 1""",
)
def sentiment_when_present(t):
    return summary.sentiment_when_present(sentiment_window(t.bars_h, t.news_h))


@query(
    "source_counts",
    """select 'bars' as source, count(*) as rows from bars_h union all select 'news', count(*) from news_h
union all select 'prices', count(*) from prices_h union all select 'fundamentals', count(*) from fund_h""",
)
def source_counts(t):
    return summary.source_counts(bars=t.bars_h, news=t.news_h, prices=t.prices_h, fundamentals=t.fund_h)


# Scores


def _ladder_sql(value: str, steps: list[tuple[str, int]], rest: int) -> str:
    whens = " ".join(f"when {value} {test} then {points}" for test, points in steps)
    return f"case when {value} is null then 0 {whens} else {rest} end"


HEALTH_SQL = "least(100, " + " + ".join(
    [
        _ladder_sql(
            "revenue_growth_yoy",
            [("> 0.2", 30), ("> 0.1", 25), ("> 0.05", 20), ("> 0", 15), ("> -0.05", 10)],
            5,
        ),
        _ladder_sql(
            "(net_income/nullif(revenue, 0))",
            [("> 0.35", 25), ("> 0.3", 22), ("> 0.25", 20), ("> 0.2", 18), ("> 0.15", 15)],
            10,
        ),
        _ladder_sql("net_income_growth_yoy", [("> 0.2", 5), ("> 0.1", 3), ("> 0", 2)], 0),
        _ladder_sql(
            "(operating_cash_flow/nullif(net_income, 0))",
            [("> 1.5", 20), ("> 1.2", 18), ("> 1.0", 15), ("> 0.8", 12)],
            8,
        ),
        _ladder_sql(
            "(total_liabilities/nullif(total_assets, 0))",
            [("< 0.3", 15), ("< 0.4", 12), ("< 0.5", 10), ("< 0.6", 8)],
            5,
        ),
        _ladder_sql(
            "(operating_income/nullif(revenue, 0))",
            [("> 0.5", 10), ("> 0.45", 9), ("> 0.4", 8), ("> 0.35", 7), ("> 0.3", 6)],
            4,
        ),
    ]
) + ")"

IMPACT_SQL = f"""scored as (select *, cast({HEALTH_SQL} as int) as h from fund_growth),
impact as (select ticker, report_date, h as financial_health_score, cast((h - 50)*2 as double) as stock_impact_score,
  case when h >= 85 then 'STRONGLY_POSITIVE' when h >= 70 then 'POSITIVE' when h >= 55 then 'SLIGHTLY_POSITIVE'
    when h >= 40 then 'NEUTRAL' when h >= 25 then 'NEGATIVE' else 'STRONGLY_NEGATIVE' end as stock_impact_label,
  case when h >= 85 then '+5% to +10%' when h >= 70 then '+2% to +5%' when h >= 55 then '0% to +2%'
    when h >= 40 then '-2% to +2%' when h >= 25 then '-5% to -2%' else '-10% to -5%' end as expected_price_change,
  case when h >= 85 then 'HIGH' when h >= 70 then 'MEDIUM-HIGH' when h >= 55 then 'MEDIUM'
    when h >= 40 then 'MEDIUM' when h >= 25 then 'MEDIUM-HIGH' else 'HIGH' end as impact_confidence from scored)"""


@query(
    "yoy_growth",
    f"select ticker, report_date, {rounded('revenue_growth_yoy', 'net_income_growth_yoy')} from fund_growth",
)
def yoy_growth(t):
    return t.fund_growth.select("ticker", "report_date", "revenue_growth_yoy", "net_income_growth_yoy")


@query("health_score", f"with {IMPACT_SQL} select ticker, report_date, financial_health_score from impact")
def health(t):
    return t.fund_growth.select("ticker", "report_date", health_score().alias("financial_health_score"))


@query("stock_impact", f"with {IMPACT_SQL} select * from impact")
def stock_impact(t):
    scored = t.fund_growth.select("ticker", "report_date", health_score().alias("financial_health_score"))
    return add_stock_impact(scored)


@query(
    "score_trend",
    f"""with {IMPACT_SQL}
select ticker, {rnd("avg(financial_health_score)", "mean_score")},
  arg_min(financial_health_score, report_date) as first_score,
  arg_max(financial_health_score, report_date) as last_score,
  case when count(*) = 1 then 'STABLE' when arg_max(financial_health_score, report_date)
    > arg_min(financial_health_score, report_date) then 'IMPROVING' else 'DECLINING' end as trend,
  arg_max(stock_impact_label, report_date) as latest_impact from impact group by 1""",
)
def score_trend(t):
    return summary.score_trend(add_scores(t.fund_growth))


# Predictions and metrics

PREDICTION_SQL = f"""{LABEL_SQL},
pred as (select *, close*(1 + (rn*37 % 11 - 5)/1000) as pred_a, close*(1 + (rn*17 % 7 - 3)/1000) as pred_b,
  cast(rn*7 % 3 as int) as pred_signal, cast(rn*13 % 160 - 20 as double) as raw_position,
  cast(rn*29 % 400 - 50 + 0.5 as double) as raw_timing, (rn*5 % 41 - 10)/7 as raw_profit,
  (rn % 50)/100 + 0.5 as raw_confidence from labelled),
post as (select ticker, timestamp, close, signal, position_size, timing_minutes, profit, pred_signal,
  case pred_signal when 0 then 'SELL' when 1 then 'HOLD' else 'BUY' end as name,
  case when pred_signal = 1 then 0 else cast(trunc(least(greatest(raw_position, 0), 100)) as int) end as pred_position_size,
  case when pred_signal = 1 then 0 else cast(trunc(least(greatest(raw_timing, 1), 240)) as int) end as pred_timing_minutes,
  case when pred_signal = 1 then 0 else raw_profit end as pred_profit, raw_confidence from pred)"""


def _post(t):
    raw = t.predictions.withColumn("raw_signal", F.col("pred_signal"))
    true = {c: f"true_{c}" for c in ("signal", "position_size", "timing_minutes", "profit")}
    return recommend.post_process(raw.withColumnsRenamed(true))


@query(
    "prediction_post",
    f"""with {PREDICTION_SQL}
select ticker, timestamp, name as signal, pred_position_size as position_size,
  pred_timing_minutes as timing_minutes, {rnd("pred_profit", "expected_profit_pct")},
  {rnd("raw_confidence", "signal_confidence")} from post""",
)
def prediction_post(t):
    return _post(t).select(
        *KEYS, "signal", "position_size", "timing_minutes", "expected_profit_pct", "signal_confidence"
    )


@query(
    "ensemble_mean",
    f"with {PREDICTION_SQL} select ticker, timestamp, {rnd('(pred_a + pred_b)/2', 'prediction')} from pred",
)
def ensemble_mean(t):
    out = metrics.mean_prediction(t.predictions, ["pred_a", "pred_b"])
    return out.select(*KEYS, "prediction")


@query(
    "regression_metrics",
    f"""with {PREDICTION_SQL}, mu as (select avg(close) as m from pred)
select {rnd("avg((close - pred_a)**2)", "mse")}, {rnd("sqrt(avg((close - pred_a)**2))", "rmse")},
  {rnd("avg(abs(close - pred_a))", "mae")}, {rnd("1 - sum((close - pred_a)**2)/sum((close - m)**2)", "r2")},
  {rnd("avg(abs((close - pred_a)/nullif(close, 0)))*100", "mape")} from pred, mu""",
)
def regression_metrics(t):
    return metrics.regression_metrics(t.predictions, "close", "pred_a")


def _scored(t):
    names = {"signal": "name", "position_size": "pred_position_size",
             "timing_minutes": "pred_timing_minutes", "expected_profit_pct": "pred_profit"}
    out = _post(t).withColumnsRenamed(names)
    true = ("signal", "position_size", "timing_minutes", "profit")
    return out.withColumnsRenamed({f"true_{c}": c for c in true})


@query(
    "trading_metrics",
    f"""with {PREDICTION_SQL}
select {rnd("avg(case when signal = pred_signal then 1.0e0 else 0 end)", "signal_accuracy")},
  {rnd("coalesce(avg(abs(position_size - pred_position_size)) filter (signal <> 1), 0)", "position_mae")},
  {rnd("coalesce(avg(abs(timing_minutes - pred_timing_minutes)) filter (signal <> 1), 0)", "timing_mae")},
  {rnd("coalesce(avg(abs(profit - pred_profit)) filter (signal <> 1), 0)", "profit_mae")} from post""",
)
def trading_metrics(t):
    return metrics.trading_metrics(_scored(t))


@query(
    "confusion_matrix",
    f"""with {PREDICTION_SQL}
select label, count(*) filter (signal = label and pred_signal = 0) as pred_0,
  count(*) filter (signal = label and pred_signal = 1) as pred_1,
  count(*) filter (signal = label and pred_signal = 2) as pred_2
from (values (0), (1), (2)) as l(label), pred group by 1""",
)
def confusion_matrix(t):
    return metrics.confusion_matrix(t.predictions)


@query(
    "classification_report",
    f"""with {PREDICTION_SQL},
per as (select label, case label when 0 then 'SELL' when 1 then 'HOLD' else 'BUY' end as name,
  count(*) filter (signal = label and pred_signal = label) as tp, count(*) filter (pred_signal = label) as p,
  count(*) filter (signal = label) as s from (values (0), (1), (2)) as l(label), pred group by 1),
sc as (select name, coalesce(tp/nullif(p, 0), 0) as precision, coalesce(tp/nullif(s, 0), 0) as recall,
  coalesce(2*tp/nullif(p + s, 0), 0) as f1, s as support, tp from per),
tot as (select cast(sum(support) as bigint) as n, sum(tp) as hits from sc),
lines as (select name as label, precision, recall, f1, support from sc
  union all select 'accuracy', hits/n, hits/n, hits/n, n from tot
  union all select 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) as bigint) from sc
  union all select 'weighted avg', sum(precision*support)/sum(support), sum(recall*support)/sum(support),
    sum(f1*support)/sum(support), cast(sum(support) as bigint) from sc)
select label, {rounded("precision", "recall", "f1")}, support from lines""",
)
def classification_report(t):
    return metrics.classification_report(t.predictions)


@query(
    "recommendation",
    f"""with {PREDICTION_SQL},
last as (select * from post qualify row_number() over (partition by ticker order by timestamp desc) = 1)
select ticker, {rnd("close", "current_price")}, name as signal, name as action, pred_position_size as shares,
  pred_timing_minutes as minutes,
  case when pred_timing_minutes >= 60 then (pred_timing_minutes // 60) || 'h ' || (pred_timing_minutes % 60) || 'm'
    else pred_timing_minutes || 'm' end as formatted,
  case name when 'BUY' then 'SELL' when 'SELL' then 'BUY' else 'N/A' end as exit_action,
  {rnd("pred_profit", "expected_profit_pct")},
  {rnd("case when pred_position_size > 0 then close*pred_position_size*pred_profit/100 else 0 end", "expected_profit_dollars")},
  {rnd("close*pred_position_size", "total_investment")}, {rnd("raw_confidence", "confidence")} from last""",
)
def recommendation(t):
    last = latest_rows(_post(t).drop("close"))
    out = recommend.recommendations(last, clean.latest_price(t.bars_h))
    return out.select(
        "ticker",
        "current_price",
        "signal",
        "action",
        "shares",
        "timing.minutes",
        "timing.formatted",
        F.col("timing.action").alias("exit_action"),
        "expected_profit_pct",
        "expected_profit_dollars",
        "total_investment",
        "confidence",
    )
