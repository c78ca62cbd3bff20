"""Queries on the bar series: indicators, labels, fill, alignment, the feature frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from candela.functions.calendar_features import add_time_features
from candela.operators.asof import align_fundamentals, align_latest_price, price_on_news
from candela.operators.fill import fill_series
from candela.operators.indicators import INDICATOR_COLUMNS, indicators
from candela.operators.labels import latest_rows, lead_target, time_split, trade_labels
from candela.operators.sentiment import SENTIMENT_COLUMNS, sentiment_window
from candela.plans.catalog import query, rnd, rounded
from candela.plans.feature_frame import decompose, feature_frame, valid_rows
from candela.schemas import OHLCV, STATEMENT_VALUES
from candela.timeline import POS, TOTAL, positioned

KEYS = ("ticker", "timestamp")


def _family(t, name: str, *columns: str):
    return indicators(t.bars_h, [name]).select(*KEYS, *columns)


def _full(agg: str, column: str, n: int, over: str = "partition by ticker order by timestamp") -> str:
    w = f"over ({over} rows between {n - 1} preceding and current row)"
    return f"case when count({column}) {w} = {n} then {agg}({column}) {w} end"


def ewm_sql(source: str, column: str, span: int) -> str:
    """Adjusted exponential mean as a weighted self join; weights below 1e-17 are left out."""
    r = 1 - 2 / (span + 1)
    rows = {9: 176, 12: 235, 26: 509}[span]
    return f"""select a.ticker, a.rn, sum(b.{column} * power({r!r}, a.rn - b.rn))
         / sum(case when b.{column} is not null then power({r!r}, a.rn - b.rn) end) as y
  from {source} a join {source} b on a.ticker = b.ticker and b.rn between a.rn - {rows} and a.rn
  group by 1, 2"""


SMA = [f"sma_{n}" for n in (5, 10, 20, 50)]


@query(
    "sma",
    "select ticker, timestamp, "
    + ", ".join(rnd(_full("avg", "close", n), f"sma_{n}") for n in (5, 10, 20, 50))
    + " from bars_h",
)
def sma(t):
    return _family(t, "sma", *SMA)


@query(
    "ema",
    f"""with e12 as ({ewm_sql("rows_h", "close", 12)}), e26 as ({ewm_sql("rows_h", "close", 26)})
select b.ticker, b.timestamp, {rnd("e12.y", "ema_12")}, {rnd("e26.y", "ema_26")}
from rows_h b join e12 using (ticker, rn) join e26 using (ticker, rn)""",
)
def ema(t):
    return _family(t, "ema", "ema_12", "ema_26")


_GAPS_SQL = "gaps as (select * replace (case when rn % 13 <> 0 then close end as close) from rows_h)"


def _with_gaps(t):
    """Hourly bars whose every 13th close is missing."""
    rn = F.col(POS) + 1
    return positioned(t.bars_h).withColumn("close", F.when(rn % 13 != 0, F.col("close"))).drop(POS, TOTAL)


@query(
    "ema_with_gaps",
    f"""with {_GAPS_SQL}, e12 as ({ewm_sql("gaps", "close", 12)}), e26 as ({ewm_sql("gaps", "close", 26)})
select b.ticker, b.timestamp, {rnd("e12.y", "ema_12")}, {rnd("e26.y", "ema_26")}
from gaps b join e12 using (ticker, rn) join e26 using (ticker, rn)""",
)
def ema_with_gaps(t):
    return indicators(_with_gaps(t), ["ema"]).select(*KEYS, "ema_12", "ema_26")


MACD_SQL = f"""e12 as ({ewm_sql("rows_h", "close", 12)}), e26 as ({ewm_sql("rows_h", "close", 26)}),
mac as (select ticker, rn, e12.y as ema_12, e26.y as ema_26, e12.y - e26.y as macd
  from e12 join e26 using (ticker, rn)),
sig as ({ewm_sql("mac", "macd", 9)})"""


@query(
    "macd_with_gaps",
    f"""with {_GAPS_SQL}, {MACD_SQL.replace("rows_h", "gaps")}
select b.ticker, b.timestamp, {rounded("macd")}, {rnd("sig.y", "macd_signal")},
  {rnd("macd - sig.y", "macd_histogram")}
from gaps b join mac using (ticker, rn) join sig using (ticker, rn)""",
)
def macd_with_gaps(t):
    return indicators(_with_gaps(t), ["macd"]).select(*KEYS, "macd", "macd_signal", "macd_histogram")


@query(
    "macd",
    f"""with {MACD_SQL}
select b.ticker, b.timestamp, {rounded("macd")}, {rnd("sig.y", "macd_signal")},
  {rnd("macd - sig.y", "macd_histogram")}
from rows_h b join mac using (ticker, rn) join sig using (ticker, rn)""",
)
def macd(t):
    return _family(t, "macd", "macd", "macd_signal", "macd_histogram")


RSI_SQL = f"""delta as (select ticker, timestamp, close,
  coalesce(close - lag(close) over (partition by ticker order by timestamp), 0) as d from bars_h),
gl as (select ticker, timestamp, greatest(d, 0) as up, greatest(-d, 0) as down from delta),
rs as (select ticker, timestamp, {_full("avg", "up", 14)} as g, {_full("avg", "down", 14)} as l from gl),
rsi as (select ticker, timestamp, case when l > 0 then 100 - 100/(1 + g/l) when g > 0 then 100 end as rsi
  from rs)"""


@query("rsi", f"with {RSI_SQL} select ticker, timestamp, {rounded('rsi')} from rsi")
def rsi(t):
    return _family(t, "rsi", "rsi")


BANDS_SQL = f"""mid as (select ticker, timestamp, close, {_full("avg", "close", 20)} as m,
  {_full("stddev_samp", "close", 20)} as s from bars_h),
bands as (select ticker, timestamp, m as bb_middle, m + 2*s as bb_upper, m - 2*s as bb_lower,
  (m + 2*s) - (m - 2*s) as bb_width,
  (close - (m - 2*s))/nullif((m + 2*s) - (m - 2*s), 0) as bb_position from mid)"""
BANDS = ["bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_position"]


@query("bollinger", f"with {BANDS_SQL} select ticker, timestamp, {rounded(*BANDS)} from bands")
def bollinger(t):
    return _family(t, "bollinger", *BANDS)


def _change(k: int) -> str:
    lag = f"lag(close, {k}) over (partition by ticker order by timestamp)"
    return f"(close - {lag})/nullif({lag}, 0)"


CHANGES = {"price_change": 1, "price_change_5d": 5, "price_change_10d": 10}


@query(
    "pct_change",
    "select ticker, timestamp, "
    + ", ".join(rnd(_change(k), n) for n, k in CHANGES.items())
    + " from bars_h",
)
def pct_change(t):
    return _family(t, "pct_change", *CHANGES)


@query(
    "volume_indicators",
    f"""select ticker, timestamp, {rnd(_full("avg", "volume", 20), "volume_sma")},
  {rnd(f"volume/nullif({_full('avg', 'volume', 20)}, 0)", "volume_ratio")} from bars_h""",
)
def volume_indicators(t):
    return _family(t, "volume", "volume_sma", "volume_ratio")


@query(
    "volatility",
    f"""select ticker, timestamp, {rnd(_full("stddev_samp", "close", 5), "volatility_5d")},
  {rnd(_full("stddev_samp", "close", 20), "volatility_20d")} from bars_h""",
)
def volatility(t):
    return _family(t, "volatility", "volatility_5d", "volatility_20d")


@query(
    "spreads",
    f"""select ticker, timestamp, {rnd("(high - low)/nullif(close, 0)", "hl_spread")},
  {rnd("(close - open)/nullif(open, 0)", "oc_spread")} from bars_h""",
)
def spreads(t):
    return _family(t, "spreads", "hl_spread", "oc_spread")


TIME_SQL = """cast(year(timestamp) as int) as year, cast(month(timestamp) as int) as month,
  cast(day(timestamp) as int) as day, cast(isodow(timestamp) - 1 as int) as day_of_week,
  cast(dayofyear(timestamp) as int) as day_of_year, cast(week(timestamp) as int) as week_of_year,
  cast(quarter(timestamp) as int) as quarter,
  round(sin(month(timestamp)*2*pi()/12), 6) + 0.0 as month_sin,
  round(cos(month(timestamp)*2*pi()/12), 6) + 0.0 as month_cos,
  round(sin((isodow(timestamp) - 1)*2*pi()/7), 6) + 0.0 as day_of_week_sin,
  round(cos((isodow(timestamp) - 1)*2*pi()/7), 6) + 0.0 as day_of_week_cos,
  cast(isodow(timestamp) >= 6 as int) as is_weekend"""


@query("time_features", f"select ticker, timestamp, {TIME_SQL} from bars_d")
def time_features(t):
    return add_time_features(t.bars_d.select(*KEYS))


@query(
    "lead_target",
    f"""select * from (select ticker, timestamp, {rounded("close")},
  lead(close, 1) over (partition by ticker order by timestamp) as target from bars_h)
where target is not null""",
)
def lead_targets(t):
    return lead_target(t.bars_h).select(*KEYS, "close", "target")


@query(
    "fill_forward_back",
    """with holes as (select ticker, timestamp, rn,
  case when rn % 5 = 0 and rn > 20 then close end as close_gap,
  case when rn % 3 = 0 and ticker <> 'click' then volume end as volume_gap from rows_h)
select ticker, timestamp,
  round(coalesce(last_value(close_gap ignore nulls) over before,
    first_value(close_gap ignore nulls) over after, 0), 6) + 0.0 as close_gap,
  round(coalesce(last_value(volume_gap ignore nulls) over before,
    first_value(volume_gap ignore nulls) over after, 0), 6) + 0.0 as volume_gap
from holes
window before as (partition by ticker order by rn rows between unbounded preceding and current row),
  after as (partition by ticker order by rn rows between current row and unbounded following)""",
)
def fill_forward_back(t):
    rn = F.col(POS) + 1
    holes = positioned(t.bars_h).select(
        *KEYS,
        F.when((rn % 5 == 0) & (rn > 20), F.col("close")).alias("close_gap"),
        F.when((rn % 3 == 0) & (F.col("ticker") != "click"), F.col("volume")).alias("volume_gap"),
    )
    return fill_series(holes, ["close_gap", "volume_gap"])


LABEL_SQL = """pairs as (select a.ticker, a.rn, b.rn - a.rn as step,
    (b.close - a.close)/nullif(a.close, 0) as r
  from rows_h a join rows_h b on a.ticker = b.ticker and b.rn between a.rn + 1 and a.rn + 240),
best as (select ticker, rn, step, r from pairs
  qualify row_number() over (partition by ticker, rn order by abs(r) desc, step) = 1),
labels as (select ticker, timestamp, a.rn, close,
  coalesce(abs(r) > 0 and abs(r) >= 0.001, false) as trade, r, step
  from rows_h a left join best using (ticker, rn)),
labelled as (select ticker, timestamp, rn, close,
  case when trade and r > 0 then 2 when trade then 0 else 1 end as signal,
  case when trade then cast(trunc(100*least(abs(r)/0.01, 1)) as int) else 0 end as position_size,
  cast(case when trade then step else 0 end as int) as timing_minutes,
  case when trade then abs(r)*100 else 0 end as profit from labels)"""


@query(
    "trade_labels",
    f"""with {LABEL_SQL}
select ticker, timestamp, signal, position_size, timing_minutes, {rounded("profit")} from labelled""",
)
def trade_label(t):
    return trade_labels(t.bars_h).select(
        *KEYS, "signal", "position_size", "timing_minutes", "profit"
    )


@query(
    "trade_labels_with_gaps",
    f"""with {_GAPS_SQL}, {LABEL_SQL.replace("rows_h", "gaps").replace("from pairs", "from pairs where r is not null")}
select ticker, timestamp, signal, position_size, timing_minutes, {rounded("profit")} from labelled""",
)
def trade_label_with_gaps(t):
    return trade_labels(_with_gaps(t)).select(*KEYS, "signal", "position_size", "timing_minutes", "profit")


@query(
    "trade_labels_by_time",
    """with pairs as (select a.ticker, a.timestamp, b.rn - a.rn as step,
    date_diff('second', a.timestamp, b.timestamp) // 60 as minutes, (b.close - a.close)/nullif(a.close, 0) as r
  from rows_h a join rows_h b on a.ticker = b.ticker and b.rn between a.rn + 1 and a.rn + 2000),
best as (select * from pairs where minutes <= 2000
  qualify row_number() over (partition by ticker, timestamp order by abs(r) desc, step) = 1),
labels as (select a.ticker, a.timestamp, coalesce(abs(r) > 0 and abs(r) >= 0.02, false) as trade, r, minutes
  from rows_h a left join best using (ticker, timestamp))
select ticker, timestamp, case when trade and r > 0 then 2 when trade then 0 else 1 end as signal,
  cast(case when trade then minutes else 0 end as int) as timing_minutes,
  round(case when trade then abs(r)*100 else 0 end, 6) + 0.0 as profit from labels""",
)
def trade_label_by_time(t):
    labels = trade_labels(t.bars_h, max_holding=2000, min_profit=0.02, by_time=True)
    return labels.select(*KEYS, "signal", "timing_minutes", "profit")


@query(
    "time_split",
    """select ticker, timestamp, rn > floor(count(*) over (partition by ticker) * (1 - 0.2e0)) as is_validation
from rows_h""",
)
def split(t):
    return time_split(t.bars_h, 0.2).select(*KEYS, "is_validation")


@query(
    "time_split_pooled",
    """select ticker, timestamp, row_number() over (order by timestamp, ticker) > floor(count(*) over () * (1 - 0.2e0)) as is_validation
from bars_d""",
)
def split_pooled(t):
    return time_split(t.bars_d, 0.2, pooled=True).select(*KEYS, "is_validation")


SENTIMENT_SQL = """sent as (select b.ticker, b.timestamp, count(n.published_at) as sentiment_count,
  case when count(n.published_at) = 0 then 0 else avg(n.sentiment) end as sentiment_mean,
  case when count(n.published_at) = 0 then 0 else stddev_samp(n.sentiment) end as sentiment_std,
  case when count(n.published_at) = 0 then 0 else max(n.sentiment) end as sentiment_max,
  case when count(n.published_at) = 0 then 0 else min(n.sentiment) end as sentiment_min
from {bars} b left join {news} n on n.ticker = b.ticker
  and n.published_at >= b.timestamp - interval 24 hour and n.published_at < b.timestamp
group by 1, 2)"""
_SENTIMENT_OUT = (
    "select ticker, timestamp, sentiment_count, "
    + rounded(*(c for c in SENTIMENT_COLUMNS if c != "sentiment_count"))
    + " from sent"
)


@query("sentiment_24h", f"with {SENTIMENT_SQL.format(bars='bars_h', news='news_h')} {_SENTIMENT_OUT}")
def sentiment_24h(t):
    return sentiment_window(t.bars_h, t.news_h)


_GAPPY_NEWS = """gappy as (select * replace (case when uuid % 3 <> 0 and ticker <> 'view' then 1000 + sentiment end as sentiment) from news_h),
few as (select * from bars_h where ticker <> 'click' or hour(timestamp) % 5 = 0)"""


@query("sentiment_24h_gaps", f"with {_GAPPY_NEWS}, {SENTIMENT_SQL.format(bars='few', news='gappy')} {_SENTIMENT_OUT}")
def sentiment_24h_gaps(t):
    """Scores far from zero, many missing, for one ticker all; every bar comes twice."""
    scored = (F.col("uuid") % 3 != 0) & (F.col("ticker") != "view")
    news = t.news_h.withColumn("sentiment", F.when(scored, F.lit(1000.0) + F.col("sentiment")))
    few = t.bars_h.where("ticker <> 'click' or hour(timestamp) % 5 = 0")
    return sentiment_window(few.unionByName(few), news)


@query("sentiment_24h_daily", f"with {SENTIMENT_SQL.format(bars='bars_d', news='news_d')} {_SENTIMENT_OUT}")
def sentiment_24h_daily(t):
    return sentiment_window(t.bars_d, t.news_d)


@query(
    "asof_fundamentals",
    f"""select b.ticker, b.timestamp, {rounded(*STATEMENT_VALUES, prefix="f.")}
from bars_d b asof left join fund_d f on b.ticker = f.ticker and b.timestamp >= f.report_date""",
)
def asof_fundamentals(t):
    return align_fundamentals(t.bars_d.select(*KEYS), t.fund_d)


@query(
    "asof_price_on_news",
    f"""select n.uuid, n.ticker, n.published_at, {rounded("sentiment")}, cast(n.published_at as date)
  as price_date, {rnd("b.close", "close_on_price_date")}
from news_d n asof left join bars_d b on n.ticker = b.ticker
  and date_trunc('day', n.published_at) >= b.timestamp""",
)
def asof_price_on_news(t):
    out = price_on_news(t.news_d, t.bars_d)
    return out.withColumn("price_date", F.col("price_date").cast("date"))


@query(
    "latest_price_align",
    f"""select ticker, timestamp, {rnd('''last_value(price ignore nulls) over (partition by ticker
  order by timestamp rows between unbounded preceding and current row)''', "latest_price")}
from bars_d left join prices_d using (ticker, timestamp)""",
)
def latest_price_align(t):
    return align_latest_price(t.bars_d.select(*KEYS), t.prices_d)


@query(
    "latest_price_asof",
    f"""select b.ticker, b.timestamp, {rnd("n.sentiment", "latest_price")}
from bars_h b asof left join news_h n on b.ticker = n.ticker and b.timestamp >= n.published_at""",
)
def latest_price_asof(t):
    ticks = t.news_h.select("ticker", F.col("published_at").alias("timestamp"), F.col("sentiment").alias("price"))
    return align_latest_price(t.bars_h.select(*KEYS), ticks, exact=False)


_DOUBLES = [
    *OHLCV,
    *INDICATOR_COLUMNS,
    *(c for c in SENTIMENT_COLUMNS if c != "sentiment_count"),
    "latest_price",
    *STATEMENT_VALUES,
]
_TIME_NAMES = """year, month, day, day_of_week, day_of_year, week_of_year, quarter, month_sin, month_cos,
  day_of_week_sin, day_of_week_cos, is_weekend"""


def filled(c: str) -> str:
    return f"coalesce(last_value({c} ignore nulls) over before, first_value({c} ignore nulls) over after, 0)"


FRAME_SQL = f"""{MACD_SQL},
{RSI_SQL},
{BANDS_SQL},
{SENTIMENT_SQL.format(bars="bars_h", news="news_h")},
rolls as (select *, {", ".join(f"{_full('avg', 'close', n)} as sma_{n}" for n in (5, 10, 20, 50))},
  {_full("avg", "volume", 20)} as volume_sma,
  {_full("stddev_samp", "close", 5)} as volatility_5d, {_full("stddev_samp", "close", 20)} as volatility_20d,
  {", ".join(f"{_change(k)} as {n}" for n, k in CHANGES.items())},
  (high - low)/nullif(close, 0) as hl_spread, (close - open)/nullif(open, 0) as oc_spread,
  lead(close, 1) over (partition by ticker order by timestamp) as target from rows_h),
reports as (select b.ticker, b.timestamp, f.* exclude (ticker, report_date)
  from bars_h b asof left join fund_h f on b.ticker = f.ticker and b.timestamp >= f.report_date),
wide as (select rolls.*, volume/nullif(volume_sma, 0) as volume_ratio, ema_12, ema_26, macd, sig.y as macd_signal,
  macd - sig.y as macd_histogram, rsi, bb_middle, bb_upper, bb_lower, bb_width, bb_position,
  sentiment_mean, sentiment_count, sentiment_std, sentiment_max, sentiment_min, price as latest_price,
  {", ".join(STATEMENT_VALUES)}
  from rolls join mac using (ticker, rn) join sig using (ticker, rn) join rsi using (ticker, timestamp)
  join bands using (ticker, timestamp) join sent using (ticker, timestamp)
  left join prices_h using (ticker, timestamp) join reports using (ticker, timestamp)),
frame as (select ticker, timestamp, {", ".join(f"{filled(c)} as {c}" for c in _DOUBLES)}, sentiment_count, target
from wide where {{rows}}
window before as (partition by ticker order by timestamp rows between unbounded preceding and current row),
  after as (partition by ticker order by timestamp rows between current row and unbounded following))"""


def _frame(t, **options):
    bars = t.stored(t.bars_h, "bars")
    return feature_frame(bars, t.news_h, t.prices_h, t.fund_h, **options)


@query(
    "feature_frame",
    f"""with {FRAME_SQL.format(rows="target is not null")}
select ticker, timestamp, {rounded(*_DOUBLES)}, sentiment_count, {TIME_SQL}, {rounded("target")} from frame""",
)
def feature_frame_train(t):
    return _frame(t)


@query(
    "feature_frame_score",
    f"""with {FRAME_SQL.format(rows="true")}
select ticker, timestamp, {rounded(*_DOUBLES)}, sentiment_count, {TIME_SQL}, {rounded("target")} from frame""",
)
def feature_frame_score(t):
    return _frame(t, mode="score")


@query(
    "latest_features",
    f"""with {FRAME_SQL.format(rows="true")}
select ticker, timestamp, {rounded(*_DOUBLES)}, sentiment_count, {TIME_SQL}, {rounded("target")} from frame
qualify row_number() over (partition by ticker order by timestamp desc) = 1""",
)
def latest_features(t):
    return latest_rows(_frame(t, mode="score"))


@query(
    "valid_rows",
    """with w as (select *, avg(close) over (partition by ticker order by rn rows between 49 preceding and
  current row) as a, lead(close) over (partition by ticker order by rn) as target from rows_h)
select ticker, timestamp, round(a, 6) + 0.0 as sma_50, round(target, 6) + 0.0 as target
from w where rn >= 50 and target is not null""",
)
def valid(t):
    series = indicators(t.bars_h, ["sma"]).select(*KEYS, "close", "sma_50")
    return valid_rows(lead_target(series, drop_missing=False)).select(*KEYS, "sma_50", "target")


def _causal(c: str) -> str:
    return f"coalesce(last_value({c} ignore nulls) over before, 0)"


@query(
    "feature_frame_causal",
    f"""with {FRAME_SQL.format(rows="target is not null")},
causal as (select ticker, timestamp, {", ".join(f"{_causal(c)} as {c}" for c in _DOUBLES)} from wide where target is not null
  window before as (partition by ticker order by timestamp rows between unbounded preceding and current row))
select ticker, timestamp, {rounded(*_DOUBLES)} from causal""",
)
def feature_frame_causal(t):
    """No bar is filled from a later one."""
    return _frame(t, fill="causal").select(*KEYS, *_DOUBLES)


@query(
    "asof_fundamentals_lagged",
    f"""select b.ticker, b.timestamp, {rounded(*STATEMENT_VALUES, prefix="f.")}
from bars_d b asof left join (select * replace (report_date + interval 45 day as report_date) from fund_d) f
  on b.ticker = f.ticker and b.timestamp >= f.report_date""",
)
def asof_fundamentals_lagged(t):
    """Reports are seen 45 days after their date."""
    return align_fundamentals(t.bars_d.select(*KEYS), t.fund_d, availability_lag_days=45)


@query("decompose_bars", f"""select timestamp, ticker, {rounded(*OHLCV)} from (select *, lead(close) over (partition by ticker order by timestamp) as target
  from bars_h) where target is not null""")
def decompose_bars(t):
    return decompose(_frame(t))["bars"]


@query(
    "decompose_news",
    f"""with {SENTIMENT_SQL.format(bars="bars_h", news="news_h")}
select s.timestamp as published_at, ticker, {rounded("sentiment_mean")} from sent s
join (select ticker, timestamp, lead(close) over (partition by ticker order by timestamp) as target from bars_h) b using (ticker, timestamp)
where target is not null""",
)
def decompose_news(t):
    return decompose(_frame(t))["news"].withColumnRenamed("sentiment", "sentiment_mean")


@query(
    "decompose_fundamentals",
    f"""with b as (select *, lead(close) over (partition by ticker order by timestamp) as target from bars_h),
w as (select b.ticker, b.timestamp, {", ".join(f"f.{c}" for c in STATEMENT_VALUES)}
  from b asof left join fund_h f on b.ticker = f.ticker and b.timestamp >= f.report_date where target is not null)
select timestamp as report_date, ticker, {", ".join(f"round({filled(c)}, 6) + 0.0 as {c}" for c in STATEMENT_VALUES)} from w
  window before as (partition by ticker order by timestamp rows between unbounded preceding and current row),
  after as (partition by ticker order by timestamp rows between current row and unbounded following)""",
)
def decompose_fundamentals(t):
    return decompose(_frame(t))["fundamentals"]


@query(
    "decompose_prices",
    """select ticker, timestamp, close as price from (select *, lead(close) over (partition by ticker order by
  timestamp) as target from bars_h) where target is not null""",
)
def decompose_prices(t):
    return decompose(_frame(t))["prices"]
