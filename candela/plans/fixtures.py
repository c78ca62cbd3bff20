"""The test tables seen as market data, in Spark and in SQL.

``Tables`` builds each view lazily from the parquet files; ``VIEWS`` states the same views in ANSI
SQL, in dependency order, for the comparison queries.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.functions.scoring import add_growth
from candela.operators.labels import trade_labels
from candela.session import configure, materialize
from candela.timeline import POS, positioned


def every_seventh(bars: DataFrame) -> DataFrame:
    """Every seventh close of a ticker, as price snapshots."""
    return (
        positioned(bars)
        .where(F.col(POS) % 7 == 6)
        .select("timestamp", "ticker", F.col("close").alias("price"))
    )


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        """A table with its wall-clock timestamps read as UTC instants."""
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        zoned = {c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}
        return df.withColumns(zoned) if zoned else df

    def event_bars(self, unit: str) -> DataFrame:
        return self.read("events").groupBy(
            F.col("event_type").alias("ticker"), F.date_trunc(unit, "ts").alias("timestamp")
        ).agg(
            F.min_by("value", "ts").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )

    @cached_property
    def bars_h(self) -> DataFrame:
        return self.event_bars("hour")

    @cached_property
    def news_h(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("double")
        return (
            self.read("events")
            .select(
                F.col("event_id").alias("uuid"),
                F.col("ts").alias("published_at"),
                F.col("event_type").alias("ticker"),
                (k / 50 - 1).alias("sentiment"),
            )
        )

    @cached_property
    def bars_d(self) -> DataFrame:
        price = "o_totalprice"
        return self.read("orders").groupBy(
            F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").alias("timestamp")
        ).agg(
            F.min_by(price, "o_orderkey").alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, "o_orderkey").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )

    @cached_property
    def news_d(self) -> DataFrame:
        lines = self.read("lineitem")
        orders = self.read("orders").select("o_orderkey", "o_orderpriority")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("uuid"),
            F.col("l_shipdate").alias("published_at"),
            F.col("o_orderpriority").alias("ticker"),
            (F.col("l_discount") * 20 - 1).alias("sentiment"),
        )

    @cached_property
    def fund_d(self) -> DataFrame:
        price = F.col("o_totalprice").cast("decimal(18,2)")

        def total(status: str | None) -> Column:
            part = price if status is None else F.when(F.col("o_orderstatus") == status, price).otherwise(0)
            return F.sum(part).cast("double")

        sums = self.read("orders").groupBy(
            F.col("o_orderpriority").alias("ticker"),
            F.date_trunc("quarter", "o_orderdate").alias("report_date"),
        ).agg(
            total(None).alias("r"),
            total("F").alias("f"),
            total("O").alias("o"),
            F.count(F.lit(1)).cast("double").alias("n"),
        )
        r, o = F.col("r"), F.col("o")
        return sums.select(
            "ticker",
            "report_date",
            r.alias("revenue"),
            (F.col("f") * 0.6).alias("net_income"),
            (r / F.col("n") / 5e4).alias("eps"),
            ((r - o) * 0.5).alias("operating_cash_flow"),
            (r * 4.0).alias("total_assets"),
            (o * 5.0).alias("total_liabilities"),
        )

    @cached_property
    def fund_growth(self) -> DataFrame:
        return add_growth(self.fund_d).withColumn("operating_income", F.col("net_income") * 1.25)

    @cached_property
    def prices_d(self) -> DataFrame:
        """Every seventh close of a ticker, as price snapshots."""
        return every_seventh(self.bars_d)

    @cached_property
    def prices_h(self) -> DataFrame:
        return every_seventh(self.bars_h)

    @cached_property
    def fund_h(self) -> DataFrame:
        """Weekly reports for the tickers of the hourly bars."""
        value = F.col("value").cast("decimal(18,2)")
        sums = self.read("events").groupBy(
            F.col("event_type").alias("ticker"), F.date_trunc("week", "ts").alias("report_date")
        ).agg(
            F.sum(value).cast("double").alias("r"),
            F.sum(F.when(F.col("user_id") % 2 == 0, value).otherwise(0)).cast("double").alias("e"),
            F.count(F.lit(1)).cast("double").alias("n"),
        )
        r, e = F.col("r"), F.col("e")
        return sums.select(
            "ticker",
            "report_date",
            r.alias("revenue"),
            (e * 0.5).alias("net_income"),
            (r / F.col("n")).alias("eps"),
            ((r - e) * 0.5).alias("operating_cash_flow"),
            (r * 4.0).alias("total_assets"),
            (e * 3.0).alias("total_liabilities"),
        )

    @cached_property
    def news_text(self) -> DataFrame:
        """Articles as a text export: some without a time, some with a score that is no number."""
        uuid, text = F.col("uuid"), F.date_format("published_at", "yyyy-MM-dd HH:mm:ss")
        score = F.when(uuid % 19 == 0, "n/a").when(uuid % 23 == 0, "NaN")
        return self.news_d.select(
            "uuid",
            F.when(uuid % 17 != 0, F.concat(text, F.lit("+00:00"))).alias("published_at"),
            "ticker",
            score.otherwise(F.col("sentiment").cast("string")).alias("sentiment_score"),
        )

    @cached_property
    def bars_text(self) -> DataFrame:
        """Bars as a vendor export in local time: copies, missing volumes, closes that are no number."""
        day = F.day("timestamp")
        out = self.bars_d.select(
            F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("Date"),
            "ticker",
            *(F.col(c).cast("string").alias(c.capitalize()) for c in ("open", "high", "low")),
            F.when(day == 13, "bad").otherwise(F.col("close").cast("string")).alias("Close"),
            F.when(day != 17, F.col("volume").cast("string")).alias("Volume"),
            F.lit(0).alias("seq"),
        )
        copies = out.where(day % 2 == 0).withColumns({"Close": F.lit("1.0"), "seq": F.lit(1)})
        return out.unionByName(copies)

    @cached_property
    def news_pages(self) -> DataFrame:
        """Article pages as JSON text: up to 100 articles of one ticker, with decoys and gaps.

        Page ``event_id div 100`` bounds a page, since every event is an article.
        """
        n = self.news_h.withColumn("_page", F.floor(F.col("uuid") / 100))
        uuid = F.col("uuid")

        def entity(symbol: Column, score: Column) -> Column:
            return F.struct(
                symbol.alias("symbol"),
                symbol.alias("name"),
                score.cast("double").alias("sentiment_score"),
                F.lit(1.0).alias("match_score"),
            )

        none = F.lit(None)
        score = F.when(uuid % 13 == 0, none).otherwise(F.col("sentiment"))
        entities = F.concat(
            F.when(uuid % 2 == 0, F.array(entity(F.lit("ZZZ"), F.lit(-9.0)))).otherwise(F.array()),
            F.when(uuid % 5 == 0, F.array(none.cast("struct<symbol:string,name:string,sentiment_score:double,match_score:double>"))).otherwise(F.array()),
            F.when(uuid % 11 == 0, F.array()).otherwise(F.array(entity(F.col("ticker"), score))),
            F.when(uuid % 7 == 0, F.array(entity(F.col("ticker"), F.lit(9.0)))).otherwise(F.array()),
        )
        text = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        article = F.struct(
            uuid.cast("string").alias("uuid"),
            F.concat(F.lit("title "), uuid.cast("string")).alias("title"),
            F.lit("en").alias("language"),
            F.when(uuid % 17 != 0, text).alias("published_at"),
            F.concat(F.lit("s"), (uuid % 4).cast("string")).alias("source"),
            entities.alias("entities"),
        )
        page = F.struct(
            F.struct(F.count(F.lit(1)).cast("int").alias("returned")).alias("meta"),
            F.sort_array(F.collect_list(article)).alias("data"),
        )
        full = n.groupBy("ticker", "_page").agg(F.to_json(page).alias("json"))
        blank = n.select("ticker").distinct().select(
            "ticker", F.lit('{"meta":{"returned":0},"data":[]}').alias("json")
        )
        return full.select("ticker", "json").unionByName(blank)

    @cached_property
    def statements(self) -> DataFrame:
        """Fundamentals as labelled lines. Labels vary by ticker; ticker 2 has an empty best label."""
        number = F.substring("ticker", 1, 1).cast("int")
        choice = number % 3
        revenue = F.when(choice == 0, "Total Revenue").when(choice == 1, "Revenue").otherwise("Revenues")

        def line(statement: str, label: Column, value: str) -> Column:
            return F.struct(
                F.lit(statement).alias("statement"),
                label.alias("line_item"),
                F.col(value).alias("value"),
            )

        empty = F.struct(
            F.lit("income").alias("statement"),
            F.lit("Total Revenue").alias("line_item"),
            F.lit(None).cast("double").alias("value"),
        )
        lines = F.array(
            line("income", revenue, "revenue"),
            line("income", F.when(choice == 1, "Net Income Common Stockholders").otherwise("Net Income"), "net_income"),
            line("income", F.when(choice == 2, "EPS").otherwise("Basic EPS"), "eps"),
            line("balance", F.when(choice == 0, "Assets").otherwise("Total Assets"), "total_assets"),
            line("balance", F.lit("Total Liabilities"), "total_liabilities"),
            line("cashflow", F.when(choice == 1, "Operating Activities").otherwise("Operating Cash Flow"), "operating_cash_flow"),
        )
        lines = F.when(number == 2, F.concat(lines, F.array(empty))).otherwise(lines)
        return self.fund_d.select(
            "ticker", F.col("report_date").alias("quarter"), F.explode(lines).alias("_l")
        ).select("ticker", "_l.statement", "_l.line_item", "quarter", "_l.value")

    @cached_property
    def predictions(self) -> DataFrame:
        """Labelled hourly bars with invented predictions that depend on the row number."""
        rn = F.col(POS) + 1
        return positioned(trade_labels(self.bars_h)).select(
            "ticker",
            "timestamp",
            "close",
            "signal",
            "position_size",
            "timing_minutes",
            "profit",
            (F.col("close") * (1 + (rn * 37 % 11 - 5) / 1000)).alias("pred_a"),
            (F.col("close") * (1 + (rn * 17 % 7 - 3) / 1000)).alias("pred_b"),
            (rn * 7 % 3).cast("int").alias("pred_signal"),
            (rn * 13 % 160 - 20).cast("double").alias("raw_position"),
            (rn * 29 % 400 - 50 + 0.5).cast("double").alias("raw_timing"),
            ((rn * 5 % 41 - 10) / 7).alias("raw_profit"),
            ((rn % 50) / 100 + 0.5).alias("raw_confidence"),
        )

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        return materialize(df, label)


VIEWS = {
    "bars_h": """select event_type as ticker, date_trunc('hour', ts) as timestamp,
       arg_min(value, ts) as open, max(value) as high, min(value) as low,
       arg_max(value, ts) as close, cast(count(*) as double) as volume
from events group by 1, 2""",
    "news_h": """select event_id as uuid, ts as published_at, event_type as ticker,
       cast(json_extract_string(props, '$.k') as double)/50 - 1 as sentiment
from events""",
    "bars_d": """select o_orderpriority as ticker, o_orderdate as timestamp,
       arg_min(o_totalprice, o_orderkey) as open, max(o_totalprice) as high, min(o_totalprice) as low,
       arg_max(o_totalprice, o_orderkey) as close, cast(count(*) as double) as volume
from orders group by 1, 2""",
    "news_d": """select cast(l_orderkey * 8 + l_linenumber as bigint) as uuid, l_shipdate as published_at, o_orderpriority as ticker,
       l_discount*20-1 as sentiment
from lineitem join orders on l_orderkey = o_orderkey""",
    "fund_d": """select ticker, report_date, r as revenue, f*0.6e0 as net_income, r/n/5e4 as eps,
       (r-o)*0.5e0 as operating_cash_flow, r*4e0 as total_assets, o*5e0 as total_liabilities
from (select o_orderpriority as ticker, date_trunc('quarter', o_orderdate) as report_date,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) as r,
        cast(sum(case when o_orderstatus='F' then cast(o_totalprice as decimal(18,2)) else 0 end) as double) as f,
        cast(sum(case when o_orderstatus='O' then cast(o_totalprice as decimal(18,2)) else 0 end) as double) as o,
        cast(count(*) as double) as n
      from orders group by 1, 2)""",
    "fund_growth": """select *, net_income*1.25e0 as operating_income,
       (revenue - lag(revenue, 4) over w)/nullif(lag(revenue, 4) over w, 0) as revenue_growth_yoy,
       (net_income - lag(net_income, 4) over w)/nullif(lag(net_income, 4) over w, 0) as net_income_growth_yoy
from fund_d window w as (partition by ticker order by report_date)""",
    "prices_d": """select timestamp, ticker, close as price
from (select *, row_number() over (partition by ticker order by timestamp) as rn from bars_d)
where rn % 7 = 0""",
    "prices_h": """select timestamp, ticker, close as price from rows_h where rn % 7 = 0""",
    "fund_h": """select ticker, report_date, r as revenue, e*0.5e0 as net_income, r/n as eps,
       (r-e)*0.5e0 as operating_cash_flow, r*4e0 as total_assets, e*3e0 as total_liabilities
from (select event_type as ticker, date_trunc('week', ts) as report_date,
        cast(sum(cast(value as decimal(18,2))) as double) as r,
        cast(sum(case when user_id % 2 = 0 then cast(value as decimal(18,2)) else 0 end) as double) as e,
        cast(count(*) as double) as n
      from events group by 1, 2)""",
    "news_text": """select uuid, ticker, case when uuid % 17 <> 0 then published_at end as published_at,
       case when uuid % 19 = 0 or uuid % 23 = 0 then 0 else sentiment end as sentiment
from news_d""",
    "articles": """select uuid, ticker, published_at,
       case when uuid % 11 = 0 then (case when uuid % 7 = 0 then 9e0 end)
            when uuid % 13 = 0 then null else sentiment end as score,
       (uuid % 11 <> 0 or uuid % 7 = 0) as named
from news_h where uuid % 17 <> 0""",
    "rows_h": """select *, row_number() over (partition by ticker order by timestamp) as rn from bars_h""",
    "rows_d": """select *, row_number() over (partition by ticker order by timestamp) as rn from bars_d""",
}


def with_views(sql: str) -> str:
    """``sql`` with the views it uses put in front."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(body)
                used.append(name)

    visit(sql)
    if not used:
        return sql
    head = ",\n".join(f"{name} as ({VIEWS[name]})" for name in used)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {head},\n{body[5:]}"
    return f"with {head}\n{body}"
