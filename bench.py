"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Bars are cut per minute and per day from the test tables and stored first, as a user's bars would
be. Each query runs once to warm up and is then timed over a full pass of its result.
"""

import json
import os
import time

from candela.operators.asof import align_fundamentals
from candela.operators.indicators import indicators
from candela.operators.labels import trade_labels
from candela.operators.quantiles import exact_quantiles
from candela.operators.sentiment import sentiment_window
from candela.plans.feature_frame import feature_frame
from candela.plans.fixtures import Tables
from candela.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    t = Tables(spark, folder)
    minutes = t.stored(t.event_bars("minute"), "bars-minute")
    daily = t.stored(t.bars_d, "bars-daily")
    news = t.stored(t.news_h, "news")
    queries = {
        "sma": lambda: indicators(minutes, ["sma"]),
        "ema": lambda: indicators(minutes, ["ema"]),
        "indicators_all": lambda: indicators(minutes),
        "sentiment_24h": lambda: sentiment_window(minutes, news),
        "asof_fundamentals": lambda: align_fundamentals(daily, t.fund_d),
        "trade_labels": lambda: trade_labels(minutes),
        "quantiles": lambda: exact_quantiles(minutes, ["close", "volume"], [0.25, 0.5, 0.75]),
        "feature_frame": lambda: feature_frame(minutes, news, t.prices_h, t.fund_h),
    }
    seconds = {}
    for name, build in queries.items():
        for _ in range(2):
            start = time.time()
            build().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
    spark.stop()
    line = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
