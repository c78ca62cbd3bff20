"""Wall time of the same results in one pandas process, with the usual row loops."""

import sys
import time
from pathlib import Path

import numpy as np
import pandas as pd

sys.path[:0] = [str(p) for p in Path(__file__).resolve().parents[:2]]

from test_series import expected_indicators, loop_labels  # noqa: E402

FOLDER = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
SHARE = 0.05  # the loops are timed on this share of the bars and scaled up


def main():
    events = pd.read_parquet(f"{FOLDER}/events.parquet").sort_values("ts")
    events["timestamp"] = events.ts.dt.floor("min")
    keys = ["event_type", "timestamp"]
    bars = events.groupby(keys).value.agg(["first", "max", "min", "last", "count"]).reset_index()
    bars.columns = ["ticker", "timestamp", "open", "high", "low", "close", "volume"]
    news = events[events.event_id % 3 == 0]
    stamps = news.ts.to_numpy()
    score = news.props.str.extract(r"(\d+)")[0].astype(float).to_numpy() / 50 - 1

    start = time.time()
    for _, g in bars.groupby("ticker"):
        expected_indicators(g)
    print("indicators_all", round(time.time() - start, 2))

    part = bars.sample(frac=SHARE, random_state=1)
    start = time.time()
    for ts in part.timestamp.to_numpy():
        s = pd.Series(score[(stamps >= ts - np.timedelta64(24, "h")) & (stamps < ts)])
        s.mean(), s.std(), s.max(), s.min()
    print("sentiment_24h (scaled)", round((time.time() - start) / SHARE, 2))

    one = bars[bars.ticker == bars.ticker.iloc[0]]
    one = one.head(int(len(bars) * SHARE))
    start = time.time()
    loop_labels(one, 240, 0.001, False)
    print("trade_labels (scaled)", round((time.time() - start) * len(bars) / len(one), 2))


if __name__ == "__main__":
    main()
