"""Series operators against pandas, with blocks far smaller than the series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candela.operators.fill import fill_series
from candela.operators.indicators import FAMILIES, INDICATOR_COLUMNS, indicators
from candela.operators.labels import latest_rows, lead_target, time_split, trade_labels
from candela.timeline import positioned

HOUR = 3_600_000_000


def by_key(df):
    pdf = df.toPandas()
    return pdf.sort_values(["ticker", "timestamp"]).reset_index(drop=True)


def expected_indicators(g):
    c = g["close"]
    out = pd.DataFrame(index=g.index)
    for n in (5, 10, 20, 50):
        out[f"sma_{n}"] = c.rolling(n).mean()
    out["ema_12"] = c.ewm(span=12).mean()
    out["ema_26"] = c.ewm(span=26).mean()
    out["macd"] = out.ema_12 - out.ema_26
    out["macd_signal"] = out.macd.ewm(span=9).mean()
    out["macd_histogram"] = out.macd - out.macd_signal
    d = c.diff().fillna(0)
    gain, loss = d.clip(lower=0).rolling(14).mean(), (-d).clip(lower=0).rolling(14).mean()
    out["rsi"] = 100 - 100 / (1 + gain / loss)
    out["bb_middle"] = c.rolling(20).mean()
    dev = c.rolling(20).std()
    out["bb_upper"], out["bb_lower"] = out.bb_middle + 2 * dev, out.bb_middle - 2 * dev
    out["bb_width"] = out.bb_upper - out.bb_lower
    out["bb_position"] = (c - out.bb_lower) / out.bb_width
    for name, k in (("price_change", 1), ("price_change_5d", 5), ("price_change_10d", 10)):
        out[name] = c.pct_change(k)
    out["volume_sma"] = g.volume.rolling(20).mean()
    out["volume_ratio"] = g.volume / out.volume_sma
    out["volatility_5d"], out["volatility_20d"] = c.rolling(5).std(), c.rolling(20).std()
    out["hl_spread"] = (g.high - g.low) / c
    out["oc_spread"] = (c - g.open) / g.open
    return out


@pytest.mark.parametrize("rows", [704, 8192])
def test_all_indicators_match_pandas(bars, bars_pdf, rows):
    got = by_key(indicators(bars, rows=rows, width_us=HOUR))
    src = bars_pdf.sort_values(["ticker", "timestamp"]).reset_index(drop=True)
    want = src.groupby("ticker", group_keys=False)[list(src.columns)].apply(expected_indicators)
    assert len(got) == len(src)
    assert list(got.columns) == list(src.columns) + INDICATOR_COLUMNS
    for c in INDICATOR_COLUMNS:
        np.testing.assert_allclose(got[c], want[c].sort_index(), rtol=1e-8, atol=1e-9, err_msg=c)


@pytest.mark.parametrize("family", FAMILIES)
def test_blocks_do_not_change_a_family(bars, family):
    small = by_key(indicators(bars, [family], rows=704, width_us=HOUR))
    large = by_key(indicators(bars, [family]))
    pd.testing.assert_frame_equal(small, large, rtol=1e-10)


def test_constant_and_rising_prices(spark):
    rows = [(f"2024-01-01 00:{i:02d}:00", t, 5.0, 5.0, 5.0, v, 1.0)
            for i in range(30) for t, v in (("FLAT", 5.0), ("UP", 5.0 + i))]
    df = spark.createDataFrame(rows, "timestamp string, ticker string, open double, high double, "
                               "low double, close double, volume double")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    got = by_key(indicators(df, ["rsi", "bollinger"]))
    flat, up = got[got.ticker == "FLAT"], got[got.ticker == "UP"]
    assert flat.rsi.isna().all() and flat.bb_position.isna().all()
    assert up.rsi.iloc[:13].isna().all() and (up.rsi.iloc[13:] == 100).all()


def test_padded_percent_change(spark):
    df = spark.sql("""select timestamp'2024-01-01' + make_dt_interval(0,0,i) as timestamp, 'X' as ticker,
        1d as open, 1d as high, 1d as low, c as close, 1d as volume
        from values (0, 1d), (1, null), (2, 2d) as t(i, c)""")
    got = by_key(indicators(df, ["pct_change"]))["price_change"].tolist()
    assert np.isnan(got[0]) and got[1:] == [0.0, 1.0]


@pytest.mark.parametrize("rows", [704, 8192])
def test_exponential_means_with_missing_closes(bars, bars_pdf, rows):
    gap = F.pmod(F.unix_micros("timestamp") / 60_000_000, F.lit(13)) < 2
    holes = bars.withColumn("close", F.when(~gap, F.col("close")))
    got = by_key(indicators(holes, ["ema", "macd"], rows=rows, width_us=HOUR))
    src = by_key(holes)
    assert 50 < src.close.isna().sum() < len(src)
    for _, g in src.groupby("ticker"):
        c = g.close
        fast, slow = c.ewm(span=12).mean(), c.ewm(span=26).mean()
        signal = (fast - slow).ewm(span=9).mean()
        for name, want in (("ema_12", fast), ("ema_26", slow), ("macd_signal", signal)):
            np.testing.assert_allclose(got.loc[g.index, name], want, rtol=1e-9, atol=1e-10, err_msg=name)


def test_ewm_golden(spark):
    from candela.operators.indicators import _ewm
    from candela.timeline import blocked

    df = spark.sql("""select timestamp'2024-01-01' + make_dt_interval(0,0,i) as timestamp, 'X' as ticker,
        x from values (0, 10d), (1, 11d), (2, 12d), (3, 11d), (4, 13d) as t(i, x)""")
    out = blocked(df).withColumn("_sub", F.lit(0))
    for columns in _ewm("x", 3, "e", 0).values():
        w = "partition by ticker, _blk order by timestamp"
        out = out.selectExpr("*", *(f"{text.format(w=w)} as {c}" for c, text in columns.items()))
    want = [10, 10.666666666666666, 11.428571428571429, 11.2, 12.129032258064516]
    np.testing.assert_allclose(by_key(out)["e"], want, rtol=1e-14)


def loop_labels(g, steps, threshold, by_time):
    close, ts = g.close.to_numpy(), g.timestamp.to_numpy()
    out = []
    for i in range(len(close)):
        best, when, sig = 0.0, 0, 1
        for k in range(i + 1, min(i + steps, len(close) - 1) + 1):
            m = k - i
            if by_time:
                m = int((ts[k] - ts[i]) / np.timedelta64(1, "s") / 60)
                if m > steps:
                    break
            r = (close[k] - close[i]) / close[i]
            if abs(r) > best and abs(r) >= threshold:
                best, when, sig = abs(r), m, 2 if r > 0 else 0
        size = int(100 * min(best / 0.01, 1.0)) if sig != 1 else 0
        out.append((sig, size, when, best * 100))
    return pd.DataFrame(out, columns=["signal", "position_size", "timing_minutes", "profit"], index=g.index)


@pytest.mark.parametrize("steps,by_time", [(30, False), (240, False), (3, False), (30, True), (200, True)])
@pytest.mark.parametrize("rows", [256, 8192])
def test_trade_labels_match_loop(bars, bars_pdf, steps, by_time, rows):
    got = by_key(trade_labels(bars, max_holding=steps, min_profit=0.004, by_time=by_time,
                              rows=rows, width_us=HOUR))
    src = bars_pdf.sort_values(["ticker", "timestamp"]).reset_index(drop=True)
    want = src.groupby("ticker", group_keys=False)[list(src.columns)].apply(
        loop_labels, steps, 0.004, by_time).sort_index()
    for c in ("signal", "position_size", "timing_minutes"):
        assert (got[c] == want[c]).all(), c
    np.testing.assert_allclose(got.profit, want.profit, rtol=1e-12)


@pytest.mark.parametrize("per_minute,steps", [(100, 5), (7, 60), (100, 700)])
def test_labels_of_dense_bars_match_loop(spark, per_minute, steps):
    """Many bars a minute, with pauses; either the time or the row limit ends a window."""
    rng = np.random.default_rng(per_minute + steps)
    gaps = rng.integers(1, 2 * 60_000_000 // per_minute, 1500)
    gaps[rng.integers(0, 1500, 12)] += steps * 60_000_000 * rng.integers(1, 4, 12)
    src = pd.DataFrame({"timestamp": pd.Timestamp("2024-03-01") + pd.to_timedelta(gaps.cumsum(), unit="us"), "ticker": "D",
                        "close": np.round(100 + rng.normal(0, 0.2, 1500).cumsum(), 2)})
    got = by_key(trade_labels(spark.createDataFrame(src), max_holding=steps, min_profit=0.001, by_time=True))
    want = loop_labels(src, steps, 0.001, True)
    for c in ("signal", "position_size", "timing_minutes"):
        assert (got[c].to_numpy() == want[c].to_numpy()).all(), c
    np.testing.assert_allclose(got.profit, want.profit, rtol=1e-12)


def test_label_micro_case(spark):
    df = spark.sql("""select timestamp'2024-01-01' + make_dt_interval(0,0,i) as timestamp, 'X' as ticker,
        c as close from values (0, 100d), (1, 101d), (2, 101d), (3, 98d) as t(i, c)""")
    got = by_key(trade_labels(df, max_holding=3))
    first, last = got.iloc[0], got.iloc[3]
    assert (first.signal, first.timing_minutes, first.position_size) == (0, 3, 100)
    assert abs(first.profit - 2.0) < 1e-12
    assert (last.signal, last.timing_minutes, last.position_size, last.profit) == (1, 0, 0, 0.0)


@pytest.mark.parametrize("by_time", [False, True])
def test_labels_pass_over_missing_closes(spark, by_time):
    df = spark.sql("""select timestamp'2024-01-01' + make_dt_interval(0,0,i) as timestamp, 'X' as ticker,
        c as close from values (0, 100d), (1, null), (2, 90d), (3, 95d), (4, null) as t(i, c)""")
    got = by_key(trade_labels(df, max_holding=3, by_time=by_time))
    assert got.signal.tolist() == [0, 1, 2, 1, 1] and got.timing_minutes.tolist() == [2, 0, 1, 0, 0]
    assert abs(got.profit[0] - 10) < 1e-12


@pytest.mark.parametrize("horizon", [1, 7])
def test_lead_target(bars, bars_pdf, horizon):
    got = by_key(lead_target(bars, horizon=horizon, drop_missing=False, rows=100, width_us=HOUR))
    src = bars_pdf.sort_values(["ticker", "timestamp"]).reset_index(drop=True)
    want = src.groupby("ticker")["close"].shift(-horizon)
    np.testing.assert_array_equal(got.target, want)
    dropped = lead_target(bars, horizon=horizon, rows=100, width_us=HOUR).count()
    assert dropped == want.notna().sum()
    assert lead_target(bars, "nope").count() == 0


@pytest.mark.parametrize("mode", ["reference", "causal", "forward"])
def test_fill(spark, bars, bars_pdf, mode):
    src = bars_pdf.sort_values(["ticker", "timestamp"]).reset_index(drop=True)
    holes = src["close"].where((src.index % 97 == 3) | (src.ticker == "BBB") & (src.index > 1000))
    frame = src[["timestamp", "ticker"]].assign(v=holes)
    df = spark.createDataFrame(frame, "timestamp timestamp, ticker string, v double")
    df = df.withColumn("v", F.nanvl("v", F.lit(None)))
    got = by_key(fill_series(df, ["v"], mode, rows=64, width_us=HOUR))
    g = frame.groupby("ticker")["v"]
    want = g.ffill()
    if mode == "reference":
        want = want.groupby(frame.ticker).bfill()
    if mode != "forward":
        want = want.fillna(0)
    np.testing.assert_array_equal(got.v, want)


def test_positions_split_and_last(bars, bars_pdf):
    got = by_key(positioned(bars, width_us=HOUR))
    assert (got["_pos"] == got.groupby("ticker").cumcount()).all()
    split = by_key(time_split(bars, 0.2))
    for _, g in split.groupby("ticker"):
        assert (~g.is_validation).sum() == int(len(g) * 0.8)
        assert g.is_validation.is_monotonic_increasing
    pooled = time_split(bars, 0.2, pooled=True).toPandas()
    assert pooled[pooled.is_validation].timestamp.min() > pooled[~pooled.is_validation].timestamp.max()
    last = by_key(latest_rows(bars))
    want = bars_pdf.groupby("ticker").timestamp.max()
    assert dict(zip(last.ticker, last.timestamp)) == want.to_dict()
