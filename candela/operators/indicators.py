"""Technical indicators of daily or intraday bars.

Each family lists its columns as SQL expressions in levels; a level reads only columns of earlier
ones. The levels of all wanted families are merged, so 24 columns cost one shuffle and a handful of
window passes, and a rolling value two families need is computed once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from candela.timeline import BLK, KEEP, POS, blocked

SMA_WINDOWS = (5, 10, 20, 50)
EMA_SPANS = (12, 26)
SIGNAL_SPAN = 9
RSI_WINDOW = 14
BAND_WINDOW = 20
CHANGE_STEPS = {"price_change": 1, "price_change_5d": 5, "price_change_10d": 10}

# Rows of history behind a block. The decayed weights of spans 26 and 9 fall below 1e-23 there.
EWM_HISTORY = 704
_EWM_ROWS = 1024
_SUB = "_sub"


@dataclass(frozen=True)
class Family:
    history: int
    outputs: list[str]
    levels: dict[int, dict[str, str]] = field(default_factory=dict)


def _frame(n: int) -> str:
    return f"({{w}} rows between {n - 1} preceding and current row)"


_SO_FAR = "({w} rows between unbounded preceding and current row)"


def _rolling(agg: str, column: str, n: int, out: str) -> dict[int, dict[str, str]]:
    """``out`` is NULL unless the last ``n`` rows exist and all hold a value.

    Missing values are counted along the way, which is cheaper than counting inside each frame.
    """
    gaps, before = f"_gaps_{column}", f"_gaps_{column}_{n}"
    value = f"_{agg}_{column}_{n}"
    return {
        0: {gaps: f"count_if({column} is null) over {_SO_FAR}"},
        2: {
            before: f"lag({gaps}, {n}) over ({{w}})",
            value: f"{agg}({column}) over {_frame(n)}",
        },
        3: {out: f"case when {POS} >= {n - 1} and {gaps} = coalesce({before}, 0) then {value} end"},
    }


def _ewm(column: str, span: int, out: str, level: int) -> dict[int, dict[str, str]]:
    """Bias-adjusted exponential mean: ``sum r^k x[t-k] / sum r^k`` with ``r = 1 - 2/(span+1)``.

    Both sums run over the rows that hold a value, so a row without one keeps the mean before it.
    The mean is NULL before the first value and after ``EWM_HISTORY`` rows without any.

    A running sum of ``x * r^-i`` would overflow on a long series, so ``i`` restarts every 1024
    rows and the sum of the previous stretch is carried in with weight ``r^(i+1)``. Stretches
    further back weigh less than 1e-34.
    """
    r = f"{1 - 2 / (span + 1)!r}D"
    i = f"({POS} % {_EWM_ROWS})"
    stretch = (
        f"(partition by ticker, {BLK}, {_SUB} order by timestamp"
        " rows between unbounded preceding and current row)"
    )
    sums = {f"_run_{out}": column, f"_norm_{out}": f"if({column} is null, null, 1D)"}
    known = f"_known_{out}"

    def total(run: str) -> str:
        return f"({run} + power({r}, {i} + 1) * coalesce(_carry{run}, 0D))"

    return {
        level: {
            run: f"power({r}, {i}) * coalesce(sum({value} * power({r}, -{i})) over {stretch}, 0D)"
            for run, value in sums.items()
        },
        level + 1: {
            known: f"max(if({column} is null, null, {POS})) over {_SO_FAR}",
            **{
                f"_carry{run}": f"last_value(case when {i} = {_EWM_ROWS - 1} then {run} end) ignore nulls"
                " over ({w} rows between unbounded preceding and 1 preceding)"
                for run in sums
            },
        },
        level + 2: {
            out: f"case when {POS} - {known} < {EWM_HISTORY}"
            f" then try_divide({total(f'_run_{out}')}, {total(f'_norm_{out}')}) end"
        },
    }


def _merge(*parts: dict[int, dict[str, str]]) -> dict[int, dict[str, str]]:
    out: dict[int, dict[str, str]] = {}
    for part in parts:
        for level, columns in part.items():
            out.setdefault(level, {}).update(columns)
    return out


def _sma() -> Family:
    parts = [_rolling("avg", "close", n, f"sma_{n}") for n in SMA_WINDOWS]
    return Family(max(SMA_WINDOWS), [f"sma_{n}" for n in SMA_WINDOWS], _merge(*parts))


def _ema() -> Family:
    # The running sums belong to level 1, so that their carry shares the pass of level 2.
    parts = [_ewm("close", n, f"ema_{n}", 1) for n in EMA_SPANS]
    return Family(EWM_HISTORY, [f"ema_{n}" for n in EMA_SPANS], _merge(*parts))


def _macd() -> Family:
    fast, slow = EMA_SPANS
    signal = _ewm("macd", SIGNAL_SPAN, "macd_signal", 5)
    levels = _merge({4: {"macd": f"ema_{fast} - ema_{slow}"}}, signal)
    levels[8] = {"macd_histogram": "macd - macd_signal"}
    return Family(EWM_HISTORY, ["macd", "macd_signal", "macd_histogram"], levels)


def _rsi() -> Family:
    """RSI from plain rolling means; the first bar counts as no change."""
    n = RSI_WINDOW
    levels = {
        0: {"_delta": "coalesce(close - lag(close) over ({w}), 0D)"},
        1: {"_rise": "greatest(_delta, 0D)", "_fall": "greatest(-_delta, 0D)"},
        2: {
            "_gain": f"avg(_rise) over {_frame(n)}",
            "_loss": f"avg(_fall) over {_frame(n)}",
        },
        3: {
            "rsi": f"""case when {POS} < {n - 1} then null
                when _loss > 0 then 100 - 100 / (1 + _gain / _loss)
                when _gain > 0 then 100D end"""
        },
    }
    return Family(n + 1, ["rsi"], levels)


def _bollinger() -> Family:
    n = BAND_WINDOW
    levels = _merge(
        _rolling("avg", "close", n, "bb_middle"), _rolling("stddev_samp", "close", n, "_band")
    )
    levels[4] = {"bb_upper": "bb_middle + 2 * _band", "bb_lower": "bb_middle - 2 * _band"}
    levels[5] = {
        "bb_width": "bb_upper - bb_lower",
        "bb_position": "try_divide(close - bb_lower, bb_upper - bb_lower)",
    }
    outputs = ["bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_position"]
    return Family(n, outputs, levels)


def _pct_change() -> Family:
    """Change over 1, 5 and 10 rows; a missing close counts as the last known one."""
    levels = {
        0: {"_known": f"last_value(close) ignore nulls over {_SO_FAR}"},
        2: {f"_known_{k}": f"lag(_known, {k}) over ({{w}})" for k in CHANGE_STEPS.values()},
        3: {
            name: f"try_divide(_known - _known_{k}, _known_{k})" for name, k in CHANGE_STEPS.items()
        },
    }
    return Family(max(CHANGE_STEPS.values()), list(CHANGE_STEPS), levels)


def _volume() -> Family:
    levels = _rolling("avg", "volume", BAND_WINDOW, "volume_sma")
    levels[4] = {"volume_ratio": "try_divide(volume, volume_sma)"}
    return Family(BAND_WINDOW, ["volume_sma", "volume_ratio"], levels)


def _volatility() -> Family:
    parts = [_rolling("stddev_samp", "close", n, f"volatility_{n}d") for n in (5, 20)]
    return Family(20, ["volatility_5d", "volatility_20d"], _merge(*parts))


def _spreads() -> Family:
    levels = {
        3: {
            "hl_spread": "try_divide(high - low, close)",
            "oc_spread": "try_divide(close - open, open)",
        }
    }
    return Family(0, ["hl_spread", "oc_spread"], levels)


_FAMILIES: dict[str, Family] = {
    "sma": _sma(),
    "ema": _ema(),
    "macd": _macd(),
    "rsi": _rsi(),
    "bollinger": _bollinger(),
    "pct_change": _pct_change(),
    "volume": _volume(),
    "volatility": _volatility(),
    "spreads": _spreads(),
}
FAMILIES = list(_FAMILIES)
INDICATOR_COLUMNS = [c for f in _FAMILIES.values() for c in f.outputs]


def history_rows(names: list[str]) -> int:
    return max(_FAMILIES[n].history for n in names)


def sort_order(names: list[str]) -> str:
    """Sort columns of the block windows; exponential means also sort by stretch."""
    return f"{_SUB}, timestamp" if {"ema", "macd"} & set(names) else "timestamp"


def add_families(
    df: DataFrame, names: list[str], extra: dict[str, str] | None = None
) -> DataFrame:
    """Add the named families to blocked bars.

    ``extra`` holds more window expressions over the input columns, with ``{w}`` for the window;
    they are computed in the same pass.
    """
    chosen = [f for n, f in _FAMILIES.items() if n in names or (n == "ema" and "macd" in names)]
    levels = _merge(*(f.levels for f in chosen), {0: extra or {}})
    if _SUB in sort_order(names):
        df = df.selectExpr("*", f"cast(floor({POS} / {_EWM_ROWS}) as bigint) as {_SUB}")
    w = f"partition by ticker, {BLK} order by {sort_order(names)}"
    for level in sorted(levels):
        columns = [f"{text.format(w=w)} as {name}" for name, text in levels[level].items()]
        if columns:
            df = df.selectExpr("*", *columns)
    return df


def indicators(bars: DataFrame, names: list[str] | None = None, **layout: int) -> DataFrame:
    """Bars plus the columns of the named families (all of them by default)."""
    names = FAMILIES if names is None else names
    wanted = [c for n, f in _FAMILIES.items() if n in names for c in f.outputs]
    df = add_families(blocked(bars, back=history_rows(names), **layout), names)
    return df.where(KEEP).select(*bars.columns, *wanted)
