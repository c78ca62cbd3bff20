"""Future-looking columns: lead target, best forward trade, time-ordered split, last bar."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.timeline import BLK, KEEP, POS, TOTAL, blocked, block_window, positioned, slice_id

SELL, HOLD, BUY = 0, 1, 2
MAX_HOLDING = 240
MIN_PROFIT = 0.001
MAX_POSITION = 100
FULL_CONFIDENCE_RETURN = 0.01

_MINUTE_US = 60_000_000


def lead_target(
    bars: DataFrame,
    column: str = "close",
    horizon: int = 1,
    drop_missing: bool = True,
    **layout: int,
) -> DataFrame:
    """Add ``target``, the value of ``column`` ``horizon`` rows later; unknown columns give NULL."""
    if column not in bars.columns:
        out = bars.withColumn("target", F.lit(None).cast("double"))
    else:
        placed = blocked(bars, ahead=horizon, **layout)
        out = (
            placed.withColumn("target", F.lead(column, horizon).over(block_window()))
            .where(F.col(KEEP))
            .select(*bars.columns, "target")
        )
    return out.where(F.col("target").isNotNull()) if drop_missing else out


def _priced(price: str, pos: Column) -> Column:
    """The bar as (price, pos, at); NULL without a price, so that no extreme picks it."""
    at = F.unix_micros("timestamp").alias("at")
    return F.when(F.col(price).isNotNull(), F.struct(F.col(price).alias("price"), pos.alias("pos"), at))


def _best_high(price: str) -> Column:
    return F.max(_priced(price, -F.col(POS)))


def _best_low(price: str) -> Column:
    return F.min(_priced(price, F.col(POS)))


def _extremes_by_rows(df: DataFrame, price: str, steps: int) -> DataFrame:
    """Highest and lowest price of the next ``steps`` rows with the earliest row reaching them.

    Rows are cut into groups of ``steps``. The next ``steps`` rows are the rest of one group plus
    the start of the following one, so running extremes from both ends of each group answer every
    row at constant cost, whatever ``steps`` is.
    """
    group = F.floor(F.col(POS) / steps)
    df = df.withColumn("_g", group)
    high, low = _best_high(price), _best_low(price)
    cells = Window.partitionBy("ticker", BLK, "_g")
    down = cells.orderBy(F.col("timestamp").desc()).rowsBetween(Window.unboundedPreceding, 0)
    up = cells.orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({"_rest_hi": high.over(down), "_rest_lo": low.over(down)})
    df = df.withColumns({"_head_hi": high.over(up), "_head_lo": low.over(up)})

    w = block_window("_g")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def future(end: str, best: Callable) -> Column:
        # Near the end of the ticker the last bar closes the window.
        to_end = F.when(F.last("_g").over(whole) > F.lead("_g", 1).over(w),
                        F.last(f"_head_{end}").over(whole))
        head = F.lead(f"_head_{end}", steps).over(w)
        head = F.when(F.col(POS) + steps < F.col(TOTAL), head).otherwise(to_end)
        return best(F.lead(f"_rest_{end}", 1).over(w), head)

    df = df.withColumns({"_hi": future("hi", F.greatest), "_lo": future("lo", F.least)})
    return df.drop("_g", "_rest_hi", "_rest_lo", "_head_hi", "_head_lo")


def _extremes_by_time(df: DataFrame, price: str, minutes: int) -> DataFrame:
    """As :func:`_extremes_by_rows`, also ending ``minutes`` whole minutes after the bar.

    Where the row limit is reached first the row result stands. Otherwise time is cut into cells as long as the
    window, which is then the rest of a bar's cell and the head of the next one. Rest and head are running extremes;
    the head's end is found by reading bars and window ends in one order of time. Each bar is handled twice, however
    many bars its window holds.
    """
    df = _extremes_by_rows(df, price, minutes)
    span = (minutes + 1) * _MINUTE_US - 1
    us, cell = F.col("_us"), F.col("_cell")
    df = df.withColumn("_us", F.unix_micros("timestamp")).withColumn("_cell", slice_id(us, span))
    high, low = _best_high(price), _best_low(price)
    cells = Window.partitionBy("ticker", BLK, "_cell")
    down = cells.orderBy(us.desc()).rowsBetween(Window.unboundedPreceding, 0)
    up = cells.orderBy("_us").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_rest", F.struct(cell.alias("cell"), high.over(down).alias("hi"), low.over(down).alias("lo")))
    df = df.withColumn("_head", F.struct(cell.alias("cell"), high.over(up).alias("hi"), low.over(up).alias("lo")))
    series = Window.partitionBy("ticker", BLK).orderBy("_us")
    df = df.withColumns({"_next": F.lead("_rest", 1).over(series), "_limit": F.lead("_us", minutes).over(series)})

    # A window's end comes after a bar of the same time.
    ends = F.explode(F.array(F.struct(us.alias("at"), F.lit(0).alias("end")), F.struct((us + span).alias("at"), F.lit(1).alias("end"))))
    both = df.withColumn("_e", ends)
    so_far = Window.partitionBy("ticker", BLK).orderBy("_e.at", "_e.end").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("_e.end") == 0, F.col("_head")), ignorenulls=True).over(so_far)
    df = both.withColumn("_last", last).where("_e.end = 1")

    def extreme(end: str, best: Callable) -> Column:
        rest = F.when(F.col("_next.cell") == cell, F.col(f"_next.{end}"))
        head = F.when(F.col("_last.cell") == cell + 1, F.col(f"_last.{end}"))
        by_rows = F.coalesce(F.col("_limit") - us <= span, F.lit(False))
        return F.when(by_rows, F.col(f"_{end}")).otherwise(best(rest, head))

    df = df.withColumns({"_hi": extreme("hi", F.greatest), "_lo": extreme("lo", F.least)})
    return df.drop("_us", "_cell", "_rest", "_head", "_next", "_limit", "_e", "_last")


def trade_labels(
    bars: DataFrame,
    price: str = "close",
    max_holding: int = MAX_HOLDING,
    min_profit: float = MIN_PROFIT,
    max_position: int = MAX_POSITION,
    by_time: bool = False,
    **layout: int,
) -> DataFrame:
    """Label each bar with the best trade of the next ``max_holding`` rows (or minutes).

    The largest absolute return wins, the earliest on ties; below ``min_profit`` the label is HOLD.
    Bars without a price are never an exit, and are themselves HOLD; they still count as steps.
    """
    df = blocked(bars, ahead=max_holding, **layout)
    extremes = _extremes_by_time if by_time else _extremes_by_rows
    df = extremes(df, price, max_holding)
    now = F.col(price)
    hi, lo = F.col("_hi"), F.col("_lo")
    df = df.withColumns(
        {
            "_up": F.coalesce(F.try_divide(hi["price"] - now, now), F.lit(0.0)),
            "_dn": F.coalesce(F.try_divide(now - lo["price"], now), F.lit(0.0)),
            "_up_steps": -hi["pos"] - F.col(POS),
            "_dn_steps": lo["pos"] - F.col(POS),
        }
    )
    up, dn = F.col("_up"), F.col("_dn")
    rises = (up > dn) | ((up == dn) & (F.col("_up_steps") < F.col("_dn_steps")))
    df = df.withColumns(
        {
            "_best": F.greatest(up, dn),
            "_rises": rises,
            "_steps": F.when(rises, F.col("_up_steps")).otherwise(F.col("_dn_steps")),
        }
    )
    best = F.col("_best")
    trade = (best > 0) & (best >= min_profit)
    size = (F.least(best / FULL_CONFIDENCE_RETURN, F.lit(1.0)) * max_position).cast("int")
    minutes = F.col("_steps")
    if by_time:
        exit_us = F.when(F.col("_rises"), hi["at"]).otherwise(lo["at"])
        minutes = F.floor((exit_us - F.unix_micros("timestamp")) / _MINUTE_US)
    return df.where(F.col(KEEP)).select(
        *bars.columns,
        F.when(trade & F.col("_rises"), BUY).when(trade, SELL).otherwise(HOLD).alias("signal"),
        F.when(trade, size).otherwise(0).alias("position_size"),
        F.when(trade, minutes).otherwise(0).cast("int").alias("timing_minutes"),
        F.when(trade, best * 100).otherwise(0.0).alias("profit"),
    )


def _cell_of_rank(rows: DataFrame, cell: str, rank: Column) -> DataFrame:
    """One row: the cell that holds the row of ``rank``, and its rank there. Cells are counted and put in order, not rows."""
    order = Window.partitionBy(F.lit(1)).orderBy("_cell")
    counts = rows.groupBy(F.expr(cell).alias("_cell")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_upto", F.sum("_n").over(order))
    inside = (rank - F.col("_upto") + F.col("_n")).alias("rank")
    return counts.where(F.col("_upto") > rank).agg(F.min(F.struct(F.col("_cell").alias("cell"), inside)).alias("_found"))


def pooled_cut(df: DataFrame, share: float) -> DataFrame:
    """One row with ``_found.cell``, the (timestamp, ticker) of the row at ``int(n * share)`` over all tickers in time order.

    Days, minutes of one day and bars of one minute are counted in turn; NULL if there is no such row.
    """
    keys = df.select("timestamp", "ticker")
    rows = keys.agg(F.floor(F.count(F.lit(1)) * F.lit(share)).alias("rank"))
    day = _cell_of_rank(keys, "date_trunc('day', timestamp)", rows.scalar())
    found = day.scalar()
    keys = keys.where(F.date_trunc("day", "timestamp") == found["cell"])
    found = _cell_of_rank(keys, "date_trunc('minute', timestamp)", found["rank"]).scalar()
    keys = keys.where(F.date_trunc("minute", "timestamp") == found["cell"])
    return _cell_of_rank(keys, "struct(timestamp, ticker)", found["rank"])


def time_split(
    df: DataFrame, validation: float = 0.2, pooled: bool = False, **layout: int
) -> DataFrame:
    """Add ``is_validation``: the last share of each ticker's rows, or of the rows of all tickers in time order.

    ``pooled`` cuts all tickers at one row, so no training row is later than a validation row; bars of one
    time go by ticker.
    """
    if not pooled:
        cut = F.floor(F.col(TOTAL) * (1 - validation))
        return (
            positioned(df, **layout)
            .withColumn("is_validation", F.col(POS) >= cut)
            .drop(POS, TOTAL)
        )
    cut = pooled_cut(df, 1 - validation).scalar()["cell"]
    return df.withColumn("is_validation", F.coalesce(F.struct("timestamp", "ticker") >= cut, F.lit(False)))


def latest_rows(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The last row of each ticker, combined on the map side."""
    row = F.struct(*df.columns)
    return df.groupBy("ticker").agg(F.max_by(row, ts).alias("_r")).select("_r.*")
