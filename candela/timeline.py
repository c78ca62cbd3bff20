"""Row positions and bounded blocks of a per-ticker series.

A window over a whole ticker puts the ticker in one task. Here a series is cut into blocks of
about ``BLOCK_ROWS`` rows, and each block also receives the rows before it that its windows can
see. Windows then run over ``(ticker, block)``, so one ticker is spread over many tasks while
every row-count frame gives the same value as over the whole series.

Bars are counted per (ticker, time slice) first; that count table has one row per ticker and day,
so its running sum per ticker is small. A slice is never split between blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
BLOCK_ROWS = 8192

BLK, POS, TOTAL, KEEP = "_blk", "_pos", "_total", "_keep"
_SL, _OFF, _END, _OWN = "_sl", "_off", "_end", "_own"
LAYOUT = [BLK, POS, TOTAL, KEEP]


def slice_id(micros: Column, width_us: int) -> Column:
    """Floor division in whole numbers; also right before 1970."""
    return ((micros - F.pmod(micros, F.lit(width_us))) / F.lit(width_us)).cast("long")


def _div(c: Column, n: int) -> Column:
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("long")


def slice_index(df: DataFrame, width_us: int = DAY_US) -> DataFrame:
    """Per (ticker, slice): rows before the slice, rows up to its end, rows of the ticker."""
    counts = df.groupBy(
        "ticker", slice_id(F.unix_micros("timestamp"), width_us).alias(_SL)
    ).agg(F.count(F.lit(1)).alias("_cnt"))
    series = Window.partitionBy("ticker").orderBy(_SL)
    end = F.sum("_cnt").over(series.rowsBetween(Window.unboundedPreceding, 0))
    return counts.select(
        "ticker",
        _SL,
        (end - F.col("_cnt")).alias(_OFF),
        end.alias(_END),
        F.sum("_cnt").over(Window.partitionBy("ticker")).alias(TOTAL),
    )


def positioned(df: DataFrame, width_us: int = DAY_US) -> DataFrame:
    """Add the 0-based position of each bar in its ticker (``_pos``) and the ticker's bar count."""
    order = Window.partitionBy("ticker", _SL).orderBy("timestamp")
    return (
        df.withColumn(_SL, slice_id(F.unix_micros("timestamp"), width_us))
        .join(slice_index(df, width_us), ["ticker", _SL])
        .withColumn(POS, F.col(_OFF) + F.row_number().over(order) - 1)
        .drop(_SL, _OFF, _END)
    )


def block_window(*sub_order: str) -> WindowSpec:
    """Window over one block in time order."""
    return Window.partitionBy("ticker", BLK).orderBy(*sub_order, "timestamp")


def blocked(
    df: DataFrame,
    back: int = 0,
    ahead: int = 0,
    rows: int = BLOCK_ROWS,
    width_us: int = DAY_US,
    index_of: DataFrame | None = None,
) -> DataFrame:
    """Lay ``df`` out in blocks whose kept rows see ``back`` earlier and ``ahead`` later rows.

    Adds ``_blk``, ``_pos``, ``_total`` and ``_keep``; each input row has ``_keep`` true in exactly
    one block. With ``ahead`` the kept rows of a block are shifted back by ``ahead`` rows, so only
    earlier rows ever need to be copied. ``index_of`` names a cheaper frame with the same keys to
    count.
    """
    halo = back + ahead
    if halo > rows:
        raise ValueError("a block must be at least as long as the frames it serves")
    index = slice_index(df if index_of is None else index_of, width_us)
    own = _div(F.col(_OFF), rows)
    if halo:
        last = F.max(own).over(Window.partitionBy("ticker"))
        targets = F.array_distinct(
            F.array(own, _div(F.col(_END), rows), _div(F.col(_END) + (halo - 1), rows))
        )
        index = index.withColumn("_last", last).withColumn("_targets", targets)
        index = index.withColumn(BLK, F.explode("_targets")).where(F.col(BLK) <= F.col("_last"))
        index = index.drop("_last", "_targets")
    else:
        index = index.withColumn(BLK, own)
    index = index.withColumn(_OWN, F.col(BLK) == own)

    placed = df.withColumn(_SL, slice_id(F.unix_micros("timestamp"), width_us)).join(
        index, ["ticker", _SL]
    )
    order = block_window()
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = placed.select(
        "*",
        (F.min(_OFF).over(whole) + F.row_number().over(order) - 1).alias(POS),
        F.min(F.when(F.col(_OWN), F.col(_OFF))).over(whole).alias("_from"),
        F.max(F.when(F.col(_OWN), F.col(_END))).over(whole).alias("_to"),
    )
    owner = F.least(F.col(POS) + ahead, F.col(TOTAL) - 1)
    keep = F.coalesce((owner >= F.col("_from")) & (owner < F.col("_to")), F.lit(False))
    return placed.withColumn(KEEP, keep).drop(_SL, _OFF, _END, _OWN, "_from", "_to")


def kept(df: DataFrame) -> DataFrame:
    """Drop copied rows and the layout columns."""
    return df.where(F.col(KEEP)).drop(*LAYOUT)
