"""Fill missing values along each ticker: last known value, then first known value, then zero."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.session import materialize
from candela.timeline import BLK, KEEP, blocked

MODES = ("reference", "causal", "forward", "none")


def fill_within_blocks(
    df: DataFrame, output: list[str], columns: list[str], sort: str = "timestamp"
) -> DataFrame:
    """Carry ``columns`` forward inside each block and keep the rows the block owns.

    Values are taken from kept rows only: a copied row may have seen too little history.
    """
    w = f"partition by ticker, {BLK} order by {sort} rows between unbounded preceding and current row"

    def carried(c: str) -> str:
        return f"last_value(case when {KEEP} then {c} end) ignore nulls over ({w}) as {c}"

    filled = [carried(c) if c in columns else c for c in [*output, KEEP]]
    needed = dict.fromkeys([*output, "ticker", *sort.split(", "), BLK, KEEP])
    return df.select(*needed).selectExpr(*filled).where(KEEP).select(*output)


def fill_across_blocks(df: DataFrame, columns: list[str], mode: str, instead: tuple[str, str, DataFrame] | None = None) -> DataFrame:
    """Finish the fill from one row per block.

    The last row of a block already holds the block's last known values. The first known value of a
    ticker is what a backward fill puts into every row before it. Both are worked out on the table of blocks, so
    the frame is joined once, on ticker and block. ``df`` is read twice and should be a stored table.

    ``instead`` (column, other, tickers): for tickers that are not in the last, the column is the filled other one.
    """
    if mode not in MODES:
        raise ValueError(f"fill mode must be one of {MODES}")
    if mode == "none" or not columns:
        return df
    back = columns if mode == "reference" else []
    ends = df.groupBy("ticker", BLK).agg(
        F.max_by(F.struct(*columns), "timestamp").alias("_end"),
        *(F.expr(f"min_by({c}, case when {c} is not null then timestamp end)").alias(f"_f_{c}") for c in back),
    )
    series = f"partition by ticker order by {BLK} rows between"
    carry = ends.selectExpr(
        "ticker",
        BLK,
        *(f"last_value(_end.{c}) ignore nulls over ({series} unbounded preceding and 1 preceding) as _l_{c}" for c in columns),
        *(f"first_value(_f_{c}) ignore nulls over ({series} unbounded preceding and unbounded following) as _f_{c}" for c in back),
    )
    if instead:
        having = instead[2].select("ticker").distinct().withColumn("_has", F.lit(True))
        carry = carry.join(having, "ticker", "left")
    kinds = dict(df.dtypes)

    def options(c: str) -> str:
        found = [c, f"_l_{c}"]
        if mode == "reference":
            found.append(f"_f_{c}")
        if mode != "forward":
            found.append(f"cast(0 as {kinds[c]})")
        return f"coalesce({', '.join(found)})"

    def filled(c: str) -> str:
        if instead and c == instead[0]:
            return f"if(_has, {options(c)}, {options(instead[1])}) as {c}"
        return f"{options(c)} as {c}"

    return df.join(carry, ["ticker", BLK]).selectExpr(
        *(filled(c) if c in columns else c for c in df.columns)
    )


def fill_series(
    df: DataFrame, columns: list[str], mode: str = "reference", **layout: int
) -> DataFrame:
    """Fill ``columns`` of a frame keyed by (ticker, timestamp).

    ``reference`` fills forward, backward, then with 0; ``causal`` skips the backward step, which
    would copy later values into earlier rows; ``forward`` only carries values on.
    """
    local = fill_within_blocks(blocked(df, **layout), [*df.columns, BLK], columns)
    return fill_across_blocks(materialize(local, "fill"), columns, mode).select(*df.columns)
