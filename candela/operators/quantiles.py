"""Exact quantiles without sorting the data, in one task or at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a factor of two in the first pass, and of one such cell in the second.
_OCTAVE, _FINE = 1024, 1 << 20
#: More than the octaves of all doubles, so that larger sizes have larger numbers.
_SHIFT = 1100 * _OCTAVE


def _coarse(v: Column) -> Column:
    """A whole number that never falls when ``v`` grows; a cell holds values within a thousandth of each other."""
    size = F.floor(F.log2(F.abs(v)) * _OCTAVE) + _SHIFT
    endless = F.lit(2 * _SHIFT)
    placed = F.when(F.abs(v) == float("inf"), endless).otherwise(size).cast("long")
    return F.when(v == 0, F.lit(0)).when(F.isnan(v), endless + 1).when(v < 0, -placed).otherwise(placed).cast("long")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Interpolated quantiles, one row per (keys, column, q) with the value in ``quantile``.

    Three passes of counting, each combined before its shuffle. The first counts values in cells whose width grows
    with their size, which suits any skew; a wanted rank then lies in one known cell. The second cuts the
    cells with wanted ranks evenly between their least and greatest value; the third counts the values of the cells
    left, one in about a million of a cell. Ranks are known exactly all the way, so nothing is estimated and
    nothing can be missed. Cells are put in order, never rows.
    """
    keys = list(keys)
    by = [*keys, "column"]
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns]
    values = (
        df.select(*keys, F.explode(F.array(*cells)).alias("_c"))
        .select(*keys, "_c.*")
        .where(F.col("v").isNotNull())
    )
    v = F.col("v")

    def counted(rows: DataFrame, group: list[str], cell: str) -> DataFrame:
        """Rows, least and greatest value of each cell, and the rows of its group before it."""
        table = rows.groupBy(*group, cell).agg(F.count(F.lit(1)).alias("_n"), F.min("v").alias("_min"), F.max("v").alias("_max"))
        return table.withColumn("_before", F.sum("_n").over(Window.partitionBy(*group).orderBy(cell)) - F.col("_n"))

    def holding(table: DataFrame) -> DataFrame:
        """The cells that hold wanted ranks, and the ranks inside them."""
        found = table.where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
        return found.withColumn("_rank", F.col("_rank") - F.col("_before")).drop("_n", "_before")

    def within(rows: DataFrame, found: DataFrame, group: list[str]) -> DataFrame:
        # Without keys there are a few cells per column. With keys Spark picks by size, and adaptive
        # execution splits a key that holds much of the data.
        some = found.select(*group, F.col("_min").alias("_lo"), F.col("_max").alias("_hi")).distinct()
        return rows.join(some if keys else F.broadcast(some), group)

    def wanted(q: float) -> Column:
        rank = F.col("_rows").cast("double") * q - q
        side = lambda end, r: F.struct(F.lit(float(q)).alias("q"), F.lit(end).alias("_end"), (rank - F.floor(rank)).alias("_part"), r.alias("_rank"))
        return F.array(side(0, F.floor(rank)), side(1, F.ceil(rank)))

    coarse = values.withColumn("_c1", _coarse(v))
    first = counted(coarse, by, "_c1").withColumn("_rows", F.sum("_n").over(Window.partitionBy(*by)))
    targets = first.select("*", F.explode(F.flatten(F.array(*map(wanted, qs)))).alias("_t")).select("*", "_t.*").drop("_t", "_rows")
    first = holding(targets)

    at = by + ["_c1"]
    span = F.col("_hi") - F.col("_lo")
    share = F.when(span > 0, (v - F.col("_lo")) / span).otherwise(0.0)
    fine = F.when(F.abs(span) < float("inf"), F.floor(share * _FINE)).otherwise(0).cast("long")
    inner = within(coarse, first, at).withColumn("_c2", fine).drop("_lo", "_hi")
    second = holding(first.drop("_min", "_max").join(counted(inner, at, "_c2"), at))

    at = at + ["_c2"]
    last = counted(within(inner, second, at).drop("_lo", "_hi").withColumn("_v", v), at, "_v")
    third = holding(second.drop("_min", "_max").join(last, at))

    one = lambda end: F.max(F.when(F.col("_end") == end, F.col("_v")))
    low, high, part = one(0), one(1), F.first("_part")
    return third.groupBy(*by, "q").agg(F.when(low == high, low).otherwise(low + (high - low) * part).alias("quantile"))
