"""Counts, means and squared deviations that can be merged without loss of digits.

Sums of squares lose all digits when scores are large against their spread; means and squared deviations do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("rows", "n", "mean", "m2", "hi", "lo")


def moments(column: str) -> Column:
    """Aggregate: rows, rows with a value, their mean, squared deviations and extremes, as one struct."""
    n = F.count(column)
    return F.struct(
        F.count(F.lit(1)).alias("rows"), n.alias("n"), F.avg(column).alias("mean"), (F.var_pop(column) * n).alias("m2"), F.max(column).alias("hi"), F.min(column).alias("lo")
    )


def merge_two(a: Column, b: Column) -> Column:
    """The moments of two disjoint sets of rows; either may be NULL."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    share = F.try_divide(b["n"], n)
    both = F.struct(
        (a["rows"] + b["rows"]).alias("rows"),
        n.alias("n"),
        F.when(a["n"] == 0, b["mean"]).when(b["n"] == 0, a["mean"]).otherwise(a["mean"] + apart * share).alias("mean"),
        F.when(a["n"] == 0, b["m2"]).when(b["n"] == 0, a["m2"]).otherwise(a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"),
        F.greatest(a["hi"], b["hi"]).alias("hi"),
        F.least(a["lo"], b["lo"]).alias("lo"),
    )
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


def merged(parts: Column) -> Column:
    """The moments of an array of moments, merged in its order."""
    return F.aggregate(F.slice(parts, 2, F.size(parts)), F.get(parts, F.lit(0)), merge_two)


def sample_deviation(m: Column) -> Column:
    """Sample standard deviation; NULL below two values."""
    return F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)))
