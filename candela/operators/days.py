"""Day calendars: generation, exclusion, sampling, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar(spans: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every day from ``start`` to ``end``, both included, for each row of ``spans``."""
    days = F.sequence(F.to_date(start), F.to_date(end))
    others = [c for c in spans.columns if c not in (start, end)]
    return spans.select(*others, F.explode(days).alias("day"))


def span_of(df: DataFrame, ts: str, keys: list[str] | None = None) -> DataFrame:
    """First and last day of a table."""
    return df.groupBy(*(keys or [])).agg(
        F.to_date(F.min(ts)).alias("start"), F.to_date(F.max(ts)).alias("end")
    )


def without_days(days: DataFrame, excluded: DataFrame) -> DataFrame:
    return days.join(excluded.select("day").distinct(), "day", "left_anti")


def union_days(*sets: DataFrame) -> DataFrame:
    out = sets[0].select("day")
    for other in sets[1:]:
        out = out.union(other.select("day"))
    return out.distinct()


def sample_days(days: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``k`` days without replacement; the same days for the same seed."""
    drawn = F.md5(F.concat(F.col("day").cast("string"), F.lit(f":{seed}")))
    return days.orderBy(drawn, "day").limit(k)


def target_days(
    span: DataFrame, fixed: DataFrame, k: int = 30, fallback: int = 60, seed: int = 42
) -> DataFrame:
    """Fixed days plus ``k`` random other days of the span; ``fallback`` days if that is empty."""
    every = calendar(span).select("day")
    chosen = union_days(fixed, sample_days(without_days(every, fixed), k, seed))
    has_any = chosen.limit(1).select(F.lit(1).alias("_any"))
    spare = sample_days(every, fallback, seed).withColumn("_any", F.lit(1))
    return chosen.union(spare.join(has_any, "_any", "left_anti").select("day"))


def batch_ranges(spans: DataFrame, days: int = 30) -> DataFrame:
    """Consecutive ranges of ``days`` days; the last one ends with its span."""
    starts = F.sequence(F.col("start"), F.col("end"), F.make_dt_interval(days=F.lit(days)))
    others = [c for c in spans.columns if c not in ("start", "end")]
    return spans.select(*others, "end", F.posexplode(starts).alias("batch", "batch_start")).select(
        *others,
        "batch",
        "batch_start",
        F.least(F.date_add("batch_start", days - 1), F.col("end")).alias("batch_end"),
    )
