"""Calendar columns of a timestamp."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIME_COLUMNS = [
    "year",
    "month",
    "day",
    "day_of_week",
    "day_of_year",
    "week_of_year",
    "quarter",
    "month_sin",
    "month_cos",
    "day_of_week_sin",
    "day_of_week_cos",
    "is_weekend",
]


def add_time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Twelve calendar columns; Monday is day 0 and weeks are ISO weeks."""
    month_angle = F.month(ts) * (2 * math.pi / 12)
    weekday_angle = F.weekday(ts) * (2 * math.pi / 7)
    return df.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.day(ts),
            "day_of_week": F.weekday(ts),
            "day_of_year": F.dayofyear(ts),
            "week_of_year": F.weekofyear(ts),
            "quarter": F.quarter(ts),
            "month_sin": F.sin(month_angle),
            "month_cos": F.cos(month_angle),
            "day_of_week_sin": F.sin(weekday_angle),
            "day_of_week_cos": F.cos(weekday_angle),
            "is_weekend": (F.weekday(ts) >= 5).cast("int"),
        }
    )
