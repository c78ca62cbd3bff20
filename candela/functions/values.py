"""Scalar conversions shared by the sources. A missing value is always NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKET_ZONE = "America/New_York"


def to_number(c: Column, default: float | None = None) -> Column:
    """Text or number to double; text that is no number, and NaN, become NULL or ``default``."""
    number = c.cast("string").try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if default is None else F.coalesce(number, F.lit(default))


def parse_utc(c: Column, zone: str = "UTC") -> Column:
    """ISO text to an instant.

    Text with an offset is taken as is; text without one is local time of ``zone``. Unparsable text
    gives NULL. In a clock change a skipped local time moves forward and a repeated one takes the
    earlier offset.
    """
    text = F.trim(c)
    has_offset = text.rlike(r"\d{2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)$")
    parsed = F.try_to_timestamp(text)
    return F.when(has_offset, parsed).otherwise(F.to_utc_timestamp(parsed, zone))


def local_to_utc(c: Column, zone: str = MARKET_ZONE) -> Column:
    """A timestamp that holds local wall-clock time of ``zone`` to UTC."""
    return F.to_utc_timestamp(c, zone)


def normalise_ticker(c: Column) -> Column:
    return F.upper(F.trim(c))
