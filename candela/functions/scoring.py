"""Financial health score, its expected stock impact, and year-over-year growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values: (threshold, points) pairs compared with "greater than", then the points below all.
GROWTH_POINTS = ([(0.20, 30), (0.10, 25), (0.05, 20), (0.0, 15), (-0.05, 10)], 5)
MARGIN_POINTS = ([(0.35, 25), (0.30, 22), (0.25, 20), (0.20, 18), (0.15, 15)], 10)
PROFIT_GROWTH_POINTS = ([(0.20, 5), (0.10, 3), (0.0, 2)], 0)
CASH_POINTS = ([(1.5, 20), (1.2, 18), (1.0, 15), (0.8, 12)], 8)
OPERATING_POINTS = ([(0.50, 10), (0.45, 9), (0.40, 8), (0.35, 7), (0.30, 6)], 4)
# Compared with "less than".
DEBT_POINTS = ([(0.30, 15), (0.40, 12), (0.50, 10), (0.60, 8)], 5)
MAX_HEALTH = 100

# Lowest health, label, expected change, confidence.
IMPACT_BANDS = [
    (85, "STRONGLY_POSITIVE", "+5% to +10%", "HIGH"),
    (70, "POSITIVE", "+2% to +5%", "MEDIUM-HIGH"),
    (55, "SLIGHTLY_POSITIVE", "0% to +2%", "MEDIUM"),
    (40, "NEUTRAL", "-2% to +2%", "MEDIUM"),
    (25, "NEGATIVE", "-5% to -2%", "MEDIUM-HIGH"),
]
LOWEST_BAND = ("STRONGLY_NEGATIVE", "-10% to -5%", "HIGH")


def _ladder(value: Column, steps: tuple[list[tuple[float, int]], int], below: bool = False) -> Column:
    """Points of the first step passed; a missing value adds nothing."""
    pairs, rest = steps
    out = F.when(value.isNull(), 0)
    for threshold, points in pairs:
        out = out.when(value < threshold if below else value > threshold, points)
    return out.otherwise(rest)


def health_score() -> Column:
    """0-100 from growth, margins, cash quality and debt. A zero denominator adds nothing."""
    income_share = F.try_divide("net_income", "revenue")
    cash_quality = F.try_divide("operating_cash_flow", "net_income")
    debt_share = F.try_divide("total_liabilities", "total_assets")
    operating_share = F.try_divide("operating_income", "revenue")
    total = (
        _ladder(F.col("revenue_growth_yoy"), GROWTH_POINTS)
        + _ladder(income_share, MARGIN_POINTS)
        + _ladder(F.col("net_income_growth_yoy"), PROFIT_GROWTH_POINTS)
        + _ladder(cash_quality, CASH_POINTS)
        + _ladder(debt_share, DEBT_POINTS, below=True)
        + _ladder(operating_share, OPERATING_POINTS)
    )
    return F.least(total, F.lit(MAX_HEALTH))


def add_stock_impact(df: DataFrame, health: str = "financial_health_score") -> DataFrame:
    """Impact score, label, expected change and confidence of a health score."""

    def band(field: int) -> Column:
        first, *others = IMPACT_BANDS
        out = F.when(F.col(health) >= first[0], first[field])
        for row in others:
            out = out.when(F.col(health) >= row[0], row[field])
        return out.otherwise(LOWEST_BAND[field - 1])

    return df.withColumns(
        {
            "stock_impact_score": F.round((F.col(health) - 50) * 2, 1).cast("double"),
            "stock_impact_label": band(1),
            "expected_price_change": band(2),
            "impact_confidence": band(3),
        }
    )


def add_scores(fundamentals: DataFrame) -> DataFrame:
    """Both scores on a fundamentals table with growth columns."""
    return add_stock_impact(fundamentals.withColumn("financial_health_score", health_score()))


def add_growth(
    fundamentals: DataFrame, columns: tuple[str, ...] = ("revenue", "net_income"), lag: int = 4
) -> DataFrame:
    """``<column>_growth_yoy`` against the report ``lag`` quarters earlier.

    A ticker has one row per quarter, so its window is short.
    """
    w = Window.partitionBy("ticker").orderBy("report_date")
    return fundamentals.withColumns(
        {
            f"{c}_growth_yoy": F.try_divide(F.col(c) - F.lag(c, lag).over(w), F.lag(c, lag).over(w))
            for c in columns
        }
    )
