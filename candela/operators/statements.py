"""Quarterly statements: line items under varying labels to one row per quarter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Statement, field, labels in order of preference.
LINE_ITEMS = [
    ("income", "revenue", ["Total Revenue", "Revenue", "Revenues"]),
    ("income", "net_income", ["Net Income", "Net Income Common Stockholders"]),
    ("income", "eps", ["Basic EPS", "Earnings Per Share", "EPS"]),
    ("balance", "total_assets", ["Total Assets", "Assets"]),
    ("balance", "total_liabilities", ["Total Liabilities", "Liabilities"]),
    (
        "cashflow",
        "operating_cash_flow",
        [
            "Operating Cash Flow",
            "Total Cash From Operating Activities",
            "Cash From Operating Activities",
            "Operating Activities",
        ],
    ),
]


def fundamentals_from_statements(lines: DataFrame, since=None) -> DataFrame:
    """Long statement lines (``ticker, statement, line_item, quarter, value``) to fundamentals.

    The label is chosen per ticker and field: the most preferred one that occurs at all, even if
    its value is missing in some quarter. The quarters are those of the income statement, from
    ``since`` on. Choice and pivot are conditional aggregates, combined before the shuffle.
    """
    item = F.col("line_item")

    def is_item(statement: str, label: str):
        return (F.col("statement") == statement) & (item == label)

    ranks, values = [], []
    for statement, field, labels in LINE_ITEMS:
        rank = F.lit(None).cast("int")
        for i in reversed(range(len(labels))):
            rank = F.when(is_item(statement, labels[i]), i).otherwise(rank)
        ranks.append(F.min(rank).alias(f"_rank_{field}"))
        values += [
            F.max(F.when(is_item(statement, label), F.nanvl("value", F.lit(None)))).alias(
                f"_{field}_{i}"
            )
            for i, label in enumerate(labels)
        ]
    chosen = lines.groupBy("ticker").agg(*ranks)
    recent = lines if since is None else lines.where(F.col("quarter") >= F.lit(since))
    quarters = (
        recent.groupBy("ticker", "quarter")
        .agg(F.max(F.col("statement") == "income").alias("_income"), *values)
        .where(F.col("_income"))
    )
    picked = []
    for _, field, labels in LINE_ITEMS:
        value = F.lit(None).cast("double")
        for i in range(len(labels)):
            value = F.when(F.col(f"_rank_{field}") == i, F.col(f"_{field}_{i}")).otherwise(value)
        picked.append(value.alias(field))
    return quarters.join(chosen, "ticker").select(
        F.col("quarter").alias("report_date"), "ticker", *picked
    )
