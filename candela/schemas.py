"""Explicit schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_TS, _S, _D, _I = T.TimestampType(), T.StringType(), T.DoubleType(), T.IntegerType()

OHLCV = ["open", "high", "low", "close", "volume"]
STATEMENT_VALUES = [
    "revenue",
    "net_income",
    "eps",
    "operating_cash_flow",
    "total_assets",
    "total_liabilities",
]

BARS = _fields(("timestamp", _TS), ("ticker", _S), *((c, _D) for c in OHLCV))
PRICES = _fields(("timestamp", _TS), ("ticker", _S), ("price", _D))
NEWS = _fields(("published_at", _TS), ("ticker", _S), ("sentiment", _D))
FUNDAMENTALS = _fields(
    ("report_date", _TS), ("ticker", _S), *((c, _D) for c in STATEMENT_VALUES)
)
STATEMENTS = _fields(
    ("ticker", _S), ("statement", _S), ("line_item", _S), ("quarter", _TS), ("value", _D)
)

# Text files: every field is read as text and converted by the cleaning step.
NEWS_TEXT_COLUMNS = [
    "date_requested",
    "uuid",
    "title",
    "description",
    "keywords",
    "snippet",
    "url",
    "image_url",
    "language",
    "published_at",
    "source",
    "ticker",
    "sentiment_score",
]
NEWS_TEXT = _fields(*((c, _S) for c in NEWS_TEXT_COLUMNS))

ENTITY = _fields(("symbol", _S), ("name", _S), ("sentiment_score", _D), ("match_score", _D))
ARTICLE = T.StructType(
    [
        T.StructField(c, _S, True)
        for c in (
            "uuid",
            "title",
            "description",
            "keywords",
            "snippet",
            "url",
            "image_url",
            "language",
            "published_at",
            "source",
        )
    ]
    + [T.StructField("entities", T.ArrayType(ENTITY), True)]
)
NEWS_PAGE = T.StructType(
    [
        T.StructField(
            "meta",
            _fields(*((c, _I) for c in ("found", "returned", "limit", "page", "total_pages"))),
            True,
        ),
        T.StructField("data", T.ArrayType(ARTICLE), True),
    ]
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed frame without rows, for a source that is absent."""
    return spark.createDataFrame([], schema)


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    """Raise with the missing names when ``df`` lacks any of ``columns``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
