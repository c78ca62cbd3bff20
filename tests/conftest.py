import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from candela.session import local_session

    session = local_session("4", "candela-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bars_pdf():
    """Three tickers, uneven gaps, prices on a cent grid."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    parts = []
    for ticker, n, step in (("AAA", 900, 60), ("BBB", 333, 3600), ("C", 1, 60)):
        gaps = rng.integers(1, 5, n) * step
        close = np.round(np.maximum(5, 100 + rng.normal(0, 1.2, n).cumsum()), 2)
        parts.append(
            pd.DataFrame(
                {
                    "timestamp": pd.Timestamp("2024-03-01") + pd.to_timedelta(gaps.cumsum(), unit="s"),
                    "ticker": ticker,
                    "open": np.round(close + rng.normal(0, 0.5, n), 2),
                    "high": close + 1.0,
                    "low": close - 1.0,
                    "close": close,
                    "volume": rng.integers(0, 50, n).astype(float),
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="session")
def bars(spark, bars_pdf):
    from candela.schemas import BARS

    return spark.createDataFrame(bars_pdf, BARS)
