"""Models, streams, and the entry module."""

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from candela.learning import trading
from candela.learning.price import PriceModel
from candela.learning.trading import TradingModel
from candela.operators import clean
from candela.operators.labels import time_split, trade_labels
from candela.plans import job_queries
from candela.plans.feature_frame import feature_frame
from candela.plans.fixtures import Tables
from candela.session import new_path, shared_dir

FEW = {"maxIter": 3, "maxDepth": 3}
SMALL = {"numTrees": 3, "maxDepth": 3}


@pytest.fixture(scope="module")
def frame(spark, bars):
    return feature_frame(bars)


def test_price_model(spark, bars, frame, tmp_path):
    model = PriceModel(["boosted", "forest"], {"boosted": FEW, "forest": SMALL}).fit(frame)
    parts = {r.part: r for r in model.evaluate(frame).collect()}
    assert set(parts) == {"train", "validation", "all"} and parts["train"].r2 > 0.5
    model.save(str(tmp_path / "m"))
    again = PriceModel.load(spark, str(tmp_path / "m"))
    for name in ("families", "params", "validation", "early_stop", "features"):
        assert getattr(again, name) == getattr(model, name)
    one, two = (m.predict(frame).toPandas().sort_values(["ticker", "timestamp"]) for m in (model, again))
    np.testing.assert_array_equal(one.prediction, two.prediction)
    np.testing.assert_allclose(one.prediction, (one.prediction_boosted + one.prediction_forest) / 2)
    top = [r.importance for r in model.importance(spark, 5).collect()]
    assert top == sorted(top, reverse=True) and len(top) == 5
    score = feature_frame(bars, mode="score")
    assert model.forecast(score).count() == 3


def test_trading_model(spark, bars, frame, tmp_path):
    model = TradingModel(min_profit=0.004, max_holding=30, signal_params=SMALL, head_params=FEW).fit(frame)
    predicted = model.predict(frame).toPandas()
    assert set(predicted.signal) <= {"BUY", "SELL"}
    assert predicted.position_size.between(0, 100).all() and predicted.timing_minutes.between(1, 30).all()
    assert predicted.signal_confidence.between(0, 1).all()
    metrics = {r.part: r.signal_accuracy for r in model.evaluate(frame).collect()}
    assert set(metrics) == {"train", "validation", "all"}
    model.save(str(tmp_path / "t"))
    again = TradingModel.load(spark, str(tmp_path / "t"))
    for name in ("signal_params", "head_params", "max_holding", "include_hold", "features"):
        assert getattr(again, name) == getattr(model, name)
    prices = clean.latest_price(bars)
    score = feature_frame(bars, mode="score")
    one, two = (sorted(map(str, m.recommend(score, prices).collect())) for m in (model, again))
    assert one == two and len(one) == 3


class Caught(Exception):
    pass


def test_training_rows_lie_evenly(spark, frame, monkeypatch):
    """The cut is found among bare rows; the rows learned from are those before it, dealt evenly."""
    cut_from = []

    def caught(rows, label):
        raise Caught(rows)

    monkeypatch.setattr(trading, "time_split", lambda df, *a, **k: cut_from.append(df.columns) or time_split(df, *a, **k))
    monkeypatch.setattr(trading, "materialize", caught)
    monkeypatch.setattr(trading, "PART_ROWS", 100)
    with pytest.raises(Caught) as found:
        TradingModel().fit(frame)
    rows = found.value.args[0]
    sizes = rows.rdd.glom().map(len).collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) - min(sizes) <= len(sizes)
    assert "signal" not in cut_from[0]
    plain = time_split(trade_labels(frame.drop("target")), pooled=True).where("not is_validation")
    labels = lambda df: sorted(df.select(*trading.LABEL_COLUMNS).collect())
    assert labels(rows) == labels(plain)


def test_model_frames_take_prices_from_stored_bars(spark, monkeypatch):
    """The events are not summed up into bars again for the prices."""
    t, seen = Tables(spark, "/root/testdata/sf0.001"), []
    monkeypatch.setattr(job_queries, "feature_frame", lambda bars, news, prices, *a, **k: seen.append(prices) or bars)
    job_queries._train_frame(t)
    job_queries._score_frame(t)
    want = sorted(t.prices_h.collect())
    for prices in seen:
        assert sorted(prices.collect()) == want and not any("events.parquet" in f for f in prices.inputFiles())


def test_hold_only_series_trains_on_everything(spark, bars):
    flat = bars.where("ticker = 'BBB'").withColumn("close", F.lit(5.0))
    model = TradingModel(signal_params=SMALL, head_params=FEW).fit(feature_frame(flat))
    predicted = model.predict(feature_frame(flat)).select("signal").distinct().collect()
    assert [r.signal for r in predicted] == ["HOLD"]


class Session:
    """Just enough of a session to ask it for its shared folder."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder or default)})


def test_shared_folder_follows_the_session(spark):
    assert new_path(spark, "x").startswith(shared_dir(spark))
    assert shared_dir(Session("spark://host:7077", "hdfs://nn/shared/")) == "hdfs://nn/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("spark://host:7077", None))


@pytest.mark.parametrize("name", ["sma", "trade_labels", "stream_articles", "stream_sentiment", "news_from_json",
                                  "describe_numeric", "stream_scores"])
def test_registered_queries_match_sql(spark, name):
    import compare

    folder = "/root/testdata/sf0.001"
    _, rows, note = compare.compare(spark, compare.connect(folder), folder, name)
    assert rows > 0 and note == "ok"


def test_registry_is_consistent():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 80


def test_rounds_kept():
    from candela.learning.price import best_round

    assert best_round([5, 4, 3, 3.5, 3.4]) == 3
    assert best_round([5, 4, *[4.5] * 10, 4.2]) == 2
    assert best_round([5, 4, *[4.5] * 12, 3]) == 15  # the whole ensemble is better than the best before the pause
    assert best_round([1.0]) == 1


def test_early_stopping_cuts_the_ensemble(spark, bars, frame, tmp_path):
    """Noise as target: boosting fits it ever better on the training rows and ever worse on the others."""
    noisy = frame.withColumn("target", F.pmod(F.xxhash64("ticker", "timestamp"), F.lit(1000)) / 1000.0)
    few = {"maxIter": 30, "maxDepth": 5, "stepSize": 0.5}
    model = PriceModel("boosted", {"boosted": few}).fit(noisy)
    rounds = model.rounds(spark).orderBy("round").collect()
    kept = [r for r in rounds if r.kept]
    assert len(rounds) == 30 and 0 < len(kept) < 30 and len(model.model.stages[1].trees) == len(kept)
    assert kept[-1].validation_error <= rounds[-1].validation_error
    parts = {r.part: r.mse for r in model.evaluate(noisy).collect()}
    np.testing.assert_allclose(parts["validation"], kept[-1].validation_error, rtol=1e-9)
    model.save(str(tmp_path / "r"))
    assert PriceModel.load(spark, str(tmp_path / "r")).errors == model.errors
    total = sum(r.importance for r in model.importance(spark, 1000).collect())
    np.testing.assert_allclose(total, 1)


@pytest.mark.parametrize("include_hold", [False, True])
def test_boosted_signal_head(spark, frame, tmp_path, include_hold):
    from candela.operators.metrics import confusion_matrix

    few = {"maxIter": 3, "maxDepth": 3}
    model = TradingModel(min_profit=0.004, max_holding=30, include_hold=include_hold, signal_family="boosted", signal_params=few, head_params=few).fit(frame)
    assert model.labels == ([0, 1, 2] if include_hold else [0, 2])
    predicted = model.predict(frame).toPandas()
    assert predicted.signal_confidence.between(1 / 3 - 1e-9, 1).all()
    assert set(predicted.signal) <= ({"BUY", "SELL", "HOLD"} if include_hold else {"BUY", "SELL"})
    scored = model.scored(frame)
    matrix = {r.label: r.pred_0 + r.pred_1 + r.pred_2 for r in confusion_matrix(scored).collect()}
    labels = {r.signal: r["count"] for r in scored.groupBy("signal").count().collect()}
    assert {k: n for k, n in matrix.items() if n} == labels
    assert sum(model.rows.values()) > 0 and model.rows["signal"] <= scored.where("not is_validation").count()
    model.save(str(tmp_path / "b"))
    again = TradingModel.load(spark, str(tmp_path / "b"))
    assert (again.labels, again.rows, again.signal_family) == (model.labels, model.rows, "boosted")
    one, two = (sorted(map(str, m.predict(frame).select("ticker", "timestamp", "signal", "signal_confidence").collect())) for m in (model, again))
    assert one == two
