"""The four-headed trading model: signal, position size, holding time, profit."""

from __future__ import annotations

from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.learning.price import VALIDATION, _read_note, _write_note, fit_all
from candela.operators.labels import (
    HOLD,
    MAX_HOLDING,
    MAX_POSITION,
    MIN_PROFIT,
    latest_rows,
    time_split,
    trade_labels,
)
from candela.operators.metrics import trading_metrics
from candela.operators.recommend import post_process, recommendations, signal_code
from candela.plans.feature_frame import feature_columns
from candela.session import materialize

LABEL_COLUMNS = ["signal", "position_size", "timing_minutes", "profit"]
HEADS = {"position_size": "raw_position", "timing_minutes": "raw_timing", "profit": "raw_profit"}

# The default parameters of the heads.
SIGNAL_PARAMS = {
    "forest": {"numTrees": 100, "maxDepth": 10, "seed": 42},
    "boosted": {"maxIter": 100, "stepSize": 0.05, "maxDepth": 5, "subsamplingRate": 0.8, "seed": 42},
}
HEAD_PARAMS = {"maxIter": 100, "stepSize": 0.05, "maxDepth": 5, "subsamplingRate": 0.8, "seed": 42}

#: Training rows worth a task of their own.
PART_ROWS = 8192


class TradingModel:
    """Fitted on all tickers together; every head learns from the rows that concern it.

    The signal head sees trades only unless ``include_hold`` is set; without HOLD rows it never
    answers HOLD. Size and time learn from positive labels, profit from labels other than 0. A head
    whose rows are all filtered out learns from every row.

    The signal head is a forest, or boosted trees: one ensemble for each label that occurs, trained against the
    others, whose probabilities are scaled to a sum of 1.
    """

    def __init__(
        self,
        max_position: int = MAX_POSITION,
        min_profit: float = MIN_PROFIT,
        max_holding: int = MAX_HOLDING,
        include_hold: bool = False,
        validation: float = 0.2,
        signal_family: str = "forest",
        signal_params: dict | None = None,
        head_params: dict | None = None,
    ):
        self.max_position = max_position
        self.min_profit = min_profit
        self.max_holding = max_holding
        self.include_hold = include_hold
        self.validation = validation
        self.signal_family = signal_family
        self.signal_params = {**SIGNAL_PARAMS[signal_family], **(signal_params or {})}
        self.head_params = {**HEAD_PARAMS, **(head_params or {})}
        self.features: list[str] = []
        #: Labels that the signal head knows, and the rows each head has learned from.
        self.labels: list[int] = []
        self.rows: dict[str, int] = {}
        self.model: PipelineModel | None = None

    def label(self, frame: DataFrame) -> DataFrame:
        return trade_labels(
            frame,
            max_holding=self.max_holding,
            min_profit=self.min_profit,
            max_position=self.max_position,
        )

    def _parts(self, frame: DataFrame) -> DataFrame:
        """Labels and ``is_validation``. The cut looks at times only, so it is found among bare rows, not labelled ones."""
        return self.label(time_split(frame, self.validation, pooled=True))

    def fit(self, frame: DataFrame) -> TradingModel:
        """Label the frame, split by time and fit the heads on the earlier part."""
        frame = frame.drop("target")
        self.features = feature_columns(frame)
        data = self._parts(frame).where(~F.col(VALIDATION))
        assembler = VectorAssembler(
            inputCols=self.features, outputCol="features", handleInvalid="error"
        )
        rows = assembler.transform(data).select("features", *LABEL_COLUMNS)
        # Every level of every tree is a job over all rows, as slow as its largest part; labelled blocks lie unevenly.
        parts = min(rows.sparkSession.sparkContext.defaultParallelism, -(-frame.count() // PART_ROWS))
        rows = materialize(rows.repartition(max(1, parts)), "training")
        wanted = {"signal": F.lit(True) if self.include_hold else F.col("signal") != HOLD}
        wanted |= {c: F.col(c) != 0 if c == "profit" else F.col(c) > 0 for c in HEADS}
        counts = rows.agg(F.count(F.lit(1)).alias("all"), *(F.count_if(w).alias(c) for c, w in wanted.items())).first()
        subset = {c: rows.where(w) if counts[c] else rows for c, w in wanted.items()}
        self.rows = {c: counts[c] or counts["all"] for c in wanted}
        self.labels = sorted(r.signal for r in subset["signal"].select("signal").distinct().collect())  # three at most
        jobs = [partial(self._signal_learner(k).fit, self._signal_rows(subset["signal"], k)) for k in self._signal_heads()]
        for column, out in HEADS.items():
            learner = GBTRegressor(
                featuresCol="features", labelCol=column, predictionCol=out, **self.head_params
            )
            jobs.append(partial(learner.fit, subset[column]))
        self.model = PipelineModel([assembler, *fit_all(jobs)])
        return self

    def _signal_heads(self) -> list[int | None]:
        return [None] if self.signal_family == "forest" else self.labels

    def _signal_learner(self, k: int | None):
        """The forest over all labels, or the boosted trees of label ``k`` against the others."""
        kind, mark = (RandomForestClassifier, "") if k is None else (GBTClassifier, f"_{k}")
        learner = kind(featuresCol="features", labelCol="_label", predictionCol=f"_prediction{mark}", **self.signal_params)
        return learner.setProbabilityCol(f"_probability{mark}").setRawPredictionCol(f"_votes{mark}")

    def _signal_rows(self, rows: DataFrame, k: int | None) -> DataFrame:
        label = F.col("signal") if k is None else F.col("signal") == k
        return rows.withColumn("_label", label.cast("int").cast("double"))

    def _signal(self, df: DataFrame) -> DataFrame:
        """Add the likeliest label and its probability."""
        if self.signal_family == "forest":
            return df.withColumns({"raw_signal": F.col("_prediction").cast("int"), "raw_confidence": F.array_max(vector_to_array("_probability"))})
        each = [vector_to_array(f"_probability_{k}")[1] for k in self.labels]
        # Of equally likely labels the first.
        best = F.greatest(*(F.struct(p.alias("p"), F.lit(-k).alias("k")) for p, k in zip(each, self.labels, strict=True)), F.struct(F.lit(-1.0).alias("p"), F.lit(0).alias("k")))
        df = df.withColumn("_best", best).withColumn("_total", sum(each, F.lit(0.0)))
        return df.withColumns({"raw_signal": -F.col("_best.k"), "raw_confidence": F.coalesce(F.try_divide(F.col("_best.p"), F.col("_total")), F.lit(1.0 / len(self.labels)))})

    def predict(self, frame: DataFrame) -> DataFrame:
        """The frame's other columns plus signal, size, time, profit and confidence."""
        keep = [c for c in frame.columns if c not in self.features or c == "close"]
        raw = self._signal(self.model.transform(frame))
        raw = raw.select(*keep, "raw_signal", *HEADS.values(), "raw_confidence")
        return post_process(raw, self.max_position, self.max_holding)

    def evaluate(self, frame: DataFrame) -> DataFrame:
        """Accuracy and mean errors over the training rows, the validation rows and all rows."""
        scored = self.scored(frame)
        part = F.when(F.col(VALIDATION), "validation").otherwise("train")
        parts = scored.withColumn("part", F.explode(F.array(part, F.lit("all"))))
        return trading_metrics(parts, ["part"])

    def scored(self, frame: DataFrame) -> DataFrame:
        """True labels next to ``pred_`` columns, for the metrics and the confusion matrix."""
        labelled = self._parts(frame.drop("target"))
        true = {c: f"true_{c}" for c in LABEL_COLUMNS}
        predicted = self.predict(labelled.withColumnsRenamed(true))
        return predicted.select(
            "ticker",
            "timestamp",
            VALIDATION,
            *(F.col(new).alias(old) for old, new in true.items()),
            signal_code(F.col("signal")).alias("pred_signal"),
            F.col("position_size").alias("pred_position_size"),
            F.col("timing_minutes").alias("pred_timing_minutes"),
            F.col("expected_profit_pct").alias("pred_profit"),
        )

    def recommend(self, frame: DataFrame, prices: DataFrame) -> DataFrame:
        """One recommendation per ticker from the last row of a ``score`` frame."""
        last = latest_rows(frame.drop("target")).fillna(0, subset=self.features)
        return recommendations(self.predict(last), prices)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        settings = (
            "max_position", "min_profit", "max_holding", "include_hold", "validation",
            "signal_family", "signal_params", "head_params",
        )
        note = {name: getattr(self, name) for name in settings}
        _write_note(path, {"features": self.features, "settings": note, "labels": self.labels, "rows": self.rows})

    @classmethod
    def load(cls, spark, path: str) -> TradingModel:
        note = _read_note(spark, path)
        loaded = cls(**note["settings"])
        loaded.features, loaded.labels, loaded.rows = note["features"], note["labels"], note["rows"]
        loaded.model = PipelineModel.load(f"{path}/model")
        return loaded
