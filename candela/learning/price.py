"""Price regressors: boosted trees, forest, and their mean."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.operators.labels import latest_rows, time_split
from candela.operators.metrics import mean_prediction, regression_metrics
from candela.plans.feature_frame import feature_columns, valid_rows
from candela.session import materialize

# The default parameters of each family.
FAMILY_PARAMS = {
    "boosted": {"maxIter": 100, "stepSize": 0.05, "maxDepth": 5, "subsamplingRate": 0.8, "seed": 42},
    "boosted_deep": {
        "maxIter": 100,
        "stepSize": 0.05,
        "maxDepth": 6,
        "subsamplingRate": 0.8,
        "seed": 42,
    },
    "forest": {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 1, "seed": 42},
}
ENSEMBLE = ["boosted", "boosted_deep", "forest"]
VALIDATION = "is_validation"
#: Rounds without gain on the validation rows after which boosting has ended.
PATIENCE = 10


def _features_assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def _regressor(family: str, label: str, out: str, params: dict | None):
    settings = {**FAMILY_PARAMS[family], **(params or {})}
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": out}
    return RandomForestRegressor(**common, **settings) if family == "forest" else GBTRegressor(**common, **settings)


def best_round(errors: list[float], patience: int = PATIENCE) -> int:
    """Rounds to keep: up to the best one before ``patience`` rounds without gain, or before the end.

    All rounds are known here, so a later round counts if the whole ensemble is better than that.
    """
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    if errors[-1] < errors[best]:
        best = min(range(len(errors)), key=errors.__getitem__)
    return best + 1


def fit_rounds(learner: GBTRegressor, train: DataFrame, validation: DataFrame):
    """(model, error per round) of a boosted learner cut at its best round.

    Trees of a round do not depend on the number of rounds, so the shorter ensemble is fitted afresh.
    """
    model = learner.fit(train)
    if not validation.head(1):
        return model, []
    errors = list(model.evaluateEachIteration(validation, "squared"))
    kept = best_round(errors)
    return (model if kept == len(errors) else learner.copy({learner.maxIter: kept}).fit(train)), errors


def fit_all(jobs: list[Callable]) -> list:
    """Run independent fits side by side; each one alone leaves much of a cluster idle."""
    with ThreadPool(len(jobs)) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(lambda job: job()), jobs)


class PriceModel:
    """One family, or the mean of several, fitted on all tickers together.

    Trees are grown by MLlib: per level every partition sends histogram sums, so data never leaves
    its partition. ``params`` maps a family to parameter overrides.
    """

    def __init__(
        self,
        families: list[str] | str = "boosted",
        params: dict[str, dict] | None = None,
        validation: float = 0.2,
        early_stop: bool = True,
    ):
        self.families = [families] if isinstance(families, str) else list(families)
        self.params = params or {}
        self.validation = validation
        self.early_stop = early_stop
        self.features: list[str] = []
        self.model: PipelineModel | None = None
        #: Of each boosted family the error of each round on the validation rows.
        self.errors: dict[str, list[float]] = {}

    def _out(self, family: str) -> str:
        return f"prediction_{family}"

    def fit(self, frame: DataFrame, target: str = "target") -> PriceModel:
        """Fit on the rows before the validation part, the last in time over all tickers, which steers early stopping."""
        data = frame if VALIDATION in frame.columns else time_split(valid_rows(frame), self.validation, pooled=True)
        self.features = [c for c in feature_columns(data) if c not in (VALIDATION, target)]
        stop = self.early_stop and self.validation > 0
        assembler = _features_assembler(self.features)
        rows = assembler.transform(data).select("features", target, VALIDATION)
        rows = materialize(rows, "training")
        train, held = rows.where(~F.col(VALIDATION)), rows.where(VALIDATION)
        jobs = []
        for family in self.families:
            learner = _regressor(family, target, self._out(family), self.params.get(family))
            stops = stop and family != "forest"
            jobs.append(partial(fit_rounds, learner, train, held) if stops else partial(lambda x: (x.fit(train), []), learner))
        fitted = fit_all(jobs)
        self.errors = {family: errors for family, (_, errors) in zip(self.families, fitted, strict=True) if errors}
        self.model = PipelineModel([assembler, *(model for model, _ in fitted)])
        return self

    def rounds(self, spark: SparkSession) -> DataFrame:
        """One row per boosted family and round: its error on the validation rows, and whether it is kept."""
        rows = [(f, i + 1, float(e), i < best_round(errors)) for f, errors in self.errors.items() for i, e in enumerate(errors)]
        return spark.createDataFrame(rows, "family string, round int, validation_error double, kept boolean")

    def predict(self, frame: DataFrame) -> DataFrame:
        """Add ``prediction`` and one column per family."""
        out = self.model.transform(frame).drop("features")
        return mean_prediction(out, [self._out(f) for f in self.families])

    def evaluate(self, frame: DataFrame, target: str = "target") -> DataFrame:
        """Metrics over the training rows, the validation rows and all rows."""
        data = time_split(valid_rows(frame), self.validation, pooled=True)
        scored = self.predict(data).select(target, "prediction", VALIDATION)
        part = F.when(F.col(VALIDATION), "validation").otherwise("train")
        parts = scored.withColumn("part", F.explode(F.array(part, F.lit("all"))))
        return regression_metrics(parts, target, "prediction", ["part"])

    def forecast(self, frame: DataFrame) -> DataFrame:
        """Predicted price of each ticker from its last row."""
        last = latest_rows(frame)
        last = last.fillna(0, subset=self.features)
        return self.predict(last).select("ticker", "timestamp", "close", "prediction")

    def importance(self, spark, top: int = 20) -> DataFrame:
        """Mean feature importance over the families, highest first."""
        trees = self.model.stages[1:]
        mean = sum(t.featureImportances.toArray() for t in trees) / len(trees)
        rows = [(f, float(x)) for f, x in zip(self.features, mean)]
        table = spark.createDataFrame(rows, "feature string, importance double")
        return table.orderBy(F.col("importance").desc(), "feature").limit(top)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        settings = ("families", "params", "validation", "early_stop")
        note = {name: getattr(self, name) for name in settings}
        _write_note(path, {"features": self.features, "settings": note, "errors": self.errors})

    @classmethod
    def load(cls, spark, path: str) -> PriceModel:
        note = _read_note(spark, path)
        loaded = cls(**note["settings"])
        loaded.features, loaded.errors = note["features"], note["errors"]
        loaded.model = PipelineModel.load(f"{path}/model")
        return loaded


def _write_note(path: str, note: dict) -> None:
    """Settings next to the model, in the same file system."""
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(note),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/settings")


def _read_note(spark, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/settings").first()["value"])
