"""Model metrics as aggregates over prediction tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.operators.labels import BUY, HOLD, SELL

LABELS = [SELL, HOLD, BUY]
LABEL_NAMES = ["SELL", "HOLD", "BUY"]


def mean_prediction(df: DataFrame, columns: list[str], out: str = "prediction") -> DataFrame:
    """Average of several models' predictions."""
    return df.withColumn(out, reduce(Column.__add__, (F.col(c) for c in columns)) / len(columns))


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, keys: list[str] | None = None
) -> DataFrame:
    """mse, rmse, mae, r2 and mape in one pass; rows with a zero actual stay out of mape.

    The spread of the actual values comes from ``var_pop``, which does not lose digits.
    """
    y, p = F.col(actual), F.col(predicted)
    mse = F.avg((y - p) * (y - p))
    return df.groupBy(*(keys or [])).agg(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"),
        (F.avg(F.abs(F.try_divide(y - p, y))) * 100).alias("mape"),
    )


def trading_metrics(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Signal accuracy over all rows; mean errors over rows whose true label is a trade.

    Reads ``signal, position_size, timing_minutes, profit`` and their ``pred_`` counterparts.
    """
    trade = F.col("signal") != HOLD

    def error(name: str) -> Column:
        gap = F.abs(F.col(name) - F.col(f"pred_{name}"))
        return F.coalesce(F.avg(F.when(trade, gap)), F.lit(0.0))

    hit = F.when(F.col("signal") == F.col("pred_signal"), 1.0).otherwise(0.0)
    return df.groupBy(*(keys or [])).agg(
        F.avg(hit).alias("signal_accuracy"),
        error("position_size").alias("position_mae"),
        error("timing_minutes").alias("timing_mae"),
        error("profit").alias("profit_mae"),
    )


def confusion_matrix(df: DataFrame, actual: str = "signal", predicted: str = "pred_signal") -> DataFrame:
    """Rows per true label and predicted label; every label has a row and a column."""
    counts = df.agg(
        *(
            F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"{a}_{p}")
            for a in LABELS
            for p in LABELS
        )
    )
    rows = F.array(
        *(
            F.struct(F.lit(a).alias("label"), *(F.col(f"{a}_{p}").alias(f"pred_{p}") for p in LABELS))
            for a in LABELS
        )
    )
    return counts.select(F.explode(rows).alias("_r")).select("_r.*")


def classification_report(
    df: DataFrame, actual: str = "signal", predicted: str = "pred_signal"
) -> DataFrame:
    """Precision, recall, f1 and support per label, then accuracy, macro and weighted means."""
    a, p = F.col(actual), F.col(predicted)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(a == p).alias("hits"),
        *(F.count_if((a == k) & (p == k)).alias(f"tp_{k}") for k in LABELS),
        *(F.count_if(p == k).alias(f"predicted_{k}") for k in LABELS),
        *(F.count_if(a == k).alias(f"support_{k}") for k in LABELS),
    )
    zero = F.lit(0.0)

    def ratio(x: Column, y: Column) -> Column:
        return F.coalesce(F.try_divide(x, y), zero)

    def line(name: str, precision, recall, f1, support) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    scores = {}
    for k in LABELS:
        tp = F.col(f"tp_{k}")
        precision = ratio(tp, F.col(f"predicted_{k}"))
        recall = ratio(tp, F.col(f"support_{k}"))
        f1 = ratio(2 * tp, F.col(f"predicted_{k}") + F.col(f"support_{k}"))
        scores[k] = (precision, recall, f1)
    n = F.col("n")
    macro = [reduce(Column.__add__, (scores[k][i] for k in LABELS)) / len(LABELS) for i in range(3)]
    weighted = [
        ratio(reduce(Column.__add__, (scores[k][i] * F.col(f"support_{k}") for k in LABELS)), n)
        for i in range(3)
    ]
    accuracy = ratio(F.col("hits"), n)
    lines = [line(LABEL_NAMES[k], *scores[k], F.col(f"support_{k}")) for k in LABELS]
    lines.append(line("accuracy", accuracy, accuracy, accuracy, n))
    lines.append(line("macro avg", *macro, n))
    lines.append(line("weighted avg", *weighted, n))
    return counts.select(F.explode(F.array(*lines)).alias("_r")).select("_r.*")
