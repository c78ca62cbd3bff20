"""Toxicity scores by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A document's features are the n-grams it holds, lower-cased, anything but letters counting as a blank. Each is worth its
log-count ratio: how much likelier toxic documents hold it. A logistic regression on the most
telling ones is fitted on a bounded sample; all documents are scored over their whole text.

A regression on rare labels puts most scores below a half. So the intercept is moved to where predictions of learning
rows are best (F1): they come from models fitted, ratios and choice of n-grams included, without the row's own fold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.labelled import remainder, sample
from candela.llm.words import blocks, mix, small_batches
from candela.session import materialize

ORDERS = (4, 5)
#: Most labelled rows learned from, by label.
SAMPLE = {1: 4000, 0: 8000}
FEATURES = 4096
#: Documents of the sample that must hold an n-gram.
SUPPORT = 5
CELLS = 1 << 20
#: Folds of the learning rows, by a hash of the id, for the intercept.
FOLDS = 3
_COUNTS = [f"{name}_{k}" for k in range(FOLDS) for name in ("toxic", "clean")]

_LETTERS = np.full(0x3000, 0x20, np.uint32)
for _c in range(0x3000):
    if chr(_c).isalpha():
        _LETTERS[_c] = ord(chr(_c).lower()[0])


def _features(data: np.ndarray, offsets: np.ndarray):
    """(row, n-gram) of every position of whole texts, one order after the other."""
    ahead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=ahead[1:])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    if len(points) != ahead[-1]:  # broken UTF-8: bytes are as good
        points, ahead = data.astype(np.uint32), np.arange(len(data) + 1)
    plain = np.where(points < len(_LETTERS), _LETTERS[np.minimum(points, len(_LETTERS) - 1)], points).astype(np.uint64)
    first = ahead[offsets]
    # A blank stands before and after each row, so that word ends show.
    padded = np.full(len(plain) + 2 * (len(first) - 1), 0x20, np.uint64)
    row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    padded[np.arange(len(plain)) + 2 * row_of + 1] = plain
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first) + 2)
    for n in ORDERS:
        size = len(padded) - n + 1
        if size <= 0:
            continue
        code = np.full(size, n, np.uint64)
        for d in range(n):
            code = code * np.uint64(0x100000001B3) + padded[d : d + size]
        same = rows[:size] == rows[n - 1 :]
        yield rows[:size][same], mix(code[same])


def _held(data, offsets):
    """Distinct (row, n-gram) pairs."""
    parts = [_distinct(r, g) for r, g in _features(data, offsets)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def _distinct(row: np.ndarray, gram: np.ndarray):
    order = np.argsort(gram, kind="stable")
    row, gram = row[order], gram[order]
    order = np.argsort(row, kind="stable")
    row, gram = row[order], gram[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    return row[new], gram[new]


def _count(batches):
    """Documents of each fold and label that hold an n-gram."""
    for batch in batches:
        label, fold = (batch.column(c).to_numpy() for c in ("label", "fold"))
        for first, data, offsets in blocks(batch.column("text")):
            row, gram = _held(data, offsets)
            grams, back = np.unique(gram, return_inverse=True)
            kind = 2 * fold[first + row] + (label[first + row] != 1)
            counts = [np.bincount(back[kind == k], minlength=len(grams)) for k in range(2 * FOLDS)]
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), *map(pa.array, counts)], names=["gram", *_COUNTS])


def _lookup(known: np.ndarray, sieve: np.ndarray, data, offsets):
    """(row, feature) of the known n-grams that each row holds."""
    rows, features = [], []
    for row, gram in _features(data, offsets):
        some = np.flatnonzero(sieve[(gram & np.uint64(CELLS - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(known, gram[some]), len(known) - 1)
        same = known[place] == gram[some]
        rows.append(row[some][same])
        features.append(place[same])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(rows) * len(known) + np.concatenate(features))
    return pairs // len(known), pairs % len(known)


def _sieve(known: np.ndarray) -> np.ndarray:
    out = np.zeros(CELLS, bool)
    out[(known & np.uint64(CELLS - 1)).astype(np.int64)] = True
    return out


def fit_logistic(row, feature, value, label, features: int, penalty: float = 1.0, steps: int = 300):
    """(weights, intercept) of a ridge-penalised logistic regression, by accelerated gradient steps."""
    n = len(label)
    norm = np.bincount(row, value**2, n)
    rate = 1.0 / (0.25 * max(norm.max(initial=1.0) + 1.0, 1.0) * n / 8 + penalty)
    w = np.zeros(features + 1)
    look, before = w.copy(), w.copy()
    for t in range(steps):
        z = np.bincount(row, value * look[feature], n) + look[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label
        grad = np.append(np.bincount(feature, value * error[row], features) + penalty * look[:-1], error.sum())
        w = look - rate * grad
        look = w + t / (t + 3) * (w - before)
        before = w
    return w[:-1], float(w[-1])


def best_cut(z: np.ndarray, label: np.ndarray) -> float:
    """The value from which predicting label 1 has the best F1; between it and the next smaller value."""
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(label[order] == 1)
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + hits[-1])
    f1[:-1][z[order][1:] == z[order][:-1]] = -1  # equal values fall together
    k = int(f1.argmax())
    below = z[order][k + 1] if k + 1 < len(z) else z[order][k]
    return float(z[order][k] + below) / 2


def _ratio(toxic, clean, ones: int, zeros: int):
    """Log-count ratio of columns or arrays."""
    log = F.log if not isinstance(toxic, np.ndarray) else np.log
    return log((toxic + 1) / (F.lit(ones + 2) if log is F.log else ones + 2)) - log((clean + 1) / (F.lit(zeros + 2) if log is F.log else zeros + 2))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, most: dict[int, int] = SAMPLE) -> DataFrame:
    """One row per document row: doc_id, held_out, score (0 to 1), predicted.

    Learns from at most ``most`` labelled rows of each label, none of them held out. Null and empty
    texts hold no n-gram and get the intercept's score; so do all rows if no label can be learned from, with
    score 0. Repeated rows get equal scores; other columns are ignored, whatever their names. FEATURES n-grams held by
    at least SUPPORT documents of the sample are used.
    """
    spark = small_batches(docs.sparkSession)
    known_rows = sample(docs, labels, "toxic", most).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int"))
    kinds = ", ".join(f"{c} long" for c in _COUNTS)
    counts = known_rows.mapInArrow(_count, f"gram long, {kinds}").groupBy("gram").agg(*(F.sum(c).alias(c) for c in _COUNTS))
    total = [sum((F.col(c) for c in _COUNTS[j::2]), F.lit(0)) for j in (0, 1)]
    counts = materialize(counts.where(total[0] + total[1] >= SUPPORT), "gram-counts")
    sizes = {(r.fold, r.label): r.n for r in known_rows.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    size = lambda label, without: sum(n for (fold, x), n in sizes.items() if x == label and fold != without)
    # Without a fold and with all of them: the most telling n-grams, FEATURES rows at most each.
    parts = []
    for without in (*range(FOLDS), None):
        toxic, clean = (sum((F.col(f"{name}_{k}") for k in range(FOLDS) if k != without), F.lit(0)) for name in ("toxic", "clean"))
        telling = F.abs(_ratio(toxic, clean, size(1, without), size(0, without))) * F.sqrt(toxic + clean)
        chosen = counts.where(toxic + clean >= SUPPORT).orderBy(F.desc(telling), "gram").limit(FEATURES)
        parts.append(chosen.toArrow())
    known = np.unique(np.concatenate([t.column("gram").to_numpy() for t in parts]).view(np.uint64))
    weights, intercept = np.zeros(len(known)), -30.0
    if len(known) and size(1, None) and size(0, None):
        shared = spark.sparkContext.broadcast((known, _sieve(known)))

        def rows(batches):
            for batch in batches:
                for first, data, offsets in blocks(batch.column("text")):
                    row, feature = _lookup(*shared.value, data, offsets)
                    cut = np.searchsorted(row, np.arange(len(offsets)))
                    lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(feature.astype(np.int16)))
                    yield pa.RecordBatch.from_arrays([batch.column(c).slice(first, len(offsets) - 1).cast(pa.int32()) for c in ("label", "fold")] + [lists], names=["label", "fold", "features"])

        table = known_rows.mapInArrow(rows, "label int, fold int, features array<short>").toArrow().combine_chunks()  # sum(most) rows
        lists = table.column("features").combine_chunks()
        feature = lists.values.to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        label, fold = (table.column(c).to_numpy() for c in ("label", "fold"))

        def fitted(without: int | None, part: pa.Table):
            """Weights of all n-grams and intercept, from the rows of the other folds."""
            held = [np.sum([part.column(f"{name}_{k}").to_numpy() for k in range(FOLDS) if k != without], axis=0) for name in ("toxic", "clean")]
            at = np.searchsorted(known, part.column("gram").to_numpy().view(np.uint64))
            ratios = np.zeros(len(known))
            ratios[at] = _ratio(*held, size(1, without), size(0, without))
            used = np.flatnonzero((fold[row] != (-1 if without is None else without)) & (ratios[feature] != 0))
            among = fold != (-1 if without is None else without)
            place = np.cumsum(among) - 1
            w, b = fit_logistic(place[row[used]], feature[used], ratios[feature[used]], label[among], len(known))
            return w * ratios, b

        z = np.zeros(len(label))
        for k in range(FOLDS):
            if size(1, k) and size(0, k):
                w, b = fitted(k, parts[k])
                z[fold == k] = (np.bincount(row, w[feature], len(label)) + b)[fold == k]
        weights, intercept = fitted(None, parts[-1])
        intercept -= best_cut(z, label) if len(set(fold)) > 1 else 0.0
    model = spark.sparkContext.broadcast((known, _sieve(known), weights, intercept))

    def score(batches):
        known, sieve, weights, intercept = model.value
        for batch in batches:
            parts = []
            for _, data, offsets in blocks(batch.column("text")):
                z = np.full(len(offsets) - 1, intercept)
                if len(known):
                    row, feature = _lookup(known, sieve, data, offsets)
                    z += np.bincount(row, weights[feature], len(z))
                parts.append(1 / (1 + np.exp(-np.clip(z, -700, 700))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
