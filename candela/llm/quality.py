"""Quality scores by the votes of labelled neighbours in a latent-semantic space.

Texts are counted as byte n-grams, as n-grams of character shapes and by words said twice, damped, weighted by inverse
document frequency and projected on the leading singular vectors of a bounded labelled sample. The
sample's vectors are broadcast; every document is compared with all of them in blocks, and its
nearest neighbours vote with their cosine similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.labelled import remainder, sample
from candela.llm.words import SPACED, Words, blocks, small_batches

#: Most labelled rows learned from, by label; their vectors are what is broadcast.
SAMPLE = {0: 1500, 1: 1500}
RAW, SHAPES, REPEATS, DIMENSIONS, NEIGHBOURS = 2048, 2048, 16, 48, 15
#: A repeated word counts as much as this many n-grams.
REPEAT_WEIGHT = 4.0
BLOCK_ROWS = 512

_SHAPE = np.arange(256, dtype=np.uint32)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_SHAPE[0x80:] = ord("a")


def _counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Damped n-gram counts, a row for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, RAW + SHAPES + REPEATS), np.float32)
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    for values, k, begin, width in ((data.astype(np.uint32), 2, 0, RAW), (_SHAPE[data], 3, RAW, SHAPES)):
        size = len(data) - k + 1
        if size <= 0:
            continue
        code = values[:size].copy()
        for d in range(1, k):
            code = code * np.uint32(0x01000193) ^ values[d : d + size]
        code *= np.uint32(0x9E3779B1)
        cell = (code >> np.uint32(32 - width.bit_length() + 1)).astype(np.int64)
        same = row[:size] == row[k - 1 :]
        out[:, begin : begin + width] = np.bincount((row[:size] * width + cell)[same], minlength=n * width).reshape(n, width)
    w = Words(data, offsets, SPACED, lower=True)
    h, word_row = w.hashes(), w.rows()
    again = np.flatnonzero((h[1:] == h[:-1]) & (word_row[1:] == word_row[:-1]))
    cell = word_row[again] * REPEATS + (h[again] % np.uint64(REPEATS)).astype(np.int64)
    out[:, RAW + SHAPES :] = np.bincount(cell, minlength=n * REPEATS).reshape(n, REPEATS)
    np.log1p(out, out=out)
    out[:, RAW + SHAPES :] *= REPEAT_WEIGHT
    return out


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """Slices of at most BLOCK_ROWS rows."""
    for a in range(0, len(offsets) - 1, BLOCK_ROWS):
        part = offsets[a : a + BLOCK_ROWS + 1]
        yield data[part[0] : part[-1]], part - part[0]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def latent_space(x: np.ndarray, dimensions: int) -> np.ndarray:
    """Leading right singular vectors of ``x`` as columns, by randomised subspace iteration."""
    rng = np.random.default_rng(5)
    width = min(dimensions + 8, *x.shape)
    q = np.linalg.qr(x @ rng.standard_normal((x.shape[1], width)).astype(np.float32))[0]
    for _ in range(4):
        q = np.linalg.qr(x @ (x.T @ q))[0]
    return np.linalg.svd(q.T @ x, full_matrices=False)[2][:dimensions].T.astype(np.float32)


def votes(vectors: np.ndarray, known: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """Share of the k nearest known vectors' similarity that has label 1; exact over all of them."""
    likeness = vectors @ known.T
    k = min(k, len(known))
    top = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(likeness, top, 1), 0) + 1e-9
    return np.clip((weight * labels[top]).sum(1) / weight.sum(1), 0, 1)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most: dict[int, int] = SAMPLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document row: doc_id, held_out, score (0 to 1), predicted, and the ``carry`` columns.

    Learns from at most ``most`` labelled rows of each label, none of them held out. Null and empty
    texts have the null vector, whose neighbours all count alike: they get the sample's mean label.
    Without usable labels every score is 0.5. Repeated rows get equal scores; other columns are
    ignored, whatever their names.
    """
    spark = small_batches(docs.sparkSession)

    def count(batches):
        for batch in batches:
            for first, data, offsets in blocks(batch.column("text")):
                at = first
                for part, cuts in _pieces(data, offsets):
                    x = _counts(part, cuts)
                    rows = [r.tobytes() for r in x.astype(np.float16)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(rows)).cast(pa.int64()), batch.column("label").slice(at, len(rows)).cast(pa.int32()), pa.array(rows, pa.binary())], names=["doc_id", "label", "x"])
                    at += len(rows)

    table = sample(docs, labels, "quality", most).mapInArrow(count, "doc_id long, label int, x binary").toArrow()  # sum(most) rows
    table = table.sort_by("doc_id")
    model = None
    if len(table):
        x = np.stack([np.frombuffer(r.as_py(), np.float16) for r in table.column("x")]).astype(np.float32)
        y = table.column("label").to_numpy().astype(np.float64)
        idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
        x = _unit(x * idf)
        axes = latent_space(x, DIMENSIONS)
        model = idf[:, None] * axes, _unit(x @ axes), y
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        for batch in batches:
            out = [np.zeros(0)]
            for _, data, offsets in blocks(batch.column("text")):
                for part, cuts in _pieces(data, offsets):
                    if model is None:
                        out.append(np.full(len(cuts) - 1, 0.5))
                        continue
                    project, known, y = model
                    vectors = _unit(_counts(part, cuts) @ project)
                    s = votes(vectors, known, y, NEIGHBOURS)
                    s[np.diff(cuts) == 0] = y.mean()
                    out.append(s)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out)), *batch.columns[2:]], names=["doc_id", "score", *batch.schema.names[2:]])

    types = dict(docs.dtypes)
    schema = f"doc_id {types['doc_id']}, score double" + "".join(f", `_carry_{c}` {types[c]}" for c in carry)
    scored = docs.select("doc_id", "text", *(F.col(c).alias(f"_carry_{c}") for c in carry)).mapInArrow(score, schema)
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
        *(F.col(f"_carry_{c}").alias(c) for c in carry),
    )
