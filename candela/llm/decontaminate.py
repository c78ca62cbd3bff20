"""Benchmark decontamination by winnowing.

Training and test texts keep the smallest 5-word hash of every 6 consecutive ones. Two texts that
share 10 words in a row then share a kept hash, so no such span is missed. A bitmap of fixed size
with the test hashes sieves the documents' hashes where they are made; what passes is extended to
the windows of ten words around it, and these windows, as text, are joined with the test windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.words import ALNUM, Words, blocks, grams, sliding_min, small_batches
from candela.session import materialize

GRAM = 5
#: Cells of the sieve. Its size is fixed; a full sieve lets more pass but loses nothing.
CELLS = 1 << 22

_COVERED = """aggregate(array_sort(spans), named_struct('n', 0L, 'stop', 0L),
  (a, x) -> named_struct('n', a.n + greatest(0L, x.stop - greatest(a.stop, x.start)),
                         'stop', greatest(a.stop, x.stop)), a -> a.n)"""


def _kept(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed k-grams: (index of the first word, hash); every tie is kept."""
    at, g = grams(hashes, first, GRAM)
    width = window - GRAM + 1
    if len(g) < width:
        return at[:0], g[:0]
    low = sliding_min(g, width)
    low = np.where(at[width - 1 :] - at[: len(low)] == width - 1, low, np.uint64(0))
    keep = np.zeros(len(g), bool)
    for d in range(width):
        keep[d : d + len(low)] |= g[d : d + len(low)] == low
    return at[keep], g[keep]


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


def _test_windows(window: int):
    def run(batches):
        for batch in batches:
            ids, out = batch.column("item_id"), []
            for row, data, offsets in blocks(batch.column("text")):
                w = Words(data, offsets, ALNUM, lower=True)
                h = w.hashes()
                fingerprint = dict(zip(*_kept(h, w.first, window), strict=True))
                whole = dict(zip(*grams(h, w.first, window, 1), strict=True))
                for r in range(len(offsets) - 1):
                    a, b = int(w.first[r]), int(w.first[r + 1])
                    if not a < b:
                        continue
                    size = min(window, b - a)
                    for s in range(a, b - size + 1):
                        if size == window:
                            cells = [int(fingerprint[p]) for p in range(s, s + window - GRAM + 1) if p in fingerprint]
                            cells.append(int(whole[s]))
                        else:
                            cells = [int(grams(h[a:b], np.array([0, b - a]), size, 1)[1][0])]
                        out.append((ids[row + r].as_py(), size, w.text(s, s + size).decode(), [c & (CELLS - 1) for c in cells]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int32()),
                 pa.array([x[2] for x in out], pa.string()), pa.array([x[3] for x in out], pa.list_(pa.int64()))],
                names=["item_id", "size", "words", "cells"])

    return run


def _candidates(sieve, window: int, short: list[int], carry: list[str]):
    def run(batches):
        full = np.unpackbits(np.frombuffer(sieve.value, np.uint8)).astype(bool)
        for batch in batches:
            counts, found = [], []
            for _, data, offsets in blocks(batch.column("text")):
                w = Words(data, offsets, ALNUM, lower=True)
                h = w.hashes()
                counts.append(w.counts)
                spans = []
                at, g = _kept(h, w.first, window)
                at = at[full[_cell(g)]]
                if len(at):
                    near = np.unique((at[:, None] - np.arange(window - GRAM + 1)).ravel())
                    begins, g = grams(h, w.first, window, 1)
                    begins = begins[full[_cell(g)]]
                    spans.append((window, np.intersect1d(near, begins)))
                for size in short:
                    begins, g = grams(h, w.first, size, 1)
                    spans.append((size, begins[full[_cell(g)]]))
                rows: list[list] = [[] for _ in range(len(offsets) - 1)]
                for size, begins in spans:
                    owner = np.searchsorted(w.first, begins, "right") - 1
                    for s, r in zip(begins.tolist(), owner.tolist(), strict=True):
                        start = s - int(w.first[r])
                        rows[r].append({"start": start, "stop": start + size, "words": w.text(s, s + size).decode()})
                found += rows
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("words", pa.string())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_row", "doc_id", *carry)), pa.array(n, pa.int64()), pa.array(found, kind)], names=["_row", "doc_id", *carry, "n_words", "found"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document row: doc_id, the ``carry`` columns, n_words, n_hit, n_items, items (sorted ids as strings).

    A word is hit if it lies in a run of ``window`` words that also stands in a benchmark text; a
    benchmark text of fewer words counts as one shorter run. Only A-Z are lower-cased. Null and empty
    texts have no words and hit nothing; an empty benchmark hits nothing. Rows that share a doc_id,
    and rows without one, are judged one by one. Copies of a benchmark row count once; an item
    without an id counts as the id ''. Other columns are ignored, whatever their names.
    """
    spark = small_batches(docs.sparkSession)
    tests = materialize(
        benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(
            _test_windows(window), "item_id string, size int, words string, cells array<long>"
        ),
        "test-windows",
    )
    short = [r[0] for r in tests.where(F.col("size") < window).select("size").distinct().collect()]
    cells = tests.select(F.explode("cells").alias("cell")).distinct().toArrow().column(0).to_numpy()  # CELLS at most
    bits = np.zeros(CELLS, bool)
    bits[cells] = True
    sieve = spark.sparkContext.broadcast(np.packbits(bits).tobytes())
    types = dict(docs.dtypes)
    carried = [f"_carry_{c}" for c in carry]
    carried_types = "".join(f"`_carry_{c}` {types[c]}, " for c in carry)
    marked = materialize(
        docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text", *(F.col(c).alias(f"_carry_{c}") for c in carry)).mapInArrow(
            _candidates(sieve, window, sorted(short), carried),
            f"_row long, doc_id {types['doc_id']}, {carried_types}n_words long, found array<struct<start: long, stop: long, words: string>>",
        ),
        "marked",
    )
    windows = tests.select("words", F.coalesce("item_id", F.lit("")).alias("item_id")).distinct()
    hits = (
        marked.select("_row", F.inline("found"))
        .join(windows, "words")
        .groupBy("_row")
        .agg(
            F.collect_set(F.struct("start", "stop")).alias("spans"),
            F.array_sort(F.collect_set("item_id")).alias("items"),
        )
        .select("_row", F.expr(_COVERED).alias("n_hit"), "items")
    )
    return marked.join(hits, "_row", "left").select(
        "doc_id",
        *(F.col(f"_carry_{c}").alias(c) for c in carry),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", F.array().cast("array<string>"))).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
