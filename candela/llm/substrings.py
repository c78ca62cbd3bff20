"""Exact removal of repeated word windows by super-k-mer partitioning.

The smallest hash among the short word groups of a window, its minimiser, depends on the window's
words only, so equal windows agree on it. Consecutive windows with one bucket travel as one packed
string; each bucket sorts its windows and keeps the first of equal ones. Windows repeated inside a
block of documents are settled before the shuffle, so a passage copied into a third of all documents
reaches its bucket once per block. Buckets are sized from counts over all windows; where a minimiser
is too common, a second one, under another order, splits it by content.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.words import BLOCK_BYTES, SPACED, Words, blocks, grams, mix, sliding_min, small_batches, spaced

#: Words of a minimiser.
GROUP = 3
#: Minimisers are counted in this many cells.
CELLS = 1 << 14
#: Windows of a bucket, about; at 200 bytes each a bucket fits easily into a Python worker.
BUCKET_WINDOWS = 400_000
#: Bytes of text whose repeats are settled before the shuffle.
SETTLED_BYTES = 3 * BLOCK_BYTES

NO_ID = -(2**63)


def _minimisers(hashes, first, window, salt):
    """(first word of each window, minimiser), windows of one row side by side."""
    at, g = grams(hashes, first, GROUP, salt)
    width = window - GROUP + 1
    if len(g) < width:
        return at[:0], g[:0]
    low = sliding_min(g, width)
    real = at[width - 1 :] - at[: len(low)] == width - 1
    return at[: len(low)][real], low[real]


def _cell_counts(window):
    def run(batches):
        counts = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, data, offsets in blocks(batch.column("text")):
                w = Words(data, offsets, SPACED)
                _, low = _minimisers(w.hashes(), w.first, window, 0)
                counts += np.bincount((low & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["cell", "n"])

    return run


def bucket_layout(counts: np.ndarray, size: int = BUCKET_WINDOWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bucket, number of buckets and hot flag of every cell.

    Small cells share a bucket, larger ones are split by their minimisers; a cell of over four times
    the mean holds a common minimiser and is split by a second one.
    """
    parts = np.maximum(1, -(-counts // size))
    hot = (counts > 4 * max(1.0, counts.mean())) & (parts > 1)
    small = np.where(parts == 1, counts, 0)
    shared = np.cumsum(small) // size
    own = np.concatenate([[0], np.cumsum(np.where(parts > 1, parts, 0))[:-1]])
    return np.where(parts == 1, shared, shared.max() + 1 + own), parts, hot


def _later(h, ids, at, lo, hi, text: bytes) -> np.ndarray:
    """Which windows stand earlier as well. Windows come in order of (ids, at); text[lo:hi] is a window.

    Equal hashes are checked against the text; where they lie, the text itself decides.
    """
    n = len(h)
    if not n:
        return np.zeros(0, bool)
    order = np.argsort(h, kind="stable")
    head = np.ones(n, bool)
    head[1:] = h[order][1:] != h[order][:-1]
    source = np.empty(n, np.int64)
    source[order] = order[np.flatnonzero(head)][np.cumsum(head) - 1]
    own = np.arange(n)
    copy = source != own
    spot = np.flatnonzero(copy)
    if not len(spot):
        return copy
    # Where both sides step one word on, one comparison covers the whole run.
    chained = np.zeros(len(spot), bool)
    step = lambda x: (ids[x[1:]] == ids[x[:-1]]) & (at[x[1:]] == at[x[:-1]] + 1) & (x[1:] == x[:-1] + 1) & (lo[x[1:]] < hi[x[:-1]])
    chained[1:] = step(spot) & step(source[spot])
    begins = np.flatnonzero(~chained)
    stops = np.append(begins[1:], len(spot)) - 1
    a, b = spot[begins], spot[stops]
    c, d = source[a], source[b]
    for p, q, r, s in zip(lo[a].tolist(), hi[b].tolist(), lo[c].tolist(), hi[d].tolist(), strict=True):
        if text[p:q] != text[r:s]:
            seen: dict[bytes, int] = {}
            for i in range(n):
                source[i] = seen.setdefault(text[lo[i] : hi[i]], i)
            break
    return (source != own) & ((ids[source] != ids) | (at[source] != at))


def _spans(begin: np.ndarray, row: np.ndarray, window: int):
    """Maximal runs of covered words: (row, start, stop) from window starts sorted by (row, start)."""
    if not len(begin):
        return row, begin, begin
    new = np.ones(len(begin), bool)
    new[1:] = (row[1:] != row[:-1]) | (begin[1:] > begin[:-1] + window)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(begin)) - 1
    return row[heads], begin[heads], begin[tails] + window


_CODEC = pa.Codec("zstd", compression_level=3)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compress better."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).ravel()


def _pack(ids, tags, starts, sizes, text: bytes) -> bytes:
    """One packed string: ids as steps, tags, starts, numbers of windows, words."""
    raw = struct.pack("<q", len(ids)) + _planes(np.diff(ids, prepend=0)) + tags.tobytes() + _planes(starts.astype(np.int32)) + _planes(sizes.astype(np.int32)) + text
    return struct.pack("<q", len(raw)) + _CODEC.compress(raw, asbytes=True)


def _unpack(blob: bytes):
    raw = _CODEC.decompress(blob[8:], struct.unpack("<q", blob[:8])[0], asbytes=True)
    n = struct.unpack("<q", raw[:8])[0]
    ids = np.cumsum(_from_planes(raw, np.int64, n, 8))
    tags = np.frombuffer(raw, np.int32, n, 8 + 8 * n)
    starts, sizes = (_from_planes(raw, np.int32, n, 8 + k * n) for k in (12, 16))
    return ids, tags, starts, sizes, raw[8 + 20 * n :]


def _rows(ids, tags, spans) -> pa.RecordBatch:
    """Rows of (_id, _tag, spans); spans are (row, start, stop) arrays sorted by row."""
    row, start, stop = spans
    used, begin = np.unique(row, return_index=True)
    flat = np.empty(2 * len(row), np.int32)
    flat[::2], flat[1::2] = start, stop
    lists = pa.ListArray.from_arrays(pa.array(np.append(2 * begin, len(flat)).astype(np.int32)), pa.array(flat))
    return pa.RecordBatch.from_arrays([pa.array(ids[used]), pa.array(tags[used]), lists], names=["_id", "_tag", "spans"])


_SEND = "bucket long, _id long, _tag int, spans array<int>, packed binary"


def _send(layout, window):
    def block(ids, tags, data, offsets, place):
        first_bucket, parts, hot = place
        order = np.argsort(ids, kind="stable")
        if (order[1:] < order[:-1]).any():
            sizes = np.diff(offsets)[order]
            data = np.concatenate([data[offsets[r] : offsets[r + 1]] for r in order]) if len(data) else data
            offsets, ids, tags = np.concatenate([[0], np.cumsum(sizes)]), ids[order], tags[order]
        data, offsets = spaced(data, offsets)
        w = Words(data, offsets, SPACED)
        h = w.hashes()
        begin, low = _minimisers(h, w.first, window, 0)
        if not len(begin):
            return
        _, key = grams(h, w.first, window, 7)
        text = data.tobytes()
        row = np.searchsorted(w.first, begin, "right") - 1
        at = begin - w.first[row]
        lo, hi = w.starts[begin], w.ends[begin + window - 1]
        rank = ids[row]
        if len(np.unique(ids)) < len(ids):
            by = np.lexsort((at, rank))
            later = np.empty(len(by), bool)
            later[by] = _later(key[by], rank[by], at[by], lo[by], hi[by], text)
        else:
            later = _later(key, rank, at, lo, hi, text)
        if later.any():
            spans = _spans(at[later], row[later], window)
            rows = _rows(ids, tags, spans)
            through = mix(rows.column(0).to_numpy().view(np.uint64)) % np.uint64(first_bucket.max() + 1)
            yield pa.RecordBatch.from_arrays([pa.array(through.astype(np.int64)), *rows.columns, pa.nulls(len(rows), pa.binary())], schema=SENT)
        cell = (low & np.uint64(CELLS - 1)).astype(np.int64)
        split = mix(low, 1)
        if hot[cell].any():
            _, other = _minimisers(h, w.first, window, 1)
            split = np.where(hot[cell], mix(other, 1), split)
        bucket = first_bucket[cell] + (split % parts[cell].astype(np.uint64)).astype(np.int64)
        go = np.flatnonzero(~later)
        if not len(go):
            return
        new = np.ones(len(go), bool)
        new[1:] = (go[1:] != go[:-1] + 1) | (row[go][1:] != row[go][:-1]) | (bucket[go][1:] != bucket[go][:-1])
        heads = go[new]
        tails = go[np.append(np.flatnonzero(new)[1:], len(go)) - 1]
        by = np.argsort(bucket[heads], kind="stable")
        heads, tails = heads[by], tails[by]
        cuts = np.flatnonzero(np.diff(bucket[heads])) + 1
        bounds = [0, *cuts.tolist(), len(heads)]
        slices = [text[a:b] for a, b in zip(lo[heads].tolist(), hi[tails].tolist(), strict=True)]
        numbers, packed = [], []
        for a, b in zip(bounds, bounds[1:], strict=False):
            part = heads[a:b]
            numbers.append(int(bucket[part[0]]))
            packed.append(_pack(ids[row[part]], tags[row[part]], at[part], tails[a:b] - part + 1, b"\n".join(slices[a:b])))
        none = len(numbers)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.list_(pa.int32())), pa.array(packed, pa.binary())], schema=SENT)

    def run(batches):
        place = layout.value
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_tag"))
            for row, data, offsets in blocks(batch.column("text"), SETTLED_BYTES):
                n = len(offsets) - 1
                yield from block(ids[row : row + n], tags[row : row + n], data, offsets, place)

    return run


SENT = pa.schema(
    [("bucket", pa.int64()), ("_id", pa.int64()), ("_tag", pa.int32()), ("spans", pa.list_(pa.int32())), ("packed", pa.binary())]
)


def _sort_bucket(window):
    def run(table: pa.Table) -> pa.Table:
        found = [table.select(["_id", "_tag", "spans"]).filter(table.column("spans").is_valid())]
        parts = [_unpack(b.as_py()) for b in table.column("packed") if b.is_valid]
        if parts:
            ids, tags, starts, sizes = (np.concatenate([p[i] for p in parts]) for i in range(4))
            text = b"\n".join(p[4] for p in parts)
            data = np.frombuffer(text, np.uint8)
            ends_of = np.flatnonzero(data == 0x0A)
            offsets = np.concatenate([[0], ends_of + 1, [len(data)]])
            w = Words(data, offsets, SPACED)
            begin, key = grams(w.hashes(), w.first, window, 7)
            run_of = np.searchsorted(w.first, begin, "right") - 1
            at = starts[run_of] + begin - w.first[run_of]
            lo, hi = w.starts[begin], w.ends[begin + window - 1]
            by = np.lexsort((at, tags[run_of], ids[run_of]))
            later = _later(key[by], ids[run_of][by], at[by], lo[by], hi[by], text)
            gone = by[later]
            if len(gone):
                i, t, s = ids[run_of][gone], tags[run_of][gone], at[gone]
                doc = np.concatenate([[0], np.cumsum((i[1:] != i[:-1]) | (t[1:] != t[:-1]))])
                head = np.unique(doc, return_index=True)[1]
                found.append(pa.Table.from_batches([_rows(i[head], t[head], _spans(s, doc, window))]))
        return pa.concat_tables([f.cast(found[0].schema) for f in found])

    return run


def _identity() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.hash("text").alias("_tag")]


def repeated_spans(docs: DataFrame, window: int = 20) -> DataFrame:
    """(_id, _tag, spans): for each document with later copies of a window, [start, stop, ...] of the
    words they cover, in any order and possibly overlapping. ``_id`` is the id or the smallest long
    for null, ``_tag`` the text's hash."""
    spark = small_batches(docs.sparkSession)
    texts = docs.select("text")
    counts = np.zeros(CELLS, np.int64)
    totals = texts.mapInArrow(_cell_counts(window), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for cell, n in totals.collect():  # CELLS rows at most
        counts[cell] = n
    layout = spark.sparkContext.broadcast(bucket_layout(counts))
    sent = docs.select(*_identity(), "text").mapInArrow(_send(layout, window), _SEND)
    return (
        sent.groupBy("bucket")
        .applyInArrow(_sort_bucket(window), "_id long, _tag int, spans array<int>")
        .groupBy("_id", "_tag")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def _cut(batches):
    for batch in batches:
        spans = batch.column("spans")
        words, removed, digest, kept_text = [], [], [], []
        for row, data, offsets in blocks(batch.column("text")):
            data, offsets = spaced(data, offsets)
            w = Words(data, offsets, SPACED)
            text = data.tobytes()
            for r in range(len(offsets) - 1):
                a, b = int(w.first[r]), int(w.first[r + 1])
                cut = spans[row + r].as_py()
                if not cut:
                    kept = text[w.starts[a] : w.ends[b - 1]] if b > a else b""
                    gone = 0
                else:
                    keep = np.zeros(b - a + 1, np.int32)
                    np.add.at(keep, cut[::2], 1)
                    np.add.at(keep, cut[1::2], -1)
                    keep = np.cumsum(keep)[:-1] == 0
                    gone = int((~keep).sum())
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], keep, [0]])))
                    kept = b" ".join(text[w.starts[a + i] : w.ends[a + j - 1]] for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
                words.append(b - a)
                removed.append(gone)
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept.decode("utf-8") if gone else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept_text, pa.string()), *batch.columns[3:]],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", *batch.schema.names[3:]],
        )


def remove_repeats(docs: DataFrame, window: int = 20, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_sha256, kept, and the ``carry`` columns.

    A word goes if a run of ``window`` words over it also starts at a smaller (doc_id, word) in the
    input. ``kept`` is the remaining words joined by one space, null where nothing was removed.
    Null and empty texts have no words; a null id counts as smaller than all others. Rows that share an id
    are copies of one document: equal windows at the same word of them do not remove each other.
    An empty table gives an empty result; columns not named in ``carry`` are ignored.
    """
    spans = repeated_spans(docs, window).hint("shuffle_hash")
    texts = docs.select("doc_id", "text", *(F.col(c).alias(f"_carry_{c}") for c in carry), *_identity())
    joined = texts.join(spans, ["_id", "_tag"], "left").select("doc_id", "text", "spans", *(f"_carry_{c}" for c in carry))
    types = dict(docs.dtypes)
    schema = f"doc_id {types['doc_id']}, n_words long, n_removed long, kept_sha256 string, kept string"
    schema += "".join(f", `_carry_{c}` {types[c]}" for c in carry)
    return joined.mapInArrow(_cut, schema).withColumnsRenamed({f"_carry_{c}": c for c in carry})
