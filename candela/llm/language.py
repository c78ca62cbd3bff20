"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample. It labels every
byte of a text; a text is run in segments side by side, and the probabilities of all its bytes are
averaged. Text is lower-cased (A-Z) and other ASCII characters but letters are blanks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.labelled import remainder
from candela.llm.words import blocks, small_batches

HIDDEN = 8
#: Documents learned from, at most, of each language. All languages are learned.
SAMPLE = 400
SEGMENT, TRAIN_SEGMENT = 128, 64
STEPS, BATCH, RATE = 400, 128, 0.015
#: STEPS serve so many languages; more languages take more steps, so that each is drawn as often.
SERVED = 64
#: Segments drawn from a long training text: DRAWN over the number of languages, LEAST_DRAWN at least.
DRAWN, LEAST_DRAWN = 512, 4
LANES = 512

_INPUT = np.full(256, 0x20, np.uint8)
_INPUT[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_INPUT[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_INPUT[0x80:] = np.arange(0x80, 0x100)


def new_network(classes: int, rng: np.random.Generator, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Per direction: input gates by byte, recurrent gates (update, reset, candidate); the output layer."""
    net = {}
    for side in "fb":
        net[f"x{side}"] = rng.normal(0, 0.5, (256, 3 * hidden))
        net[f"u{side}"] = rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, 3 * hidden))
    net["v"] = rng.normal(0, 0.3, (2 * hidden, classes))
    net["c"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in net.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


def train_direction(x: np.ndarray, u: np.ndarray, codes: np.ndarray):
    """States after each step of ``codes`` (steps, lanes), and per step the gates, candidates and
    recurrent candidate inputs that training needs."""
    steps, lanes = codes.shape
    hidden = u.shape[0]
    states = np.empty((steps, lanes, hidden), np.float32)
    gates, candidates, recurrent = [], [], []
    h = np.zeros((lanes, hidden), np.float32)
    for t in range(steps):
        given, memory = x[codes[t]], h @ u
        zr = _sigmoid(given[:, : 2 * hidden] + memory[:, : 2 * hidden])
        z, r, m = zr[:, :hidden], zr[:, hidden:], memory[:, 2 * hidden :]
        n = np.tanh(given[:, 2 * hidden :] + r * m)
        h = n + z * (h - n)
        states[t] = h
        gates.append(zr)
        candidates.append(n)
        recurrent.append(m.copy())
    return states, gates, candidates, recurrent


def run_direction(x: np.ndarray, u: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The states alone, faster: gates apart and in place, sigmoids as (1 + tanh(a / 2)) / 2."""
    steps, lanes = codes.shape
    hidden = u.shape[0]
    half = np.float32(0.5)
    xz, xr, xn = (np.ascontiguousarray(part) for part in np.split(x, 3, axis=1))
    uz, ur, un = (half * part for part in np.split(u, 3, axis=1))
    xz, xr = half * xz, half * xr
    states = np.empty((steps, lanes, hidden), np.float32)
    z, r, n, m = (np.empty((lanes, hidden), np.float32) for _ in range(4))
    h = np.zeros((lanes, hidden), np.float32)
    for t in range(steps):
        code = codes[t]
        np.take(xr, code, 0, out=n, mode="clip")
        np.matmul(h, ur, out=r)
        r += n
        np.tanh(r, out=r)
        np.matmul(h, un, out=m)
        r *= m
        r += m
        np.take(xn, code, 0, out=n, mode="clip")
        n += r
        np.tanh(n, out=n)
        np.take(xz, code, 0, out=m, mode="clip")
        np.matmul(h, uz, out=z)
        z += m
        np.tanh(z, out=z)
        np.subtract(h, n, out=m)
        z *= m
        z += h
        z += n
        h = np.multiply(z, half, out=states[t])
    return states


def back_direction(u: np.ndarray, codes: np.ndarray, kept, upstream: np.ndarray):
    """Gradients of the input and recurrent gates, by backpropagation through time."""
    states, gates, candidates, recurrent = kept
    steps, lanes = codes.shape
    hidden = u.shape[0]
    grad_u = np.zeros_like(u)
    inputs = np.empty((steps, lanes, 3 * hidden), np.float32)
    dh = np.zeros((lanes, hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        before = states[t - 1] if t else np.zeros((lanes, hidden), np.float32)
        z, r, n = gates[t][:, :hidden], gates[t][:, hidden:], candidates[t]
        dh = dh + upstream[t]
        dn = dh * (1 - z) * (1 - n * n)
        dr = dn * recurrent[t] * r * (1 - r)
        dz = dh * (before - n) * z * (1 - z)
        inputs[t] = np.concatenate([dz, dr, dn], axis=1)
        through = np.concatenate([dz, dr, dn * r], axis=1)
        grad_u += before.T @ through
        dh = dh * z + through @ u.T
    grad_x = np.zeros((256, 3 * hidden), np.float32)
    flat, order = inputs.reshape(-1, 3 * hidden), np.argsort(codes, axis=None, kind="stable")
    seen, first = np.unique(codes.ravel()[order], return_index=True)
    grad_x[seen] = np.add.reduceat(flat[order], first, axis=0)
    return grad_x, grad_u


def gradients(net, codes: np.ndarray, labels: np.ndarray):
    """(loss, gradients) of the mean cross-entropy over all positions; codes are (steps, lanes)."""
    forward = train_direction(net["xf"], net["uf"], codes)
    backward = train_direction(net["xb"], net["ub"], codes[::-1])
    both = np.concatenate([forward[0], backward[0][::-1]], axis=2)
    logits = both @ net["v"] + net["c"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    n = codes.size
    loss = -np.log(np.maximum(p[:, np.arange(len(labels)), labels], 1e-12)).mean()
    p[:, np.arange(len(labels)), labels] -= 1
    p /= n
    out = {"v": both.reshape(n, -1).T @ p.reshape(n, -1), "c": p.sum(axis=(0, 1))}
    up = p @ net["v"].T
    hidden = net["uf"].shape[0]
    out["xf"], out["uf"] = back_direction(net["uf"], codes, forward, up[:, :, :hidden])
    out["xb"], out["ub"] = back_direction(net["ub"], codes[::-1], backward, up[::-1, :, hidden:])
    return float(loss), out


def spread(text: bytes, count: int) -> bytes:
    """``count`` training segments from all over a text, end to end; a text that is not longer as it is."""
    if len(text) <= count * TRAIN_SEGMENT:
        return text
    begins = np.random.default_rng(zlib.crc32(text)).integers(0, len(text) - TRAIN_SEGMENT + 1, count)
    return b"".join(text[b : b + TRAIN_SEGMENT] for b in begins.tolist())


def train(texts: list[bytes], labels: np.ndarray, classes: int, steps: int = STEPS, seed: int = 7, count: int = 0) -> dict[str, np.ndarray]:
    """A network fitted by Adam to random segments, languages drawn evenly.

    Texts as long as ``count`` segments are taken for segments end to end, and no other is cut from them.
    """
    rng = np.random.default_rng(seed)
    net = new_network(classes, rng)
    coded = [_INPUT[np.frombuffer(t, np.uint8)] for t in texts]
    by_class = [np.flatnonzero(labels == c) for c in range(classes)]
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    for step in range(1, steps + 1):
        lanes = np.full((BATCH, TRAIN_SEGMENT), 0x20, np.uint8)
        picked = rng.integers(0, classes, BATCH)
        for i, c in enumerate(picked):
            text = coded[rng.choice(by_class[c])]
            if count and len(text) == count * TRAIN_SEGMENT:
                begin = rng.integers(0, count) * TRAIN_SEGMENT
            else:
                begin = rng.integers(0, max(1, len(text) - TRAIN_SEGMENT + 1))
            part = text[begin : begin + TRAIN_SEGMENT]
            lanes[i, : len(part)] = part
        _, grads = gradients(net, np.ascontiguousarray(lanes.T), picked)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * min(1.0, 1.0 / max(size, 1e-9)) if size > 1 else RATE
        rate *= 1 - 0.9 * step / steps
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            net[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def probabilities(net, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean class probabilities over all bytes of each text; rows of empty texts are 0."""
    size = np.diff(offsets)
    pieces = -(-size // SEGMENT)
    row = np.repeat(np.arange(len(size)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = offsets[:-1][row] + nth * SEGMENT
    length = np.minimum(SEGMENT, offsets[1:][row] - begin)
    order = np.argsort(-length, kind="stable")
    classes, hidden = len(net["c"]), len(net["uf"])
    sums = np.zeros((len(row), classes))
    coded = np.append(_INPUT[data], np.full(SEGMENT, 0x20, np.uint8))
    for a in range(0, len(row), LANES):
        part = order[a : a + LANES]
        steps = int(length[part].max())
        at = np.arange(steps)
        codes = np.where(at < length[part][:, None], coded[begin[part][:, None] + at], np.uint8(0x20)).T.copy()
        f = run_direction(net["xf"], net["uf"], codes)
        b = run_direction(net["xb"], net["ub"], codes[::-1])[::-1]
        # States are between -1 and 1, so the exponents stay small.
        logits = net["v"][:hidden].T @ f.reshape(-1, hidden).T
        logits += net["v"][hidden:].T @ b.reshape(-1, hidden).T
        logits += net["c"][:, None]
        np.exp(logits, out=logits)
        logits *= (at[:, None] < length[part]).ravel() / logits.sum(axis=0)
        sums[part] = logits.reshape(classes, steps, -1).sum(axis=1).T
    out = np.zeros((len(size), classes))
    np.add.at(out, row, sums)
    return out / np.maximum(size, 1)[:, None]


def languages(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """One row per document row: doc_id, held_out, lang_pred, score (0 to 1).

    Learns every language, from at most ``most`` documents of each, none of them held out (crc32 of the id
    as text modulo 4 is 2); of a long one, from segments all over it. Null texts and texts without a letter are 'und' with score 0; so is all
    if no language can be learned. Rows without an id are not learned from and count as the id 'null'. Repeated rows
    get equal results; other columns are ignored, whatever their names.
    """
    spark, kind = small_batches(docs.sparkSession), docs.schema["doc_id"].dataType.simpleString()
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") > 0) & (remainder("doc_id", 4) != 2))
    names = [r.lang for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # Ids beyond ``most`` are cut off in each task; a repeated id counts once.
    chosen = usable.select("doc_id", "lang").withColumn("rank", F.dense_rank().over(by_hash)).where(F.col("rank") <= most).select("doc_id", "lang").distinct()
    rows = usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])  # languages * most rows
    # Of rows that share an id and a language the one with the smallest text hash is learned.
    rows = rows.groupBy("doc_id", "lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    net = None
    if names:
        count, place = max(LEAST_DRAWN, DRAWN // len(names)), {name: i for i, name in enumerate(names)}

        def drawn(batches):
            for batch in batches:
                parts = [spread(t.encode(), count) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(parts, pa.binary())], names=["doc_id", "lang", "part"])

        known = rows.mapInArrow(drawn, f"doc_id {kind}, lang string, part binary").toArrow().sort_by([("doc_id", "ascending"), ("lang", "ascending")]).to_pylist()
        net = train([r["part"] for r in known], np.array([place[r["lang"]] for r in known]), len(names), STEPS * -(-len(names) // SERVED), count=count)
    shared = spark.sparkContext.broadcast((names, net))

    def label(batches):
        names, net = shared.value
        for batch in batches:
            text = batch.column("text")
            found, score = [], []
            for first, data, offsets in blocks(text):
                lettered = np.zeros(len(data) + 1, np.int64)
                np.cumsum((_INPUT[data] != 0x20) & (data < 0x80), out=lettered[1:])
                has = np.diff(lettered[offsets]) > 0
                for r in np.flatnonzero(~has & (np.diff(offsets) > 0)):
                    has[r] = any(c.isalpha() for c in text[first + int(r)].as_py())
                p = probabilities(net, data, offsets) if net else np.zeros((len(has), 1))
                has &= bool(net)
                best = p.argmax(axis=1)
                found += [names[b] if h else "und" for b, h in zip(best, has, strict=True)]
                score.append(np.where(has, np.clip(p[np.arange(len(best)), best], 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string()), pa.array(np.concatenate(score) if score else np.zeros(0))], names=["doc_id", "lang_pred", "score"])

    found = docs.select("doc_id", "text").mapInArrow(label, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
