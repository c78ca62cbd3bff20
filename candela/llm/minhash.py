"""MinHash fingerprints of whole texts, and near copies by signature bands.

Shingles are runs of five lower-cased words (the whole text if it has fewer); texts of at most 256
bytes, where words say little, add their runs of four bytes. Each of 128 universal hash functions,
applied to whole blocks of shingles in numpy, keeps the least value per document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.components import components
from candela.llm.ngram_join import LARGE, _alike, _near_in_group, _signature, shingle_sets
from candela.llm.words import _LOWER, SPACED, Words, blocks, grams, mix
from candela.session import materialize

SLOTS, WORDS, SHORT_BYTES, SHORT_RUN = 128, 5, 256, 4
#: 32 bands of 4 slots find a pair of similarity 0.75 with probability 1 - (1 - 0.75^4)^32 > 0.9999.
BANDS = 32
#: A range of ids for this much text; a range is sorted and streamed, never held, so larger ones would do.
#: Rows whose texts are held at once.
ROWS = 512
PART_BYTES, MOST_PARTS = 16 << 20, 1 << 16

_rng = np.random.default_rng(1729)
_FACTORS = _rng.integers(0, 2**63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**64, SLOTS, dtype=np.uint64)
NOTHING = (1 << 32) - 1


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit shingles, first): shingles of row r are at first[r]:first[r + 1]."""
    w = Words(data, offsets, SPACED, lower=True)
    h = w.hashes()
    at, g = grams(h, w.first, WORDS)
    row = np.searchsorted(w.first, at, "right") - 1
    parts, rows = [g], [row]
    for k in range(1, WORDS):
        few = np.flatnonzero(w.counts == k)
        if len(few):
            begin, s = grams(h, w.first, k)
            parts.append(s[np.searchsorted(begin, w.first[few])])
            rows.append(few)
    size = np.diff(offsets)
    short = np.flatnonzero((size > 0) & (size <= SHORT_BYTES))
    if len(short):
        low = _LOWER[data].astype(np.uint64)
        runs = np.maximum(size[short] - SHORT_RUN + 1, 1)
        begin = np.repeat(offsets[short], runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        stop = np.repeat(offsets[short + 1], runs)
        code = np.zeros(len(begin), np.uint64)
        for d in range(SHORT_RUN):
            code = code * np.uint64(257) + np.where(begin + d < stop, low[np.minimum(begin + d, len(low) - 1)] + np.uint64(1), np.uint64(0))
        parts.append(mix(code, 9))
        rows.append(np.repeat(short, runs))
    if len(parts) > 1:
        row, g = np.concatenate(rows), np.concatenate(parts)
        order = np.argsort(row, kind="stable")
        row, g = row[order], g[order]
    return (g >> np.uint64(32)).astype(np.uint64), np.searchsorted(row, np.arange(len(offsets)))


def signatures(column: pa.Array) -> np.ndarray:
    """One row of 128 least hash values (uint32) per text; a text without shingles has all bits set."""
    out = np.full((len(column), SLOTS), NOTHING, np.uint32)
    for row, data, offsets in blocks(column):
        x, first = _shingles(data, offsets)
        some = np.flatnonzero(np.diff(first))
        if not len(some):
            continue
        begin, value = first[some], np.empty_like(x)
        for k in range(SLOTS):
            np.multiply(x, _FACTORS[k], out=value)
            value += _SHIFTS[k]
            out[row + some, k] = np.minimum.reduceat(value, begin) >> np.uint64(32)
    return out


def _text_of(signature: np.ndarray) -> list[str]:
    """16 bits of every slot as hex digits."""
    raw = signature.astype(np.uint16).astype(">u2").tobytes().hex()
    return [raw[i : i + 4 * SLOTS] for i in range(0, len(raw), 4 * SLOTS)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots of two arrays of fingerprints."""
    return (a.astype(np.uint16) == b.astype(np.uint16)).mean(axis=1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; null texts count as empty, equal texts have equal fingerprints."""

    def run(batches):
        for batch in batches:
            marks = _text_of(signatures(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint string")


def _compare(batches):
    """Rows in order of (part, place); each row's successor follows it, the part's last row is a guest."""
    held = None
    for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, len(whole), ROWS)):
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        n = len(batch)
        held = batch.slice(n - 1, 1)
        if n < 2:
            continue
        column = batch.column("text").fill_null("")
        texts = column.to_pylist()
        part, guest = batch.column("part").to_numpy(), batch.column("guest").to_numpy(zero_copy_only=False)
        own = np.flatnonzero((part[1:] == part[:-1]) & ~guest[:-1])
        chars = [len(texts[i]) for i in own]
        edited = pa.array([texts[i][: c - c // 3] + texts[i + 1][: c // 3] for i, c in zip(own.tolist(), chars, strict=True)], pa.string())
        first, second = signatures(column), signatures(edited)
        marks = _text_of(first)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(own)), pa.array(chars, pa.int64()), pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in edited], pa.string()), pa.array([marks[i] for i in own], pa.string()), pa.array(_text_of(second), pa.string()), pa.array(likeness(first[own], second)), pa.array(likeness(first[own], first[own + 1]))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its text edited with the next document's, and likenesses.

    The next document has the next smaller doc_id; the last one's is the first. Ids are cut into
    ranges, so the order needs no single task; the first document of each range is also sent to the
    range before it. A null id stands last; rows that share an id follow each other in order of their
    texts' hashes. A single row is its own next; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_id"))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0]
    parts = min(max(1, (size or 0) // PART_BYTES), MOST_PARTS)
    cuts = rows.agg(F.percentile_approx("_id", [k / parts for k in range(1, parts)], 100 * parts)).head()[0] if parts > 1 else []
    ranges = docs.sparkSession.sparkContext.broadcast(np.unique(np.array(cuts or [], np.int64)))  # MOST_PARTS numbers at most

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        return pd.Series(-np.searchsorted(ranges.value, ids.to_numpy())).astype("int32")

    rows = rows.withColumn("part", part("_id")).withColumn("_tie", F.xxhash64("text"))
    first = F.min(F.struct(F.expr("~_id").alias("id"), F.col("_tie").alias("tie")))
    heads = rows.groupBy("part").agg(first.alias("first")).orderBy("part").collect()  # one row per range
    before = {h.part: heads[i - 1].part for i, h in enumerate(heads)}
    if not heads:
        return rows.select("doc_id", F.lit(0).cast("long").alias("n_chars"), *(F.lit("").alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")), *(F.lit(0.0).alias(c) for c in ("near_edited", "near_next")))
    targets = docs.sparkSession.createDataFrame([(h.part, ~h.first.id, h.first.tie, before[h.part]) for h in heads], "part int, id long, tie long, target int")
    sent = (
        rows.join(F.broadcast(targets), ["part"])
        .withColumn("copies", F.when((F.col("_id") == F.col("id")) & (F.col("_tie") == F.col("tie")), F.expr("array(struct(part, false as guest), struct(target as part, true as guest))")).otherwise(F.expr("array(struct(part, false as guest))")))
        .select("doc_id", "text", "_id", "_tie", F.explode("copies").alias("c"))
        .select("doc_id", "text", "_id", "_tie", "c.part", "c.guest")
    )
    return (
        sent.repartition(max(len(heads), 1), "part")
        .sortWithinPartitions("part", "guest", F.desc("_id"), "_tie")
        .select("doc_id", "text", "part", "guest")
        .mapInArrow(_compare, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    )


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id): documents joined by near copies, found by bands of their signatures.

    Each text stands once for its copies. Documents that agree on a band are paired with the band's
    smallest document; then documents of a band that are still in different components are paired with
    one another, if a bound on the difference of their shingles allows it. A pair counts if the whole
    texts' 5-word shingles have a Jaccard similarity of 0.75 or more. Rows without an id link with nothing.
    """

    def bands(batches):
        for batch in batches:
            s = signatures(batch.column("text"))
            empty = (s == NOTHING).all(axis=1)
            keys = mix(s.reshape(len(s), BANDS, -1).astype(np.uint64) @ _FACTORS[: SLOTS // BANDS], 11)
            keys += np.arange(BANDS, dtype=np.uint64)
            lists = [[] if e else k for e, k in zip(empty, keys.view(np.int64).tolist(), strict=True)]
            sizes, marks = [], []
            for _, data, offsets in blocks(batch.column("text")):
                tokens, first = shingle_sets(data, offsets)
                sizes += np.diff(first).tolist()
                marks += [_signature(tokens[i:j]) for i, j in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("sha"), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                names=["node", "sha", "n", "signature", "bands"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    some = texts.where("node is not null and text is not null").distinct()
    hashed = some.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    index = materialize(hashed.mapInArrow(bands, "node long, sha string, n long, signature binary, bands array<long>").where("size(bands) > 0"), "bands")
    reps = index.groupBy("sha").agg(F.min("node").alias("rep"))
    owned = index.select("node", "sha").join(reps, "sha")
    copies = materialize(owned.where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct(), "copies")
    marked = materialize(index.join(owned.where("node = rep").select("node", "sha"), ["node", "sha"], "left_semi").select("node", "n", "signature", F.explode("bands").alias("band")), "marked")
    text = lambda x: some.toDF(x, f"text_{x}")
    alike = lambda pairs: pairs.join(text("a"), "a").join(text("b"), "b").mapInArrow(_alike, "a long, b long")
    hubs = marked.groupBy("band").agg(F.min("node").alias("b"), F.count("*").alias("held")).where("held > 1")
    links = materialize(alike(marked.select("node", "band").join(hubs, "band").where("node <> b").select(F.col("node").alias("a"), "b").distinct()), "hub-links").union(copies)
    # Bands of the same documents are looked at once. A large one is cut by size, as sizes of a link differ by a third at most.
    placed = marked.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    member = F.xxhash64("node", "signature")
    split = (
        placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("held"), F.bit_xor(member).alias("x"), F.sum(member % (1 << 40)).alias("y"))
        .where("low < high").groupBy("held", "x", "y").agg(F.min("band").alias("band")).select("band", "held")
    )
    level = F.floor(F.log("n") / F.log(F.lit(4 / 3))).cast("int")
    at = lambda place, guest: F.struct(place.alias("level"), F.lit(guest).alias("guest"))
    places = F.when(F.col("held") > LARGE, F.array(at(level, False), at(level + 1, True))).otherwise(F.array(at(F.lit(0), False)))
    groups = placed.join(split, "band").select("band", "node", "component", "n", "signature", F.explode(places).alias("at")).select("*", "at.level", "at.guest").drop("at")
    rest = groups.groupBy("band", "level").applyInArrow(_near_in_group, "a long, b long").distinct()
    found = components(links.union(alike(rest)))
    return texts.select("node").join(found, "node", "left").select(F.col("node").alias("doc_id"), F.coalesce("component", "node").alias("component_id"))
