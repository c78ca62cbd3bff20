"""Similarity join of documents on their 5-word shingles, by adaptive multi-match prefixes.

All shingle sets are sorted in one global order, rare shingles first. If two sets have a Jaccard
similarity of at least 3/4, their prefixes of length n - ceil(3n/4) + m share m shingles, so a
document with a longer prefix may ask for more matches before a pair is looked at. Each document
picks the m with the least estimated cost: entries written plus candidates expected, each by the
known counts of frequent shingles.

Pairs come in two passes, so that a group of copies never yields all its pairs. The first pairs each
document with the most central ones that share a prefix shingle. The second takes only pairs whose
documents the first left in different components. Both are sieved by a bound on the sets'
difference, from parity bitmaps of about two bits a shingle; then shared prefix shingles are counted,
and whole texts compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.components import components
from candela.llm.words import SPACED, Words, blocks, grams, mix, small_batches
from candela.session import materialize

WORDS = 5
#: Candidates cost this many times as much as an entry of the index.
PAIR_COST = 20.0
#: Most shingles asked for; longer prefixes never pay.
MOST_MATCHES = 8
#: Frequent shingles known by their counts: at most this many, each seen this often among so many
#: shingles of one task. The counts only order shingles and weigh costs; no pair depends on them.
FREQUENT, SEEN, COUNTED = 1 << 17, 2, 1 << 21
#: Turns of the first pass, hubs of a group and tries of a document in a turn, and the part (one in so many) of
#: a document's prefix that a hub must share. The second pass takes whatever the first leaves apart.
HUB_TURNS, HUBS, EVIDENCE = 1, 2, 6
#: A token held by more documents than this is split into several hub groups.
HUB_ROWS = 100_000
#: Groups of more documents are cut by size.
LARGE = 2000
#: Pairs of texts held at once.
PAIRS = 256
SIGNATURE = 1024  # bytes at most, 8192 bits


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): distinct shingles of row r are hashes[first[r]:first[r + 1]], sorted."""
    w = Words(data, offsets, SPACED, lower=True)
    h = w.hashes()
    at, g = grams(h, w.first, WORDS)
    row = np.searchsorted(w.first, at, "right") - 1
    counts = w.counts
    for k in range(1, WORDS):  # fewer words: the whole sequence
        short = np.flatnonzero(counts == k)
        if len(short):
            begin, s = grams(h, w.first, k)
            s = s[np.searchsorted(begin, w.first[short])]
            row, g = np.concatenate([row, short]), np.concatenate([g, s])
    order = np.argsort(g, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    row, g = row[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    row, g = row[new], g[new]
    return g, np.searchsorted(row, np.arange(len(offsets)))


def _frequent(batches):
    """(token, n) of the shingles that several documents of this task hold."""

    def counted(parts):
        tokens = np.concatenate(parts)
        tokens.sort()
        heads = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        n = np.diff(np.append(heads, len(tokens)))
        some = n >= SEEN
        return pa.RecordBatch.from_arrays([pa.array(tokens[heads[some]].view(np.int64)), pa.array(n[some])], names=["token", "n"])

    held, size = [], 0
    for batch in batches:
        for _, data, offsets in blocks(batch.column("text")):
            held.append(shingle_sets(data, offsets)[0])
            size += len(held[-1])
            if size >= COUNTED:
                yield counted(held)
                held, size = [], 0
    if size:
        yield counted(held)


def prefix_choice(counts: np.ndarray) -> tuple[int, int]:
    """(matches, length) of the cheapest prefix; ``counts`` are the documents holding each shingle, in order."""
    n = len(counts)
    overlap = (3 * n + 3) // 4
    most = min(overlap, MOST_MATCHES)
    length = n - overlap + np.arange(1, most + 1)
    entries = length.astype(float)
    postings = np.cumsum(counts - 1.0)[length - 1]
    cost = entries + postings + PAIR_COST * postings / np.arange(1, most + 1)
    best = int(np.argmin(cost))
    return best + 1, int(length[best])


def _signature(tokens: np.ndarray) -> bytes:
    """Parity bitmap: bit b tells whether an odd number of shingles fall on b."""
    bits = 64
    while bits < 2 * len(tokens) and bits < 8 * SIGNATURE:
        bits *= 2
    return np.packbits(np.bincount((mix(tokens, 3) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").astype(np.uint8).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles in one set only; the larger bitmap is folded."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(y) < len(x):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _index(known):
    def run(batches):
        hot, hot_n = known.value
        sieve = np.zeros(1 << 21, bool)
        sieve[(hot & np.uint64((1 << 21) - 1)).astype(np.int64)] = True
        for batch in batches:
            n_out, set_key, set_key2, matches, prefix, signature = [], [], [], [], [], []
            for _, data, offsets in blocks(batch.column("text")):
                tokens, first = shingle_sets(data, offsets)
                count = np.ones(len(tokens), np.int64)
                maybe = np.flatnonzero(sieve[(tokens & np.uint64((1 << 21) - 1)).astype(np.int64)])
                if len(maybe):
                    place = np.minimum(np.searchsorted(hot, tokens[maybe]), len(hot) - 1)
                    same = hot[place] == tokens[maybe]
                    count[maybe[same]] = hot_n[place[same]]
                total = np.zeros(len(tokens) + 1, np.uint64)
                np.cumsum(mix(tokens, 5), out=total[1:])
                total2 = np.zeros(len(tokens) + 1, np.uint64)
                np.cumsum(mix(tokens, 6), out=total2[1:])
                set_key.append(mix(total[first[1:]] - total[first[:-1]]))
                set_key2.append(mix(total2[first[1:]] - total2[first[:-1]]))
                n_out.append(np.diff(first))
                common = np.flatnonzero(np.add.reduceat(np.append(count > 1, 0), first[:-1]) * (np.diff(first) > 0))
                mixed = set(common.tolist())
                for r, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                    t = tokens[a:b]
                    if r in mixed:
                        order = np.argsort(count[a:b], kind="stable")
                        m, size = prefix_choice(count[a:b][order])
                        head = t[order[:size]]
                    else:
                        m, head = 1, t[: b - a - (3 * (b - a) + 3) // 4 + 1] if b > a else t
                    matches.append(m)
                    prefix.append(head.view(np.int64))
                    signature.append(_signature(t))
            join = lambda x: np.concatenate(x) if x else np.zeros(0, np.uint64)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(join(n_out).astype(np.int64)), pa.array(join(set_key).view(np.int64)), pa.array(join(set_key2).view(np.int64)), pa.array(matches, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(join(prefix).astype(np.int64))), pa.array(signature, pa.binary())],
                names=["node", "n", "k1", "k2", "matches", "prefix", "signature"])

    return run


def _passes(batches):
    """Pairs that size and signatures allow."""
    for batch in batches:
        na, nb = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        a, b = batch.column("s_a"), batch.column("s_b")
        ok = 4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)
        for i in np.flatnonzero(ok):
            ok[i] = 7 * least_difference(a[i].as_py(), b[i].as_py()) <= na[i] + nb[i]
        kept = pa.array(np.flatnonzero(ok))
        yield pa.RecordBatch.from_arrays([batch.column("a").take(kept), batch.column("b").take(kept)], names=["a", "b"])


def _near(n, component, guest, signatures):
    """Index pairs (i, j) of a group that size and signatures allow, of different components; in blocks."""
    size = np.array([len(s) for s in signatures])
    for length in np.unique(size):
        some = np.flatnonzero((size == length) | (size == 2 * length))
        bits = np.frombuffer(b"".join(signatures[i] if size[i] == length else (np.bitwise_xor.reduce(np.frombuffer(signatures[i], np.uint8).reshape(2, -1), axis=0)).tobytes() for i in some), np.uint64).reshape(len(some), -1)
        step = max(1, (1 << 19) // max(1, len(some) * bits.shape[1]))
        for at in range(0, len(some), step):
            part = some[at : at + step]
            x, y = part[:, None], some[None, :]
            # Of two equally long signatures the pair is met twice, of a longer and a shorter one once.
            ok = (component[x] != component[y]) & (size[x] == length) & ((size[y] > length) | (x < y)) & ~(guest[x] & guest[y])
            ok &= 4 * np.minimum(n[x], n[y]) >= 3 * np.maximum(n[x], n[y])
            if not ok.any():
                continue
            apart = np.zeros(ok.shape, np.int64)
            for w in range(bits.shape[1]):
                apart += np.bitwise_count(bits[at : at + step, w][:, None] ^ bits[None, :, w])
            i, j = np.nonzero(ok & (7 * apart <= n[x] + n[y]))
            yield part[i], some[j]


def _near_in_group(table: pa.Table) -> pa.Table:
    node, n, component, guest = (table.column(c).to_numpy() for c in ("node", "n", "component", "guest"))
    pairs = list(_near(n, component, guest, table.column("signature").to_pylist()))
    i, j = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
    return pa.table({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])})


def _alike(batches):
    """Pairs whose whole texts have a Jaccard similarity of 3/4 at least."""
    for whole in batches:
        for at in range(0, len(whole), PAIRS):
            batch, parts = whole.slice(at, PAIRS), []
            for name in ("text_a", "text_b"):
                sets = []
                for _, data, offsets in blocks(batch.column(name)):
                    tokens, first = shingle_sets(data, offsets)
                    sets += [tokens[i:j] for i, j in zip(first[:-1], first[1:], strict=True)]
                parts.append(sets)
            ok = [100 * (both := len(np.intersect1d(x, y, True))) >= 75 * (len(x) + len(y) - both) for x, y in zip(*parts, strict=True)]
            kept = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(kept), batch.column("b").take(kept)], names=["a", "b"])


def _sieved(pairs: DataFrame, index: DataFrame) -> DataFrame:
    side = lambda x: index.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_passes, "a long, b long")


def _matched(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs that share as many prefix shingles as the shorter of their prefixes asks for."""
    pairs = materialize(pairs, "rest-near")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = materialize(index.join(needed, "node", "left_semi").select("node", "matches", "prefix"), "rest-prefixes")
    side = lambda x: some.select(F.col("node").alias(x), F.col("matches").alias(f"m_{x}"), F.col("prefix").alias(f"p_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where("size(array_intersect(p_a, p_b)) >= least(m_a, m_b)").select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """The pairs (a, b) whose whole texts make them links."""
    pairs = materialize(pairs, f"{label}-sieved")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = materialize(texts.join(needed, "node", "left_semi"), f"{label}-texts")
    text = lambda x: some.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    whole = pairs.join(text("a"), "a").join(text("b"), "b")
    return materialize(whole.mapInArrow(_alike, "a long, b long"), label)


def _placed(postings: DataFrame, links: DataFrame) -> DataFrame:
    """The postings with the component of their document under ``links``."""
    parts = components(links)
    return postings.join(parts, "node", "left").select("token", "part", "node", "p", "centre", F.coalesce("component", "node").alias("component"))


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Two documents link when the Jaccard similarity of their distinct 5-word shingles is 0.75 or more;
    fewer than five words are one shingle; without words a document links with nothing. Only A-Z are
    lower-cased. Rows that share a doc_id are one node: all their links count, and each row is
    returned. Rows without an id have themselves as component (null) and link with nothing. An empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    spark = small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    frequent = (
        texts.select("text").mapInArrow(_frequent, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow().sort_by("token")  # FREQUENT rows at most
    )
    hot, hot_n = (frequent.column(c).to_numpy() for c in ("token", "n"))
    order = np.argsort(hot.view(np.uint64))
    known = spark.sparkContext.broadcast((hot.view(np.uint64)[order], hot_n[order]))
    index = materialize(
        texts.mapInArrow(_index(known), "node long, n long, k1 long, k2 long, matches int, prefix array<long>, signature binary"),
        "shingle-index",
    )
    large = [(int(t), int(-(-c // HUB_ROWS))) for t, c in zip(hot, hot_n, strict=True) if c > HUB_ROWS]
    entries = index.where("n > 0 and node is not null").select(F.explode("prefix").alias("token"), "node", "k1", F.size("prefix").alias("p"))
    if large:
        parts = F.broadcast(spark.createDataFrame(large, "token long, parts int"))  # FREQUENT rows at most
        part = F.coalesce(F.pmod("k1", "parts"), F.lit(0)).alias("part")
        entries = entries.join(parts, "token", "left").select("token", "node", "k1", "p", part, F.col("parts").isNotNull().alias("split"))
    else:
        entries = entries.withColumns({"part": F.lit(0), "split": F.lit(False)})
    # Copies of one set stand side by side in each group; the first stands for all of them. Who is alone
    # in a part of a split token stays: the parts are for the hubs only, the second pass takes the whole token.
    entries.createOrReplaceTempView("candela_entries")
    postings = materialize(
        spark.sql("""select token, part, node, p, sum(held) over (partition by node) as centre from (
            select *, lag(k1) over (partition by token, part order by k1, node) as before,
              count(1) over (partition by token, part) as held from candela_entries)
            where (held > 1 or split) and (before is null or before <> k1)"""),
        "postings",
    )
    spark.catalog.dropTempView("candela_entries")
    classes = index.where("n > 0 and node is not null").groupBy("k1", "k2", "n").agg(F.min("node").alias("rep"), F.count_distinct("node").alias("size"))
    copies = materialize(
        index.where("n > 0 and node is not null").select("node", "k1", "k2", "n")
        .join(classes.where("size > 1"), ["k1", "k2", "n"]).where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct(),
        "copies",
    )
    links = copies.where("a is null")
    rank = "row_number() over (partition by token, part order by centre desc, node)"
    for turn in range(HUB_TURNS):
        # Documents whose shingles most others share come first: a copy with few changes is near to all.
        placed = _placed(postings, links)
        low, high = turn * HUBS, (turn + 1) * HUBS
        hub = placed.selectExpr("token", "part", "node as hub", "component as hub_component", f"{rank} as nth").where(f"nth <= {high}").where(f"nth > {low}")
        near = placed.join(hub, ["token", "part"]).where("component <> hub_component")
        hubs = near.groupBy(F.col("node").alias("a"), F.col("hub").alias("b")).agg(F.count("*").alias("seen"), F.first("p").alias("p"))
        # Weak evidence can wait for the last pass, which counts all shared shingles of a pair.
        best = "row_number() over (partition by a order by seen desc, b) as nth"
        hubs = hubs.where(f"seen * {EVIDENCE} >= p").selectExpr("*", best).where(f"nth <= {HUBS}").select("a", "b")
        links = links.union(_verified(_sieved(hubs, index), texts, "hub-links"))
    # What is left: documents of one group in different components. Many shingles of a passage have the
    # same group; it is looked at once. A large group is cut by size, as sizes of a link differ by a third at most.
    placed = _placed(postings, links)
    member = F.xxhash64("node")
    split = (
        placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("held"), F.bit_xor(member).alias("x"), F.sum(member % (1 << 40)).alias("y"))
        .where("low < high").groupBy("held", "x", "y").agg(F.min("token").alias("token")).select("token", "held")
    )
    sized = placed.join(split, "token").join(index.select("node", "n", "signature"), "node")
    level = F.floor(F.log("n") / F.log(F.lit(4 / 3))).cast("int")
    places = F.when(F.col("held") > LARGE, F.array(F.struct(level.alias("level"), F.lit(False).alias("guest")), F.struct((level + 1).alias("level"), F.lit(True).alias("guest")))).otherwise(F.array(F.struct(F.lit(0).alias("level"), F.lit(False).alias("guest"))))
    groups = sized.select("token", "node", "component", "n", "signature", F.explode(places).alias("at")).select("*", "at.level", "at.guest").drop("at")
    rest = groups.groupBy("token", "level").applyInArrow(_near_in_group, "a long, b long").distinct()
    second = _verified(_matched(rest, index), texts, "rest-links")
    found = materialize(components(links.union(second).union(copies)), "components").withColumnsRenamed({"node": "_node"})
    return index.join(found, F.col("node") == F.col("_node"), "left").select(
        F.col("node").cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id")
    )
