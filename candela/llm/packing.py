"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

Documents are tokenized where they lie and cut into pieces; only lengths travel. Pieces are dealt at
random to cells of bounded size. In each cell a few islands breed packings: crossover injects whole
well-filled bins of one packing into another, drops the bins that now hold a document twice, and
best-fits the displaced documents: one that fills a bin better than smaller ones in it takes their place, the rest
go where they fit best. After a round every island gets its neighbour's elite packing.
Bins of a cell's best packing that are not quite full are dissolved, and their pieces are dealt to
fewer cells, until one cell is left; its packing is final.
"""

from __future__ import annotations

import os
import zlib
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.words import BLOCK_BYTES, SPACED, Words, blocks, give_back, small_batches
from candela.session import materialize

CELL_PIECES = 8192
ISLANDS, ROUNDS = 3, 2
#: Crossovers of an island in a round: at least, at most, and pieces handled by all of them together, about.
CHILDREN, MOST_CHILDREN, BRED = 8, 300, 1 << 16
PEOPLE = 12
#: Bins, and displaced documents, looked at for an exchange in one crossover.
EXCHANGED = 48
#: Bins filled to less than this part go on to the next level.
FULL = 0.995
#: Words whose ids a task remembers.
KNOWN_WORDS = 500_000
#: Bytes of text whose different words are looked up together.
TOKEN_BYTES = 4 * BLOCK_BYTES

_tokenizers: dict[str, Tokens] = {}


class Tokens:
    """Ids of texts as bytes. Words between ASCII white space never share a token, so each is looked up."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Texts of tokens that are matched before words are, as bytes.
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Whether an id ends a word, for tokenizers that mark it; without marks words are encoded one by one.
        vocabulary, mark = self.tokenizer.get_vocab(), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closing = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if mark and token.endswith(mark)]] = True
        self.known: dict[bytes, bytes] = {}

    def learn(self, new: list[bytes]) -> None:
        # A word of letters alone is one unit to the tokenizer; many are encoded as one text, unit by unit.
        texts = b"\n".join(new).decode().split("\n") if new else []
        alone = [t.isalpha() for t in texts]
        plain, units = list(compress(texts, alone)), list(compress(new, alone))
        cuts = range(0, len(plain), 256)
        joined = [" ".join(plain[i : i + 256]) for i in cuts]
        for i in range(0, len(joined), 16):
            for k, e in enumerate(self.tokenizer.encode_batch_fast(joined[i : i + 16], add_special_tokens=False), i):
                part, ids = units[cuts[k] : cuts[k] + 256], np.array(e.ids, "<u4")
                stops = np.flatnonzero(self.closing[ids]) + 1
                if len(stops) != len(part):
                    self._one_by_one(part, plain[cuts[k] : cuts[k] + 256])
                    continue
                raw, stops = ids.tobytes(), (4 * stops).tolist()
                self.known.update(zip(part, [raw[x:y] for x, y in zip([0, *stops], stops, strict=False)], strict=True))
        rest = [not x for x in alone]
        self._one_by_one(list(compress(new, rest)), list(compress(texts, rest)))

    def _one_by_one(self, words: list[bytes], texts: list[str]) -> None:
        for i in range(0, len(words), 4096):
            for word, e in zip(words[i : i + 4096], self.tokenizer.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False), strict=True):
                self.known[word] = np.array(e.ids, "<u4").tobytes()

    def whole(self, text: bytes) -> bytes:
        """Ids of a text that holds such a token; case is left aside in the test, which does no harm."""
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def with_added(self, raw: bytes, offsets: np.ndarray) -> dict[int, bytes]:
        low = raw.lower()
        if not any(t in low for t in self.added):
            return {}
        rows = enumerate(zip(offsets.tolist(), offsets[1:].tolist(), strict=False))
        return {r: self.whole(raw[a:b]) for r, (a, b) in rows if any(t in low[a:b] for t in self.added)}

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows side by side, where each row's begin and end). Each different word of the block is looked up once."""
        w = Words(data, offsets, SPACED)
        if not len(w.starts):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        ends = np.concatenate([[0], np.cumsum(w.ends - w.starts)])
        found = pa.Array.from_buffers(pa.large_binary(), len(w.starts), [None, pa.py_buffer(ends), pa.py_buffer(data[SPACED[data]])]).dictionary_encode()
        code, (_, where, letters) = found.indices.to_numpy(), found.dictionary.buffers()
        cuts, letters = np.frombuffer(where, np.int64, len(found.dictionary) + 1).tolist(), letters.to_pybytes()
        words = [letters[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]
        parts = [self.known.get(word) for word in words]
        new = [k for k, part in enumerate(parts) if part is None]
        if len(self.known) > KNOWN_WORDS:  # words met again are worth keeping
            self.known = {word: part for word, part in zip(words, parts, strict=True) if part is not None}
        self.learn([words[k] for k in new])
        for k in new:
            parts[k] = self.known[words[k]]
        table = np.frombuffer(b"".join(parts), "<u4")
        stop = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4)
        size = np.diff(stop, prepend=0)[code]
        upto = np.cumsum(size)
        # The ids of a word stand in the table as far from their place in the block as its first one does.
        where = np.repeat(stop[code] - upto, size) + np.arange(upto[-1])
        return table[where], np.concatenate([[0], upto])[w.first]


_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True


def _parted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with A-Z lower-cased and a blank between a letter and a following mark.

    The tokenizer parts them there too, so the ids stay, and fewer different words are met.
    """
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    at = np.flatnonzero(_LETTER[data[:-1]] & _MARK[data[1:]]) + 1
    return np.insert(data, at, 0x20), offsets + np.searchsorted(at, offsets, "left")


def _pieces(path: str, size: int, end: int):
    def run(batches):
        if path not in _tokenizers:
            _tokenizers[path] = Tokens(path)
        tokens, last = _tokenizers[path], np.array([end], "<u4").tobytes()
        for batch in batches:
            row_of, piece, start, length, crc = [], [], [], [], []
            for row, data, offsets in blocks(batch.column("text"), TOKEN_BYTES):
                special = tokens.with_added(data.tobytes(), offsets)
                if special:
                    data = data.copy()
                    for r in special:
                        data[offsets[r] : offsets[r + 1]] = 0x20
                flat, bounds = tokens.ids(*_parted(data, offsets))
                raw, bounds = flat.tobytes(), (4 * bounds).tolist()
                for r, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    ids = special.get(r, raw[a:b]) + last
                    for k, at in enumerate(range(0, len(ids), 4 * size)):
                        part = ids[at : at + 4 * size]
                        row_of.append(row + r)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row_of, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
        tokens.known = {}
        give_back()

    return run


def _best_fit(sizes, order, bins: list[int], room: list[int], capacity: int) -> None:
    """Put each piece of ``order`` into the bin with the least room that holds it; bins and room change."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, r in enumerate(room):
        if r > 0:
            free[r].append(b)
            mask |= 1 << r
    for i in order:
        size = sizes[i]
        fits = mask >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = free[r].pop()
            if not free[r]:
                mask ^= 1 << r
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i] = b
        r -= size
        room[b] = r
        if r:
            free[r].append(b)
            mask |= 1 << r


class Packing:
    """An assignment of pieces to bins, numbered from 0 without gaps."""

    def __init__(self, sizes: np.ndarray, bins: np.ndarray, capacity: int):
        self.bins = np.unique(bins, return_inverse=True)[1]
        self.load = np.bincount(self.bins, sizes).astype(np.int64)
        #: Fewer bins first; among equals, uneven fills are better, as they leave room in one place.
        self.rank = (len(self.load), -float(((self.load / capacity) ** 2).sum()))


def first_packing(sizes: np.ndarray, capacity: int, rng: np.random.Generator, noise: float) -> Packing:
    order = np.argsort(-(sizes * (1 + noise * rng.standard_normal(len(sizes)))), kind="stable")
    bins = [0] * len(sizes)
    _best_fit(sizes.tolist(), order.tolist(), bins, [], capacity)
    return Packing(sizes, np.array(bins, np.int64), capacity)


def _exchange(sizes: list[int], bins: list[int], room: list[int], loose: list[int], members: dict[int, list[int]]) -> list[int]:
    """Put displaced documents in the place of one or two smaller ones where that fills the bin better; what is displaced then."""
    loose = sorted(loose, key=lambda i: -sizes[i])
    for b, inside in members.items():
        best = (0, (), -1)
        for x, i in enumerate(inside):
            for group in ((i,), *((i, j) for j in inside[x + 1 :])):
                out = sum(sizes[k] for k in group)
                for d in loose[:EXCHANGED]:
                    gain = sizes[d] - out
                    if gain <= 0:
                        break
                    if best[0] < gain <= room[b]:
                        best = (gain, group, d)
        if best[0]:
            gain, group, d = best
            room[b] -= gain
            bins[d] = b
            loose.remove(d)
            loose = sorted([*loose, *group], key=lambda i: -sizes[i])
    return loose


def crossover(sizes: np.ndarray, a: Packing, b: Packing, capacity: int, rng: np.random.Generator) -> Packing:
    """Bins of ``b``, the fuller the likelier, are put whole into ``a``."""
    odds = (b.load / capacity) ** 8
    take = rng.random(len(odds)) < odds * rng.uniform(0.05, 0.6)
    injected = take[b.bins]
    broken = np.zeros(len(a.load), bool)
    broken[a.bins[injected]] = True
    # Some badly filled bins are opened too, so that their pieces get another chance.
    weak = 1.05 - a.load / capacity
    opened = min(len(a.load), 1 + int(rng.integers(0, 3 + len(a.load) // 50)))
    broken[rng.choice(len(a.load), opened, replace=False, p=weak / weak.sum())] = True
    kept = ~injected & ~broken[a.bins]
    bins = np.where(injected, len(a.load) + b.bins, a.bins)
    loose = np.flatnonzero(~injected & ~kept)
    settled = np.flatnonzero(injected | kept)
    names, bins_now = np.unique(bins[settled], return_inverse=True)
    out = np.zeros(len(sizes), np.int64)
    out[settled] = bins_now
    room = (capacity - np.bincount(bins_now, sizes[settled], len(names)).astype(np.int64)).tolist()
    result = out.tolist()
    open_bins = np.flatnonzero(np.array(room) > 0)
    members: dict[int, list[int]] = {int(x): [] for x in rng.permutation(open_bins)[:EXCHANGED]}
    for i in settled[np.isin(bins_now, list(members))].tolist():
        members[result[i]].append(i)
    loose = np.array(_exchange(sizes.tolist(), result, room, loose.tolist(), members), np.int64)
    order = loose[np.argsort(-sizes[loose] * (1 + 0.1 * rng.random() * rng.standard_normal(len(loose))), kind="stable")]
    _best_fit(sizes.tolist(), order.tolist(), result, room, capacity)
    return Packing(sizes, np.array(result, np.int64), capacity)


def breed(sizes: np.ndarray, start: list[Packing], capacity: int, rng: np.random.Generator, children: int | None = None) -> Packing:
    """The best packing after some crossovers; stops at the least number of bins possible."""
    bound = -(-int(sizes.sum()) // capacity)
    people = sorted(start, key=lambda p: p.rank)
    for _ in range(min(MOST_CHILDREN, max(CHILDREN, BRED // max(1, len(sizes)))) if children is None else children):
        if people[0].rank[0] <= bound:
            break
        a, b = rng.choice(len(people), 2, replace=len(people) < 2)
        child = crossover(sizes, people[a], people[b], capacity, rng)
        if all(child.rank != p.rank for p in people):
            people = sorted([*people, child], key=lambda p: p.rank)[:PEOPLE]
    return people[0]


def _island(capacity: int, level: int, round_: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        cell, island = (int(k) for k in key)
        rows = rows.sort_values("uid", ignore_index=True)
        sizes = rows["length"].to_numpy()
        rng = np.random.default_rng([level, round_, cell, island])
        if round_ == 0:
            start = [first_packing(sizes, capacity, rng, 0.02 * island)]
            if start[0].rank[0] > -(-int(sizes.sum()) // capacity):  # else no packing is better
                start += [first_packing(sizes, capacity, rng, 0.05 * (k + island)) for k in (1, 2, 3, 4)]
        else:
            start = [Packing(sizes, rows[c].to_numpy(), capacity) for c in ("own", "migrant")]
        best = breed(sizes, start, capacity, rng)
        gain = best.rank[0] - -(-int(sizes.sum()) // capacity)
        return pd.DataFrame({"cell": cell, "uid": rows["uid"], "length": sizes, "island": island, "bin": best.bins, "load": best.load[best.bins], "above": gain, "fill": -best.rank[1]})

    return run


_STATE = "cell long, uid long, length long, island int, bin long, load long, above long, fill double"


def _pack_level(items: DataFrame, cells: int, capacity: int, level: int) -> DataFrame:
    """(cell, uid, length, bin, load) of the best packing of every cell."""
    dealt = items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(cells)).alias("cell"))
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    blank = F.lit(0).cast("long")
    state = dealt.select("*", islands, blank.alias("own"), blank.alias("migrant"))
    for round_ in range(ROUNDS):
        bred = materialize(state.groupBy("cell", "island").applyInPandas(_island(capacity, level, round_), _STATE), "islands")
        if round_ + 1 == ROUNDS or not bred.where("above > 0").head(1):
            break
        maps = bred.groupBy("cell", "uid", "length").agg(F.map_from_entries(F.collect_list(F.struct("island", "bin"))).alias("bins"))
        state = maps.select("cell", "uid", "length", islands, "bins").select(
            "cell", "uid", "length", "island", F.col("bins")[F.col("island")].alias("own"), F.col("bins")[(F.col("island") + 1) % ISLANDS].alias("migrant")
        )
    best = bred.groupBy("cell").agg(F.min(F.struct("above", -F.col("fill"), "island"))["island"].alias("island"))
    return bred.join(best, ["cell", "island"]).select("cell", "uid", "length", "bin", "load")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1, cell_pieces: int = CELL_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its whole text and the id ``end``; null and empty texts are the id
    ``end`` alone. Longer documents are cut every ``capacity`` ids. Rows that share a doc_id, and rows without one,
    are documents of their own. An empty table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, capacity, end), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    pieces = materialize(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == capacity
    done = [pieces.where(whole).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    items = pieces.where(~whole).select("uid", "length")
    n, level = items.count(), 1
    while n:
        cells = -(-n // cell_pieces)
        packed = materialize(_pack_level(items, cells, capacity, level), "packed")
        last = cells == 1
        closed = packed if last else packed.where(F.col("load") >= FULL * capacity)
        sequence = (F.lit(level << 55) + F.col("cell") * (1 << 24) + F.col("bin")).alias("sequence_id")
        before = "coalesce(sum(length) over (partition by cell, bin order by uid rows between unbounded preceding and 1 preceding), 0L) as offset"
        done.append(closed.selectExpr("*", before).select("uid", sequence, "offset"))
        if last:
            break
        items = packed.where(F.col("load") < FULL * capacity).select("uid", "length")
        left = items.count()
        # If hardly any bin filled up, larger cells would not help either: take them as they are.
        if left > 0.9 * n:
            done[-1] = packed.selectExpr("*", before).select("uid", sequence, "offset")
            break
        n, level = left, level + 1
    placed = done[0]
    for part in done[1:]:
        placed = placed.union(part)
    return pieces.join(placed, "uid").drop("uid")
