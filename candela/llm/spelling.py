"""Groups of spelling variants by permuterm rotations.

A word is closed by a terminator and turned: ``b$a`` is the rotation of ``ab$`` behind ``a``. If one code point
between a and b is skipped, the rotation of ``acb`` begins with the whole rotation of ``ab``, and with that of
``adb``. So words at one edit's distance stand side by side when rotations are sorted: a group holds the word
``ab`` itself and the words with one code point put in there, at most one for each letter of the alphabet.

Groups are scanned, never paired: each member learns how many neighbours it has there and the most frequent one.
A pair of words differs in one way, so it stands in one group, but for runs of one letter: taking out any letter of
the run gives the same word, and only the last of these places counts.

Words of more than ``LONG`` code points would make rotations as long as themselves; there each rotation is named by
remainders modulo four primes, 124 bits in all, and a word of n letters costs n such names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.words import blocks, small_batches
from candela.session import materialize

#: Lower-cased letters of a word; a run of fewer cannot become a word.
LETTERS = "a-zÀ-ÿ"
#: One run in so many, by its hash, has lost a code point.
BROKEN = 31
#: Different words counted in a task before they are handed on.
COUNTED = 1 << 17
#: Rotations of words up to this many code points are written out.
LONG = 64
#: Names of longer rotations: primes near 2**31 and a base.
PRIMES, BASE = (2147483647, 2147483629, 2147483587, 2147483579), 1_000_003


def _words(least: int):
    def run(batches):
        runs = re.compile(f"[{LETTERS}]{{{least},}}")
        known: Counter[str] = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for row, data, offsets in blocks(batch.column("text")):
                raw = data.tobytes().lower()  # bytes: A-Z only
                for r, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
                    name = "null" if ids[row + r] is None else ids[row + r]
                    start = zlib.crc32(f"{name}:".encode())
                    for word, n in Counter(runs.findall(raw[a:b].decode("utf-8", "replace"))).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % BROKEN == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        known[word] += n
                    if len(known) > COUNTED:
                        yield flush()
                        known.clear()
        if known:
            yield flush()

    return run


def vocabulary(docs: DataFrame, least: int = 7, times: int = 2) -> DataFrame:
    """(word, n) of the words of at least ``least`` code points that occur ``times`` times or more."""
    found = docs.select("doc_id", "text").mapInArrow(_words(least), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def _scanned(turned: DataFrame, key: list[str], rank: str) -> DataFrame:
    """(id, near, best): neighbours that each member has in its group, and the best as (-n, id).

    ``turned`` has the group's key, the skipped code point ``c`` (null in the word without it), the first letter ``b0``
    behind the edit, n, id, and ``rank``, which orders members as their words are ordered.
    """
    group = f"over (partition by {', '.join(key)} order by n desc, {rank} rows between unbounded preceding and unbounded following)"
    scan = turned.selectExpr(
        "id", "c", "b0", "n",
        f"first_value(struct(-n as m, id)) {group} as first",
        f"nth_value(struct(-n as m, id), 2) {group} as second",
        f"count(c) {group} as longer",
        f"count_if(c <> b0) {group} as settled",
        f"count_if(c is null) {group} as shorter",
    ).where("second is not null")
    near = "case when c is null then settled else longer - 1 + if(c <> b0, shorter, 0L) end as near"
    return scan.selectExpr("id", near, "if(first.id = id, second, first) as best")


def _short_near(words: DataFrame) -> DataFrame:
    """(word, n_near, best) among words of at most LONG code points."""
    at = words.where(F.length("word") <= LONG).select("word", "n", F.explode(F.expr("sequence(0, 2 * length(word))")).alias("j"))
    turned = at.selectExpr(
        # Even places turn the whole word, odd ones skip a code point.
        "concat(substring(word, (j + 1) div 2 + 1), '$', substring(word, 1, j div 2)) as key",
        "if(j % 2 = 1, substring(word, j div 2 + 1, 1), null) as c",
        "n",
    ).repartition("key")
    back = "concat(substring_index(key, '$', -1), coalesce(c, ''), substring_index(key, '$', 1)) as id"
    ready = turned.selectExpr("key", "c", "n", "if(key like '$%', '', substring(key, 1, 1)) as b0", back)
    return _scanned(ready, ["key"], "id").groupBy(F.col("id").alias("word")).agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _powers(n: int, prime: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    have, step = 1, BASE
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(step) % np.uint64(prime)
        have, step = have + more, step * step % prime
    return out


def _named(word: str):
    """(place, names of the whole word's rotations, names of those that skip a code point); names are two longs."""
    x = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    whole, skipped = [], []
    for prime in PRIMES:
        p, one = np.uint64(prime), np.uint64(pow(BASE, -1, prime))
        head = np.concatenate([[np.uint64(0)], np.cumsum(x * _powers(len(x), prime) % p)]) % p
        whole.append(int(head[-1]))
        skipped.append((head[:-1] + (head[-1] + p - head[1:]) % p * one) % p)
    pair = lambda a, b: (a << 31 | b) if isinstance(a, int) else ((a << np.uint64(31)) | b).view(np.int64)
    return (pair(*whole[:2]), pair(*whole[2:])), (pair(*skipped[:2]), pair(*skipped[2:]))


def _long_rotations(long: int):
    names = ["k1", "k2", "size", "at", "c", "b0", "rank", "n", "id"]

    def run(batches):
        for batch in batches:
            for word, n, uid in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "id")), strict=True):
                (w1, w2), (s1, s2) = _named(word)
                size = len(word)
                following = [word[i] if i < size else "" for i in range(size + 1)]
                # The next letter behind a run decides whether the word without a letter of the run comes first.
                after = [""] * (size + 1)
                for i in range(size - 1, -1, -1):
                    after[i] = after[i + 1] if following[i + 1] == word[i] else following[i + 1]
                ranks = [x + ("\x00" if y < x or not x else "\x02") for x, y in zip(following, after, strict=True)]
                count = size + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w1] * count), pa.array([w2] * count), pa.array([size] * count), pa.array(range(count), pa.int64()), pa.nulls(count, pa.string()), pa.array(following), pa.array(ranks), pa.array([n] * count), pa.array([uid] * count)],
                    names=names)
                if size > long:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s1), pa.array(s2), pa.array([size - 1] * size), pa.array(range(size), pa.int64()), pa.array(list(word)), pa.array(following[1:]), pa.array([x + "\x01" for x in word]), pa.array([n] * size), pa.array([uid] * size)],
                        names=names)

    return run


def _long_near(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of pairs with a word of over LONG code points."""
    named = materialize(words.where(F.length("word") >= LONG).withColumn("id", F.monotonically_increasing_id()), "long-words")
    turned = named.mapInArrow(_long_rotations(LONG), "k1 long, k2 long, size long, at long, c string, b0 string, rank string, n long, id long")
    found = _scanned(turned, ["k1", "k2", "size", "at"], "rank").selectExpr("id", "near", "best.m", "best.id as other")
    text = found.join(named.selectExpr("id as other", "word as best_word"), "other").join(named.select("id", "word"), "id")
    return text.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("m", F.col("best_word").alias("id"))).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms. Counts grow tenfold a step, so chains are short."""
    known = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        step = known.join(ahead, F.col("root") == F.col("_at"), "left")
        known = materialize(step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if not known.where("moved").head(1):
            return known.select("word", "root")
        known = known.drop("moved")


def spelling_variants(docs: DataFrame, least: int = 7, times: int = 2, ratio: int = 10) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Words are runs of letters, A-Z lower-cased; one in BROKEN runs, chosen by a hash of document and run, has lost a code
    point. Near words differ by one inserted, deleted or replaced code point. ``form`` is the most frequent near word
    (ties: the smallest) if it occurs ``ratio`` times as often, ``root`` the end of the chain of forms. Null and empty
    texts have no words, a null id counts as the text 'null', repeated rows count again. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    small_batches(docs.sparkSession)
    words = materialize(vocabulary(docs, least, times), "vocabulary")
    near = _short_near(words)
    if words.where(F.length("word") > LONG).head(1):
        near = near.unionByName(_long_near(words)).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    near = near.select("word", "n_near", F.col("best.id").alias("_best"), (-F.col("best.m")).alias("_best_n"))
    chosen = F.col("_best_n") >= ratio * F.col("n")
    table = materialize(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(chosen, F.col("_best")).alias("form"), F.when(chosen, F.col("_best_n")).alias("form_n")
        ),
        "variants",
    )
    roots = _roots(table.where("form is not null"))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
