"""The stages of the corpus pipeline, each against a plain version over what the stage before it kept."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
import public_tokenizers

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BAD = range(0, 300, 4)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n):
    return [f"{a}{b}{c}" for a, b, c in zip(*(rng.choice(x, n) for x in (["the", "an", "er", "on"], ["re", "st", "ing", ""], [*"abcdefgh"])), strict=True)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents 0 to 299 are labelled; the planted ones above have no label, clean style and known fates."""
    rng = np.random.default_rng(3)
    rows = {i: " ".join(f"{w}!!".upper() for w in prose(rng, 80)) if i in BAD else " ".join(prose(rng, 80)) for i in range(300)}
    a, passage, leak = prose(rng, 80), prose(rng, 26), prose(rng, 12)
    near, far = list(a), list(a)
    near[40], far[::6] = "changed", ["x"] * len(far[::6])
    rows |= {1000: " ".join(a), 1001: " ".join(a), 1002: " ".join(near), 1003: " ".join(far)}
    for i in (1010, 1011, 1012):
        rows[i] = " ".join(prose(rng, 60) + passage + prose(rng, 60))
    rows |= {1020: " ".join(passage), 1030: " ".join(prose(rng, 60) + [w.upper() for w in leak] + prose(rng, 60)), 1031: " ".join(prose(rng, 60) + leak[:9] + prose(rng, 60))}
    rows |= {1040: "", 1041: None, 1042: "the ana", 1050: " ".join(prose(rng, 6000))}
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows.items()]
    docs += [docs[5], (None, rows[1030], "en", "s", len(rows[1030])), (None, None, None, None, None)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i not in BAD), 0) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, " ".join(leak)), (2, " ".join(prose(rng, 30))), (3, None), (4, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def kept(spark, folder):
    """The rows before the first stage and after each, all stages run on their predecessor's rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [[tuple(r) for r in docs.collect()]]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns
        out.append([tuple(r) for r in got.collect()])
        docs = spark.createDataFrame(out[-1], SCHEMA)
    return out, docs


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_stage_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["good_quality", "one_of_each", "without_repeats", "without_leaks", "packed"]


def test_quality_stage_rejects_bad_documents_only(kept):
    before, after = kept[0][:2]
    assert set(after) <= set(before)
    gone = {r[0] for r in before} - {r[0] for r in after}
    assert gone <= set(BAD) and len(gone) >= 0.95 * len(BAD)


def test_near_copies_stage(kept):
    before, after = kept[0][1:3]
    sets, part = {}, {}
    for i, text, *_ in before:
        w = SPACED.findall(low(text))
        if i is not None:
            sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
            part[i] = i
    for x in sets:
        for y in sets:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= 75 * len(sets[x] | sets[y]):
                first, other = sorted((part[x], part[y]))
                part = {k: first if v == other else v for k, v in part.items()}
    want = [r for r in set(before) if r[0] is not None and part[r[0]] == r[0]] + [r for r in before if r[0] is None]
    assert order(after) == order(want)
    assert {1000, 1003} <= set(part.values()) and part[1001] == part[1002] == 1000


def test_repeated_passages_stage(kept):
    before, after = kept[0][2:4]
    seen, want = set(), []
    for row in sorted(before, key=lambda r: (r[0] is not None, r[0] or 0)):
        w, gone = SPACED.findall(row[1] or ""), set()
        for s in range(len(w) - 19):
            if tuple(w[s : s + 20]) in seen:
                gone |= set(range(s, s + 20))
            seen.add(tuple(w[s : s + 20]))
        text = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else row[1]
        want.append((row[0], text, *row[2:4], len(text) if gone else row[4]))
    assert order(after) == order(want)
    texts = {r[0]: r[1] for r in after}
    assert len(texts[1011].split()) == len(texts[1012].split()) == 120 and texts[1020] == ""


def test_benchmark_leaks_stage(spark, folder, kept):
    before, after = kept[0][3:5]
    windows = set()
    for item in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = ALNUM.findall(low(item.text))
        windows |= {tuple(w[s : s + 10]) for s in range(len(w) - 9)}
    words = [ALNUM.findall(low(r[1])) for r in before]
    leaks = [any(tuple(w[s : s + 10]) in windows for s in range(len(w) - 9)) for w in words]
    assert order(after) == order([r for r, leak in zip(before, leaks, strict=True) if not leak])
    assert any(leaks) and 1031 in {r[0] for r in after}


def test_packing_stage_and_run(spark, folder, kept):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text, *_ in kept[0][-1]:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(i is None, i or 0, k, s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    for got in (corpus_pipeline.packed(spark, kept[1], folder), corpus_pipeline.run(spark, folder)):
        rows = got.collect()
        pieces = [tuple(r[c] for c in columns) for r in rows]
        assert sorted((p[0] is None, p[0] or 0, *p[1:]) for p in pieces) == sorted(want)
        bins = {}
        for r in rows:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for part in bins.values():
            part.sort()
            assert [o for o, _ in part] == [sum(n for _, n in part[:k]) for k in range(len(part))] and sum(part[-1]) <= 4096
        assert len(bins) <= -(-sum(p[3] for p in pieces) // 4096) + 1


def test_stages_of_an_empty_table(spark, folder):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, node long, part int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == corpus_pipeline.COLUMNS and out.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect() == []
