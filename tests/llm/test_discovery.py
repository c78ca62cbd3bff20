"""Spelling variants, clusters and personal data against plain versions: nulls, ties, copies, long texts, empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from candela.llm import private, spelling
from candela.llm.pivots import choose_pivots, cluster_vectors, nearest
from candela.llm.private import base_spans, known_instances, personal_data, stretches
from candela.llm.spelling import spelling_variants

CLASH = "lang string, n long, word string, key string, id long, base string, found long, uid long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "w", "k", 2, "b", 3, 4) for i, t in rows], f"doc_id long, text string, {CLASH}")


# Spelling variants


def plain_variants(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    words = {w: n for w, n in counts.items() if n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    out = {}
    for w, n in words.items():
        others = [x for x in words if abs(len(x) - len(w)) <= 1 and x != w and near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        out[w] = [best if best and words[best] >= 10 * n else None, None, n, len(others), None]
    for w, row in out.items():
        row[4] = words[row[0]] if row[0] else None
        root = w
        while out[root][0]:
            root = out[root][0]
        row[1] = root
    return {w: tuple(row) for w, row in out.items()}


def variants(docs):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(docs).collect()}


@pytest.fixture(scope="module")
def spelled():
    rng = np.random.default_rng(5)
    rows = [(None, None), (1, ""), (2, "1234 ..."), (3, "short words only here"), (3, "ABCDEFG abcdefg Ébcdefg ébcdefg×÷ ébcdefg×÷")]
    roots = ["aabbaabb", "abababab", "aaaaaaaa", "ÿÿÿÿÿÿÿÿ", "letters", "lettersé", "abcdefghijkl"]
    for i in range(60):
        words = []
        for _ in range(150):
            w = roots[int(rng.integers(len(roots)))]
            for _ in range(int(rng.choice([0, 0, 0, 0, 0, 0, 0, 0, 1, 2]))):
                k, c = int(rng.integers(len(w) + 1)), "abéy"[int(rng.integers(4))]
                w = [w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]][int(rng.integers(3))]
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((100 + i, " ".join(words)))
    return [*rows, rows[-1], (None, "letters letters lettres lettres")]


@pytest.mark.parametrize("long", [64, 8, 7])
def test_variants(spark, spelled, monkeypatch, long):
    monkeypatch.setattr(spelling, "LONG", long)
    want = plain_variants(spelled)
    assert len(want) > 300 and sum(x[0] is not None for x in want.values()) > 50 and any(x[1] != (x[0] or w) for w, x in want.items())
    assert variants(documents(spark, spelled)) == want


def test_long_words(spark):
    a = "x" * 9000 + "y" * 9000
    rows = [(i, t) for t in (a, a[:5] + a[6:], a[:-3] + "z" + a[-2:]) for i in (8, 9)] + [(i, a) for i in range(10, 40)]
    got = variants(documents(spark, rows))
    want = plain_variants(rows)
    assert got == want and max(map(len, got)) == 18000


def test_no_words(spark):
    assert variants(documents(spark, [])) == {}
    assert variants(documents(spark, [(1, None), (None, "a b c")])) == {}


# Clusters


def plain_clusters(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    find = lambda v: min((apart(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        held = defaultdict(list)
        for _, v in kept:
            held[find(v)[1]].append(v)
        centroids = [[sum(x) // len(held[j]) for x in zip(*held[j], strict=True)] if held[j] else c for j, c in enumerate(centroids)]
    found = [(i, *find(v)[::-1]) for i, v in kept]
    total = Counter()
    for _, j, d in found:
        total[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, total[j], sum(total.values()), digest[j]) for i, j, d in found), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, [1], 2) for i, v in rows], "vec_id long, embedding array<float>, label int, cluster int, v array<int>, n long")


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (5, 64))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.4, 64)).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 330)] + [(5, rows[7][1]), (None, rows[9][1]), (None, rows[3][1])]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [math.nan] + [0.0] * 63, [math.inf] * 64]
    return rows + [(1000 + i, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize("some", [slice(None), slice(0, 3), slice(300, 330)])
def test_clusters(spark, points, some):
    got = sorted(map(tuple, cluster_vectors(vectors(spark, points[some])).collect()), key=str)
    assert got == plain_clusters(points[some])


def test_no_vectors(spark, points):
    for rows in ([], points[-7:]):
        df = cluster_vectors(vectors(spark, rows))
        assert df.collect() == [] and [t for _, t in df.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


def test_bounds_spare_distances_and_keep_ties():
    rng = np.random.default_rng(1)
    v = rng.integers(-900, 900, (2000, 64))
    v[:, 0] += np.arange(2000) % 5 * 20_000
    centroids = np.concatenate([v[:5], v[:3]])
    pivots = choose_pivots(v[:100], 6)
    table = np.sqrt(((v[:, None] - pivots[None]) ** 2).sum(2))
    number, best, measured = nearest(v, table, centroids, pivots)
    every = ((v[:, None] - centroids[None]) ** 2).sum(2)
    assert (best == every.min(1)).all() and (number == every.argmin(1)).all()
    assert measured < 0.5 * every.size


# Personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for at, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(digits[::-1])) % 10 == 0
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}
            if ok[kind]:
                out.append((m.start(), at, m.end(), kind))
    return sorted(out)


def card(rng):
    body = "".join(map(str, rng.integers(0, 10, 15)))
    return next(body + d for d in "0123456789" if base_spans(body + d))


def test_base_spans_are_those_of_the_patterns():
    rng = np.random.default_rng(11)
    odd = ["a@b.c@d.e", "x..%+-@-.-.é", "@@a@b", "a@b", "1.2.3.4.5.6.7.8", "001.002.003.256", "0000.1.1.1", "1.2.3.4", "+1 (212) 555-0100", "+12", "+1-------2", "+", "++1 23 4567890",
           "4111 1111 1111 1111", "4111-1111-1111-1111", "4111--1111", "4111  1111", "é٣٤", "1" * 30, "a.b@c.d_e@f.g", "1.2.3.4@5.6"]
    for text in odd + [" ".join(rng.choice(odd, 6)) for _ in range(60)] + ["".join(rng.choice(list("a@.1+ -()_"), 60)) for _ in range(300)]:
        assert base_spans(text) == plain_base(text), text


def plain_known(edges, seeds):
    known = dict(seeds)
    for _ in range(private.ROUNDS):
        held = defaultdict(set)
        for p, i in edges:
            held[p].add(i)
        sure = {}
        for p, some in held.items():
            for kind, hits in Counter(known[i] for i in some if i in known).items():
                if hits >= private.SUPPORT and hits >= private.CONFIDENCE * len(some):
                    sure[p] = (kind, hits / (len(some) + 1))
        doubt = defaultdict(float)
        for p, i in set(edges):
            if p in sure and i not in known:
                doubt[i, sure[p][0]] += math.log(1 - sure[p][1])
        new = {}
        for (i, kind), x in sorted(doubt.items(), key=lambda d: (d[1], d[0][1])):
            if x <= math.log(1 - private.ACCEPTED) + 1e-9:
                new.setdefault(i, kind)
        if not new:
            break
        known |= new
    return known


@pytest.fixture(scope="module")
def people():
    rng = np.random.default_rng(4)
    rows = [(None, None), (0, ""), (0, "x"), (None, "call me at nothing")]
    filler = lambda: " ".join(f"w{x}" for x in rng.integers(10, 60, 8))
    phone = lambda: f"({rng.integers(100, 999)}) 555-{rng.integers(1000, 9999)}"
    for i in range(60):
        number = f"+1 {phone()}" if i % 6 else phone()
        rows.append((10 + i, f"{filler()} call me at {number} in the evening {filler()}"))
    # A second context, learned through the instances of the first.
    for i in range(22):
        number = re.search(r"\(\d+\) 555-\d+", rows[4 + 6 * (i % 10)][1])[0] if i < 20 else phone()
        rows.append((100 + i, f"{filler()} reach us under {number} any day {filler()}"))
    for i in range(20):
        rows.append((200 + i, f"{filler()} paid by card {card(rng)} thank you {filler()}"))
        rows.append((300 + i, f"{filler()} order number {rng.integers(10**9, 10**10)} has shipped {filler()} version 3. CC 4.0"))
        rows.append((400 + i, f"{filler()} order number +1 {phone()} has shipped {filler()}"))
    bad = str(10**15 + 7)
    rows += [(500, f"{filler()} paid by card {bad} thank you {filler()}"), (501, rows[5][1]), (501, "z " * 50_000 + rows[4][1])]
    return rows


def test_patterns_find_unseen_identifiers(spark, people):
    edges, seeds, found = set(), {}, []
    for _, text in people:
        text = text or ""
        found.append(stretches(text, base_spans(text)))
        for s in found[-1]:
            edges |= {(p, s["instance"]) for p in s["patterns"]}
            if s["kind"] and s["instance"] not in seeds:
                seeds[s["instance"]] = s["kind"]
    want = plain_known(edges, seeds)
    got = known_instances(spark.createDataFrame(sorted(edges), "pattern string, instance string"), spark.createDataFrame(sorted(seeds.items()), "instance string, kind string"))
    assert {r.instance: r.kind for r in got.collect()} == want and len(want) > len(seeds) + 5

    rows = personal_data(documents(spark, people)).collect()
    assert len(rows) == len(people)
    by_id = {r.doc_id: r for r in rows}
    text_of = dict(people)
    for i in range(0, 60, 6):  # phones without a plus, in a context of phones
        kind, a, b = by_id[10 + i].spans.split(":")
        assert kind == "phone" and text_of[10 + i][int(a) : int(b)].startswith("(") and by_id[10 + i].n_phone == 0
    assert all(by_id[i].spans.startswith("phone:") for i in range(120, 122))  # found in the second round
    assert by_id[500].spans.startswith("card:") and by_id[500].n_card == 0
    assert all(by_id[300 + i].spans == "" for i in range(20))  # a context that holds other numbers too
    want_rows = []
    for i, text in people:
        base = plain_base(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base)
        want_rows.append((str(i), *(sum(s[3] == k for s in base) for k in PLAIN), hashlib.sha256(joined.encode()).hexdigest()))
        assert any(r.doc_id == i and set(filter(None, joined.split(","))) <= set(r.spans.split(",")) for r in rows)
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == sorted(want_rows)


def test_no_documents(spark):
    assert personal_data(documents(spark, [])).collect() == []
