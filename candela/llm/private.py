"""Personal data by fixed shapes, and more of it by bootstrapped contextual patterns.

Emails, network addresses, cards and phones of fixed shapes are the seeds. What stands beside an identifier makes up its
lexical patterns: two words before, one word on each side, two words after. Patterns and instances form a graph.
In each round Spark scores the patterns of each kind by the share of their distinct instances known to be of that kind;
trusted patterns then score the instances they hold, and instances of high score are known in the next round.
All stretches of a text that look like an identifier, digits or an @ in them, take part, so that a
pattern that also holds other numbers is not trusted.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.words import small_batches
from candela.session import materialize

KINDS = ["email", "ip", "card", "phone"]
#: A pattern is trusted if it holds this many known instances of a kind, and this share of its instances are such.
SUPPORT, CONFIDENCE = 5, 0.8
#: Score from which an instance is known.
ACCEPTED = 0.9
ROUNDS = 4
#: Digits of an identifier without @.
DIGITS = 6
#: Context words come from so many characters beside a stretch.
BESIDE = 160
#: Longer instances are known by their hash.
NAME = 64

# The base kinds. Runs are taken whole, as no part of a run can match where the run does not.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_CORE_START = re.compile(r"[+(]{0,2}[0-9A-Za-z]")
_EDGE = re.compile(r"[0-9A-Za-z)]")
_DIGIT = re.compile(r"[0-9]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str):
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if m:
            yield start, m.end()
            at = end = m.end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind's place, end, kind) of the fixed shapes, in order of start and kind; code points, end exclusive."""
    found = [(a, 0, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                found.append((m.start(), 1, m.end(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end(), "card"))
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end(), "phone"))
    return sorted(found)


def _contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a stretch; digits beside it count as equal."""
    tidy = lambda words: [_DIGIT.sub("0", w.lower()) for w in words]
    left = ["^", "^", *tidy(text[max(0, start - BESIDE) : start].split()[-2:])][-2:]
    right = [*tidy(text[end : end + BESIDE].split()[:2]), "$", "$"][:2]
    return [f"{left[0]} {left[1]} _", f"{left[1]} _ {right[0]}", f"_ {right[0]} {right[1]}"]


def _name(surface: str) -> str:
    surface = surface.lower()
    return surface if len(surface) <= NAME else "sha:" + hashlib.sha256(surface.encode()).hexdigest()


def _looks_like(surface: str) -> bool:
    return "@" in surface or sum(c.isdigit() and c.isascii() for c in surface) >= DIGITS


def stretches(text: str, base: list[tuple[int, int, str]]) -> list[dict]:
    """All base spans, and what else looks like an identifier: tokens, and groups of them one blank apart."""
    out = [{"start": a, "end": b, "kind": kind, "instance": _name(text[a:b]), "patterns": _contexts(text, a, b)} for a, _, b, kind in base]
    taken: list[list[int]] = []  # disjoint
    for a, _, b, _ in base:
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    groups: list[list[tuple[int, int]]] = []
    last = -1  # where a further token of the group would start
    for m in _TOKEN.finditer(text):
        core = _CORE_START.search(m[0])
        if not core:
            continue
        a, b = m.start() + core.start(), m.end()
        while not _EDGE.match(text, b - 1):
            b -= 1
        if groups and m.start() == last and a == m.start():
            groups[-1].append((a, b))
        else:
            groups.append([(a, b)])
        last = m.end() + 1 if b == m.end() and text[m.end() : m.end() + 1] == " " else -1
    i = 0
    for tokens in groups:
        while i < len(taken) and taken[i][1] <= tokens[0][0]:
            i += 1
        if i < len(taken) and taken[i][0] < tokens[-1][1]:
            continue
        for a, b in dict.fromkeys([(tokens[0][0], tokens[-1][1]), *tokens]):
            if _looks_like(text[a:b]):
                out.append({"start": a, "end": b, "kind": None, "instance": _name(text[a:b]), "patterns": _contexts(text, a, b)})
    return out


_FOUND = "array<struct<start:long,end:long,kind:string,instance:string,patterns:array<string>>>"
_FOUND_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def _read(batches):
    for batch in batches:
        for at in range(0, len(batch), 512):
            part = batch.slice(at, 512)
            counts, base_text, found = {k: [] for k in KINDS}, [], []
            for i in range(len(part)):
                text = part.column("text")[i].as_py() or ""
                base = base_spans(text)
                for k in KINDS:
                    counts[k].append(sum(s[3] == k for s in base))
                base_text.append(_joined(base))
                found.append(stretches(text, base))
            yield pa.RecordBatch.from_arrays(
                [part.column("uid"), part.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(base_text, pa.string()), pa.array(found, _FOUND_TYPE)],
                names=["uid", "doc_id", *(f"n_{k}" for k in KINDS), "base", "found"])


def known_instances(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(instance, kind): the seeds and what trusted patterns lead to, from distinct ``edges`` (pattern, instance)."""
    known = materialize(seeds.select("instance", "kind"), "known")
    held = materialize(edges.groupBy("pattern").agg(F.count("*").alias("held")).where(F.col("held") >= SUPPORT), "patterns")
    for _ in range(ROUNDS):
        hits = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.count("*").alias("hits")).where(F.col("hits") >= SUPPORT)
        sure = hits.join(held, "pattern").where(F.col("hits") >= CONFIDENCE * F.col("held"))
        # One unknown instance more is allowed for, so that no pattern is certain.
        trusted = materialize(sure.select("pattern", "kind", (F.col("hits") / (F.col("held") + 1)).alias("confidence")), "trusted")
        open_edges = edges.join(known.select("instance"), "instance", "left_anti")
        doubt = open_edges.join(trusted, "pattern").groupBy("instance", "kind").agg(F.sum(F.log(1 - F.col("confidence"))).alias("doubt"))
        found = doubt.where(F.col("doubt") <= F.log(F.lit(1 - ACCEPTED)) + 1e-9)
        best = found.groupBy("instance").agg(F.min(F.struct("doubt", "kind"))["kind"].alias("kind"))
        new = materialize(best, "found")
        if not new.head(1):
            break
        known = materialize(known.union(new), "known")
    return known


def _merge(batches):
    place = {k: i for i, k in enumerate(KINDS)}
    for batch in batches:
        spans, digest = [], []
        for base, more in zip(batch.column("base").to_pylist(), batch.column("more").to_pylist(), strict=True):
            digest.append(hashlib.sha256(base.encode()).hexdigest())
            if not more:
                spans.append(base)
                continue
            every, end = [], -1
            for span in base.split(",") if base else []:
                kind, a, b = span.split(":")
                every.append((int(a), place[kind], int(b), kind))
            # Of a group and its tokens the group counts.
            for s in sorted(more, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= end:
                    every.append((s["start"], place[s["kind"]], s["end"], s["kind"]))
                    end = s["end"]
            spans.append(_joined(sorted(every)))
        names = [f"n_{k}" for k in KINDS]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(batch.column(n) for n in names), pa.array(digest, pa.string()), pa.array(spans, pa.string())],
            names=["doc_id", *names, "base_sha256", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and ``base_sha256`` are of the fixed shapes; ``spans`` has these and what the patterns lead to, as
    kind:start:end in order. Added spans overlap no span of a fixed shape. Null and empty texts have no spans; rows that share an id, or have none, are
    documents of their own, and equal texts get equal spans. A surface of two kinds counts as the first listed. An empty table gives an empty result; other
    columns are ignored, whatever their names.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    read = materialize(rows.mapInArrow(_read, f"uid long, doc_id {kind}, {counts}, base string, found {_FOUND}"), "stretches")
    found = read.select("uid", F.explode("found").alias("s")).select("uid", "s.*")
    edges = materialize(found.select(F.explode("patterns").alias("pattern"), "instance").distinct(), "edges")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    seeds = found.where("kind is not null").groupBy("instance").agg(F.min(F.struct(order.alias("at"), "kind"))["kind"].alias("kind"))
    known = known_instances(edges, seeds)
    open_ = found.where("kind is null").select("uid", "start", "end", "instance")
    more = open_.join(known, "instance").groupBy("uid").agg(F.collect_list(F.struct("start", "end", "kind")).alias("more"))  # of one document
    joined = read.join(more, "uid", "left").select("doc_id", *(f"n_{k}" for k in KINDS), "base", "more")
    return joined.mapInArrow(_merge, f"doc_id {kind}, {counts}, base_sha256 string, spans string")
