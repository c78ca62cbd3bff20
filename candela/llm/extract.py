"""Main text of web pages by wrappers inferred for each host.

A page is read as a stream of blocks: the path of elements around a block, and its text. Streams of
one host are aligned step by step into a wrapper, an expression without unions: where two streams
differ, the part becomes optional, or a repeated group if it repeats what stands beside it. Each place of a wrapper,
also inside repeated and optional groups, counts on how many pages it stands and the texts most pages have there.
A text that most pages with the place share is a constant, every other one fills a slot. Slots make up the main text,
inside an article or main element if the page has one; constants do not, wherever they stand.

Where pages are copies of each other nothing varies, and shares tell nothing; their texts stay. Names of elements
are a heuristic for what varies from page to page without being main text (comments, adverts, related links): they
count for the exact element, and never for one that holds the article or nearly all text of the page.

Pages are folded into wrappers where they lie, so what is shuffled is one wrapper a host and batch.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.words import small_batches

#: A text shared by this many aligned pages, and by this part of those that have its place, is a constant.
CONSTANT_PAGES, SHARE = 3, 0.8
#: Texts counted at one place; of more, those rarer than one in so many are forgotten first.
TEXTS = 128
#: An element that holds this part of a page's text is no boilerplate, whatever its names say.
NEARLY_ALL = 0.9
#: Longest group of blocks looked for as a repetition.
GROUP = 6
#: Wrappers of a host are first folded in this many parts.
PARTS = 32

# Element names and name parts of classes, ids and roles.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "select", "object"}
#: Raw elements whose body is no markup: without an end tag they take the rest of the page.
BODY = {"script", "style", "title", "textarea", "iframe"}
IN_HEAD = {"base", "link", "meta", "title", "style", "script", "noscript", "template"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "noscript"}
NAMED = {"ad", "ads", "advert", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "pagination", "popup", "promo", "promotion", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
MAIN = {"article", "main"}
#: Names that make an article element a comment or a teaser, and first parts that turn a name into a remark about the page.
NO_ARTICLE = {"ad", "ads", "advert", "comment", "comments", "promo", "related", "replies", "reply", "sidebar", "sponsored", "teaser", "widget"}
REMARKS = {"has", "is", "js", "no", "not", "with", "without"}
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""", re.S)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS_OF_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_VALUES = re.compile(r"""=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
_NOT_SHOWN = re.compile(r"""aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none""", re.I)


def _marked(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element's attributes tell that it is no main text; ``inside``: it stands in an article."""
    if len(attributes) <= 3:
        return False
    if _NOT_SHOWN.search(attributes) or _HIDDEN.search(_VALUES.sub("=", attributes)):
        return True
    if name in ("body", "html"):
        return False
    words = {w for m in _NAMES.finditer(attributes) for w in (m[2] or m[3] or m[4] or "").split()}
    parts = [[p.lower() for p in _PARTS_OF_NAME.findall(w)] for w in words]
    found = {p for some in parts if some and some[0] not in REMARKS for p in some}
    return bool(found & (NO_ARTICLE if name in MAIN else NAMED - {"header"} if inside else NAMED))


class _Element:
    """An open element; ``mark`` tells that its attributes speak against main text, ``size`` its text."""

    __slots__ = ("mark", "name", "size")

    def __init__(self, name: str, mark: bool):
        self.name, self.mark, self.size = name, mark, 0


def _paths(found: list[tuple[list[_Element], str]]) -> list[tuple[str, str]]:
    """(path, text) of the blocks; marks of elements that hold the article or nearly all text are taken back."""
    total = sum(len(text) for _, text in found)
    every = {id(e): e for stack, _ in found for e in stack}
    for stack, text in found:
        for e in stack:
            e.size += len(text)
    for e in every.values():
        if e.mark and e.size >= NEARLY_ALL * total and e.name not in MAIN:
            e.mark = False
    held = [(stack, i) for stack, _ in found for i, e in enumerate(stack) if e.name in MAIN and not e.mark]
    if held and not any(all(not e.mark and e.name not in ASIDE for e in stack[:i]) for stack, i in held):
        stack, i = max(held, key=lambda h: h[0][h[1]].size)
        for e in stack[:i]:
            e.mark = False
            e.name = "div" if e.name in ASIDE else e.name
    return [("/".join(e.name + "!" * e.mark for e in stack), text) for stack, text in found]


def page_blocks(page: str) -> list[tuple[str, str]]:
    """(path, text) of the blocks of a page in order; raw elements and comments are left out."""
    found: list[tuple[list[_Element], str]] = []
    stack: list[_Element] = []
    text: list[str] = []
    at, head = 0, False
    endless: set[str] = set()  # raw elements without a further end tag

    def flush() -> None:
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if words:
                found.append((list(stack), words))

    while m := _MARKUP.search(page, at):
        if m.start() > at:
            head = head and page[at : m.start()].isspace()
            if not head:
                text.append(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing = name.lower(), bool(m[1] or m[4])
        if name == "head":
            flush()
            head = not closing
            continue
        # Both tags of a head may be left out: it ends before what cannot stand in it.
        head = head and (closing or name in IN_HEAD)
        if name in RAW and not closing:
            if not (m[3] or m[6] or "").rstrip().endswith("/"):
                flush()
                end = None if name in endless else _ENDS[name].search(page, at)
                if end:
                    at = end.start()
                else:
                    endless.add(name)
                    at = len(page) if name in BODY else at
            continue
        if head:
            continue
        if name in INLINE:
            if name == "br":
                text.append(" ")
            continue
        if name in VOID:
            flush()
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
        else:
            gone = CLOSES.get(name)
            if gone is None and name not in INLINE:
                gone = {"p"}
            while stack and stack[-1].name in gone:
                stack.pop()
            stack.append(_Element(name, _marked(name, m[3] or m[6] or "", any(e.name in MAIN for e in stack))))
    if at < len(page):
        text.append(page[at:])
    flush()
    return _paths(found)


# A wrapper is a list of nodes: ["t", path, pages, {text hash: pages with it}], ["r", nodes], ["o", nodes].


def _key(node) -> str:
    """What two nodes must share to be aligned."""
    return node[1] if node[0] == "t" else "(" + ",".join(map(_key, node[1])) + ")"


def _counted(a: dict, b: dict, together: bool) -> dict:
    """Counts of the texts of two nodes; beyond TEXTS of them, all lose as much as the next one has."""
    out = dict(a)
    for text, n in b.items():
        out[text] = max(out.get(text, 0), n) if together else out.get(text, 0) + n
    if len(out) > TEXTS:
        lost = sorted(out.values(), reverse=True)[TEXTS]
        out = {text: n - lost for text, n in out.items() if n > lost}
    return out


def _join(a, b, together: bool):
    """One node for two aligned ones; ``together``: both stand on one page."""
    if a[0] == "t" and b[0] == "t":
        return ["t", a[1], max(a[2], b[2]) if together else a[2] + b[2], _counted(a[3], b[3], together)]
    kind = "r" if "r" in (a[0], b[0]) else "o"
    inner = [x[1] if x[0] != "t" else [x] for x in (a, b)]
    return [kind, [_join(x, y, together) for x, y in zip(*inner, strict=True)]]


def _bare(node) -> str:
    """The key without repetition and option of a single block."""
    return _key(node[1][0]) if node[0] != "t" and len(node[1]) == 1 else _key(node)


def collapse(nodes: list) -> list:
    """Adjacent equal groups become one repeated group, shorter groups first."""
    for size in range(1, GROUP + 1):
        keys, out, i = [_bare(n) for n in nodes], [], 0
        while i < len(nodes):
            group, j = nodes[i : i + size], i + size
            inside = len(group) == size and (size == 1 or all(n[0] == "t" for n in group))
            while inside and keys[j : j + size] == keys[i : i + size] and (size == 1 or all(n[0] == "t" for n in nodes[j : j + size])):
                group = [_join(x, y, True) for x, y in zip(group, nodes[j : j + size], strict=True)]
                j += size
            if inside and j > i + size:
                flat = [n for g in group for n in (g[1] if g[0] != "t" else [g])]
                out.append(["r", flat])
                i = j
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def align(a: list, b: list) -> list:
    """The wrapper of two wrappers; what only one of them has becomes optional."""
    left, right = [_bare(n) for n in a], [_bare(n) for n in b]
    if left == right:
        return [_join(x, y, False) for x, y in zip(a, b, strict=True)]
    out = []
    optional = lambda part: [["o", [n]] if n[0] == "t" else n for n in part]
    for tag, i, j, k, m in SequenceMatcher(None, left, right, False).get_opcodes():
        if tag == "equal":
            out += [_join(x, y, False) for x, y in zip(a[i:j], b[k:m], strict=True)]
        else:
            out += optional(a[i:j]) + optional(b[k:m])
    return collapse(out)


def page_wrapper(blocks: list[tuple[str, str]]) -> list:
    return collapse([["t", path, 1, {_hash(text): 1}] for path, text in blocks])


def _hash(text: str) -> str:
    return f"{zlib.crc32(text.encode()):x}"


def _texts(nodes):
    for n in nodes:
        if n[0] == "t":
            yield n
        else:
            yield from _texts(n[1])


def _boilerplate(path: str) -> bool:
    """Menus, notices and the like; a header inside the article is part of it."""
    inside = False
    for e in path.split("/"):
        if e.endswith("!") or (e in ASIDE and not (inside and e == "header")):
            return True
        inside |= e in MAIN
    return False


def _in_main(path: str) -> bool:
    return any(e in MAIN for e in path.split("/"))


class Rules:
    """What a wrapper tells about the blocks of its host's pages."""

    def __init__(self, nodes: list):
        self.constants, varies = set(), False
        for _, path, pages, texts in _texts(nodes):
            shared = {t for t, n in texts.items() if n >= CONSTANT_PAGES and n >= SHARE * pages}
            self.constants |= {(path, t) for t in shared}
            # Texts forgotten, or others than those shared, show that pages differ.
            varies |= not _boilerplate(path) and pages > 1 and (len(texts) > len(shared) or not texts)
        if not varies:
            self.constants = set()

    def main_text(self, blocks: list[tuple[str, str]]) -> str:
        kept = [b for b in blocks if not _boilerplate(b[0])]
        article = [b for b in kept if _in_main(b[0])]
        slots = [b for b in article or kept if (b[0], _hash(b[1])) not in self.constants]
        size = lambda some: sum(len(t) for _, t in some)
        # An article with over a third of constants is a copy of others, in part at least; so is a page without any slot.
        if (article and 3 * size(slots) < 2 * size(article)) or not slots:
            slots = article or kept
        return " ".join(text for _, text in slots)


def _fold(batches):
    for batch in batches:
        wrappers: dict[str, list] = {}
        for host, page in zip(batch.column("_host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            found = page_wrapper(page_blocks(page or ""))
            if found:
                wrappers[host] = align(wrappers[host], found) if host in wrappers else found
        yield pa.RecordBatch.from_arrays([pa.array(list(wrappers), pa.string()), pa.array([json.dumps(w) for w in wrappers.values()], pa.string())], names=["_host", "wrapper"])


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    out: list = []
    for text in sorted(rows["wrapper"], key=lambda t: (len(t), t)):
        out = align(out, json.loads(text)) if out else json.loads(text)
    return pd.DataFrame({"_host": rows["_host"].iloc[:1], "wrapper": [json.dumps(out)]})


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(_host, wrapper) of pages (_host, html); the wrapper as JSON."""
    folded = pages.mapInArrow(_fold, "_host string, wrapper string")
    parts = folded.groupBy("_host", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS)).alias("part"))
    some = parts.applyInPandas(lambda rows: _merge(rows), "_host string, wrapper string")
    return some.groupBy("_host").applyInPandas(lambda rows: _merge(rows), "_host string, wrapper string")


def _extract(batches):
    known: dict[str, Rules] = {}
    for batch in batches:
        texts = []
        for wrapper, page in zip(batch.column("wrapper").to_pylist(), batch.column("html").to_pylist(), strict=True):
            wrapper = wrapper or "[]"
            if wrapper not in known:
                if len(known) > 5000:
                    known.clear()
                known[wrapper] = Rules(json.loads(wrapper))
            texts.append(known[wrapper].main_text(page_blocks(page or "")))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page row: page_id, url, text, n_chars.

    Null and empty pages give an empty text. Pages without a host (null or odd urls) share one
    wrapper. Repeated rows get equal texts; an empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    small_batches(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit("")))
    rows = pages.select("page_id", "url", "html", host.alias("_host"))
    wrappers = host_wrappers(rows.select("_host", "html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.join(wrappers, "_host", "left").select("page_id", "url", "html", "wrapper").mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
