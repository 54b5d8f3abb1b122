"""Main text of web pages by union-free wrappers.

Per host, all distinct pages are read into trees and aligned, equal ones once, in groups whose wrappers are aligned in turn. Where
two token streams disagree, the mismatch becomes an optional part (only one of them has it), a repeated group (one has it more
often) or a text slot (the same place with another text). Parts and texts are counted by page: a text that most pages have at its
place is the host's template, even if some have another or none. The wrapper also remembers where the main part of the page sits.

Every page is then read along its host's wrapper: the text of the main part is kept, without the parts that are navigation, notices
or the like by their element or class, and without the template's own words. A page that does not fit keeps what does not fit as text.
"""

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.llm.common import short_batches, slices
from smeltworks.sources.scratch import materialise

# Distinct pages of a host from which on an element or a text may be template, and their share, one in so many, of all of the host's.
# So a wrapper has at most this many times the parts of a page, however many pages it is made from.
LEAST_PAGES = 3
SHARE = 100
# Wrappers that are aligned one after the other, and parts in a row from which on their order is given up.
GROUP = 64
LONG = 64
# Elements nested more deeply than this are read as part of the one above.
DEPTH = 150

# Element names of HTML and the words that class, id and role use for parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul li dt dd tr td th tbody thead tfoot".split()
)
ENDS_OWN = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"),
}
HOLDS_OWN = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}
LEFT_OUT = frozenset(
    "head title nav footer aside form script style noscript template iframe object svg math canvas audio video button select "
    "textarea input dialog menu datalist map".split()
)
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay sidebar sidebars side menu menus nav navbar navigation breadcrumb breadcrumbs comment comments disqus "
    "respond reply replies share sharing social related recommended newsletter subscribe subscription signup login search pagination "
    "pager toolbar widget widgets skip footer complementary contentinfo".split()
)
REPLY_WORDS = frozenset("comment comments disqus respond reply replies".split())
OUTER_WORDS = frozenset("header masthead topbar".split())
# Beside one of these a class name tells the state of an element, such as "has-sidebar" or "comments-open", not what it is.
STATE_WORDS = frozenset("has no not with without is open opened closed enabled disabled allowed on off layout".split())
MAIN_WORDS = frozenset("article content main post entry story body text".split())

RAW = "script|style|textarea|title|noscript|template|iframe"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)>",
    re.IGNORECASE | re.DOTALL,
)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """An element with its children, nodes and texts. ``out``: no main text by its own name or marks; ``marked``: by its marks alone."""

    __slots__ = ("name", "key", "words", "children", "out", "marked")

    def __init__(self, name: str, words: frozenset[str], out: bool, marked: bool = False):
        self.name, self.words, self.out, self.marked = name, words, out or marked, marked and not out
        self.key = name if not words else f"{name}.{'.'.join(sorted(words))}"
        self.children: list = []


def parse(html: str) -> Node:
    root = Node("#page", frozenset(), False)
    stack, inner, at = [root], 0, 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            _add_text(stack[-1], html[at : m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    inner -= sum(n.name in ("article", "main") for n in stack[i:])
                    del stack[i:]
                    break
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if name in CLOSES_P:
            inner -= _close(stack, ("p",), ("td", "th", "table", "button", "object"))
        if name in ENDS_OWN:
            inner -= _close(stack, ENDS_OWN[name], HOLDS_OWN[name])
        marks = [[w.lower() for w in WORDS.findall(mark)] for g in MARKS.findall(attrs) for mark in " ".join(g).split()] if attrs else []
        words = frozenset(w for mark in marks for w in mark)
        node = Node(name, words, name in LEFT_OUT or (not inner and name == "header"), name not in ("html", "body") and _marked(marks, not inner))
        stack[-1].children.append(node)
        if name not in VOID and not attrs.endswith("/") and len(stack) < DEPTH:
            stack.append(node)
            inner += name in ("article", "main")
    if at < len(html):
        _add_text(stack[-1], html[at:])
    _spare_ancestors(root)
    return root


def _marked(marks: list[list[str]], outer: bool) -> bool:
    """Whether class, id or role name an element as something beside the main text.

    A mark that tells a state says nothing, and a compound one gives way to a plain "content", "post" or the like next to it.
    """
    told = [m for m in marks if STATE_WORDS.isdisjoint(m)]
    if any(len(m) == 1 and m[0] in MAIN_WORDS for m in told):
        told = [m for m in told if len(m) == 1]
    words = {w for m in told for w in m}
    return not words.isdisjoint(LEFT_OUT_WORDS) or (outer and not words.isdisjoint(OUTER_WORDS))


def _spare_ancestors(root: Node) -> None:
    """What holds an article or main element that is itself not left out is no mere part beside the main text, whatever its marks."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, Node) and (c.marked or not c.out)]
    holds = set()
    for node in reversed(order):
        if any(id(c) in holds for c in node.children if isinstance(c, Node)) or (node.name in ("article", "main") and not node.out):
            holds.add(id(node))
            if node.marked:
                node.out = node.marked = False


def _leads(node: Node) -> bool:
    """Whether an element, or one below it that is not left out, is named as a main part or is the page's heading."""
    todo = [node]
    while todo:
        node = todo.pop()
        if node.name == "h1" or not node.words.isdisjoint(MAIN_WORDS):
            return True
        todo += [c for c in node.children if isinstance(c, Node) and not c.out]
    return False


def _spare_largest(root: Node) -> bool:
    """On a page without article, main element or other text, the marked element with a heading or main part and most running text
    is the main part after all. Never comments. False if there is none."""
    best, most, todo = None, 0, [root]
    while todo:
        for child in todo.pop().children:
            if not isinstance(child, Node) or not (child.marked or not child.out) or not child.words.isdisjoint(REPLY_WORDS):
                continue
            if child.name in ("article", "main") and not child.out:
                return False
            if child.marked and _leads(child) and (weight := sum(len(c.strip()) if isinstance(c, str) else _weight(c) for c in child.children)) > most:
                best, most = child, weight
            todo.append(child)
    if best is not None:
        best.out = best.marked = False
    return best is not None


def _add_text(node: Node, text: str) -> None:
    if node.children and isinstance(node.children[-1], str):
        node.children[-1] += text
    else:
        node.children.append(text)


def _close(stack: list[Node], names: tuple[str, ...], barriers: tuple[str, ...]) -> int:
    """Close an open element that the next tag ends; how many article or main elements that closed."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name in barriers:
            return 0
        if stack[i].name in names:
            closed = sum(n.name in ("article", "main") for n in stack[i:])
            del stack[i:]
            if names != ("p",):
                return closed + _close(stack, names, barriers)
            return closed
    return 0


def plain(text: str) -> str:
    return " ".join(entities.unescape(text).split())


# -- wrappers
#
# A wrapper is a list of items. An item is a dict: "k" its key (an element's, "#text", or for a group "(key key)"), "o" optional,
# or "(*)" for a group in any order), "r" repeated, "n" the pages that have it, "c" the items inside, and for texts "ts", their pages by ``mark``. In a finished
# wrapper, texts have "t" instead, the mark of the template text or None for a slot.


def mark(text: str) -> str:
    """A text that is not short is known by a digest; as no plain text does, this begins with a space."""
    return text if len(text) <= 32 else " " + hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def items_of(node: Node) -> list[dict]:
    items = []
    for child in node.children:
        if isinstance(child, Node):
            items.append({"k": child.key, "o": False, "r": False, "n": 1, "c": items_of(child)})
        elif text := plain(child):
            items.append({"k": "#text", "o": False, "r": False, "n": 1, "ts": {mark(text): 1}, "c": []})
    return fold(items)


def fold(items: list[dict]) -> list[dict]:
    """Tandem repeats of one to three items become one repeated item or group; the order of very many items is given up."""
    for period in (1, 2, 3):
        out: list[dict] = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * period and _same(out, -2 * period, -period, period):
                first, second = out[-2 * period : -period], out[-period:]
                del out[-2 * period :]
                merged = [merge_item(a, b, False) for a, b in zip(first, second, strict=True)]
                if period == 1:
                    out.append({**merged[0], "r": True})
                else:
                    out.append(_group(merged, True))
            # A group swallows a further round that follows it.
            if period > 1 and len(out) > period and (g := out[-period - 1])["r"] and g["k"][0] == "(" and g["k"] == f"({' '.join(_keys(out[-period:]))})":
                out[-period - 1 :] = [merge_item(g, _group(out[-period:], True), False)]
        items = out
    return items if len(items) <= LONG else _loose(items)


def _same(items: list[dict], i: int, j: int, size: int) -> bool:
    return all(items[i + d]["k"] == items[j + d]["k"] for d in range(size))


def _group(items: list[dict], repeated: bool, key: str | None = None) -> dict:
    return {"k": key or f"({' '.join(_keys(items))})", "o": False, "r": repeated, "n": max(i["n"] for i in items), "c": items}


def _loose(items: list[dict]) -> list[dict]:
    """A repeated group in which each key occurs once and is optional: it fits all that ``items`` fit, in any order."""
    found: dict[str, dict] = {}
    todo = items[::-1]
    while todo:
        item = todo.pop()
        if item["k"][0] == "(":
            todo += item["c"][::-1]
        else:
            found[item["k"]] = merge_item(found[item["k"]], item, False) if item["k"] in found else item
    return [_group([{**i, "o": True} for _, i in sorted(found.items())], True, "(*)")] if found else []


def _keys(items: list[dict]) -> list[str]:
    return [i["k"] for i in items]


def merge_item(a: dict, b: dict, apart: bool) -> dict:
    """``apart``: the items are of different pages, else of the same ones, or of some that cannot be told apart."""
    item = {"k": a["k"], "o": a["o"] or b["o"], "r": a["r"] or b["r"], "n": a["n"] + b["n"] if apart else max(a["n"], b["n"])}
    if a["k"] == "#text":
        if apart:
            item["ts"] = {t: a["ts"].get(t, 0) + b["ts"].get(t, 0) for t in {**a["ts"], **b["ts"]}}
        else:
            item["ts"] = {t: min(n, b["ts"][t]) for t, n in a["ts"].items() if t in b["ts"]}
        item["c"] = []
    elif a["k"] == "(*)":
        ours, theirs = {i["k"]: i for i in a["c"]}, {i["k"]: i for i in b["c"]}
        item["c"] = [merge_item(ours[k], theirs[k], apart) if k in ours and k in theirs else ours.get(k) or theirs[k] for k in sorted({**ours, **theirs})]
    elif a["k"][0] == "(":
        item["c"] = [merge_item(x, y, apart) for x, y in zip(a["c"], b["c"], strict=True)]
    else:
        item["c"] = merge(a["c"], b["c"], apart)
    return item


def merge(a: list[dict], b: list[dict], apart: bool = True) -> list[dict]:
    """Align two item lists: common items are merged, the others become optional, and repeats that arise are folded."""
    keys, others = _keys(a), _keys(b)
    if ("(*)" in keys or "(*)" in others) and a and b:
        a, b = _loose(a), _loose(b)
        return [merge_item(a[0], b[0], apart)]
    if keys == others:
        return fold([merge_item(p, q, apart) for p, q in zip(a, b, strict=True)])
    groups = {i["k"]: len(i["c"]) for i in (*a, *b) if i["k"][0] == "("}
    if groups:
        a, b = _regrouped(a, groups), _regrouped(b, groups)
        keys, others = _keys(a), _keys(b)
    out, i, j = [], 0, 0
    for x, y, n in SequenceMatcher(None, keys, others, autojunk=False).get_matching_blocks():
        out += [{**item, "o": True} for item in (*a[i:x], *b[j:y])]
        out += [merge_item(p, q, apart) for p, q in zip(a[x : x + n], b[y : y + n], strict=True)]
        i, j = x + n, y + n
    return fold(out)


def _regrouped(items: list[dict], groups: dict[str, int]) -> list[dict]:
    """Single rounds of the groups that the other side has."""
    for key, size in groups.items():
        out: list[dict] = []
        for item in items:
            out.append(item)
            if len(out) >= size and key == f"({' '.join(_keys(out[-size:]))})":
                out[-size:] = [_group(out[-size:], False)]
        items = out
    return items


def _weight(node: Node) -> int:
    """Letters of running text below a node, links left out."""
    if node.out or node.name == "a":
        return 0
    return sum(len(c) if isinstance(c, str) else _weight(c) for c in node.children)


def main_paths(root: Node) -> list[str]:
    """Paths of keys to the elements that hold the main text: articles, else main elements, else elements named so, else the
    element with most running text in its own paragraphs."""
    found: dict[str, list[str]] = {"article": [], "main": [], "words": []}
    best, best_path = 0, root.key
    todo: list[tuple[Node, str]] = [(root, root.key)]
    while todo:
        node, path = todo.pop()
        own = 0
        for child in node.children:
            if isinstance(child, str):
                own += len(child.strip())
            elif not child.out:
                below = f"{path}>{child.key}"
                if child.name == "article":
                    found["article"].append(below)
                elif child.name == "main" or "main" in child.words:
                    found["main"].append(below)
                elif child.words & MAIN_WORDS:
                    found["words"].append(below)
                if child.name in INLINE or child.name in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "ul", "ol"):
                    own += _weight(child)
                todo.append((child, below))
        if own > best:
            best, best_path = own, path
    for kind in ("article", "main"):
        if found[kind]:
            return sorted(set(found[kind]))
    named = [p for p in found["words"] if best_path == p or best_path.startswith(p + ">")]
    return [min(named, key=len)] if named else [best_path]


def finished(items: list[dict], pages: int, around: int | None = None) -> list[dict]:
    """Items that are on enough of the host's ``pages``, with the template texts: those of more than half of the pages that have
    the element around them, and of enough."""
    done, around = [], pages if around is None else around
    for i in items:
        if SHARE * i["n"] < pages:
            continue
        item = {"k": i["k"], "o": i["o"], "r": i["r"], "c": finished(i["c"], pages, around if i["k"][0] == "(" else i["n"])}
        if i["k"] == "#text":
            best = max(i["ts"].items(), key=lambda t: (t[1], t[0]), default=(None, 0))
            item["t"] = best[0] if best[1] >= LEAST_PAGES and 2 * best[1] > around else None
        done.append(item)
    return done


def induce(pages: list[str]) -> dict:
    """The wrapper of the pages of one host, copies taken once."""
    trees = [parse(p) for p in sorted(set(pages))]
    items, votes = [], Counter()
    for n, tree in enumerate(trees):
        items = items_of(tree) if not n else merge(items, items_of(tree))
        votes.update(main_paths(tree))
    return {"items": finished(items, len(trees)), "main": sorted(p for p, n in votes.items() if 2 * n >= len(trees))}


def lean(items: list[dict]) -> list[dict]:
    """What reading needs: where no template text is below, no items are."""
    kept = [{**i, "c": lean(i["c"])} for i in items]
    return kept if any(i["c"] or i.get("t") is not None for i in kept) else []


def place_of(path: str, text: str = "") -> int:
    return int.from_bytes(hashlib.blake2b(f"{path}\n{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def places(items: list[dict], path: str = "") -> set[int]:
    """Numbers of elements and texts at their paths."""
    found: set[int] = set()
    for item in items:
        if item["k"][0] == "(":
            found |= places(item["c"], path)
            continue
        below = f"{path}>{item['k']}"
        found.add(place_of(below))
        if item["k"] == "#text":
            found.update(place_of(below, t) for t in item["ts"])
        else:
            found |= places(item["c"], below)
    return found


def only_known(items: list[dict], known: set[int], path: str = "") -> list[dict]:
    """Items without the elements and texts that are not ``known`` at their paths. Where a page has one, reading goes on behind it."""
    done = []
    for item in items:
        below = f"{path}>{item['k']}"
        if item["k"][0] == "(":
            inner = only_known(item["c"], known, path)
            if item["k"] == "(*)" and inner:
                done.append({**item, "c": inner})
            elif len(inner) > 1:
                done.append({**_group(inner, item["r"]), "n": item["n"]})
            else:
                done += [{**i, "r": True} for i in inner]
        elif place_of(below) in known:
            if item["k"] == "#text":
                done.append({**item, "ts": {t: n for t, n in item["ts"].items() if place_of(below, t) in known}})
            else:
                done.append({**item, "c": only_known(item["c"], known, below)})
    return fold(done)


def times(items: list[dict], n: int) -> list[dict]:
    """The items of ``n`` times the pages."""
    if n == 1:
        return items
    return [{**i, "n": n * i["n"], "c": times(i["c"], n), **({"ts": {t: n * m for t, m in i["ts"].items()}} if "ts" in i else {})} for i in items]


# -- extraction


def extract(html: str | None, wrapper: dict | None) -> str:
    """The main text: white space inside a block and between blocks is one space."""
    if not html:
        return ""
    root = parse(html)
    text = _main_part(root, wrapper)
    while not text and _spare_largest(root):
        text = _main_part(root, None)
    return text


def _main_part(root: Node, wrapper: dict | None) -> str:
    for paths in ([set(wrapper["main"])] if wrapper and wrapper["main"] else []) + [None]:
        paths = set(main_paths(root)) if paths is None else paths
        kept: list[tuple[str, bool]] = []
        _read(root, root.key, wrapper["items"] if wrapper else [], paths, root.key in paths, kept)
        # Pages that are copies of each other are no template: words are left out only where they are the smaller part.
        own, fixed = (sum(len(t) for t, is_fixed in kept if is_fixed is f) for f in (False, True))
        text = "".join(t for t, is_fixed in kept if not (is_fixed and fixed < own))
        if text := " ".join(text.split()):
            return text
    return ""


def _read(node: Node, path: str, items: list[dict], paths: set[str], inside: bool, kept: list) -> None:
    at = 0
    for child in node.children:
        is_text = isinstance(child, str)
        item, at = _next(items, at, "#text" if is_text else child.key)
        if is_text:
            if inside:
                decoded = entities.unescape(child)
                fixed = item is not None and item["t"] is not None and mark(" ".join(decoded.split())) == item["t"]
                kept.append((decoded, fixed))
            continue
        if child.out:
            kept.append((" ", False))
            continue
        below = f"{path}>{child.key}"
        block = child.name not in INLINE
        if block:
            kept.append((" ", False))
        _read(child, below, item["c"] if item else [], paths, inside or below in paths, kept)
        if block:
            kept.append((" ", False))


def _next(items: list[dict], at: int, key: str) -> tuple[dict | None, int]:
    """The item that a token with ``key`` matches from position ``at`` on, and the position after it; a repeated one may match again."""
    for i in range(at, len(items)):
        item = items[i]
        if item["k"] == key:
            return item, i if item["r"] else i + 1
        if item["k"].startswith("("):
            for inner in item["c"]:
                if inner["k"] == key:
                    return inner, i
    return None, at


def host_of(url: Column) -> Column:
    """Host of a URL, lower case; null without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def page_items(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, h, items, main, places)``: each distinct page of a host, by a hash of it, as items in JSON."""
    page = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).where("host IS NOT NULL AND html IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            items, main, at = [], [], []
            for text in batch.column(2).to_pylist():
                tree = parse(text)
                found = items_of(tree)
                items.append(_dumps(found))
                main.append(main_paths(tree))
                at.append(sorted(places(found)))
            columns = [batch.column(0), batch.column(1), pa.array(items, pa.string()), pa.array(main, pa.list_(pa.string())), pa.array(at, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "h", "items", "main", "places"])

    read = page.select("host", F.xxhash64("html").alias("h"), "html").mapInArrow(
        run, "host string, h bigint, items string, main array<string>, places array<bigint>"
    )
    return read.dropDuplicates(["host", "h"])


def _dumps(items: list[dict]) -> str:
    return json.dumps(items, ensure_ascii=True, separators=(",", ":"))


def _recurring(read: DataFrame) -> DataFrame:
    """``(host, known)``: numbers of the elements and texts that are on enough of the host's pages."""
    total = read.groupBy("host").agg(F.count("*").alias("pages"))
    seen = read.select("host", F.explode("places").alias("place")).groupBy("host", "place").agg(F.count("*").alias("n")).where(f"n >= {LEAST_PAGES}")
    return seen.join(total, "host").where(f"{SHARE} * n >= pages").groupBy("host").agg(F.collect_list("place").alias("known"))


def _shapes(read: DataFrame) -> DataFrame:
    """``(host, items, n)``: pages without the elements and texts that are no template, equal ones once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            items = [_dumps(only_known(json.loads(i), set(k or ()))) for i, k in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.string())], names=["host", "items"])

    known = materialise(_recurring(read), "known")
    cut = read.select("host", "items").join(known, "host", "left").select("host", "items", "known").mapInArrow(run, "host string, items string")
    return cut.groupBy("host", "items").agg(F.count("*").alias("n"))


def _aligned(shapes: DataFrame) -> DataFrame:
    """``(host, items, n)``, one row per host: groups of ``GROUP`` are aligned in a task, then their results likewise.

    Groups and their order depend on the items alone, not on how the rows are dealt. Only the largest count goes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, items = None, []
        for batch in (part for whole in batches for part in slices(whole)):
            for host, deal, found, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = times(json.loads(found), n)
                if (host, deal) != at:
                    if at is not None:
                        yield _row(at[0], items)
                    at, items = (host, deal), found
                else:
                    items = merge(items, found)
        if at is not None:
            yield _row(at[0], items)

    while True:
        shapes = materialise(shapes, "shapes")
        sizes = shapes.groupBy("host").agg(F.count("*").alias("shapes"), F.max("n").alias("n"))
        if (sizes.agg(F.max(F.greatest("shapes", "n"))).first()[0] or 0) <= 1:
            return shapes
        dealt = shapes.join(sizes.select("host", "shapes"), "host")
        dealt = dealt.select("host", F.pmod(F.xxhash64("items"), F.ceil(F.col("shapes") / GROUP)).alias("deal"), "items", "n")
        ordered = dealt.repartition("host", "deal").sortWithinPartitions("host", "deal", "items", "n")
        shapes = ordered.mapInArrow(run, "host string, items string, n bigint")


def _row(host: str, items: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([host]), pa.array([_dumps(items)]), pa.array([1], pa.int64())], names=["host", "items", "n"])


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, wrapper)``: a wrapper as JSON per host, from all its distinct pages, without the parts that reading does not need."""
    read = materialise(page_items(pages, url, html), "page_items")
    total = read.groupBy("host").agg(F.count("*").alias("pages"))
    votes = read.select("host", F.explode("main").alias("path")).groupBy("host", "path").agg(F.count("*").alias("n"))
    main = votes.join(total, "host").where("2 * n >= pages").groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("main"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                json.dumps({"items": lean(finished(json.loads(items), pages)), "main": main or []}, ensure_ascii=False)
                for items, pages, main in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["host", "wrapper"])

    whole = _aligned(_shapes(read)).join(total, "host").join(main, "host", "left").select("host", "items", "pages", "main")
    return whole.mapInArrow(run, "host string, wrapper string")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars`` (code points).

    Null and empty pages have the empty text. A page whose URL has no host, and a host with fewer than ``LEAST_PAGES`` distinct pages, have no
    template: the main part alone decides. Repeated rows give repeated rows; an empty table gives none. Other columns are not read.
    """
    short_batches(pages.sparkSession)
    # Written first: its true size decides whether it is sent to all tasks or joined by a shuffle.
    known = materialise(wrappers(pages, url, html), "wrappers")
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    joined = source.withColumn("host", host_of(F.col("url"))).join(known, "host", "left").select("page_id", "url", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str | None, dict | None] = {None: None}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if wrapper not in read:
                    if len(read) > 1000:
                        read = {None: None}
                    read[wrapper] = json.loads(wrapper)
                texts.append(extract(page, read[wrapper]))
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths], names=["page_id", "url", "text", "n_chars"])

    types = dict(source.dtypes)
    return joined.mapInArrow(run, f"page_id {types['page_id']}, url string, text string, n_chars bigint")
