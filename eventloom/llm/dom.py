"""Web pages as trees of blocks: tolerant parsing, and features of every node."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

# Elements of HTML, by what they do to the text.
BLOCKS = set("address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
HIDDEN = set("noscript template svg select button canvas audio video object datalist".split())
CLOSE_P = BLOCKS - {"caption", "legend", "tbody", "td", "tfoot", "th", "thead", "tr"}
CONTROLS = set("input select textarea button".split())
CELLS = set("td th caption table".split())
#: What a start tag ends if it is open, and what that search stops at.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"})}
TABLE_PARTS = set("caption table tbody td tfoot th thead tr".split())

_MARKUP = re.compile(r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|/[^a-zA-Z>][^>]*(?:>|\Z)|(?P<start>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|[="'])*+)(?:>|\Z))""", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'])(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Page:
    """A page's blocks in page order: elements, and runs of text beside other blocks (tag '#').  Node 0 is the body.

    An element that holds one run and nothing else has that text itself.  Counts are each node's own."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["body"])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    before: list[int] = field(default_factory=lambda: [-1])
    text: list[str] = field(default_factory=lambda: [""])
    linked: list[float] = field(default_factory=lambda: [0.0])
    links: list[int] = field(default_factory=lambda: [0])
    inline: list[int] = field(default_factory=lambda: [0])
    controls: list[int] = field(default_factory=lambda: [0])
    main: list[int] = field(default_factory=lambda: [0])
    last: list[int] = field(default_factory=lambda: [-1])

    def add(self, parent: int, tag: str, names: tuple[str, ...] = (), text: str = "", linked: float = 0.0, links: int = 0, inline: int = 0, main: int | None = None) -> int:
        i = len(self.parent)
        for column, value in ((self.parent, parent), (self.tag, tag), (self.names, names), (self.before, self.last[parent]), (self.text, text), (self.linked, linked), (self.links, links), (self.inline, inline), (self.controls, 0), (self.main, self.main[parent] if main is None else main), (self.last, -1)):
            column.append(value)
        self.last[parent] = i
        return i

    def fold(self, i: int) -> None:
        """If the element, the last but one node, holds one run alone, it takes its text."""
        if i and i == len(self.parent) - 2 and self.parent[-1] == i and self.tag[-1] == "#":
            for column in (self.text, self.linked, self.links, self.inline):
                column[i] = column[-1]
            for column in (self.parent, self.tag, self.names, self.before, self.text, self.linked, self.links, self.inline, self.controls, self.main, self.last):
                column.pop()
            self.last[i] = -1


def words_of(value: str) -> list[str]:
    """The words of a class or id, in lower case, without a plural's s, six letters of each."""
    return [w.lower().rstrip("s")[:6] for w in _PART.findall(value) if len(w) > 1]


def _names(attributes: str) -> tuple[tuple[str, ...], int | None]:
    found, main = [], None
    for name, *values in _NAMED.findall(attributes):
        value = next((v for v in values if v), "")
        if name.lower() == "data-main":
            main = int(value == "1")
        else:
            found += words_of(value)
    return tuple(dict.fromkeys(found)), main


def _hidden_end(text: str, name: str, at: int) -> int:
    """Where the hidden element that begins before `at` ends; `at` if its end tag is missing."""
    open_tags = 1
    for m in re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>", re.I).finditer(text, at):
        open_tags += -1 if m[1] else 1
        if not open_tags:
            return m.end()
    return at


def parse(text: str, marks: bool = False) -> Page:
    """The page's blocks.  Mistakes are mended as browsers do in the main: paragraphs, list items and cells end by
    themselves, end tags without a start mean nothing, raw text runs to its own end tag.  A block's text has its
    references decoded and its white space (line breaks by <br> too) made one space.  `marks` reads data-main."""
    page = Page()
    stack: list[tuple[str, int]] = [("body", 0)]
    run: list[str] = []
    state = {"link": False, "linked": 0, "all": 0, "links": 0, "inline": 0}
    at, n = 0, len(text)

    def piece(s: str) -> None:
        if s:
            run.append(html.unescape(s) if "&" in s else s)
            state["all"] += len(s)
            if state["link"]:
                state["linked"] += len(s)

    def flush() -> None:
        if run:
            plain = " ".join("".join(run).split())
            if plain:
                page.add(stack[-1][1], "#", (), plain, state["linked"] / max(1, state["all"]) * len(plain), state["links"], state["inline"])
            run.clear()
        state["linked"] = state["all"] = state["links"] = state["inline"] = 0

    def pop(to: int) -> None:
        while len(stack) > to:
            page.fold(stack.pop()[1])

    def find(names: set[str], stops: set[str]) -> int:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                return k
            if stack[k][0] in stops:
                break
        return 0

    while at < n:
        m = _MARKUP.search(text, at)
        if not m:
            piece(text[at:])
            break
        piece(text[at : m.start()])
        at = m.end()
        if name := m["start"]:
            name = name.lower()
            if name in CONTROLS:
                page.controls[stack[-1][1]] += 1
            if name in BLOCKS:
                flush()
                if name in CLOSE_P and (k := find({"p"}, CELLS | {"body"})):
                    pop(k)
                if name in ENDS and (k := find(*ENDS[name])):
                    pop(k)
                names, main = _names(m["attributes"]) if m["attributes"] else ((), None)
                stack.append((name, page.add(stack[-1][1], name, names, main=main if marks else None)))
            elif name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(text, at)
                at = end.end() if end else n
            elif name in HIDDEN:
                at = at if m["attributes"].endswith("/") else _hidden_end(text, name, at)
            elif name == "hr":
                flush()
            elif name == "br":
                piece(" ")
            elif name == "a":
                state["link"] = True
                state["links"] += 1
            else:
                state["inline"] += 1
        elif name := m["end"]:
            name = name.lower()
            if name in BLOCKS:
                flush()
                if k := find({name}, set() if name in TABLE_PARTS else CELLS):
                    pop(k)
            elif name == "a":
                state["link"] = False
    flush()
    pop(0)
    return page


#: What is known of each node, by itself, its subtree, its parent and its siblings.
FEATURES = (
    "tag names_low names_high up_tag_low up_tag_high up_names_low up_names_high down_names_low down_names_high chars words link_share links inline controls stops ended leaf_chars leaves share tag_density "
    "depth depth_share begin end siblings place same_names parent_chars parent_link parent_share before_chars before_link after_chars after_link paragraphs items headings page_chars page_leaves largest digits symbols"
).split()

_STOPS, _DIGITS, _SYMBOLS = re.compile(r"[.,;:!?。，、]"), re.compile(r"\d"), re.compile(r"[|»›·•©#*$%&<>]")


def features(pages: Sequence[Page], tag_score: dict[str, float], name_score: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of FEATURES for every node of all pages, where each page's nodes begin, one more than pages).

    *_score: how much a tag or a word of a class or id speaks for main text, as learned; 0 where unknown.  Sums over a
    subtree are differences of running sums, since nodes stand in page order."""
    sizes = np.array([len(p.parent) for p in pages], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    n = int(first[-1])
    page = np.repeat(np.arange(len(pages)), sizes)
    every = lambda name: [x for p in pages for x in getattr(p, name)]
    shift = np.repeat(first[:-1], sizes)
    parent, before = (np.where((v := np.array(every(c), np.int64)) < 0, -1, v + shift) for c in ("parent", "before"))
    tags, names, texts = every("tag"), every("names"), every("text")
    up = np.maximum(parent, 0)

    depth, stop = np.zeros(n, np.int64), np.arange(1, n + 1)
    levels = [np.flatnonzero(parent < 0)]
    order = np.argsort(parent, kind="stable")
    children = np.bincount(parent[parent >= 0], minlength=n)
    begin = np.searchsorted(parent[order], np.arange(n))
    while True:
        above = levels[-1][children[levels[-1]] > 0]
        if not len(above):
            break
        count = children[above]
        own = order[np.repeat(begin[above] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
        depth[own] = len(levels)
        levels.append(own)
    for level in levels[:0:-1]:
        np.maximum.at(stop, parent[level], stop[level])

    chars = np.array([len(t) for t in texts], float)
    leaf = chars > 0
    own = {
        "chars": chars, "words": np.array([t.count(" ") + 1 if t else 0 for t in texts], float), "linked": np.array(every("linked")), "links": np.array(every("links"), float), "inline": np.array(every("inline"), float), "controls": np.array(every("controls"), float),
        "stops": np.array([len(_STOPS.findall(t)) for t in texts], float), "ended": np.array([t[-1:] in ".!?…\"”'’" and t != "" for t in texts], float), "leaves": leaf.astype(float), "nodes": np.ones(n),
        "paragraphs": np.array([t == "p" for t in tags], float), "items": np.array([t == "li" for t in tags], float), "headings": np.array([len(t) == 2 and t[0] == "h" and t != "hr" for t in tags], float),
        "digits": np.array([len(_DIGITS.findall(t)) for t in texts], float), "symbols": np.array([len(_SYMBOLS.findall(t)) for t in texts], float),
    }
    total = {}
    for k, v in own.items():
        running = np.concatenate([[0.0], np.cumsum(v)])
        total[k] = running[stop] - running[np.arange(n)]
        if k == "chars":
            before_text = running[np.arange(n)] - running[shift]
    of_page = {k: total[k][first[:-1]][page] for k in ("chars", "leaves", "nodes")}

    tag = np.array([tag_score.get(t, 0.0) for t in tags])
    low, high = np.zeros(n), np.zeros(n)
    for i, own_names in enumerate(names):
        if own_names:
            scores = [name_score.get(x, 0.0) for x in own_names]
            low[i], high[i] = min(0.0, *scores), max(0.0, *scores)
    # Along the ancestors, and over what lies below.
    ups = {"up_tag_low": (tag, np.minimum), "up_tag_high": (tag, np.maximum), "up_names_low": (low, np.minimum), "up_names_high": (high, np.maximum)}
    cells: dict[str, np.ndarray] = {}
    for k, (v, f) in ups.items():
        out = np.zeros(n)
        for level in levels[1:]:
            p = parent[level]
            out[level] = f(out[p], v[p])
        cells[k] = out
    for k, v, f in (("down_names_low", low, np.minimum), ("down_names_high", high, np.maximum)):
        out = np.zeros(n)
        for level in levels[:0:-1]:
            f.at(out, parent[level], f(out[level], v[level]))
        cells[k] = out

    siblings = np.where(parent >= 0, children[up], 1)
    place = np.zeros(n)
    for level in levels[1:]:
        at = np.argsort(level, kind="stable")
        rows = level[at]
        new = np.ones(len(rows), bool)
        new[1:] = parent[rows[1:]] != parent[rows[:-1]]
        place[rows] = np.arange(len(rows)) - np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
    kinds: dict[tuple, int] = {}
    kind = np.array([kinds.setdefault((p, t, x), len(kinds)) for p, t, x in zip(parent.tolist(), tags, names, strict=True)], np.int64)
    same = np.bincount(kind)[kind] if n else kind
    after = np.full(n, -1)
    after[before[before >= 0]] = np.flatnonzero(before >= 0)
    link_share = total["linked"] / np.maximum(1.0, total["chars"])
    log_chars = np.log1p(total["chars"])
    aside = lambda v, at, none: np.where(at >= 0, v[np.maximum(at, 0)], none)
    largest = np.zeros(len(pages))
    np.maximum.at(largest, page, chars)
    words = np.maximum(1.0, total["words"])
    deepest = np.zeros(len(pages))
    np.maximum.at(deepest, page, depth)
    cells |= {
        "tag": tag, "names_low": low, "names_high": high, "chars": log_chars, "words": np.log1p(total["words"]), "link_share": link_share, "links": total["links"] / words, "inline": total["inline"] / words, "controls": total["controls"], "stops": total["stops"] / words,
        "ended": total["ended"] / np.maximum(1.0, total["leaves"]), "leaf_chars": np.log1p(total["chars"] / np.maximum(1.0, total["leaves"])), "leaves": np.log1p(total["leaves"]), "share": total["chars"] / np.maximum(1.0, of_page["chars"]), "tag_density": np.log1p(total["chars"] / total["nodes"]),
        "depth": depth.astype(float), "depth_share": depth / np.maximum(1.0, deepest[page]), "begin": before_text / np.maximum(1.0, of_page["chars"]), "end": (before_text + total["chars"]) / np.maximum(1.0, of_page["chars"]), "siblings": np.log1p(siblings), "place": place / siblings, "same_names": np.log1p(same),
        "parent_chars": log_chars[up], "parent_link": link_share[up], "parent_share": total["chars"] / np.maximum(1.0, total["chars"][up]), "before_chars": aside(log_chars, before, -1.0), "before_link": aside(link_share, before, -1.0), "after_chars": aside(log_chars, after, -1.0), "after_link": aside(link_share, after, -1.0),
        "paragraphs": np.log1p(total["paragraphs"]), "items": np.log1p(total["items"]), "headings": np.log1p(total["headings"]), "page_chars": np.log1p(of_page["chars"]), "page_leaves": np.log1p(of_page["leaves"]), "largest": chars / np.maximum(1.0, largest[page]), "digits": total["digits"] / words, "symbols": total["symbols"] / words,
    }
    return np.column_stack([cells[k] for k in FEATURES]) if n else np.zeros((0, len(FEATURES))), first
