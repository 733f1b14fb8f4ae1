"""Main text of web pages by a graphical model on the DOM tree.

Every block element and every run of text is a node with a hidden label, main
text or not.  Node potentials come from the node's tag, names, text and links;
edge potentials couple parent and child.  Messages go upward and downward once
(sum-product, exact on a tree) and give each text run's marginal.  The
potentials are trained on labelled pages by the conditional likelihood, whose
gradient uses the same messages.

Not shown as text, and dropped before the model: scripts, styles, titles,
templates, text areas and the fallback of frames.  Text in svg and math is part
of the line it stands in; their own elements are no nodes.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled_pages as named
from .common import col

#: Labelled pages that train the model, and steps of its training.
TRAIN_PAGES, STEPS = 500, 140

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|iframe|template|noembed|noframes)(?=[\s/>])"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*+(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*)(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE)
_ATTR = re.compile(r"""\b(class|id|role|itemprop|data-y|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
                   re.IGNORECASE)

# Fixed facts of the markup language.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp "
              "small span strike strong sub sup time tt u var wbr label input link meta canvas object noscript svg math".split())
#: Roots of foreign markup, which an element of the page's own kind ends.
_FOREIGN = {"svg", "math"}
_CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
           "tfoot": {"tr", "td", "th", "thead", "tbody"}}
_SCOPE = set("table td th button ul ol dl select body html".split())

_TAG_GROUPS = [["article"], ["main"], ["section"], ["div", "center"], ["p"], ["h1"], ["h2", "h3", "h4", "h5", "h6"],
               ["ul", "ol", "dl", "menu"], ["li", "dt", "dd"], ["nav"], ["header", "hgroup"], ["footer"], ["aside"],
               ["form", "fieldset", "search", "dialog"], ["button", "select", "option", "optgroup", "legend"],
               ["table", "tbody", "thead", "tfoot", "tr", "caption"], ["td", "th"], ["blockquote", "pre", "figure", "figcaption", "xmp"],
               ["body", "html"]]
_GROUP = {t: i for i, g in enumerate(_TAG_GROUPS) for t in g}
_BREAKS_OUT = (set(_GROUP) | _VOID | _INLINE) - {"a", "cite", "data", "link", "meta", "q", "source", "time"} - _FOREIGN
_OTHER, _TEXT = len(_TAG_GROUPS), len(_TAG_GROUPS) + 1
#: Words in names of elements that speak for a kind of part.
_NAMES = [named.MENU + ["crumbs", "pager", "skip", "tabs"], named.HEADER + ["head", "logo"], named.FOOTER + ["foot", "credits"],
          named.SIDE + ["side", "trending", "popular", "more", "author", "byline", "meta"],
          named.ADVERT + ["sponsor", "advertising", "dfp", "commercial"], named.NOTICE + ["note", "announcement", "notification", "privacy"],
          named.FORM + ["form", "register", "feedback"], named.COMMENT + ["reply", "respond", "thread", "remarks"],
          named.SHARE + ["sharing", "toolbar", "buttons"], named.CONTENT + ["body", "copy", "prose", "richtext", "articlebody", "main"]]
_NAME_OF = {}
for _i, _group in enumerate(_NAMES):
    for _n in _group:
        for _w in re.findall(r"[a-z]+", _n):
            if _w not in ("top", "page", "right", "most", "list", "col", "slot", "post", "main", "text", "site", "box") or len(_group) and _i == 9:
                _NAME_OF.setdefault(_w, _i)
_N_UNARY = _TEXT + 1 + len(_NAMES) + 9
#: Kinds of child for the edge potentials.
_EDGE_TEXT, _EDGE_BOX, _EDGE_PROSE, _EDGE_PART = range(4)
_N_EDGES = 4


@dataclass
class Tree:
    """Nodes of one page in document order; a parent comes before its children."""

    parent: list[int]
    group: list[int]
    names: list[tuple[int, ...]]
    text: list[str]
    linked: list[int]
    mark: list[int]


def parse(page: str | None) -> Tree:
    """Tolerant parse into block elements and runs of text."""
    tree = Tree([-1], [_GROUP["html"]], [()], [""], [0], [0])
    stack: list[tuple[str, int]] = [("html", 0)]                # open elements: tag, node of the nearest block
    run: list[str] = []
    state = [0, 0]                                                # open links; linked characters of the run

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            parent = stack[-1][1]
            tree.parent.append(parent)
            tree.group.append(_TEXT)
            tree.names.append(())
            tree.text.append(text)
            tree.linked.append(min(state[1], len(text)))
            tree.mark.append(tree.mark[parent])
        run.clear()
        state[1] = 0

    def pop_to(tags: set[str], stop: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                flush()
                state[0] = max(0, state[0] - sum(t == "a" for t, _ in stack[i:]))
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    def leave(i: int) -> None:
        state[0] = max(0, state[0] - sum(t == "a" for t, _ in stack[i:]))
        del stack[i:]

    at = 0
    page = page or ""
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at:m.start()]
            piece = entities.unescape(piece) if "&" in piece else piece
            run.append(piece)
            if state[0]:
                state[1] += len(piece.strip())
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            if m[0].startswith("<![CDATA["):
                run.append(m[0][9:].removesuffix("]]>"))
            continue
        tag, attrs = tag.lower(), m["attrs"] or m["attrs2"] or ""
        if stack[-1][0] in _FOREIGN:                               # elements of svg and math are no nodes
            if tag == stack[-1][0] and (m["end"] or m["end2"]):
                leave(len(stack) - 1)
                continue
            if tag not in _BREAKS_OUT and (not (m["end"] or m["end2"]) or all(t != tag for t, _ in stack)):
                if tag in _FOREIGN and not (m["end"] or m["end2"] or attrs.endswith("/")):
                    stack.append((tag, stack[-1][1]))
                continue
            while stack[-1][0] in _FOREIGN:
                leave(len(stack) - 1)
        if m["end"] or m["end2"]:
            if tag == "br":
                run.append(" ")
            elif any(t == tag for t, _ in reversed(stack)) and tag not in ("html", "body"):
                if tag in _INLINE:
                    for i in range(len(stack) - 1, 0, -1):         # an inline end closes within its block only
                        if stack[i][0] == tag:
                            if tag == "a":
                                state[0] = max(0, state[0] - 1)
                            del stack[i]
                            break
                        if stack[i][0] not in _INLINE:
                            break
                else:
                    pop_to({tag}, {"td", "th", "table"} - {tag} if tag not in ("tr", "tbody", "table", "thead", "tfoot") else set())
            continue
        if tag in _INLINE:
            if tag in _VOID or tag in _FOREIGN and attrs.endswith("/"):
                run.append(" " if tag == "br" else "")
            else:
                stack.append((tag, stack[-1][1]))
                state[0] += tag == "a"
            continue
        if tag in ("html", "head") or tag in _VOID:
            flush()
            continue
        if tag in _CLOSES_P:
            pop_to({"p"}, _SCOPE)
        if tag in _CLOSES:
            for _ in range(3):
                pop_to(_CLOSES[tag], {"ul", "ol", "dl", "table", "select", "div", "section", "article"} - _CLOSES[tag])
        flush()
        parent = stack[-1][1]
        found, mark = set(), tree.mark[parent]
        if attrs and ("=" in attrs or "hidden" in attrs):
            for a in _ATTR.finditer(attrs):
                key, value = a[1].lower(), (a[2] or a[3] or a[4] or "").lower()
                if key == "data-y":
                    mark = int(value == "1")
                elif key == "style":
                    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                        found.add(5)
                elif key in ("hidden", "aria-hidden"):
                    if key == "hidden" or value == "true":
                        found.add(5)
                else:
                    found.update(_NAME_OF[w] for w in re.findall(r"[a-z]+", value) if w in _NAME_OF)
        tree.parent.append(parent)
        tree.group.append(_GROUP.get(tag, _OTHER))
        tree.names.append(tuple(found))
        tree.text.append("")
        tree.linked.append(0)
        tree.mark.append(mark)
        stack.append((tag, len(tree.parent) - 1))
    if at < len(page):
        rest = page[at:]
        run.append(entities.unescape(rest) if "&" in rest else rest)
    flush()
    return tree


@dataclass
class Forest:
    """Trees of many pages side by side, by level, with the features of their nodes."""

    parent: np.ndarray
    levels: list[np.ndarray]
    edge: np.ndarray
    x: np.ndarray


def forest(trees: list[Tree]) -> Forest:
    sizes = np.array([len(t.parent) for t in trees], dtype=np.int64)
    base = np.cumsum(sizes) - sizes
    parent = np.concatenate([np.where((p := np.array(t.parent)) >= 0, p + b, -1) for t, b in zip(trees, base)])
    group = np.concatenate([t.group for t in trees])
    n = len(parent)
    depth = np.zeros(n, dtype=np.int64)
    up = parent.copy()
    while (more := up >= 0).any():
        depth += more
        up = np.where(more, parent[np.maximum(up, 0)], -1)
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(depth.max(initial=0) + 2))
    levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    length = np.concatenate([np.array([len(s) for s in t.text], dtype=float) for t in trees])
    linked = np.concatenate([np.array(t.linked, dtype=float) for t in trees])
    stops = np.concatenate([np.array([s.count(".") + s.count("!") + s.count("?") for s in t.text], dtype=float) for t in trees])
    runs = (length > 0).astype(float)
    own = length.copy()
    page = np.repeat(np.arange(len(trees)), sizes)
    for lv in reversed(levels[1:]):
        for a in (length, linked, stops, runs):
            np.add.at(a, parent[lv], a[lv])
    total = np.maximum(length[base][page], 1)
    before = (np.cumsum(own) - own)
    before = before - before[base][page]
    x = np.zeros((n, _N_UNARY))
    x[np.arange(n), group] = 1
    for t, b in zip(trees, base):
        for i, names in enumerate(t.names):
            for k in names:
                x[b + i, _TEXT + 1 + k] = 1
    k = _TEXT + 1 + len(_NAMES)
    some = np.maximum(length, 1)
    x[:, k] = np.minimum(np.log1p(length) / 8, 1.5)
    x[:, k + 1] = linked / some
    x[:, k + 2] = np.minimum(stops / some * 20, 2)
    x[:, k + 3] = length / total
    x[:, k + 4] = before / total
    x[:, k + 5] = length == 0
    x[:, k + 6] = np.minimum(np.log1p(runs) / 4, 1.5)
    x[:, k + 7] = (linked >= 0.9 * some) & (length > 0)
    x[:, k + 8] = 1
    prose = np.isin(group, [_GROUP[t] for t in ("p", "h1", "h2", "li", "ul", "blockquote", "td", "table")])
    part = np.isin(group, [_GROUP[t] for t in ("nav", "header", "footer", "aside", "form", "button")]) | (
        x[:, _TEXT + 1:_TEXT + 10].any(axis=1))
    edge = np.where(group == _TEXT, _EDGE_TEXT, np.where(part, _EDGE_PART, np.where(prose, _EDGE_PROSE, _EDGE_BOX)))
    return Forest(parent, levels, edge, x)


def messages(f: Forest, unary: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product in both directions: node marginals (n, 2) and edge marginals (n, parent label, child label).

    ``unary``: log potential of label 1 (label 0 has 0); ``edges``: log potentials by (kind, parent label, child label).
    """
    n = len(unary)
    up = np.stack([np.zeros(n), unary], axis=1)
    sent = np.zeros((n, 2))
    pot = edges[f.edge]
    for lv in reversed(f.levels[1:]):                                       # leaves to root
        s = pot[lv] + up[lv][:, None, :]
        sent[lv] = np.logaddexp(s[:, :, 0], s[:, :, 1])
        np.add.at(up, f.parent[lv], sent[lv])
    down = np.zeros((n, 2))
    pair = np.zeros((n, 2, 2))
    for lv in f.levels[1:]:                                                 # root to leaves
        p = f.parent[lv]
        s = pot[lv] + (up[p] + down[p] - sent[lv])[:, :, None]
        down[lv] = np.logaddexp(s[:, 0, :], s[:, 1, :])
        both = s + up[lv][:, None, :]
        both -= both.reshape(-1, 4).max(axis=1)[:, None, None]
        e = np.exp(both)
        pair[lv] = e / e.sum(axis=(1, 2), keepdims=True)
    b = up + down
    b = np.exp(b - b.max(axis=1, keepdims=True))
    return b / b.sum(axis=1, keepdims=True), pair


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    edges: np.ndarray

    def marginals(self, trees: list[Tree]) -> np.ndarray:
        f = forest(trees)
        return messages(f, f.x @ self.weights, self.edges)[0][:, 1]


def truth(tree: Tree) -> np.ndarray:
    """Labels of all nodes: a run of text has its mark, an element that of most of its text."""
    y = np.zeros(len(tree.parent))
    good, all_ = np.zeros(len(y)), np.zeros(len(y))
    for i in range(len(y) - 1, -1, -1):
        if tree.text[i]:
            good[i], all_[i] = tree.mark[i] * len(tree.text[i]), len(tree.text[i])
        y[i] = good[i] * 2 > all_[i] if all_[i] else tree.mark[i]
        if i:
            good[tree.parent[i]] += good[i]
            all_[tree.parent[i]] += all_[i]
    return y


def train(labelled: list[str], steps: int = STEPS, l2: float = 2e-4) -> Model:
    """Potentials from labelled pages (``data-y`` marks): gradient = observed minus expected features."""
    trees = [parse(p) for p in labelled]
    f = forest(trees)
    y = np.concatenate([truth(t) for t in trees])
    child = np.concatenate(f.levels[1:])
    seen = np.zeros((_N_EDGES, 2, 2))
    yi = y.astype(int)
    np.add.at(seen, (f.edge[child], yi[f.parent[child]], yi[child]), 1)
    n = len(y)
    theta = np.zeros(f.x.shape[1] + seen.size)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, e = theta[:f.x.shape[1]], theta[f.x.shape[1]:].reshape(seen.shape)
        node, pair = messages(f, f.x @ w, e)
        expected = np.zeros_like(seen)
        np.add.at(expected, f.edge[child], pair[child])
        grad = np.concatenate([f.x.T @ (y - node[:, 1]), (seen - expected).ravel()]) / n - l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + 0.15 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return Model(theta[:f.x.shape[1]], theta[f.x.shape[1]:].reshape(seen.shape))


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train(named.pages(TRAIN_PAGES))


def main_texts(pages: list[str | None], model: Model) -> list[str]:
    """Main text per page: its blocks in page order, one per line."""
    out: list[str] = []
    group: list[Tree] = []

    def close() -> None:
        p = model.marginals(group)
        at = 0
        for t in group:
            out.append("\n".join(s for s, q in zip(t.text, p[at:at + len(t.text)]) if s and q > 0.5))
            at += len(t.text)
        group.clear()

    size = 0
    for page in pages:
        group.append(parse(page))
        size += len(group[-1].parent)
        if size > 20_000:
            close()
            size = 0
    if group:
        close()
    return out


def extract(pages: DataFrame, model: Model | None = None, page_id: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``.

    Null and empty pages, and pages without main text, give an empty text;
    broken markup is parsed as far as it goes; repeated rows repeat; an empty
    table gives an empty result.
    """
    model = model or default_model()
    x = pages.select(col(page_id).alias("page_id"), col(url).alias("url"), col(html).alias("html"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = main_texts(part.column(2).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 names=["page_id", "url", "text"])

    schema = x.select("page_id", "url", F.col("html").alias("text")).schema
    return x.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("bigint"))
