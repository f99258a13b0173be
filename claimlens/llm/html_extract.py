"""Main-text extraction by minimum-cut labelling (operator 7).

1. *Blocks.* One pass over a page's tags cuts it into text blocks, each with
   its chain of containers. Comments, scripts, styles and the head hold no
   text; character references are decoded and white space is folded.
2. *Classifier.* A logistic model turns a block's features (length, links,
   punctuation, its own and its containers' tags and names) into the log-odds
   of content. It is trained on blocks of a bounded sample of pages that stand
   in telling containers (article, main; nav, footer, aside, ...), pulled
   towards fixed starting weights, so that pages without such tags are judged
   by their text.
3. *Minimum cut.* The log-odds are the terminal capacities. Neighbouring
   blocks are joined by an edge, and every block and container by one with the
   container around it (DOM proximity). The maximum flow separates content
   from boilerplate: a weak block goes with the blocks around it.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import arrow_map, lists

SAMPLE_PAGES = 2_000
#: Labelled blocks that come to the driver at most.
SAMPLE_BLOCKS = 100_000
NEXT_EDGE, PARENT_EDGE = 0.6, 0.9

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# Fixed values of the page language.
SILENT = frozenset("script style template noscript title iframe svg math object select option "
                   "datalist button textarea audio video canvas".split())
CONTAINERS = frozenset("html body main article section div nav header footer aside form fieldset "
                       "ul ol dl table tbody thead tfoot tr td th blockquote figure details "
                       "dialog address menu center".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption caption summary legend label".split())
BREAKS = frozenset("br hr".split())
VOID = frozenset("br hr img input link meta area base col embed source track wbr param".split())

#: Words in class, id or role that tell content or boilerplate.
GOOD_NAMES = re.compile(r"\b(?:article|content|post|entry|story|main|text|body)(?:\b|[-_])", re.I)
BAD_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|"
    r"overlay|newsletter|subscribe|share|sharing|social|related|recommend\w*|sidebar|side|menu|nav|"
    r"navbar|navigation|breadcrumbs?|footer|header|masthead|comments?|replies|reply|discussion|login|"
    r"signin|search|tags|widget|complementary|contentinfo|alert|hidden|skip|toolbar|pagination)"
    r"(?:$|[\s_-])", re.I)
#: A class of a page that has, lacks or shows such a part, or that cuts overflow.
LAYOUT_NAMES = re.compile(r"(?:^|[_-])(?:has|have|no|not|with|without)[_-]|^(?:overflow|backface)[_-]", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

FEATURES = ("bias", "log_words", "links", "marks", "ends", "long_words", "heading", "paragraph", "item",
            "in_article", "in_main", "in_nav", "in_header", "in_footer", "in_aside", "in_form", "in_list",
            "in_table", "good_name", "bad_name", "hidden", "notice")
# Starting weights, in the order of FEATURES.
START = np.array([-1.0, 0.5, -3.0, 2.0, 0.6, 0.0, 0.2, 0.8, -0.6,
                  2.5, 2.0, -5.0, -3.0, -5.0, -5.0, -4.0, -0.3,
                  -0.3, 0.8, -7.0, -7.0, -1.5])
_NOTICE = re.compile("©|copyright|all rights reserved|privacy policy|cookies|terms of (?:use|service)", re.I)


def is_hidden(attributes: str) -> bool:
    """A bare hidden attribute, aria-hidden=true or a style that hides."""
    low = attributes.lower()
    if "hidden" not in low and "none" not in low:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).strip()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" \
                or name == "style" and _UNSEEN.search(value):
            return True
    return False


def is_bad_name(names: str) -> bool:
    """One of the names, by itself, tells boilerplate."""
    return any(BAD_NAMES.search(x) and not LAYOUT_NAMES.search(x) for x in names.split())


class Node:
    """A container of the page; ``up`` is the one around it. ``named`` is kept
    where an article or main part ends a bad name from further out."""
    __slots__ = ("tag", "up", "flags", "index", "bad", "good", "hidden", "named")

    def __init__(self, tag: str, up: Node | None, attributes: str, index: int):
        self.tag, self.up, self.index = tag, up, index
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if attributes else ""
        self.flags = (up.flags if up else frozenset()) | {tag}
        own = bool(names) and is_bad_name(names)
        # a page-wide part is not bad for its name; an article with a bad name
        # of its own (a comment) does not end the one around it
        if tag == "main" or tag == "article" and not own:
            self.bad = False
        else:
            self.bad = bool(up and up.bad) or own and tag not in ("html", "body", "article")
        self.named = bool(up and up.named) or self.bad
        self.good = bool(up and up.good) or bool(names and GOOD_NAMES.search(names))
        self.hidden = bool(up and up.hidden) or bool(attributes and is_hidden(attributes))


def parse(page: str) -> tuple[list[tuple[str, str, Node, float]], list[Node]]:
    """([(text, leaf tag, container, share of link characters)], containers)."""
    root = Node("html", None, "", 0)
    nodes, stack, blocks = [root], [root], []
    opened = Counter()      # containers of each tag on the stack
    leaf, parts, link_chars, in_link = "", [], 0, 0

    def flush():
        nonlocal parts, link_chars
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append((text, leaf, stack[-1], min(1.0, link_chars / len(text))))
            parts = []
        link_chars = 0

    def say(text: str):
        nonlocal link_chars
        if text:
            parts.append(text)
            if in_link:
                link_chars += len(text.strip())

    at, head = 0, False
    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            break
        if not head:
            say(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        closing, name, attributes = bool(m[1] or m[4]), name.lower(), m[3] or m[6] or ""
        if name in SILENT:
            if not closing and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif name == "head":
            flush()
            head = not closing
        elif name == "body":
            flush()
            head = False
        elif name == "a":
            in_link = 0 if closing else 1
        elif name in CONTAINERS:
            flush()
            leaf = ""
            if not closing:
                if name != "html" and not attributes.endswith("/"):
                    nodes.append(Node(name, stack[-1], attributes, len(nodes)))
                    stack.append(nodes[-1])
                    opened[name] += 1
            elif opened[name]:
                while True:
                    last = stack.pop().tag
                    opened[last] -= 1
                    if last == name:
                        break
        elif name in LEAVES:
            flush()
            leaf = "" if closing else name
        elif name in BREAKS:
            flush()
    if not head:
        say(page[at:])
    flush()
    return blocks, nodes


def block_features(text: str, leaf: str, node: Node, links: float) -> list[float]:
    words = text.split()
    n, f = len(words), node.flags
    return [1.0, np.log1p(n) / 2, links, min(1.0, 4 * sum(text.count(c) for c in ".,;!?") / n),
            float(text[-1] in ".!?\"'”)…"), float(len(text) > 12 * n), float(leaf[:1] == "h" and len(leaf) == 2),
            float(leaf == "p"), float(leaf in ("li", "dt", "dd")),
            float("article" in f), float("main" in f), float("nav" in f or "menu" in f),
            float("header" in f and "article" not in f), float("footer" in f), float("aside" in f),
            float("form" in f or "dialog" in f), float("ul" in f or "ol" in f or "dl" in f),
            float("table" in f), float(node.good), float(node.bad), float(node.hidden),
            float(n < 40 and _NOTICE.search(text) is not None)]


def weak_label(node: Node) -> int:
    """1 in an article or main part, 0 in a telling other part, -1 unknown."""
    f = node.flags
    if node.bad or node.hidden or f & {"nav", "footer", "aside", "form", "menu", "dialog"}:
        return 0
    return 1 if f & {"article", "main"} and not node.named else -1


def min_cut(odds: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Boolean label of each node: the source side of a minimum cut.

    ``odds`` > 0 is a node's capacity from the source, < 0 to the sink; an
    edge (u, v, capacity) goes both ways. Dinic's algorithm: levels by
    breadth-first search, then augmenting paths along them.
    """
    n = len(odds)
    excess = [float(x) for x in odds]
    head: list[list[int]] = [[] for _ in range(n)]
    to, cap = [], []
    for u, v, c in edges:
        head[u].append(len(to))
        head[v].append(len(to) + 1)
        to += [v, u]
        cap += [c, c]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(v for v in range(n) if excess[v] > tiny)
        for v in queue:
            level[v] = 0
        found = False
        while queue:
            u = queue.popleft()
            for e in head[u]:
                v = to[e]
                if cap[e] > tiny and level[v] < 0:
                    level[v] = level[u] + 1
                    found = found or excess[v] < -tiny
                    queue.append(v)
        if not found:
            return np.array([x >= 0 for x in level])
        pointer = [0] * n
        for s in range(n):
            while level[s] == 0 and excess[s] > tiny:
                path, u = [], s
                while True:
                    if excess[u] < -tiny:
                        break
                    while pointer[u] < len(head[u]):
                        e = head[u][pointer[u]]
                        if cap[e] > tiny and level[to[e]] == level[u] + 1:
                            break
                        pointer[u] += 1
                    if pointer[u] < len(head[u]):
                        path.append(head[u][pointer[u]])
                        u = to[path[-1]]
                    elif path:
                        u = to[path.pop() ^ 1]
                        pointer[u] += 1
                    else:
                        break
                if excess[u] >= -tiny:
                    break
                flow = min(excess[s], -excess[u], *(cap[e] for e in path))
                excess[s] -= flow
                excess[u] += flow
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow


def main_text(page: str | None, weights: np.ndarray) -> str:
    """The content blocks of a page, in order, joined by one space."""
    blocks, nodes = parse(page or "")
    if not blocks:
        return ""
    x = np.array([block_features(*b) for b in blocks])
    odds = np.concatenate([x @ weights, np.zeros(len(nodes))])
    n = len(blocks)
    edges = [(i, i + 1, NEXT_EDGE) for i in range(n - 1) if blocks[i][2] is blocks[i + 1][2]]
    edges += [(i, i + 1, NEXT_EDGE / 4) for i in range(n - 1) if blocks[i][2] is not blocks[i + 1][2]]
    edges += [(i, n + b[2].index, PARENT_EDGE) for i, b in enumerate(blocks)]
    edges += [(n + k.index, n + k.up.index, PARENT_EDGE / 3) for k in nodes[1:]]
    keep = min_cut(odds, edges)[:n]
    return " ".join(b[0] for b, k in zip(blocks, keep, strict=True) if k)


def _training_fn(html_col: str):
    def run(cols: dict) -> dict:
        x, y = [], []
        for page in cols[html_col].to_pylist():
            for b in parse(page or "")[0]:
                label = weak_label(b[2])
                if label >= 0:
                    x.append(block_features(*b))
                    y.append(label)
        flat = np.array(x, float).reshape(-1)
        return {"x": lists(flat, [len(FEATURES)] * len(y), pa.float64()), "y": y}
    return run


def fit_weights(x: np.ndarray, y: np.ndarray, pull: float = 0.02, steps: int = 300) -> np.ndarray:
    """Logistic weights, both labels counting alike, pulled towards START."""
    w = START.copy()
    if not (y == 1).any() or not (y == 0).any():
        return w
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    for _ in range(steps):
        d = share * (1 / (1 + np.exp(-np.clip(x @ w, -60, 60))) - y)
        w = w - 0.5 * (x.T @ d + pull * (w - START))
    return w


def fit_classifier(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> np.ndarray:
    """Block weights from at most about ``sample_pages`` pages, by text hash, and at
    most ``SAMPLE_BLOCKS`` of their labelled blocks.

    Equal pages count once in the sample. Without pages, or without blocks of
    both labels, the starting weights are returned.
    """
    total = pages.count()
    cut = (1 << 20) * min(1.0, sample_pages / max(1, total))
    part = F.pmod(F.xxhash64(html_col, F.lit("page")), F.lit(1 << 20))
    got = arrow_map(pages.select(html_col).where(part < cut).distinct(), _training_fn(html_col),
                    "x array<double>, y int").orderBy(F.xxhash64("x", "y")).limit(SAMPLE_BLOCKS).toArrow()
    if got.num_rows == 0:
        return START.copy()
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit_weights(x, got["y"].to_numpy())


def extracted(page: Column, weights: np.ndarray) -> Column:
    @F.pandas_udf("string")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            yield pd.Series([main_text(p, weights) for p in s], dtype=object)
    return run(page)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text, n_chars for every page.

    A null or empty page, and one without content, gets an empty text. Ids
    may repeat or be null; an empty table gives no rows. Further columns are
    not read.
    """
    weights = fit_classifier(pages, html_col)
    return pages.select(id_col, url_col, extracted(F.coalesce(F.col(html_col), F.lit("")), weights)
                        .alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
