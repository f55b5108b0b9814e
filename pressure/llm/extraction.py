"""Main text of pages by a tree-structured graphical model.

Every node of a page's tree is content or not. Its own features (tag, parts of its class and id
names, how much text and how much linked text there is below) give it a potential; each edge has a potential that says
how often a child is what its parent is, by kind of child. Sum-product messages, upward from the leaves and then
downward from the root, give every node's exact marginal; text blocks that are more likely content
than not are the page's text. Weights and edge potentials are fitted by maximum likelihood, with
the same messages, on labelled pages.

No table has labelled pages, so they are drawn from a grammar of page layouts
(`labelled_pages`), in which the author of a block knows whether it is content. Its words are random: the
model can only learn structure.

Null and empty pages have an empty text. An element that is not text of the page (a picture, a player) and never ends
hides nothing; only scripts, styles and the like then reach to the end. Rows are handled one by one. Columns of the result's own
names are replaced, others are kept.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressure.llm.common import shared, slices
from pressure.llm.dom import FEATURES, Page, parse

LABELLED_PAGES = 800


class Forest:
    """Many pages as arrays: parents, edge kinds and features of all nodes, nodes by depth."""

    def __init__(self, pages: list[Page]):
        sizes = np.fromiter((len(p.parent) for p in pages), np.int64, len(pages))
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.page = np.repeat(np.arange(len(pages)), sizes)
        parent = np.fromiter((x for p in pages for x in p.parent), np.int64, int(sizes.sum()))
        self.parent = np.where(parent < 0, -1, parent + first)
        depth = np.fromiter((x for p in pages for x in p.depth), np.int64, len(parent))
        self.leaf = np.fromiter((x is not None for p in pages for x in p.text), bool, len(parent))
        self.kind = self.leaf.astype(np.int64)  # of the edge to the parent
        per_node = np.fromiter((len(f) for p in pages for f in p.features), np.int64, len(parent))
        self.feature = np.fromiter((x for p in pages for f in p.features for x in f), np.int64, int(per_node.sum()))
        self.owner = np.repeat(np.arange(len(parent)), per_node)
        order = np.argsort(depth, kind="stable")
        cut = np.flatnonzero(np.diff(depth[order])) + 1
        self.levels = np.split(order, cut) if len(order) else []

    def unary(self, weights: np.ndarray) -> np.ndarray:
        """Log-odds of content from each node's own features."""
        return np.bincount(self.owner, weights[self.feature], len(self.parent))


def _through(odds: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Message over an edge: log-odds at the far end, of log-odds at this one. edge: log potentials 00, 01, 10, 11 (near, far)."""
    yes = np.logaddexp(edge[:, 1], odds + edge[:, 3])
    no = np.logaddexp(edge[:, 0], odds + edge[:, 2])
    return yes - no


def marginals(forest: Forest, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum-product over all trees at once: log-odds of every node; of every node without its parent's message; messages to parents.

    edges: by kind, log potentials of (parent, child) = 00, 01, 10, 11.
    """
    own = forest.unary(weights)
    below = own.copy()
    upward = np.zeros_like(own)
    up_edge = edges[forest.kind][:, [0, 2, 1, 3]]  # from child to parent
    for level in forest.levels[:0:-1]:
        upward[level] = _through(below[level], up_edge[level])
        np.add.at(below, forest.parent[level], upward[level])
    total = below.copy()
    down_edge = edges[forest.kind]
    for level in forest.levels[1:]:
        parent = forest.parent[level]
        total[level] = below[level] + _through(total[parent] - upward[level], down_edge[level])
    return total, below, upward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(pages: list[Page], labels: list[list[int]], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, edges) of largest likelihood of the labelled trees, by Adam on exact gradients."""
    forest = Forest(pages)
    truth = np.concatenate([np.array(x, np.float64) for x in labels])
    child = np.flatnonzero(forest.parent >= 0)
    parent, kind = forest.parent[child], forest.kind[child]
    seen = np.zeros((2, 4))
    np.add.at(seen, (kind, (2 * truth[parent] + truth[child]).astype(int)), 1.0)
    weights, edges = np.zeros(FEATURES), np.zeros((2, 4))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, edges)]
    for t in range(1, rounds + 1):
        total, below, upward = marginals(forest, weights, edges)
        to_node = truth - _sigmoid(total)
        to_weights = np.bincount(forest.feature, to_node[forest.owner], FEATURES) / len(pages) - decay * weights
        # Joint of a parent and a child: the parent without this child, the child without the parent, the edge.
        rest = total[parent] - upward[child]
        joint = edges[kind] + np.stack([0 * rest, below[child], rest, rest + below[child]], 1)
        joint = np.exp(joint - joint.max(1, keepdims=True))
        joint /= joint.sum(1, keepdims=True)
        expected = np.zeros((2, 4))
        np.add.at(expected, kind, joint)
        to_edges = (seen - expected) / len(pages) - decay * edges
        for x, g, m in zip((weights, edges), (to_weights, to_edges), moments, strict=True):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            x += rate * (1 - 0.9 * t / rounds) * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-8)
    return weights, edges


# The grammar of labelled pages: names that sites give to the parts of a page.
PARTS = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav mainmenu tabs pagination pager toc links",
    "header": "header masthead banner top siteheader topbar branding logo hero",
    "footer": "footer bottom colophon copyright legal sitefooter foot credits",
    "aside": "aside sidebar side widget rail related recommended more trending popular secondary tags archive",
    "ad": "ad ads advert advertisement sponsor sponsored promo promoted promotion commercial adsense adbox banner",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay disclaimer warning message subscribe newsletter paywall announcement",
    "comments": "comments comment discussion replies reply respond disqus responses feedback thread",
    "share": "share social sharing follow toolbar buttons meta byline",
    "form": "form search login signup register contact poll survey",
    "content": "article content post entry story body main text prose page articlebody postcontent entrycontent articletext blog",
}
_PARTS = {k: v.split() for k, v in PARTS.items()}
SYLLABLES = "ka lo mi re su ta ven dor qui pa nel bra fo gin est ul".split()


class _Writer:
    """Writes one labelled page; `marks` has, in order, whether each text block is content."""

    def __init__(self, rng: random.Random):
        self.rng = rng
        self.out: list[str] = []
        self.marks: list[int] = []

    def words(self, low: int, high: int) -> str:
        r = self.rng
        words = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]
        text = " ".join(words).capitalize()
        return text + r.choice([".", ".", ".", "!", "?", ""]) if len(words) > 3 or r.random() < 0.4 else text

    def name(self, part: str) -> str:
        r = self.rng
        if r.random() < 0.2:
            return ""
        names = " ".join(r.sample(_PARTS[part], r.randint(1, 2)))
        if r.random() < 0.3:
            names = names.replace(" ", r.choice(["-", "_", " "])) + r.choice(["", "-box", " wrap", "-1", " block", "-inner", " container"])
        return f' {r.choice(["class", "class", "id"])}="{names}"'

    def sure_name(self, part: str) -> str:
        while not (name := self.name(part)):
            pass
        return name

    def block(self, tag: str, text: str, content: int, attributes: str = "", closed: bool = True) -> None:
        self.out.append(f"<{tag}{attributes}>{text}" + (f"</{tag}>" if closed else ""))
        if text.strip():
            self.marks.append(content)

    def list_of_links(self, n: int) -> None:
        self.out.append(self.rng.choice(["<ul>", "<ul>", "<ol>"]))
        for _ in range(n):
            self.block("li", f'<a href="/x">{self.words(1, 4)}</a>', 0, closed=self.rng.random() < 0.9)
        self.out.append("</ul>")

    def junk(self, part: str) -> None:
        """A part of the page that is not content."""
        r = self.rng
        tags = {"nav": ["nav", "div"], "header": ["header", "header", "div"], "footer": ["footer", "footer", "div"], "aside": ["aside", "aside", "div"]}
        tag = r.choice(tags.get(part, ["div", "div", "section", "p" if part in ("ad", "notice", "share") else "div"]))
        name = self.name(part) if tag in ("nav", "header", "footer", "aside") else self.sure_name(part)
        if tag == "p":
            self.block("p", self.words(1, 14), 0, name)
            return
        self.out.append(f"<{tag}{name}>")
        if part == "nav":
            self.list_of_links(r.randint(2, 8))
        elif part == "form" or part == "notice" and r.random() < 0.3:
            self.out.append('<form action="/s">')
            self.block(r.choice(["label", "p", "div"]), self.words(1, 8), 0) if r.random() < 0.7 else None
            if self.out[-1].startswith("<label"):
                self.marks.pop()
                self.out.pop()
            self.out.append('<input type="text" name="q">')
            self.block("button", self.words(1, 2), 0)
            self.out.append("</form>")
        elif part == "comments":
            if r.random() < 0.6:
                self.block(r.choice(["h2", "h3"]), self.words(1, 3), 0)
            for _ in range(r.randint(1, 4)):
                inner = r.choice(["div", "article", "li", "section"])
                self.out.append(f"<{inner}{self.name('comments')}>")
                if r.random() < 0.5:
                    self.block("div", self.words(1, 3), 0)
                self.block(r.choice(["p", "p", "div"]), self.words(3, 60), 0)
                self.out.append(f"</{inner}>")
        else:
            if r.random() < (0.6 if part == "header" else 0.35):
                self.block(r.choice(["h1", "h1", "h2", "h3"] if part == "header" else ["h2", "h3", "h4"]), self.words(1, 5), 0)
            kind = r.random()
            if kind < 0.3 or part == "aside" and kind < 0.6:
                self.list_of_links(r.randint(2, 6))
            elif kind < 0.75:
                for _ in range(r.randint(1, 3)):
                    self.block("p", self.words(2, 30), 0)
            else:
                text = self.words(2, 25)
                if part == "footer" and r.random() < 0.6:
                    text = "&copy; " + text
                self.block("div", text, 0) if r.random() < 0.4 else (self.out.append(text), self.marks.append(0))
        self.out.append(f"</{tag}>")

    def article(self, tag: str, name: str) -> None:
        r = self.rng
        self.out.append(f"<{tag}{name}>")
        wrapped = r.random() < 0.35
        if r.random() < 0.85:
            inner = r.random() < 0.15 and tag == "article"
            if inner:
                self.out.append("<header>")
            self.block(r.choice(["h1", "h1", "h2"]), self.words(2, 12), 1)
            if inner:
                self.out.append("</header>")
        if r.random() < 0.2:
            self.junk("share")
        if wrapped:
            self.out.append(f"<{r.choice(['div', 'section', 'main'] if tag != 'main' else ['div', 'section'])}{self.name('content')}>")
            opened = self.out[-1][1:].split(" ")[0].rstrip(">")
        for _ in range(r.choice([1, 2, 3, 5, 8, 12])):
            kind = r.random()
            if kind < 0.72:
                text = self.words(1, r.choice([4, 20, 60, 120]))
                if r.random() < 0.15:
                    text = f"<b>{text}" + r.choice(["</b>", "<br>", ""])
                if r.random() < 0.12:
                    text += f' <a href="/y">{self.words(1, 4)}</a> {self.words(1, 6)}'
                self.block("p", text, 1, closed=r.random() < 0.85)
            elif kind < 0.8:
                self.block(r.choice(["h2", "h3"]), self.words(1, 8), 1)
            elif kind < 0.87:
                self.out.append(r.choice(["<ul>", "<ol>"]))
                for _ in range(r.randint(1, 5)):
                    self.block("li", self.words(1, 20), 1, closed=r.random() < 0.9)
                self.out.append("</ul>" if r.random() < 0.9 else "</ul>")
            elif kind < 0.91:
                self.block(r.choice(["blockquote", "pre", "div"]), self.words(3, 40), 1)
            elif kind < 0.94:
                self.out.append("<table><tr>")
                for _ in range(r.randint(1, 4)):
                    self.block(r.choice(["td", "th"]), self.words(1, 5), 1)
                self.out.append("</tr></table>")
            elif kind < 0.97:
                self.junk("ad")
            else:
                self.junk(r.choice(["aside", "notice", "form", "share"]))
        if wrapped:
            self.out.append(f"</{opened}>")
        if r.random() < 0.2:
            self.junk(r.choice(["comments", "share", "aside"]))
        self.out.append(f"</{tag}>")

    def page(self) -> tuple[str, list[int]]:
        r = self.rng
        self.out.append("<!DOCTYPE html><html><head><title>" + self.words(1, 8) + "</title><style>p{margin:0}</style><script>var a='<p>';</script></head><body>")
        wrapper = r.random() < 0.4
        if wrapper:
            self.out.append(f"<div {r.choice(['id', 'class'])}=\"{r.choice(['page', 'wrapper', 'container', 'site', 'app', 'root', 'outer'])}\">")
        for part in r.sample(["header", "header", "nav", "notice", "ad", "form"], r.randint(0, 5)):
            self.junk(part)
        columns = r.random() < 0.3
        if columns:
            self.out.append(f"<{r.choice(['main', 'div', 'div'])}{r.choice(['', ' class=columns', ' class=row', ' id=layout'])}>")
            opened = self.out[-1][1:].split(" ")[0].rstrip(">")
        if r.random() < 0.15:
            self.junk("aside")
        tag = r.choice(["article", "article", "article", "main", "div", "section"])
        self.article(tag, self.name("content") if tag in ("article", "main") else self.sure_name("content"))
        for part in r.sample(["aside", "comments", "ad", "form", "share", "notice"], r.randint(0, 4)):
            self.junk(part)
        if columns:
            self.out.append(f"</{opened}>")
        if r.random() < 0.85:
            self.junk("footer")
        if wrapper:
            self.out.append("</div>")
        if r.random() < 0.9:
            self.out.append("</body></html>")
        return "".join(self.out), self.marks


def labelled_pages(count: int = LABELLED_PAGES, seed: int = 8) -> list[tuple[str, list[int]]]:
    """(html, whether each text block, in page order, is content) of pages drawn from the grammar."""
    rng = random.Random(seed)
    return [_Writer(rng).page() for _ in range(count)]


def node_labels(page: Page, blocks: list[int]) -> list[int]:
    """Labels of all nodes from those of the text blocks: an element is content if most words below are."""
    labels = [0] * len(page.parent)
    content, words = [0.0] * len(labels), [0.0] * len(labels)
    given = iter(blocks)
    for i in range(len(labels)):
        if page.text[i] is not None:
            labels[i] = next(given)
    for i in range(len(labels) - 1, -1, -1):
        if page.text[i] is not None:
            words[i] = page.text[i].count(" ") + 1
            content[i] = words[i] * labels[i]
        else:
            labels[i] = int(2 * content[i] > words[i])
        if page.parent[i] >= 0:
            words[page.parent[i]] += words[i]
            content[page.parent[i]] += content[i]
    return labels


@lru_cache(2)
def trained(count: int = LABELLED_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Weights and edge potentials, fitted on `count` labelled pages; the same on every call."""
    pages, labels = [], []
    for source, blocks in labelled_pages(count):
        page = parse(source)
        if sum(t is not None for t in page.text) != len(blocks):
            raise ValueError("a labelled page has other blocks than labels")
        pages.append(page)
        labels.append(node_labels(page, blocks))
    return fit(pages, labels)


def extract(sources: list[str], weights: np.ndarray, edges: np.ndarray) -> list[str]:
    """Main text of each page: its content blocks, in page order, joined by line ends."""
    pages = [parse(s) for s in sources]
    forest = Forest(pages)
    total, _, _ = marginals(forest, weights, edges)
    chosen = forest.leaf & (total >= 0)
    out: list[list[str]] = [[] for _ in pages]
    texts = [t for p in pages for t in p.text]
    for node in np.flatnonzero(chosen).tolist():
        out[forest.page[node]].append(texts[node])
    return ["\n".join(blocks) for blocks in out]


def extractor(pages: DataFrame) -> Column:
    """A function from a column of HTML to one of main text."""
    model = trained()
    sent = shared(pages.sparkSession, model)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, edges = sent.value
        for batch in batches:
            sources = [s or "" for s in batch]
            parts = [extract(sources[a:b], weights, edges) for a, b in slices(np.fromiter(map(len, sources), np.int64, len(sources)))]
            yield pd.Series([t for part in parts for t in part], dtype=object)

    return text


def with_main_text(pages: DataFrame, html_column: str = "html", name: str = "text") -> DataFrame:
    """All columns and the main text of each whole page."""
    return pages.withColumn(name, extractor(pages)(F.col(html_column).cast("string")))


def extraction_report(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length in code points, of every page."""
    return with_main_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )

