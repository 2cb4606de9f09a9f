"""Main text of web pages by a tree-structured graphical model over the elements of a page."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import map_arrow, pieces
from hoarfrost.llm.page_examples import PAGES

#: Pages of the table that a model learns from at most, beside the written examples.
TRAINING_PAGES = 500

# Fixed values of the HTML standard: elements without content, elements whose content is no markup,
# and elements that flow inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: An opening tag on the left ends an open element on the right.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

# Elements that stand in a line without ending it, their content aside: replaced ones, and ones never shown.
IN_LINE = INLINE | frozenset("audio button canvas embed iframe img input map meter noscript object output picture progress script select style svg template textarea video".split())
# In a tag a quote opens a value only right after an equals sign. A tag that the page's end cuts off has no last group.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(>|\Z)""", re.S)
# What ends an element whose content is no markup: its own closing tag, whatever stands before it.
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I) for tag in RAW}
NAMES = re.compile(r"""\b(class|id|role|data-main|data-rest|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
WORD = re.compile(r"[a-z]+")
# Tags that say by themselves that a region is, or isn't, the main text; used to label pages of a table.
MAIN_TAGS, REST_TAGS = frozenset(("article", "main")), frozenset(("nav", "aside", "footer", "form", "header"))


#: How far each kind of evidence counts: size, links and share say much the same, so each counts less.
TRUST = {"tag": 0.7, "name": 2.5, "size": 0.3, "links": 0.5, "share": 0.3}


@dataclass
class Tree:
    """Elements in page order: tag, parent, names in class, id and role, and marks of labelled pages.
    `texts` are (element, text) in page order; None as a text is a break between blocks."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    marks: list[int] = field(default_factory=lambda: [0])
    texts: list[tuple[int, str | None]] = field(default_factory=list)


class Stack:
    """The open elements, from the page down, with how many of each tag there are."""

    def __init__(self, tree: Tree):
        self.tree, self.elements, self.count = tree, [0], {}

    def push(self, element: int) -> None:
        tag = self.tree.tags[element]
        self.elements.append(element)
        self.count[tag] = self.count.get(tag, 0) + 1

    def cut(self, depth: int) -> None:
        """Close all elements from a depth on."""
        for element in self.elements[depth:]:
            self.count[self.tree.tags[element]] -= 1
        del self.elements[depth:]

    def top(self) -> str:
        return self.tree.tags[self.elements[-1]]

    def depth_of(self, tags: set[str] | frozenset[str], stops: set[str] | frozenset[str] = frozenset()) -> int:
        """The depth of the innermost open element with one of the tags, 0 if there is none before a stop.
        What is passed on the way is closed with it, so a page's elements are passed about once."""
        if any(self.count.get(tag) for tag in tags):
            for depth in range(len(self.elements) - 1, 0, -1):
                tag = self.tree.tags[self.elements[depth]]
                if tag in stops:
                    break
                if tag in tags:
                    return depth
        return 0


def parse(page: str) -> Tree:
    """Elements and texts of a page as it is written: unclosed and wrongly nested tags are put up with.

    A tag that the end of the page cuts off is no text, as in a browser. Each character is looked at a
    bounded number of times, whatever is left open.
    """
    tree, at = Tree(), 0
    open_ = Stack(tree)
    while m := TOKEN.search(page, at):
        if m.start() > at:
            tree.texts.append((open_.elements[-1], html.unescape(page[at : m.start()])))
        at = m.end()
        if not m[2]:
            continue
        if not m[4]:
            return tree
        tag = m[2].lower()
        if tag not in IN_LINE:
            tree.texts.append((open_.elements[-1], None))
        if m[1]:
            if depth := open_.depth_of({tag}):
                open_.cut(depth)
            continue
        if tag in CLOSES_P and open_.count.get("p"):
            while (top := open_.top()) in INLINE or top == "p":
                open_.cut(len(open_.elements) - 1)
                if top == "p":
                    break
        if tag in CLOSES and (depth := open_.depth_of(CLOSES[tag], STOPS[tag])):
            open_.cut(depth)
        found, mark = [], 0
        for a in NAMES.finditer(m[3] or ""):
            what, value = a[1].lower(), a[2] or a[3] or a[4] or ""
            if what == "hidden":
                found.append("hidden")
            elif what.startswith("data-"):
                mark = 1 if what == "data-main" else -1
            else:
                found += WORD.findall(value.lower())
        tree.tags.append(tag)
        tree.parents.append(open_.elements[-1])
        tree.names.append(tuple(dict.fromkeys(found)))
        tree.marks.append(mark)
        if tag in RAW and not (m[3] or "").endswith("/"):
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            if tag not in IN_LINE:
                tree.texts.append((open_.elements[-1], None))
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            open_.push(len(tree.tags) - 1)
    if at < len(page):
        tree.texts.append((open_.elements[-1], html.unescape(page[at:])))
    return tree


def facts(tree: Tree) -> list[list[str]]:
    """What is seen of each element: its tag, its names, its text's length and share of links, its place."""
    n = len(tree.tags)
    size, linked, parts = [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = tree.tags[i] == "a" or in_link[tree.parents[i]]
        parts[tree.parents[i]] += 1
    for i, text in tree.texts:
        if text:
            length = len(text) if len(text) < 9 else len(" ".join(text.split()))
            size[i] += length
            linked[i] += length * in_link[i]
    for i in range(n - 1, 0, -1):
        size[tree.parents[i]] += size[i]
        linked[tree.parents[i]] += linked[i]
    total, out = max(1, size[0]), []
    for i in range(n):
        words = 0 if not size[i] else min(6, max(1, int(size[i]).bit_length() - 3))
        seen = [f"tag:{tree.tags[i]}", f"size:{words}", f"links:{min(3, int(4 * linked[i] / size[i])) if size[i] else 4}"]
        seen.append(f"share:{min(4, int(5 * size[i] / total))}")
        out.append(seen + [f"name:{x}" for x in tree.names[i]])
    return out


@dataclass
class Model:
    """Log-potentials: of what is seen of an element, and of a child's state given its parent's, by tag."""

    seen: dict[str, tuple[float, float]]
    unseen: dict[str, tuple[float, float]]
    edges: dict[str, np.ndarray]
    any_edge: np.ndarray
    root: np.ndarray

    def evidence(self, seen: list[str]) -> tuple[float, float]:
        a = b = 0.0
        for x in seen:
            kind = x[: x.index(":")]
            p, q = self.seen.get(x) or self.unseen[kind]
            weight = TRUST[kind]
            a, b = a + weight * p, b + weight * q
        return a, b

    def marginals(self, tree: Tree) -> np.ndarray:
        """The chance that each element is content: messages go up from the leaves to the page, then
        down again, so every element hears from all others (sum-product, exact on a tree)."""
        n = len(tree.tags)
        own = np.array([self.evidence(x) for x in facts(tree)])
        tables = [self.edges.get(t, self.any_edge) for t in tree.tags]
        up, gathered = [(0.0, 0.0)] * n, own.tolist()
        log_add = lambda x, y: max(x, y) + float(np.log1p(np.exp(-abs(x - y))))
        plain = [t.tolist() for t in tables]
        for i in range(n - 1, 0, -1):
            rest, main = gathered[i]
            (a, b), (c, d) = plain[i]
            up[i] = (log_add(a + rest, b + main), log_add(c + rest, d + main))
            parent = gathered[tree.parents[i]]
            parent[0] += up[i][0]
            parent[1] += up[i][1]
        down = [(0.0, 0.0)] * n
        down[0] = (float(self.root[0]), float(self.root[1]))
        chance = np.zeros(n)
        chance[0] = 1 / (1 + np.exp(min(700.0, gathered[0][0] + down[0][0] - gathered[0][1] - down[0][1])))
        for i in range(1, n):
            p = tree.parents[i]
            rest, main = gathered[p][0] + down[p][0] - up[i][0], gathered[p][1] + down[p][1] - up[i][1]
            (a, b), (c, d) = plain[i]
            down[i] = (log_add(a + rest, c + main), log_add(b + rest, d + main))
            top = max(down[i])
            down[i] = (down[i][0] - top, down[i][1] - top)
            chance[i] = 1 / (1 + np.exp(min(700.0, gathered[i][0] + down[i][0] - gathered[i][1] - down[i][1])))
        return chance


def states(tree: Tree, marked: bool) -> list[int]:
    """Labels of a labelled page: 1 for elements of the main text. `marked`: by the marks of a written
    example; else by the page's own article or main element without navigation, forms and the like."""
    out = [0] * len(tree.tags)
    for i in range(1, len(tree.tags)):
        out[i] = out[tree.parents[i]]
        if marked:
            out[i] = 1 if tree.marks[i] > 0 else 0 if tree.marks[i] < 0 else out[i]
        elif tree.tags[i] in MAIN_TAGS:
            out[i] = 1
        elif tree.tags[i] in REST_TAGS:
            out[i] = 0
    return out


def train(pages: list[tuple[Tree, list[int]]]) -> Model:
    """Potentials from counts over labelled trees, each smoothed by one more of every value."""
    seen: dict[str, list[float]] = {}
    totals: dict[str, list[float]] = {}
    edges: dict[str, np.ndarray] = {}
    every, root = np.ones((2, 2)), np.ones(2)
    for tree, labels in pages:
        for i, (what, y) in enumerate(zip(facts(tree), labels, strict=True)):
            for x in what:
                seen.setdefault(x, [0.0, 0.0])[y] += 1
                totals.setdefault(x[: x.index(":")], [0.0, 0.0])[y] += 1
            if i:
                p = labels[tree.parents[i]]
                edges.setdefault(tree.tags[i], np.zeros((2, 2)))[p, y] += 1
                every[p, y] += 1
            else:
                root[y] += 1
    kinds = {k: sum(x.startswith(f"{k}:") for x in seen) + 1 for k in totals}
    chance = lambda c, k: tuple(float(np.log((c[y] + 1) / (totals[k][y] + kinds[k]))) for y in (0, 1))
    any_edge = every / every.sum(1, keepdims=True)
    smooth = {t: np.log((c + 2 * any_edge) / (c + 2 * any_edge).sum(1, keepdims=True)) for t, c in edges.items()}
    return Model({x: chance(c, x[: x.index(":")]) for x, c in seen.items()}, {k: chance([0, 0], k) for k in totals}, smooth, np.log(any_edge), np.log(root / root.sum()))


def main_text(page: str, model: Model) -> str:
    """The texts of all elements that are more likely content than not: white space inside a block
    becomes one space, and blocks are joined by one space in page order."""
    tree = parse(page)
    keep = model.marginals(tree) > 0.5
    blocks, block = [], []
    for i, text in tree.texts:
        if text is None:
            blocks.append("".join(block))
            block = []
        elif keep[i]:
            block.append(text)
        elif block and block[-1] != " ":
            block.append(" ")
    blocks.append("".join(block))
    return " ".join(filter(None, (" ".join(x.split()) for x in blocks)))


def learn(pages: DataFrame, key: str = "page_id", page: str = "html", most: int = TRAINING_PAGES) -> Model:
    """A model from the written examples and at most `most` pages of the table that label themselves.

    Such a page has one article or main element. The pages with the smallest hashes of their keys
    are taken; one page's html counts once.
    """
    examples = [parse(x) for x in PAGES]
    examples = [(t, states(t, True)) for t in examples]
    labelled = []
    rows = pages.where(F.col(page).rlike(r"(?i)<(article|main)[\s>]")).select(F.col(page).alias("html"), F.xxhash64(F.col(page)).alias("h"))
    # The hashes alone decide first, so that tasks do not each send a full sample of pages.
    edge = rows.select("h").orderBy("h").limit(most).agg(F.max("h")).first()[0] if most else None
    sample = rows.where(F.col("h") <= edge).orderBy("h", "html").limit(most).collect() if edge is not None else []
    for html_ in dict.fromkeys(r["html"] for r in sample):
        tree = parse(html_)
        if sum(t in MAIN_TAGS for t in tree.tags) == 1:
            labelled.append((tree, states(tree, False)))
    # Written layouts and those of the table count alike, however many pages the table has.
    return train(labelled + examples * max(5, len(labelled) // len(examples)))


def extract(pages: DataFrame, model: Model, key: str = "page_id", page: str = "html", url: str = "url") -> DataFrame:
    """Every page's main text: the key, url, text (empty if none) and n_chars (code points).

    A null or empty html has no text. Repeated rows are extracted each; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, page):
            texts = [main_text(x, model) if x else "" for x in batch.column(page).to_pylist()]
            sizes = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column(url), pa.array(texts, pa.string()), sizes], [key, url, "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return map_arrow(pages.select(key, url, page), run, f"{key} {kinds[key]}, {url} {kinds[url]}, text string, n_chars long")
