"""Main text of web pages: flat text blocks judged by a decision tree.

A page is read once, from its first tag to its last, into text blocks in page order. Each block has
its number of words and share of linked words, the same of the blocks before and after it, and a
few marks of the elements around it. A decision tree, trained on a small table of labelled pages,
tells the article's blocks from all others. Every page is judged on its own, so nothing shuffles.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of the format.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = ("canvas", "iframe", "noscript", "object", "script", "select", "style", "svg", "template", "textarea", "title")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q s samp small span strike strong sub sup time tt u var br wbr img".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section summary table ul".split()
)
#: An element of the first closes an open one of the second, unless one of the third lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "a": ({"a"}, {"td", "th"}),
} | dict.fromkeys(ENDS_PARAGRAPH, ({"p"}, {"td", "th", "button", "caption", "blockquote", "div", "section", "article", "li"}))
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})

#: Elements and words of class, id and role that mark what is not the article, and what is.
OTHER_TAGS = frozenset("aside button dialog fieldset footer label legend menu nav".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies disqus dialog footer gdpr hidden login menu "
    "modal nav navbar navigation newsletter notice notification pager pagination popup promo recommended related replies reply responses search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe teaser toolbar widget".split()
)
MAIN_TAGS = frozenset({"article", "main"})
MAIN_WORDS = frozenset("article entry main maincontent post story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    rf"|<(?P<skip>{'|'.join(SKIPPED)})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=skip)(?=[\s/>])[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE_END = re.compile(r"[.!?…。！？:;][\"'”’»)\]]*$")

FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "marked_other", "in_main", "in_form", "heading", "list_item", "sentence_end", "rights",
)


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    other: bool
    main: bool
    form: bool
    heading: bool
    item: bool


@dataclass
class _Element:
    name: str
    other: bool = False
    main: bool = False


@dataclass
class _Reader:
    """The open elements and the text gathered since the last block ended."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[_Element] = field(default_factory=list)
    open: dict[str, int] = field(default_factory=dict)
    others: int = 0
    mains: int = 0
    held: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)

    def text(self, raw: str) -> None:
        self.held.append(raw)
        if self.open.get("a"):
            self.linked.append(raw)

    def flush(self) -> None:
        if self.held:
            words = html.unescape("".join(self.held)).split()
            if words:
                linked = len(html.unescape(" ".join(self.linked)).split()) if self.linked else 0
                on = self.open.get
                heading = any(on(h) for h in HEADINGS)
                self.blocks.append(
                    Block(" ".join(words), len(words), min(linked, len(words)), self.others > 0, self.mains > 0, bool(on("form")), heading, bool(on("li")))
                )
            self.held, self.linked = [], []

    def push(self, name: str, rest: str) -> None:
        element = _Element(name)
        if name in MAIN_TAGS:
            element.main = True
        elif name in OTHER_TAGS or (name == "header" and not self.mains):
            element.other = True
        if rest and name not in ("html", "body"):
            if _HIDDEN.search(rest):
                element.other = True
            for m in _NAMES.finditer(rest):
                found = {w.lower() for w in _NAME_WORD.findall(m[1] or m[2] or m[3] or "")}
                element.main |= bool(found & MAIN_WORDS) and name not in INLINE
                element.other |= bool(found & OTHER_WORDS) or ("header" in found and not self.mains and name not in HEADINGS)
        if element.other or (element.main and not self.mains):
            self.flush()
        self.stack.append(element)
        self._count(element, 1)

    def _count(self, element: _Element, by: int) -> None:
        self.open[element.name] = self.open.get(element.name, 0) + by
        self.others += by * element.other
        self.mains += by * element.main

    def pop(self, at: int) -> None:
        """Close the element at a place of the stack and all inside it."""
        if any(e.other or e.main for e in self.stack[at:]):
            self.flush()
        for e in self.stack[at:]:
            self._count(e, -1)
        del self.stack[at:]

    def close(self, names: set[str], within: set[str] = frozenset()) -> None:
        if any(self.open.get(n) for n in names):
            for at in range(len(self.stack) - 1, -1, -1):
                if self.stack[at].name in names:
                    self.pop(at)
                    return
                if self.stack[at].name in within:
                    return

    def close_inline(self, name: str) -> None:
        """An inline element ends alone; blocks that were opened inside it stay open."""
        if self.open.get(name):
            at = next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i].name == name)
            if self.stack[at].other or self.stack[at].main:
                self.flush()
            self._count(self.stack.pop(at), -1)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Scripts, styles, comments and their like have none.

    A block ends where an element begins or ends that is not inline; a line break is white space.
    Elements left open, ends without a beginning and a page that stops in a tag are taken as
    browsers take them; null or text without tags is one block at most.
    """
    reader, at = _Reader(), 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            reader.text(page[at : m.start()])
        at = m.end()
        if m["name"] is None:
            if m["skip"] and m["skip"].lower() not in INLINE:
                reader.text(" ")
            continue
        name = m["name"].lower()
        if name not in INLINE:
            reader.flush()
        elif name == "br":
            reader.text(" ")
        if m["end"]:
            if name in INLINE:
                reader.close_inline(name)
            else:
                reader.close({name})
        elif name not in VOID:
            if name in CLOSES:
                reader.close(*CLOSES[name])
            reader.push(name, m["rest"])
    if at < len(page):
        reader.text(page[at:])
    reader.flush()
    return reader.blocks


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block of a page.

    ``in_main`` is 1 inside an element that marks the article, -1 outside it, and 0 on pages
    without such an element.
    """
    n = len(found)
    out = np.zeros((n, len(FEATURES)))
    if n == 0:
        return out
    words = np.array([b.words for b in found], dtype=float)
    linked = np.array([b.link_words for b in found]) / words
    main = np.array([b.main for b in found])
    out[:, 0], out[:, 1] = words, linked
    out[1:, 2], out[1:, 3] = words[:-1], linked[:-1]
    out[:-1, 4], out[:-1, 5] = words[1:], linked[1:]
    out[:, 6] = [b.other for b in found]
    out[:, 7] = np.where(main, 1, -1) if main.any() else 0
    out[:, 8] = [b.form for b in found]
    out[:, 9] = [b.heading for b in found]
    out[:, 10] = [b.item for b in found]
    out[:, 11] = [_SENTENCE_END.search(b.text) is not None for b in found]
    out[:, 12] = ["©" in b.text for b in found]
    return out


@dataclass(frozen=True)
class Tree:
    """A split per node: rows with feature <= limit go left. A leaf has feature -1 and an answer."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    answer: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        while len(inner := np.flatnonzero(self.feature[at] >= 0)):
            node = at[inner]
            low = x[inner, self.feature[node]] <= self.limit[node]
            at[inner] = np.where(low, self.left[node], self.right[node])
        return self.answer[at]


def _split(x: np.ndarray, y: np.ndarray) -> tuple[int, float, float]:
    """Feature, limit and gain of the best cut by Gini impurity; the first of equal ones."""
    n, best = len(y), (-1, 0.0, 1e-9)
    whole = 2 * y.mean() * (1 - y.mean())
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        value, label = x[order, f], y[order]
        cut = np.flatnonzero(value[:-1] < value[1:])
        if len(cut):
            n_low = cut + 1.0
            low = np.cumsum(label)[cut] / n_low
            high = (label.sum() - low * n_low) / (n - n_low)
            gain = whole - (n_low * 2 * low * (1 - low) + (n - n_low) * 2 * high * (1 - high)) / n
            i = int(np.argmax(gain))
            if gain[i] > best[2] + 1e-12:
                best = (f, float(value[cut[i]] + value[cut[i] + 1]) / 2, float(gain[i]))
    return best


def fit(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1) -> Tree:
    """A tree of binary cuts, grown until leaves are pure, ``depth`` is reached or nothing is gained."""
    nodes: list[list] = []

    def grow(rows: np.ndarray, level: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, -1, -1, bool(y[rows].mean() >= 0.5)])
        if level < depth and len(rows) >= 2 * least and 0 < y[rows].sum() < len(rows):
            f, limit, _ = _split(x[rows], y[rows])
            if f >= 0:
                low = x[rows, f] <= limit
                if min(low.sum(), (~low).sum()) >= least:
                    nodes[at][:2] = f, limit
                    nodes[at][2] = grow(rows[low], level + 1)
                    nodes[at][3] = grow(rows[~low], level + 1)
        return at

    grow(np.arange(len(y)), 0)
    return Tree(*[np.array(c) for c in zip(*nodes, strict=True)])


_FILLER = "some of the words that a page may have in its text beside others"


def _filled(template: str) -> str:
    """``{n}`` stands for n words."""
    words = _FILLER.split()
    return re.sub(r"\{(\d+)\}", lambda m: " ".join(words[i % len(words)] for i in range(int(m[1]))), template)


#: The labelled table: pages, and for each of their blocks in turn 1 if it belongs to the article.
LABELLED = (
    ("<nav><ul><li><a href=/>{1}</a></li><li><a href=/>{2}</a></li></ul></nav><div class=ad>{8}.</div><article><h1>{6}</h1><p>{30}.</p><p>{1}.</p><p>{4}</p></article><footer>&copy; {7}.</footer>", "00011110"),
    ("<header><p>{9}.</p></header><main><h1>{1}</h1><p>{2}.</p><p>{60}.</p><ul><li>{3}</li><li>{14}.</li></ul><aside>{25}.</aside><p>{12}.</p></main><div>{40}.</div><footer>{22}.</footer>", "0111110100"),
    ("<div class=site-menu><a href=/>{2}</a> <a href=/>{1}</a></div><div id=content><h2>{5}</h2><p>{45}.</p><p>{9}.</p><p>{33}.</p></div><div class=sidebar><p>{28}.</p><a href=/>{4}</a></div><div>&copy; {6}</div>", "01111000"),
    ("<p><a href=/>{2}</a> | <a href=/>{1}</a> | <a href=/>{2}</a></p><h1>{7}</h1><p>{50}.</p><p>{26}.</p><p>{11}.</p><p>{38}.</p><p><a href=/>{5}</a></p><p>&copy; {5}</p>", "01111100"),
    ("<table><tr><td><a href=/>{2}</a></td><td><a href=/>{2}</a></td></tr></table><h1>{4}</h1><p>{24}.</p><p>{70}, <a href=/>{6}</a> {10}.</p><p><a href=/>{3}</a></p><p>&copy; {10} {2}.</p>", "0011100"),
    ("<div class=cookie-notice><p>{20}.</p><button>{1}</button></div><article><h1>{8}</h1><p>{17}.</p><p><a href=/>{14}</a></p><div class=share>{3}</div><p>{42}.</p><section class=comments><h3>{1}</h3><p>{36}.</p><p>{5}.</p></section></article>", "0011101000"),
    ("<form><label>{3}</label><p>{13}.</p></form><div class=post><h1>{3}</h1><p>{6}.</p><ol><li><a href=/>{7}</a></li></ol><blockquote>{19}</blockquote></div><form><p>{31}.</p></form><div>{12}.</div>", "00111100"),
    ("<ul><li><a href=/>{3}</a></li><li><a href=/>{2}</a></li><li><a href=/>{4}</a></li></ul><div><h1>{9}</h1><div>{65}.</div><div>{48}.</div></div><ul><li><a href=/>{11}</a></li><li><a href=/>{9}</a></li></ul><div>{3}</div>", "000111000"),
    ("<form><div><a href=/>{2}</a></div><div><h1>{5}</h1><p>{52}.</p><p>{44}.</p><p>{21}.</p></div><div>&copy; {4}</div></form>", "011110"),
    ("<article><header><h1>{6}</h1><p>{4}</p></header><p>{90}.</p><figure><figcaption>{7}</figcaption></figure><footer>{9}.</footer></article><div>{16}.</div>", "111100"),
    ("<div><a href=/>{1}</a></div><div>{5}</div><p>{35}.</p><p>{29}.</p><p>{55}.</p><div>{2}</div><div><a href=/>{12}</a></div>", "0011100"),
    ("<main><nav><a href=/>{2}</a></nav><h1>{2}</h1><p>{3}.</p><pre>{18}</pre><p><a href=/>{2}</a></p></main><div><p>{23}.</p></div>", "011110"),
    ("<div>{6}</div><article><p>{40}.</p><p>{3}.</p></article><div>{30}.</div><div>{45}.</div>", "01100"),
    ("<div><a href=/>{3}</a></div><div>{20}.</div><main><p>{55}.</p></main><p>{60}.</p><p>{25}.</p>", "00100"),
    ("<p>{9}</p><p>{41}.</p><article><h1>{8}</h1><p>{5}</p><p>{33}.</p></article>", "00111"),
    ("<div>{2}</div><h1>{6}</h1><p>{36}.</p><h2>{3}</h2><p>{58}.</p><p>{8}.</p><p>{47}.</p><div>{4}</div><div>&copy; {3}</div>", "011111100"),
    ("<p><a href=/>{1}</a></p><h2>{4}</h2><p>{32}.</p><p>{64}.</p><p><a href=/>{16}</a></p><p><a href=/>{22}</a></p><p><a href=/>{25}</a></p>", "0111000"),
    ("<div><a href=/>{18}</a></div><div><a href=/>{21}</a></div><div><a href=/>{3}</a></div><p>{39}.</p><p>{12}.</p><p>{34}.</p>", "000111"),
    ("<article><p>{40}.</p><div class=related><a href=/>{6}</a><p><a href=/>{8}</a></p></div><p>{30}.</p><nav><a href=/>{5}</a></nav></article>", "10010"),
    ("<p>{27}.</p>", "1"),
    ("<div>{1}</div><div><a href=/>{2}</a></div>", "00"),
)


def train(pages: tuple[tuple[str, str], ...] = LABELLED) -> Tree:
    """The tree of a labelled table: pages, each with a 0 or 1 for every one of its blocks."""
    x, y = [], []
    for template, labels in pages:
        found = blocks(_filled(template))
        if len(found) != len(labels):
            raise ValueError(f"{len(found)} blocks and {len(labels)} labels: {template[:60]}")
        x.append(features(found))
        y += [c == "1" for c in labels]
    return fit(np.concatenate(x), np.array(y, dtype=float))


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    kept = tree.predict(features(found))
    return "\n".join(b.text for b, k in zip(found, kept, strict=True) if k)


def extract(pages: DataFrame, tree: Tree | None = None, html_col: str = "html") -> DataFrame:
    """Each row with ``text``, the article's blocks joined by line ends, and ``n_chars``.

    White space inside a block is one blank; a page without an article has the empty text, as has a
    null or empty page. Repeated rows are judged alike, an empty table gives an empty result, and
    columns that bear a result's name are replaced. Whole pages are read; the page itself is left out.
    """
    tree = tree or train()
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    source = pages.select(*[pages[f"`{c}`"] for c in [*rest, html_col]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a few pages at a time as Python strings
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                texts = [main_text(page.as_py(), tree) for page in part.column(len(rest))]
                made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*rest, "text", "n_chars"])

    kept = source.drop(html_col).schema
    return source.mapInArrow(run, kept.add("text", "string").add("n_chars", "long"))
