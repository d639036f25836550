"""Main text of web pages by a tree-structured graphical model.

A page's elements form a tree. Each element has a hidden label, content or
not. The model has a potential for the root's label, one for each pair of
parent and child labels, and one for what is seen of an element given its
label: its tag, the words of its class, id and role, how much text it holds
itself and how much of it is in links. Sum-product message passing up and then
down the tree gives each element's exact marginal; text belongs to the
nearest element, and is kept when that element's marginal is above a half.
Menus, footers, scripts and the like are known by their tags and are left out of
the tree; so are forms, and comments, adverts and the like by the words of their
class, id and role. Such words also stand on the page's own frame
(``no-sidebar``, ``has-comments``), so they leave out no ``html``, ``body``,
``main`` or ``article``, nothing around the page's largest article, nothing that
holds a third of the text of a page without one, and nothing that holds nine tenths of
an article; there they are features like all other words.

Training: pages with exactly one ``article`` or ``main`` element are labelled by
it: it and what is below are content, except menus, forms, comments and the
like; the rest is not. The potentials are smoothed counts over a sample of
these pages, chosen by a hash of the page's html, of about ``train_pages`` rows;
features are counted in ``FEATURES`` hashed places, so the counts are small
whatever the input. Inference reads every whole page.

Blocks are elements that a browser sets apart; character references are
decoded, white space inside a block becomes one space, and blocks are joined by
a line feed in page order.

Defined results: a null or empty html gives an empty text; tags left open are
closed where their parent closes; stray end tags are ignored; a tag that never ends is
text, and so is all after it; of more than ``DEEPEST`` open elements the last one
closes where the next starts; equal rows are extracted each;
extra columns are ignored; without any labelled page the smoothed counts leave
the choice to the elements' names alone (``article`` and ``main``).
"""

from __future__ import annotations

import html as html_lib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

FEATURES = 4096

_names = lambda text: frozenset(text.split())
VOID = _names("area base br col embed hr img input link meta param source track wbr")
RAW = _names("script style textarea title noscript iframe template xmp noembed noframes")
BLOCK = _names(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul")
#: Never main text, wherever they are.
NEVER = _names("nav footer aside form button select option datalist label input svg canvas audio video object map dialog menu head")
#: What no class, id or role word leaves out.
FRAME = _names("html body main article")
#: Class, id or role words of what is no main text, also inside an article.
ASIDE = _names(
    "ad ads advert advertisement adverts banner comment comments cookie cookies consent disqus footer menu nav navbar navigation "
    "newsletter notice popup promo related share sharing sidebar social sponsor sponsored subscribe breadcrumb breadcrumbs reply replies "
    "contentinfo complementary search")
CLOSED_BY = {
    "p": _names("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                "header hgroup hr main menu nav ol p pre section table ul"),
    "li": _names("li"), "dt": _names("dt dd"), "dd": _names("dt dd"), "tr": _names("tr tbody tfoot thead"), "td": _names("td th tr tbody tfoot"),
    "th": _names("td th tr tbody tfoot"), "option": _names("option optgroup"), "thead": _names("tbody tfoot"), "tbody": _names("tbody tfoot"),
}
#: An element of these keeps open paragraphs and items outside of it open.
SCOPE = _names("article aside body div table td th section main nav footer header form blockquote ul ol dl html")

#: An end tag that none of these lets through closes nothing outside of them.
CELL = _names("td th table")
THROUGH = _names("table tr tbody thead tfoot body html")
#: The elements that a tag closes.
CLOSES = {tag: [own for own, by in CLOSED_BY.items() if tag in by] for tag in frozenset().union(*CLOSED_BY.values())}
#: So many elements are open at once; one below these stands beside the last of them.
DEEPEST = 512

#: Quotes hold a value right after an equals sign alone; any other is an ordinary character.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*+)|[^>])*+)>""", re.S)
#: What would be a tag if it had an end.
NO_END = re.compile(r"</?[a-zA-Z]")
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I | re.S)
PARTS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


class Tree:
    """Elements in page order: tags, parents and class words; and the texts,
    each with its element. Element 0 is the page. Open elements are counted by
    tag, so that no tag walks over others than those it closes: the time
    is in proportion to the page, however odd it is."""

    def __init__(self, page: str):
        self.tags, self.parents, self.marks = [""], [-1], [frozenset()]
        self.texts: list[tuple[int, str]] = []  # (element, raw text); a text of None starts a block
        self.stack = [0]
        # how many of each tag are open: in all, and from the innermost element of CELL (of SCOPE) on, for each such element
        self.open, self.cells, self.scopes = defaultdict(int), [defaultdict(int)], [defaultdict(int)]
        at = look = 0  # the text from ``at`` on is not yet taken
        while (look := page.find("<", look)) >= 0:
            m = TOKEN.match(page, look)
            if not m:
                if NO_END.match(page, look):  # a tag without an end: what follows is text
                    break
                look += 1
                continue
            if look > at:
                self.texts.append((self.stack[-1], page[at:look]))
            at = m.end()
            if tag := (m[2] or "").lower():
                if m[1]:
                    self._close(tag)
                else:
                    at = self._start(tag, m[3] or "", page, at)
            look = at
        if at < len(page):
            self.texts.append((self.stack[-1], page[at:]))

    def _push(self, element: int) -> None:
        tag = self.tags[element]
        if len(self.stack) > DEEPEST:
            self._pop()
            self.parents[element] = self.stack[-1]
        self.stack.append(element)
        self.open[tag] += 1
        for counts, bounds in ((self.cells, CELL), (self.scopes, SCOPE)):
            if tag in bounds:
                counts.append(defaultdict(int))
            counts[-1][tag] += 1

    def _pop(self) -> str:
        tag = self.tags[self.stack.pop()]
        self.open[tag] -= 1
        for counts, bounds in ((self.cells, CELL), (self.scopes, SCOPE)):
            if tag in bounds:
                counts.pop()
            else:
                counts[-1][tag] -= 1
        return tag

    def _start(self, tag: str, attributes: str, page: str, at: int) -> int:
        self._close_implied(tag)
        marks = frozenset()
        if attributes and ("=" in attributes):
            found = [v for a in ATTRIBUTE.findall(attributes) for v in a[1:] if v]
            if found:
                marks = frozenset(PARTS.findall(" ".join(found).lower()))
        element = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        self.marks.append(marks)
        if tag in BLOCK:
            self.texts.append((element, None))
        elif tag == "br":
            self.texts.append((self.stack[-1], " "))
        if tag in RAW:  # up to its own end tag, and never text
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            end = page.find(">", close.end()) if close else -1
            return end + 1 if end >= 0 else len(page)
        if tag not in VOID and (tag in BLOCK or not attributes.rstrip().endswith("/")):  # a slash does not close a block
            self._push(element)
        return at

    def _close_implied(self, tag: str) -> None:
        owners = CLOSES.get(tag)
        while owners and any(self.scopes[-1][own] for own in owners):
            while (own := self._pop()) not in owners:
                pass
            if own not in ("td", "th"):
                return

    def _close(self, tag: str) -> None:
        if not (self.open if tag in THROUGH else self.cells[-1])[tag]:
            return
        while True:
            element = self.stack[-1]
            if self._pop() == tag:
                break
        if tag in BLOCK:
            self.texts.append((self.parents[element], None))


def _bucket(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(n + 1).astype(np.int64), 12)


def observed(tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(element, feature) pairs: hashed tag and class words, and the sizes of
    own text and of the share of text in links below."""
    n = len(tree.tags)
    own = np.zeros(n, np.int64)
    for e, t in tree.texts:
        if t:
            own[e] += len(t) - t.count(" ")
    below, linked = own.tolist(), [0] * n
    for e in range(n - 1, 0, -1):  # children come after their parents
        p = tree.parents[e]
        below[p] += below[e]
        linked[p] += below[e] if tree.tags[e] == "a" else linked[e]
    share = [min(4, int(5 * k / max(b, 1))) for k, b in zip(linked, below)]
    elements, features = [], []
    sizes = _bucket(own).tolist()
    for e, tag in enumerate(tree.tags):
        names = ["t:" + tag, f"o:{sizes[e]}", f"l:{share[e]}", *("m:" + m for m in tree.marks[e])]
        elements.extend([e] * len(names))
        features.extend(names)
    return np.array(elements), np.array([_place(f) for f in features])


def _place(name: str) -> int:
    import zlib

    return zlib.crc32(name.encode()) % FEATURES


def barred(tree: Tree) -> np.ndarray:
    """Elements that are, or are below, what is never main text."""
    n = len(tree.tags)
    out = np.zeros(n, bool)
    scope = [0] * n  # the nearest article or main that an element is below
    named = []
    for e in range(1, n):
        p, tag = tree.parents[e], tree.tags[e]
        scope[e] = p if tree.tags[p] in ("article", "main") else scope[p]
        out[e] = out[p] or (tag in NEVER and tag != "form") or tag in RAW or (tag == "header" and not scope[e])
        if not out[e] and tag not in FRAME and (tag == "form" or tree.marks[e] & ASIDE):
            named.append(e)
    if named:
        wide = _wide(tree, out, scope)
        for e in named:
            out[e] = not wide(e)
        for e in range(1, n):
            out[e] |= out[tree.parents[e]]
    return out


def _wide(tree: Tree, out: np.ndarray, scope: list[int]):
    """Whether an element, by its name no main text, is the frame of some:
    around the page's largest article (or main), with a third of the text of a page
    without one, or with nine tenths of the article that it is in. ``out``: left out by tag."""
    below = [0] * len(tree.tags)
    for e, t in tree.texts:
        if t and not out[e]:
            below[e] += len(t) - t.count(" ")
    for e in range(len(below) - 1, 0, -1):
        below[tree.parents[e]] += below[e]
    tops = [e for e, t in enumerate(tree.tags) if t in ("article", "main") and not out[e]]
    around = set()
    if tops:  # comments can be articles too, with a name that says so
        e = max(tops, key=lambda e: (not tree.marks[e] & ASIDE, below[e], -e))
        while e > 0:
            around.add(e)
            e = tree.parents[e]

    def wide(e: int) -> bool:
        if e in around:
            return True
        if scope[e]:
            return 10 * below[e] > 9 * below[scope[e]]
        return not tops and 3 * below[e] > below[0]  # beside an article it may be comments

    return wide


def labels(tree: Tree) -> np.ndarray | None:
    """Each element's label from the page's one article or main; None for a page without."""
    for name in ("article", "main"):
        tops = [e for e, t in enumerate(tree.tags) if t == name]
        if len(tops) == 1:
            out = np.zeros(len(tree.tags), bool)
            out[tops[0]] = True
            for e in range(tops[0] + 1, len(out)):
                out[e] = out[tree.parents[e]]
            return out & ~barred(tree)
    return None


#: Places of the counts: features by label, then parent and child labels, then the root's label.
_PAIRS = 2 * FEATURES
_ROOT = _PAIRS + 4
_COUNTS = _ROOT + 2


def train(pages: DataFrame, train_pages: int = 4000) -> np.ndarray:
    """The model's counts, from about ``train_pages`` of the labelled rows of ``pages(html)``."""
    known = pages.where("html is not null")
    rows = known.count()
    share = min(1.0, train_pages / max(rows, 1))
    chosen = known.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30))).select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_COUNTS)
        for batch in batches:
            for page in batch.column("html").to_pylist():
                tree = Tree(page)
                y = labels(tree)
                if y is None:
                    continue
                never = barred(tree)
                element, feature = observed(tree)
                open_ = ~never[element]
                np.add.at(total, 2 * feature[open_] + y[element[open_]], 1)
                free = np.flatnonzero(~never)[1:]
                np.add.at(total, _PAIRS + 2 * y[np.array(tree.parents)[free]].astype(int) + y[free], 1)
                total[_ROOT + int(y[0])] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["place", "n"])

    found = chosen.mapInArrow(count, "place long, n double").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(_COUNTS)
    out[found["place"]] = found["n"]
    return out


class Model:
    """Log potentials from counts, with a prior count for each."""

    #: Log odds that one feature gives at most: what training pages happen to
    #: lack (say, links in the text) must not outweigh the parent's label.
    MOST = 2.0

    def __init__(self, counts: np.ndarray, prior: float = 1.0):
        seen = counts[:_PAIRS].reshape(FEATURES, 2)
        sums = seen.sum(0) + 1
        seen = seen + prior * sums / sums.sum()  # what was never seen says nothing
        emit = np.log(seen[:, 1] / sums[1]) - np.log(seen[:, 0] / sums[0])
        self.emit = np.clip(emit, -self.MOST, self.MOST)
        for name in ("t:article", "t:main"):
            self.emit[_place(name)] = 10 * self.MOST
        pair = counts[_PAIRS:_ROOT].reshape(2, 2) + np.array([[100.0, 1.0], [1.0, 100.0]])  # children mostly follow
        self.pair = np.log(pair / pair.sum(1, keepdims=True))
        root = counts[_ROOT:] + prior
        self.root = np.log(root / root.sum())

    def marginals(self, parents: np.ndarray, odds: np.ndarray) -> np.ndarray:
        """P(content) of each element of a forest. ``parents`` come before
        their children (-1: a root); ``odds``: log odds of what is seen."""
        n = len(parents)
        waves, wave = [], np.flatnonzero(parents < 0)
        order = np.argsort(parents, kind="stable")
        starts = np.searchsorted(parents[order], np.arange(n + 1))
        while len(wave):
            waves.append(wave)
            counts = starts[wave + 1] - starts[wave]
            first = np.repeat(starts[wave] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
            wave = order[first + np.arange(counts.sum())]
        up = np.zeros((n, 2))
        up[:, 1] = odds
        sent = np.zeros((n, 2))  # message of each element to its parent
        for wave in reversed(waves[1:]):
            m = np.logaddexp(self.pair[:, 0] + up[wave, :1], self.pair[:, 1] + up[wave, 1:])
            sent[wave] = m - m.max(1, keepdims=True)
            np.add.at(up, parents[wave], sent[wave])
        belief = up.copy()
        belief[waves[0]] += self.root
        for wave in waves[1:]:
            rest = belief[parents[wave]] - sent[wave]  # the parent without what this child sent
            m = np.logaddexp(rest[:, :1] + self.pair[0], rest[:, 1:] + self.pair[1])
            belief[wave] += m - m.max(1, keepdims=True)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


def main_texts(pages: list[str], model: Model) -> list[str]:
    trees = [Tree(p) for p in pages]
    sizes = np.array([len(t.tags) for t in trees])
    first = np.concatenate(([0], np.cumsum(sizes)))
    never = np.concatenate([barred(t) for t in trees])
    parents = np.concatenate([np.where(np.array(t.parents) < 0, -1, np.array(t.parents) + f) for t, f in zip(trees, first)])
    parents[never] = -1  # known, so they say nothing about their parents
    odds = np.zeros(first[-1])
    for t, f in zip(trees, first):
        element, feature = observed(t)
        np.add.at(odds, element + f, model.emit[feature])
    content = (model.marginals(parents, odds) > 0.5) & ~never
    return [_join(t, content[f : f + n]) for t, f, n in zip(trees, first, sizes)]


def _join(tree: Tree, content: np.ndarray) -> str:
    blocks: list[list[str]] = [[]]
    for e, t in tree.texts:
        if t is None:
            if blocks[-1]:
                blocks.append([])
        elif content[e]:
            blocks[-1].append(t)
        elif t.strip() and blocks[-1]:
            blocks[-1].append(" ")
    out = (SPACE.sub(" ", html_lib.unescape("".join(b))).strip() for b in blocks)
    return "\n".join(b for b in out if b)


def extract(pages: DataFrame, counts: np.ndarray) -> DataFrame:
    """page_id, url, text for each row of ``pages(page_id, url, html)``."""
    shared = pages.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value)
        for batch in batches:
            for part in W.slices(batch, "html"):
                texts = main_texts([h or "" for h in part.column("html").to_pylist()], model)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def main_text(pages: DataFrame, train_pages: int = 4000) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``."""
    out = extract(pages, train(pages.select("html"), train_pages))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
