"""Main text of web pages by belief propagation on the DOM.

A page is parsed into its tree of block elements (inline ones belong to their block). Every node is content or not. Its own
potential is a logistic function of tag, class and id words, text, link share and place; parent-child potentials say how content follows from
parent to child, except below html and body, which hold both kinds. One pass up and one down the tree (sum-product, exact on trees) gives each node's marginal; blocks whose node is
content with ``ACCEPT`` or more are kept, in page order.

Both kinds of potentials are trained on labelled pages: a bounded sample of ``SAMPLE`` pages by hash of page_id, labelled by the
elements that HTML gives a meaning (article or main against nav, aside, footer, form, notices and comments; of equal hashes those with the smaller
hash of html, and of each page the first ``SAMPLE_CHARS`` characters), from a Gaussian prior that holds what such elements and class words mean. Pages without article and main teach nothing. Elements whose text is never shown (scripts, styles, head, templates) are never content. Formulas, drawings and form
controls stand in the line; of these the controls' text goes, and what a drawing shows besides its text. Text outside all elements belongs to a body of its own, and what follows
</body> or </html> to the open element, as in browsers. Null html counts as empty
and gives an empty text. Rows that share a page_id are independent. Other columns are ignored. Pages are read whole; parsing is linear.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from adspark.llm.common import map_arrow, table

SAMPLE, SAMPLE_CHARS, ACCEPT, RIDGE = 2_000, 1 << 20, 0.5, 1.0
#: Nodes whose features are held at once.
AT_ONCE = 20_000
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)|<[!?/][^>]*+>?""", re.S)
MARK = re.compile(r"""[>"']""")
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
# Elements of HTML by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
HIDDEN = frozenset("head script style title template noscript iframe textarea object canvas meta link".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br math svg button select".split())
CONTROLS, FOREIGN, DRAWN = ("button", "select"), ("svg", "math"), ("text", "title", "foreignobject")
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SELF_CLOSING: dict[str, set[str]] = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table body html article section div nav aside main form footer header blockquote".split())
TAGS = ("html", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "li", "ul", "ol", "table", "tr", "td", "th", "blockquote", "pre", "dl", "dt", "dd",
        "figure", "figcaption", "nav", "aside", "header", "footer", "form", "hr", "details", "address", "fieldset", "menu", "center")
OUTER = frozenset({"#page", "#body", "html", "body"})
GOOD, BAD = frozenset({"article", "main"}), frozenset({"nav", "aside", "footer", "form", "menu", "fieldset"})
BAD_WORDS = re.compile(r"(?i)\b(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|sidebar|side|footer|header|masthead|breadcrumbs?|comments?|replies|disqus|cookies?|consent|notice|alert|"
                       r"popup|modal|newsletter|subscribe|signup|share|sharing|social|related|recommend\w*|widget|toolbar|pager|pagination|login|search)\b")
GOOD_WORDS = re.compile(r"(?i)\b(?:article|content|main|post|entry|story|body|text|prose)\b")


def tag_end(html: str, at: int, dead: set[int]) -> int:
    """Where the > is that ends the tag whose name ends at ``at``, outside quoted values of any length; the first one if a quote stays open, -1 if there is none.

    ``dead`` holds the places from which no such > follows; a later tag stops there, so that a page is scanned in linear time.
    """
    seen, k = [], at
    while k >= 0 and k not in dead:
        seen.append(k)
        m = MARK.search(html, k)
        if m is None:
            break
        if m[0] == ">":
            return m.start()
        close = html.find(m[0], m.end())
        k = close + 1 if close >= 0 else -1
    dead.update(seen)
    return html.find(">", at)


class Open:
    """The open elements of a page, with counts that say in one step whether an end tag or an implied end has a match.

    An entry is (tag, block, inline): the element, its block, and whether it stands in that block's line.
    """

    def __init__(self):
        self.stack: list[tuple[str, int, bool]] = [("#page", 0, False)]
        self.blocks: Counter = Counter()  # open blocks
        self.lines: list[Counter] = [Counter()]  # for each block the open elements of its line
        self.scopes: list[Counter] = [Counter()]  # for each element that ends implied ends, the open blocks since
        self.all: Counter = Counter()

    def push(self, tag: str, block: int, inline: bool) -> None:
        self.stack.append((tag, block, inline))
        self.all[tag] += 1
        if inline:
            self.lines[-1][tag] += 1
            return
        self.blocks[tag] += 1
        self.lines.append(Counter())
        if tag in SCOPES:
            self.scopes.append(Counter())
        else:
            self.scopes[-1][tag] += 1

    def pop(self) -> str:
        tag, _, inline = self.stack.pop()
        self.all[tag] -= 1
        if inline:
            self.lines[-1][tag] -= 1
            return tag
        self.blocks[tag] -= 1
        self.lines.pop()
        if tag in SCOPES:
            self.scopes.pop()
        else:
            self.scopes[-1][tag] -= 1
        return tag

    def pop_to(self, tags: set[str] | frozenset[str], inline: bool) -> None:
        """Close elements up to the last one of ``tags``, which is open."""
        while True:
            is_inline = self.stack[-1][2]
            if self.pop() in tags and is_inline == inline:
                return

    def shown(self) -> bool:
        """Whether text is shown here: not in controls, and in drawings only their text."""
        return not any(self.all[t] for t in CONTROLS) and (not self.all["svg"] or any(self.all[t] for t in DRAWN))


class Page:
    """Block elements of a page (parent before child) and its runs of text in order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.words, self.hidden = ["#page"], [-1], [""], [False]
        self.node: list[int] = []  # of each run of text
        self.text: list[str] = []
        self.links = [0]
        self._parse(html)

    def _block(self, tag: str, parent: int, words: str, hidden: bool) -> int:
        for values, value in ((self.tag, tag), (self.parent, parent), (self.words, words), (self.hidden, hidden), (self.links, 0)):
            values.append(value)
        return len(self.tag) - 1

    def _parse(self, html: str) -> None:
        now, parts = Open(), []

        def run(block: int) -> None:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                self.node.append(block)
                self.text.append(text)

        def found(text: str, decode: bool = True) -> None:
            block = now.stack[-1][1]
            if not block and not text.isspace():  # text outside all blocks: a body holds it and what follows
                inline = [t for t, _, _ in now.stack[1:]]
                while len(now.stack) > 1:
                    now.pop()
                block = self._block("#body", 0, "", False)
                now.push("#body", block, False)
                for t in inline:
                    now.push(t, block, True)
            if not self.hidden[block] and now.shown():
                shown = unescape(text) if decode else text
                parts.append(shown)
                if now.all["a"]:
                    self.links[block] += len(shown)

        at, size, last, dead = 0, len(html), html.rfind(">"), set()
        while at < size:
            m = TOKEN.search(html, at)
            if m is None:
                found(html[at:])
                break
            if m.start() > at:
                found(html[at:m.start()])
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            end = tag_end(html, at, dead) if at <= last else -1
            if end < 0:
                found(m[0])
                continue
            rest, at = html[at:end], end + 1
            if m["close"]:
                if now.lines[-1][tag]:
                    now.pop_to({tag}, True)
                elif tag not in INLINE and now.blocks[tag] and tag not in ("html", "body"):
                    run(now.stack[-1][1])
                    now.pop_to({tag}, False)
                continue
            foreign = any(now.all[t] for t in FOREIGN) and not now.all["foreignobject"]
            if foreign and (tag in CLOSES_P or tag in INLINE and tag not in FOREIGN and tag != "a"):  # such a tag ends a drawing or formula left open
                while any(now.all[t] for t in FOREIGN):
                    now.pop()
                foreign = False
            control = any(now.all[t] for t in CONTROLS)
            raw = tag in RAW and not (foreign and tag == "title")
            if tag in INLINE or (foreign or control) and not raw:
                if tag == "br":
                    parts.append(" ")
                elif tag not in VOID and not rest.endswith("/"):
                    now.push(tag, now.stack[-1][1], True)
                continue
            if not (foreign or control):
                ends = {"p"} if tag in CLOSES_P else SELF_CLOSING.get(tag, set())
                run(now.stack[-1][1])
                if any(now.scopes[-1][t] for t in ends):
                    now.pop_to(ends, False)
            block = now.stack[-1][1]
            if not (foreign or control):
                block = self._block(tag, block, " ".join(v.strip("\"'") for _, v in ATTRIBUTE.findall(rest)) if rest else "", self.hidden[block] or tag in HIDDEN)
            if not raw:
                if tag not in VOID:
                    now.push(tag, block, False)
                continue
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            if tag == "xmp":  # preformatted text, shown as it stands
                now.push(tag, block, False)
                found(html[at:end.start() if end else size], decode=False)
                run(block)
                now.pop()
            at = end.end() if end else size
        run(now.stack[-1][1])

    def _measures(self) -> tuple[np.ndarray, ...]:
        """Of each node: own text, text below, characters in links, stops, depth."""
        n = len(self.tag)
        own, stops = np.zeros(n), np.zeros(n)
        for node, text in zip(self.node, self.text):
            own[node] += len(text)
            stops[node] += sum(map(text.count, ".!?;,"))
        below, links, depth = own.tolist(), [float(x) for x in self.links], [0] * n
        for k in range(n - 1, 0, -1):
            below[self.parent[k]] += below[k]
            links[self.parent[k]] += links[k]
        for k in range(1, n):
            depth[k] = depth[self.parent[k]] + 1
        return own, np.array(below), np.array(links), stops, np.array(depth)

    def features(self) -> Iterator[np.ndarray]:
        """A row for each node, ``AT_ONCE`` rows at a time: tag, class words, amount of text, share of links, sentences, place and depth."""
        own, below, links, stops, depth = self._measures()
        n = len(self.tag)
        for a in range(0, n, AT_ONCE):
            part = slice(a, a + AT_ONCE)
            out = np.zeros((len(own[part]), FEATURES))
            for k, (tag, words) in enumerate(zip(self.tag[part], self.words[part])):
                if tag in TAG_AT:
                    out[k, TAG_AT[tag]] = 1
                if words:
                    out[k, len(TAGS)] = BAD_WORDS.search(words) is not None
                    out[k, len(TAGS) + 1] = GOOD_WORDS.search(words) is not None
            out[:, len(TAGS) + 2] = np.log1p(own[part]) / 5
            out[:, len(TAGS) + 3] = np.log1p(below[part]) / 8
            out[:, len(TAGS) + 4] = np.minimum(1, links[part] / np.maximum(1, below[part]))
            out[:, len(TAGS) + 5] = np.minimum(1, 20 * stops[part] / np.maximum(1, own[part]))
            out[:, len(TAGS) + 6] = below[part] / max(1, below[0])
            out[:, len(TAGS) + 7] = np.arange(n)[part] / n
            out[:, len(TAGS) + 8] = np.minimum(depth[part], 12) / 12
            out[:, len(TAGS) + 9] = 1
            yield out

    def label(self) -> np.ndarray | None:
        """By meaning of the elements, or None if the page has neither article nor main."""
        if not GOOD & set(self.tag):
            return None
        n = len(self.tag)
        y = np.zeros(n, bool)
        for k in range(1, n):
            bad = self.tag[k] in BAD or self.hidden[k] or (self.words[k] and BAD_WORDS.search(self.words[k]) is not None and self.tag[k] not in GOOD)
            y[k] = not bad and (self.tag[k] in GOOD or y[self.parent[k]])
        return y


TAG_AT = {t: k for k, t in enumerate(TAGS)}
FEATURES = len(TAGS) + 10


def _prior() -> np.ndarray:
    """Means of the coefficients before training: what the elements and class words mean where no labelled page has them."""
    mean = np.zeros(FEATURES)
    for tag, value in (*((t, 4.0) for t in GOOD), *((t, -8.0) for t in BAD), ("header", -4.0), ("p", 1.0)):
        mean[TAG_AT[tag]] = value
    mean[len(TAGS)], mean[len(TAGS) + 1], mean[len(TAGS) + 4], mean[len(TAGS) + 5] = -8.0, 2.0, -3.0, 1.0
    return mean


def train(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of the nodes' potentials, and log P(child | parent) - log P(child) as a 2 x 2 table."""
    rows, labels = [], []
    joint = np.full((2, 2), 1.0)
    for page in pages:
        y = page.label()
        if y is None:
            continue
        rows.append(np.concatenate([*page.features()])[1:])
        labels.append(y[1:])
        edge = np.array([k for k in range(1, len(y)) if page.tag[page.parent[k]] not in OUTER], int)
        np.add.at(joint, (y[np.array(page.parent, int)[edge]].astype(int), y[edge].astype(int)), 1)
    mean = _prior()
    if not rows:  # without labelled pages the prior decides
        return mean, np.zeros((2, 2))
    beta = mean
    x, y = np.concatenate(rows), np.concatenate(labels).astype(float)
    penalty = np.diag([RIDGE] * (FEATURES - 1) + [1e-6])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ (beta - mean))
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    prior = joint.sum(axis=0) / joint.sum()
    return beta, np.log(joint / joint.sum(axis=1, keepdims=True)) - np.log(prior)


def marginals(parent: list[int], own: np.ndarray, pair: np.ndarray, free: list[bool] | None = None) -> np.ndarray:
    """P(content) of every node by sum-product; ``own`` are log-odds, parents come before their children.

    The parents marked ``free`` have no potential with their children.
    """
    n = len(parent)
    tied, loose = pair.tolist(), [[0.0, 0.0], [0.0, 0.0]]
    tables = [loose if free and k and free[parent[k]] else tied for k in range(n)]
    up0, up1 = [0.0] * n, own.tolist()  # a node's belief from below, as logs
    sent: list[tuple[float, float]] = [(0.0, 0.0)] * n
    for k in range(n - 1, 0, -1):
        table_ = tables[k]
        a = _log_sum(table_[0][0] + up0[k], table_[0][1] + up1[k])
        b = _log_sum(table_[1][0] + up0[k], table_[1][1] + up1[k])
        sent[k] = a, b
        up0[parent[k]] += a
        up1[parent[k]] += b
    for k in range(1, n):  # a parent's whole belief without what the child sent
        p, table_ = parent[k], tables[k]
        a, b = up0[p] - sent[k][0], up1[p] - sent[k][1]
        up0[k] += _log_sum(table_[0][0] + a, table_[1][0] + b)
        up1[k] += _log_sum(table_[0][1] + a, table_[1][1] + b)
    odds = np.array(up1) - np.array(up0)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def main_text(page: Page, beta: np.ndarray, pair: np.ndarray) -> str:
    own = np.clip(np.concatenate([x @ beta for x in page.features()]), -30, 30)
    own[np.array(page.hidden)] = -200
    own[0] = 0
    p = marginals(page.parent, own, pair, [t in OUTER for t in page.tag])
    return "\n\n".join(t for node, t in zip(page.node, page.text) if node and p[node] >= ACCEPT and not page.hidden[node])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for each row of ``pages``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    h = F.struct(F.xxhash64("page_id").alias("h"), F.xxhash64("html").alias("of_html"))
    last = pages.select(h.alias("h")).orderBy("h").limit(SAMPLE).agg(F.max("h").alias("h")).first().h  # hashes alone are sorted, not pages
    sample = pages.where(h <= F.struct(F.lit(last.h), F.lit(last.of_html))).limit(SAMPLE) if last is not None else pages.limit(0)
    beta, pair = train([Page(r.html or "") for r in sample.select(F.substring("html", 1, SAMPLE_CHARS).alias("html")).toLocalIterator()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(Page(h or ""), beta, pair) for h in (x.as_py() for x in batch.column("html"))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return map_arrow(pages, run, "page_id long, url string, text string, n_chars long")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
