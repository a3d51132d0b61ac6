"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded as a tree.

Every block element is a node with features of its subtree (text, links and markup and the
ratios of these), its attributes' words, its depth, its siblings and its ancestors. Boosted
trees give each node the odds of being part of the article. The decoding picks, for the
whole tree at once, the most likely set of nodes under the rule that nothing inside a
dropped node is kept.

The trees are fitted here: on a bounded sample of the pages, as far as these mark their
article with ``article`` or ``main``, and on pages put together from the sample's sentences
in other layouts, in which the marks are names of classes only.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.llm.tables import read_table, ship, slices, tidy, unpack

# Pages the trees are fitted on, about, and pages made from them.
SAMPLE = 200
LAYOUTS = 400
ROUNDS, DEPTH, RATE, BINS = 40, 4, 0.3, 32

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset(
    "script style title textarea iframe noscript noembed noframes template select svg math".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# What an opening tag ends if it is open, and what keeps it from being looked for further up.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_TAGS = (
    "article main section div p h1 h2 h3 ul ol li dl table td blockquote pre figure header footer "
    "nav aside form button body"
).split()
_TAG_PLACE = {tag: i for i, tag in enumerate(_TAGS)}
_WORD_BITS = 128

_NAME = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
_BORDER = re.compile("[>\"']")
_NAMES = re.compile(
    r"""(?:^|\s)(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I
)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """The block elements of a page in page order, and the text between their borders."""

    tags: list[str] = field(default_factory=lambda: ["body"])
    parents: list[int] = field(default_factory=lambda: [-1])
    words: list[int] = field(default_factory=lambda: [0])
    main: list[bool | None] = field(default_factory=lambda: [None])
    links: list[int] = field(default_factory=lambda: [0])
    inputs: list[int] = field(default_factory=lambda: [0])
    inline: list[int] = field(default_factory=lambda: [0])
    texts: list[tuple[int, str]] = field(default_factory=list)

    def open(self, tag: str, parent: int, attributes: str) -> int:
        words, main = 0, None
        for name, *values in _NAMES.findall(attributes):
            value = "".join(values)
            if name == "data-main":
                main = value == "1"
                continue
            for part in _NAME_PART.findall(value):
                words |= 1 << zlib.crc32(part.lower().encode()) % _WORD_BITS
        self.tags.append(tag)
        self.parents.append(parent)
        self.words.append(words)
        self.main.append(main)
        for counts in (self.links, self.inputs, self.inline):
            counts.append(0)
        return len(self.tags) - 1


def tags_of(source: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``start, end, tag, closing, attributes`` of each tag, comment and declaration (the last
    two without a tag), in one pass over the page. What a script or the like holds is part of its
    tag.

    A tag ends at the first ``>`` outside quotes, or, if there is none, at the first one. A
    ``<`` that begins none of these is text. Quotes from which no ``>`` can be reached are
    remembered, so that no part of a page is searched again and again."""
    last = {quote: source.rfind(quote) for quote in "\"'"}
    last_end = source.rfind(">")
    hopeless: set[int] = set()

    def end_of(at: int) -> int:
        passed = []
        while border := _BORDER.search(source, at):
            at = border.start()
            if source[at] == ">":
                return at
            if at in hopeless or last[source[at]] <= at:
                break
            passed.append(at)
            at = source.find(source[at], at + 1) + 1
        hopeless.update(passed)
        return -1

    at = source.find("<")
    while at >= 0:
        end = 0
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            end = len(source) if end < 0 else end + 3
            yield at, end, "", False, ""
        elif at < last_end:
            name = _NAME.match(source, at + 1)
            if name:
                end = end_of(name.end())
                if end < 0:
                    end = source.find(">", name.end())
                tag, attributes = name[2].lower(), source[name.end() : end]
                end += 1
                if tag in _RAW and not name[1] and not attributes.endswith("/"):
                    close = re.compile("</" + tag, re.I).search(source, end)
                    end = close.start() if close else len(source)
                yield at, end, tag, bool(name[1]), attributes
            elif source[at + 1] in "!?/":
                end = source.find(">", at + 1) + 1
                yield at, end, "", False, ""
        at = source.find("<", max(end, at + 1))


class _Open:
    """The nodes that are open, and how deep each tag's are."""

    def __init__(self, root: int):
        self._nodes, self._tags = [root], [""]
        self._depths: dict[str, list[int]] = {}

    def __len__(self) -> int:
        return len(self._nodes)

    @property
    def top(self) -> int:
        return self._nodes[-1]

    def push(self, node: int, tag: str) -> None:
        self._depths.setdefault(tag, []).append(len(self._nodes))
        self._nodes.append(node)
        self._tags.append(tag)

    def deepest(self, tags: Iterable[str]) -> int:
        """The depth of the last one of these tags, 0 if none is open."""
        return max((self._depths[tag][-1] for tag in tags if self._depths.get(tag)), default=0)

    def close_from(self, depth: int) -> None:
        while len(self._nodes) > depth:
            self._nodes.pop()
            self._depths[self._tags.pop()].pop()


def parse(source: str) -> Page:
    """Forgiving: end tags may be missing, stray ones are passed over. Comments, scripts,
    styles and the like are left out. Break and image are white space. The time it takes
    follows the length of the page, whatever is on it."""
    page, stack, held, linked = Page(), _Open(0), [], 0
    at = 0

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            page.texts.append((stack.top, text))

    def take(text: str) -> None:
        if text:
            text = html.unescape(text)
            held.append(text)
            if linked > 0:
                page.links[stack.top] += len(text)

    for start, end, tag, closing, attributes in tags_of(source):
        take(source[at:start])
        at = end
        if not tag:
            continue
        if tag in _RAW:
            if not closing:
                page.inputs[stack.top] += tag in ("textarea", "select")
            continue
        if tag in _INLINE or tag in _VOID:
            if tag == "a":
                linked = 0 if closing else 1
            page.inline[stack.top] += not closing
            if tag in ("br", "img"):
                held.append(" ")
            elif tag == "input":
                page.inputs[stack.top] += 1
            elif tag == "hr":
                flush()
            continue
        flush()
        linked = 0
        if closing:
            if depth := stack.deepest([tag]):
                stack.close_from(depth)
            continue
        if tag in ("html", "body", "head"):
            continue
        if page.tags[stack.top] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and len(stack) > 1:
            stack.close_from(len(stack) - 1)
        ends, fence = _ENDS.get(tag, ((), ()))
        if (depth := stack.deepest(ends)) > stack.deepest(fence):
            stack.close_from(depth)
        node = page.open(tag, stack.top, attributes)
        if not attributes.endswith("/"):
            stack.push(node, tag)
    take(source[at:])
    flush()
    return page


_NUMBERS = 22


def features(page: Page) -> np.ndarray:
    """A row of numbers for each node."""
    n = len(page.tags)
    parents = np.array(page.parents)
    own, stops, pieces = np.zeros(n), np.zeros(n), np.zeros(n)
    begins, before = np.full(n, -1.0), 0
    for node, text in page.texts:
        if begins[node] < 0:
            begins[node] = before
        before += len(text)
        own[node] += len(text)
        stops[node] += text.count(".") + text.count(",")
        pieces[node] += 1
    links, inputs = np.array(page.links, float), np.array(page.inputs, float)
    inline = np.array(page.inline, float)
    text, linked, marks, asks, ends = own.copy(), links.copy(), inline + 1, inputs.copy(), stops.copy()
    nodes, children, deep = np.ones(n), np.zeros(n), np.zeros(n)
    paragraphs = np.array([tag == "p" for tag in page.tags], float)
    up = page.parents
    for i in range(n - 1, 0, -1):
        p = up[i]
        for total in (text, linked, marks, asks, ends, nodes, paragraphs):
            total[p] += total[i]
        children[p] += 1
        if 0 <= begins[i] and (begins[p] < 0 or begins[i] < begins[p]):
            begins[p] = begins[i]
    masks, bits = [0] * n, _WORD_BITS + len(_TAGS)
    turn, seen, alike = np.zeros(n), np.zeros(n), np.zeros(n)
    same: dict[tuple[int, str], int] = {}
    for i in range(n):
        tag, p = page.tags[i], up[i]
        place = _TAG_PLACE.get(tag)
        masks[i] = page.words[i] << len(_TAGS) | (1 << place if place is not None else 0)
        if p >= 0:
            deep[i] = deep[p] + 1
            turn[i], seen[p] = seen[p], seen[p] + 1
            same[p, tag] = same.get((p, tag), 0) + 1
    for i in range(1, n):
        alike[i] = same[up[i], page.tags[i]]
    width = (bits + 7) // 8
    mine = np.frombuffer(b"".join(m.to_bytes(width, "little") for m in masks), "u1")
    for i in range(1, n):
        masks[i] |= masks[up[i]]
    above = np.frombuffer(b"".join(m.to_bytes(width, "little") for m in masks), "u1")
    unpacked = [
        np.unpackbits(x.reshape(n, width), axis=1, bitorder="little")[:, :bits]
        for x in (mine, above)
    ]
    whole = max(before, 1)
    around = np.maximum(parents, 0)
    siblings = np.maximum(children[around], 1)
    numbers = [
        np.log1p(own),
        np.log1p(text),
        text / marks,
        linked / np.maximum(text, 1),
        links / np.maximum(own, 1),
        ends / np.maximum(text, 1),
        text / whole,
        np.log1p(nodes),
        children,
        paragraphs / nodes,
        paragraphs,
        deep,
        turn,
        turn / siblings,
        siblings,
        alike / siblings,
        np.log1p(text[around] / siblings),
        text / np.maximum(text[around], 1),
        linked[around] / np.maximum(text[around], 1),
        asks,
        asks[around],
        np.where(begins < 0, 1, begins / whole),
    ]
    return np.column_stack([*numbers, *unpacked])


@dataclass
class Trees:
    """Boosted trees of full depth, as arrays; values are put into bins first."""

    edges: list[np.ndarray]
    base: float
    features: np.ndarray  # rounds x inner nodes
    limits: np.ndarray
    leaves: np.ndarray  # rounds x leaves

    def bins(self, rows: np.ndarray) -> np.ndarray:
        cols = [np.searchsorted(e, rows[:, i], "left") for i, e in enumerate(self.edges)]
        return np.column_stack(cols).astype("u1")

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """The logarithm of the odds, of each row."""
        bins, total = self.bins(rows), np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for names, limits, leaves in zip(self.features, self.limits, self.leaves, strict=True):
            at = np.zeros(len(rows), "i8")
            for _ in range(DEPTH):
                at = 2 * at + 1 + (bins[every, names[at]] > limits[at])
            total += leaves[at - (2**DEPTH - 1)]
        return total


def boost(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Trees:
    """Trees for the logistic loss, each grown level by level on histograms."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(rows[:, i], quantiles)) for i in range(rows.shape[1])]
    share = float(np.clip(np.average(labels, weights=weights), 0.01, 0.99))
    inner, width = 2**DEPTH - 1, rows.shape[1]
    trees = Trees(
        edges,
        float(np.log(share / (1 - share))),
        np.zeros((ROUNDS, inner), "i8"),
        np.full((ROUNDS, inner), 255, "u1"),
        np.zeros((ROUNDS, inner + 1)),
    )
    bins = trees.bins(rows)
    cells = bins + np.arange(width) * BINS
    odds = np.full(len(rows), trees.base)
    for turn in range(ROUNDS):
        chance = 1 / (1 + np.exp(-odds))
        slope, bend = weights * (chance - labels), weights * chance * (1 - chance)
        at = np.zeros(len(rows), "i8")
        for level in range(DEPTH):
            first = 2**level - 1
            size = width * BINS
            where = ((at - first)[:, None] * size + cells).ravel()
            g, h = (
                np.bincount(where, np.repeat(v, width), size << level)
                .reshape(1 << level, width, BINS)
                .cumsum(2)
                for v in (slope, bend)
            )
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
            flat = gain.reshape(1 << level, -1)
            best = flat.argmax(1)
            good = flat[np.arange(1 << level), best] > 1e-3
            here = slice(first, first + (1 << level))
            trees.features[turn, here] = np.where(good, best // BINS, 0)
            trees.limits[turn, here] = np.where(good, best % BINS, 255)
            right = bins[np.arange(len(bins)), trees.features[turn][at]] > trees.limits[turn][at]
            at = 2 * at + 1 + right
        leaf = at - inner
        g, h = (np.bincount(leaf, v, inner + 1) for v in (slope, bend))
        trees.leaves[turn] = -RATE * g / (h + 1)
        odds += trees.leaves[turn][leaf]
    return trees


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """Which nodes are kept: the likeliest choice of all in which nothing inside a dropped
    node is kept. A node counts by the length of its own text."""
    n, up = len(page.tags), page.parents
    size = [0.0] * n
    for node, text in page.texts:
        size[node] += len(text)
    gain = [s * float(np.clip(o, -6, 6)) for s, o in zip(size, odds, strict=True)]
    dropped = [-g for g in gain]  # of the whole subtree
    kept = gain[:]  # with the best choice inside
    for i in range(n - 1, 0, -1):
        dropped[up[i]] += dropped[i]
        kept[up[i]] += max(kept[i], dropped[i])
    keep = [True] * n
    for i in range(n):
        keep[i] = (i == 0 or keep[up[i]]) and kept[i] >= dropped[i]
    return keep


def main_text(page: Page, odds: np.ndarray) -> str:
    keep = decode(page, odds)
    return " ".join(text for node, text in page.texts if keep[node])


# What the trees learn from


_ASIDE = frozenset("nav aside footer header form button menu".split())


def teacher(page: Page) -> np.ndarray | None:
    """Labels from ``data-main``, else from ``article`` and ``main``; None without any."""
    labels = np.zeros(len(page.tags), bool)
    marked = any(m is not None for m in page.main)
    for i, (tag, parent) in enumerate(zip(page.tags, page.parents, strict=True)):
        labels[i] = parent >= 0 and labels[parent]
        if page.main[i] is not None:
            labels[i] = page.main[i]
        elif not marked and tag in ("article", "main"):
            labels[i] = True
        elif not marked and tag in _ASIDE:
            labels[i] = False
    return labels if labels.any() else None


_MAIN_NAMES = (
    "content article-body post-content entry-content story body-text main-content text page-content "
    "post entry article maincontent storybody copy prose"
).split()
_SIDE_NAMES = {
    "menu": "menu nav navbar topnav navigation breadcrumb breadcrumbs links toc pagination pager",
    "head": "header masthead topbar banner site-header logo branding tagline skip",
    "foot": "footer site-footer copyright legal bottom colophon imprint",
    "side": "sidebar aside widget related recommended popular trending teaser more-stories tags rail",
    "note": "cookie consent notice alert popup modal overlay gdpr privacy message warning disclaimer",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner-ad commercial adbox",
    "form": "form newsletter subscribe signup login search contact subscription",
    "talk": "comments comment replies reply discussion responses feedback disqus reader-comments",
    "share": "share social follow toolbar buttons author-bio byline meta",
}


class _Layouts:
    """Pages with known main text, from given sentences."""

    def __init__(self, lines: list[str], seed: int = 0):
        self.rng = np.random.default_rng(seed)
        self.lines = lines or ["Some words of a sentence, and a few more."]

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def line(self, most: int = 400) -> str:
        text = self.pick(self.lines)
        begin = int(self.rng.integers(max(1, len(text) - 20)))
        return html.escape(text[begin : begin + int(self.rng.integers(3, most))], quote=False)

    def many(self, make, low: int, high: int) -> str:
        return "".join(make() for _ in range(int(self.rng.integers(low, high))))

    def named(self, tag: str, names: list[str], main: bool, inner: str) -> str:
        name = self.pick(names)
        where = self.pick(["class", "class", "id"])
        extra = self.pick(["", "", " clearfix", " col", " block"]) if where == "class" else ""
        return f'<{tag} {where}="{name}{extra}" data-main="{int(main)}">{inner}</{tag}>'

    def links(self) -> str:
        one = lambda: f'<li><a href="/x">{self.line(25)}</a></li>'
        plain = lambda: f'<a href="/x">{self.line(25)}</a> '
        return self.pick([f"<ul>{self.many(one, 2, 9)}</ul>", self.many(plain, 2, 9)])

    def prose(self, low: int, high: int) -> str:
        whole = lambda: f"<p>{self.line(self.pick([40, 300, 1500]))}</p>"
        return self.many(whole, low, high)

    def side(self, kind: str) -> str:
        text, names = self.line(200), _SIDE_NAMES[kind].split()
        if kind in ("menu", "side", "share"):
            inner = self.pick([self.links(), self.links(), f"<h3>{self.line(30)}</h3>{self.links()}"])
            if kind == "side":
                inner += self.pick(["", self.prose(1, 3)])
        elif kind == "form":
            inner = f'<p>{text}</p><input type="text"><input type="submit"><label>{self.line(20)}</label>'
        elif kind == "talk":
            said = lambda: f"<li><b>{self.line(15)}</b><p>{self.line()}</p></li>"
            inner = f"<h3>{self.line(20)}</h3><ul>{self.many(said, 1, 5)}</ul>"
            inner = self.pick([inner, self.many(lambda: f"<div><p>{self.line()}</p></div>", 1, 5)])
        else:
            inner = self.pick([text, f"<p>{text}</p>", self.prose(1, 4), f"{text} {self.links()}"])
        tags = {"menu": ["nav", "div", "ul"], "head": ["header", "div"], "foot": ["footer", "div"],
                "side": ["aside", "div", "section"], "form": ["form", "form", "div"]}
        tag = self.pick(tags.get(kind, ["div", "div", "section", "p" if "<" not in inner else "div"]))
        if tag in ("nav", "header", "footer", "aside", "form") and self.rng.random() < 0.4:
            return f'<{tag} data-main="0">{inner}</{tag}>'
        return self.named(tag, names, False, inner)

    def page(self) -> str:
        body = f"<h1>{self.line(80)}</h1>{self.prose(1, 8)}"
        for piece in ("<h2>{}</h2>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>"):
            if self.rng.random() < 0.3:
                body += piece.format(self.line(150)) + self.prose(0, 4)
        for kind in ("ad", "share", "side", "form"):
            if self.rng.random() < 0.2:
                body += self.side(kind) + self.prose(0, 3)
        tag = self.pick(["article", "main", "div", "div", "div", "section"])
        if tag in ("article", "main") and self.rng.random() < 0.6:
            body = f'<{tag} data-main="1">{body}</{tag}>'
        else:
            body = self.named(tag, _MAIN_NAMES, True, body)
        kinds = list(_SIDE_NAMES)
        before = [self.side(k) for k in kinds if k not in ("talk", "foot") and self.rng.random() < 0.4]
        after = [self.side(k) for k in kinds if k not in ("head",) and self.rng.random() < 0.4]
        middle = "".join([*before, body, *after])
        if self.rng.random() < 0.4:
            middle = f'<div class="{self.pick(["wrapper", "container", "page", "site"])}">{middle}</div>'
        return f"<html><body>{middle}</body></html>"


def fit(pages: list[str], seed: int = 0) -> Trees:
    """Trees from the pages that mark their article, and from layouts of their sentences."""
    rows, labels, weights, lines = [], [], [], []

    def learn(page: Page) -> None:
        marks = teacher(page)
        if marks is not None:
            rows.append(features(page))
            labels.append(marks)
            length = np.zeros(len(page.tags))
            for node, text in page.texts:
                length[node] += len(text)
            weights.append(np.log1p(length) / 5 + 0.05)

    for source in sorted(pages):
        page = parse(source)
        lines += [text for _, text in page.texts if len(text) > 20]
        learn(page)
    layouts = _Layouts(lines, seed)
    for _ in range(LAYOUTS):
        learn(parse(layouts.page()))
    return boost(np.concatenate(rows), np.concatenate(labels), np.concatenate(weights))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pickle

    pages = [text or "" for batch in batches for text in batch.column(0).to_pylist()]
    t = fit(pages)
    raw = pickle.dumps((t.edges, t.base, t.features, t.limits, t.leaves))
    yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["trees"])


def fit_pages(pages: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fitted on about ``sample`` of the pages, those with the smallest hashes of their html,
    in one task. Copies of a page count once."""
    import pickle

    texts = pages.select(pages["html"].alias("html")).filter(F.col("html").isNotNull())
    total = texts.count()
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 32)) / float(1 << 32)
    picked = texts.filter(place * total < sample).distinct().repartition(1)
    found = picked.mapInArrow(_fit, "trees binary").first()
    return Trees(*pickle.loads(found[0])) if found else fit([])


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: Trees = unpack(shared)
        for batch in (part for whole in batches for part in slices(whole, 64)):
            pages = [parse(source or "") for source in batch.column("_html").to_pylist()]
            odds = trees.odds(np.concatenate([features(page) for page in pages]))
            cuts = np.cumsum([len(page.tags) for page in pages])[:-1]
            texts = list(map(main_text, pages, np.split(odds, cuts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(texts, pa.string())], ["_row", "text"]
            )

    return tidy(run)


def extract(pages: DataFrame, trees: Trees) -> DataFrame:
    """``_row`` (the columns of ``pages`` but ``html``) and ``text``: the whole main text,
    blocks in page order joined by one space, white space in them likewise, character
    references decoded. Null and empty pages, and those that have nothing but boilerplate,
    give an empty text. Rows may repeat."""
    others = [pages[name] for name in pages.columns if name != "html"]
    rows = pages.select(
        F.struct(*others).alias("_row") if others else F.lit(None).cast("int").alias("_row"),
        pages["html"].alias("_html"),
    )
    kind = rows.schema["_row"].dataType
    schema = T.StructType([T.StructField("_row", kind), T.StructField("text", T.StringType())])
    return rows.mapInArrow(_extract(ship(pages.sparkSession.sparkContext, trees)), schema)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    found = extract(pages.select("page_id", "url", "html"), fit_pages(pages))
    return found.select(
        "_row.page_id", "_row.url", "text", F.length("text").cast("long").alias("n_chars")
    )
