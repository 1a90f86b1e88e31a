"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into blocks of text between block-level tags. Each block has features of its
ancestors (tags, and words of their class, id and role) and of its text; a chain of two states,
main text or not, has a weight for each feature and for each pair of neighbouring states.
Weights are fitted on labelled pages; the best sequence of states is found by Viterbi.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
# HTML's elements by the way they are parsed.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("script style title noscript template svg iframe object textarea select head math canvas audio video".split())
RAW = frozenset("script style title textarea iframe noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
CLOSED_BY_NEXT = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
STOPS = frozenset("ul ol dl table article section div body".split())

# The markup of labelled pages: what main text and everything else usually stands in.
MAIN_TAGS = frozenset({"article", "main"})
MAIN_MARKUP = (
    ("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "entry-content"),
    ("section", "story"), ("div", "main"), ("div", "post"), ("div", "text"), ("div", ""),
)
OTHER_MARKUP = (
    ("nav", ""), ("div", "menu"), ("div", "nav"), ("ul", "navigation"), ("div", "breadcrumb"), ("header", ""),
    ("div", "header"), ("footer", ""), ("div", "footer"), ("aside", ""), ("div", "sidebar"), ("div", "widget"),
    ("div", "ad"), ("div", "advert"), ("div", "advertisement"), ("div", "banner"), ("div", "promo"), ("div", "sponsored"),
    ("section", "comments"), ("div", "comment"), ("ol", "comment-list"), ("div", "reader-comments"), ("div", "replies"),
    ("form", ""), ("form", "search"), ("div", "newsletter"), ("div", "signup"), ("div", "subscribe"), ("div", "login"),
    ("div", "cookie"), ("div", "consent"), ("div", "notice"), ("div", "alert"), ("div", "popup"), ("div", "modal"),
    ("dialog", ""), ("div", "related"), ("div", "share"), ("div", "social"), ("div", "pagination"), ("div", "toolbar"),
    ("div", "copyright"), ("div", "hidden"), ("div", "disclaimer"), ("div", "discussion"), ("div", "tags"),
)
OTHER_TAGS = frozenset("nav header footer aside form dialog button menu".split())


def name_words(value: str) -> list[str]:
    """The words of a class, id or role, without a plural s."""
    words = [w.lower() for w in NAME_PART.findall(value)]
    return [w[:-1] if len(w) > 3 and w.endswith("s") and not w.endswith("ss") else w for w in words]


OTHER_WORDS = frozenset(w for _, names in OTHER_MARKUP for w in name_words(names)) - {"list", "reader"}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # features of the ancestors, outermost first
    linked: int  # characters inside links


@dataclass
class _Parser:
    blocks: list[Block] = field(default_factory=list)
    stack: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    unseen: int = 0
    links: int = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, tuple(f for _, fs in self.stack for f in fs), self.linked))
            self.parts.clear()
        self.linked = 0

    def text(self, text: str) -> None:
        if not self.unseen and text:
            # A reference ends where its piece of text does; tags inside one do not join it.
            self.parts.append(html.unescape(text))
            if self.links:
                self.linked += len(text)

    def pop(self, down_to: int) -> None:
        for tag, _ in self.stack[down_to:]:
            self.unseen -= tag in UNSEEN
            self.links -= tag == "a"
        del self.stack[down_to:]

    def open(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag in ("img", "wbr", "input"):
            self.text(" " if tag == "br" else "")
            return
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            over = self.stack[i][0]
            if over in CLOSED_BY_NEXT.get(tag, ()) or (over == "p" and tag in CLOSES_P):
                self.pop(i)
                break
            if over in STOPS:
                break
        if tag == "body" and self.unseen and self.stack and any(t == "head" for t, _ in self.stack):
            self.pop(next(i for i, (t, _) in enumerate(self.stack) if t == "head"))
        self.stack.append((tag, _features_of(tag, attributes) if tag not in INLINE else ()))
        self.unseen += tag in UNSEEN
        self.links += tag == "a"

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.pop(i)
                return


_FEATURES: dict[tuple[str, str], tuple[str, ...]] = {}


def _features_of(tag: str, attributes: str) -> tuple[str, ...]:
    if (tag, attributes) not in _FEATURES:
        found = [f"tag:{tag}"]
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role"):
                found += [f"name:{w}" for w in name_words(value)]
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                found.append("name:hidden")
        if len(_FEATURES) > 100_000:
            _FEATURES.clear()
        _FEATURES[tag, attributes] = tuple(found)
    return _FEATURES[tag, attributes]


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order. A tag or comment that the page's end cuts off is not text."""
    parser, at = _Parser(), 0
    while True:
        match = TOKEN.search(page, at)
        if not match:
            break
        parser.text(page[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if match[1] or match[4]:
            parser.close(tag)
            continue
        attributes = match[3] if match[2] else match[6]
        parser.open(tag, attributes)
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
    parser.text(page[at:])
    parser.flush()
    return parser.blocks


def text_features(block: Block) -> list[str]:
    words = block.text.count(" ") + 1
    size = "1-2" if words < 3 else "3-6" if words < 7 else "7-15" if words < 16 else "16+"
    share = block.linked / len(block.text)
    found = [f"words:{size}", f"links:{'none' if not share else 'some' if share < 0.6 else 'all'}"]
    if block.text[-1] in ".!?:;\"'”»":
        found.append("ends")
    if "©" in block.text:
        found.append("copyright")
    return found


@dataclass
class ChainModel:
    weights: dict[str, float]  # for main text against the rest
    steps: np.ndarray  # [state before, state]; 1 is main text
    start: np.ndarray
    _paths: dict[tuple[str, ...], float] = field(default_factory=dict, repr=False)

    def score(self, block: Block) -> float:
        path = self._paths.get(block.path)
        if path is None:
            if len(self._paths) > 100_000:
                self._paths.clear()
            path = sum(self.weights.get(f, 0.0) for f in {*block.path, _leaf(block)})
            self._paths[block.path] = path
        return path + sum(self.weights.get(f, 0.0) for f in text_features(block))

    def label(self, blocks: list[Block]) -> list[bool]:
        """The most likely states (Viterbi)."""
        (other, main), came = self.start.tolist(), []
        (oo, om), (mo, mm) = self.steps.tolist()
        for i, block in enumerate(blocks):
            if i:
                came.append((main + mo > other + oo, main + mm > other + om))
                other, main = max(other + oo, main + mo), max(other + om, main + mm)
            main += self.score(block)
        state, out = main > other, []
        for back in reversed([(False, False), *came][: len(blocks)]):
            out.append(state)
            state = back[state]
        return out[::-1]

    def main_text(self, page: str) -> str:
        blocks = blocks_of(page)
        return " ".join(b.text for b, keep in zip(blocks, self.label(blocks), strict=True) if keep)


def _leaf(block: Block) -> str:
    return "leaf:" + next((f for f in reversed(block.path) if f.startswith("tag:")), "none")


def label_by_markup(blocks: list[Block]) -> list[bool]:
    """Labels of a page that says by its markup what is what: inside an article, and in nothing else."""
    out = []
    for block in blocks:
        inside = any(f"tag:{t}" in block.path for t in MAIN_TAGS)
        other = any(f"tag:{t}" in block.path for t in OTHER_TAGS) or any(f"name:{w}" in block.path for w in OTHER_WORDS)
        out.append(inside and not other)
    return out


def varied_page(main: list[str], other: list[str], prose: list[str], rng: random.Random) -> tuple[list[Block], list[bool]]:
    """The same texts in other markup, labelled: main text plain or nested, the rest around and inside.

    Text in other places is often prose as well (a comment reads like an article), so markup
    counts most.
    """
    shell = ("tag:html", "tag:body", *(("tag:div",) if rng.random() < 0.5 else ()))
    tag, names = rng.choice(MAIN_MARKUP)
    home = (*shell, f"tag:{tag}", *(f"name:{w}" for w in name_words(names)))
    blocks: list[Block] = []
    labels: list[bool] = []

    def add_other(base: tuple[str, ...]) -> None:
        tag, names = rng.choice(OTHER_MARKUP)
        path = (*base, f"tag:{tag}", *(f"name:{w}" for w in name_words(names)))
        inner = rng.choice(("tag:p", "tag:li", "tag:div", "tag:h3", "tag:h2", "tag:h1", "", "", ""))
        for _ in range(rng.choice((1, 1, 1, 2, 3, 4))):
            text = rng.choice(prose if rng.random() < 0.5 else other)
            linked = len(text) if rng.random() < (0.6 if len(text) < 40 else 0.1) else 0
            blocks.append(Block(text, (*path, inner) if inner else path, linked))
            labels.append(False)

    bare = rng.random() < 0.12  # a page of nothing but its article
    if bare:
        home = rng.choice((home, shell, ()))
    for _ in range(0 if bare else rng.randint(1, 4)):
        add_other(shell)
    for i, text in enumerate(main):
        if i and not bare and rng.random() < 0.15:
            add_other(home)
        leaf = "tag:h1" if not i and not bare else rng.choice(("tag:p",) * 8 + ("tag:h2", "tag:li", "tag:blockquote", "tag:td", "tag:div", "tag:pre", "tag:figcaption"))
        nested = ("tag:div",) if rng.random() < 0.2 else ()
        blocks.append(Block(text, (*home, *nested, leaf), len(text) // 5 if rng.random() < 0.1 else 0))
        labels.append(True)
    if not bare and rng.random() < 0.4:
        add_other(home)
    for _ in range(0 if bare else rng.randint(1, 4)):
        add_other(shell)
    return blocks, labels


def train(pages: list[tuple[list[Block], list[bool]]], *, l2: float = 3e-4, rounds: int = 300) -> ChainModel:
    """Maximise the penalised likelihood of the labels (forward-backward, Adam)."""
    pages = [page for page in pages if page[0]]
    rows = [[sorted({*b.path, _leaf(b), *text_features(b)}) for b in blocks] for blocks, _ in pages]
    names = {f: i for i, f in enumerate(sorted({f for page in rows for fs in page for f in fs}))}
    n, longest = len(pages), max((len(p) for p in rows), default=0)
    if not n:
        return ChainModel({}, np.zeros((2, 2)), np.zeros(2))
    cols = np.array([names[f] for page in rows for fs in page for f in fs])
    flat = np.concatenate([np.arange(len(p)) + i * longest for i, p in enumerate(rows)])
    at = np.repeat(flat, [len(fs) for page in rows for fs in page])
    sizes = np.array([len(p) for p in rows])
    there = np.arange(longest) < sizes[:, None]
    gold = np.zeros((n, longest), int)
    gold[there] = [int(x) for _, labels in pages for x in labels]
    size = len(names)
    gold_main = gold[there].astype(float)
    gold_steps = np.zeros((2, 2))
    np.add.at(gold_steps, (gold[:, :-1][there[:, 1:]], gold[:, 1:][there[:, 1:]]), 1)
    gold_start = np.bincount(gold[:, 0], minlength=2).astype(float)
    theta = np.zeros(size + 6)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        unary = np.zeros((n, longest, 2))
        unary[:, :, 1] = np.bincount(at, theta[cols], n * longest).reshape(n, longest)
        steps, start = theta[size : size + 4].reshape(2, 2), theta[size + 4 :]
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = start + unary[:, 0]
        for i in range(1, longest):
            forward[:, i] = np.logaddexp.reduce(forward[:, i - 1, :, None] + steps, axis=1) + unary[:, i]
            forward[:, i][~there[:, i]] = forward[:, i - 1][~there[:, i]]
        for i in range(longest - 2, -1, -1):
            ahead = np.logaddexp.reduce(steps + (unary[:, i + 1] + backward[:, i + 1])[:, None, :], axis=2)
            backward[:, i] = np.where(there[:, i + 1, None], ahead, 0)
        total = np.logaddexp.reduce(forward[np.arange(n), sizes - 1], axis=1)
        state = np.exp(forward + backward - total[:, None, None])
        pair = np.exp(
            forward[:, :-1, :, None] + steps + (unary[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        main = state[:, :, 1][there] - gold_main
        per_block = np.zeros(n * longest)
        per_block[flat] = main
        grad = np.concatenate(
            [
                np.bincount(cols, per_block[at], size),
                (pair[there[:, 1:]].sum(axis=0) - gold_steps).ravel(),
                state[:, 0].sum(axis=0) - gold_start,
            ]
        ) / n + l2 * theta
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        rate = 0.1 / (1 + 4 * t / rounds)
        theta = theta - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in names.items()}
    return ChainModel(weights, theta[size : size + 4].reshape(2, 2), theta[size + 4 :])


def _marked(most_blocks: int):
    """Keep the pages with a main block by their own markup among their first most_blocks blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("html").to_pylist()
            yield batch.filter(pa.array([any(label_by_markup(blocks_of(p)[:most_blocks])) for p in pages], pa.bool_()))

    return run


def _training_pages(known: DataFrame, training_pages: int, most_blocks: int) -> list[str]:
    """Different pages with a main block, those with the least hashes; without any, different pages as they come.

    Copies are told by hash before whole pages are compared. Mostly the first few hashes are
    enough; if not, all pages are looked through, of which only hashes move.
    """
    hashed = known.withColumn("hash", F.xxhash64("html"))
    marked = lambda df: df.mapInArrow(_marked(most_blocks), df.schema)
    pages = lambda df: [r["html"] for r in df.orderBy("hash", "html").limit(training_pages).collect()]
    some = hashed.select("hash").distinct().orderBy("hash").limit(2 * training_pages)
    first = [r["hash"] for r in some.collect()]
    if not first:
        return []
    least = hashed.where(F.col("hash") <= max(first)).distinct()
    found = pages(marked(least))
    if len(found) < training_pages and len(first) == 2 * training_pages:
        every = marked(hashed).select("hash").distinct().orderBy("hash").limit(training_pages)
        with_main = [r["hash"] for r in every.collect()]
        found = pages(marked(hashed.where(F.col("hash").isin(with_main)).distinct())) if with_main else []
    return found or pages(least)


def fit(
    pages: DataFrame,
    *,
    training_pages: int = 200,
    longest_page: int = 100_000,
    most_blocks: int = 120,
    variants: int = 3,
    seed: int = 6,
    html_col: str = "html",
) -> ChainModel:
    """Fit on training_pages different pages at most, those with the least hashes of all that have a main block.

    Each is labelled by its own markup, and given again `variants` times in other markup with
    texts of other pages around it, cut to most_blocks blocks; of a longer page the first
    longest_page characters count. If no page has a main block, all training pages are in other
    markup, with the longer texts found as main text. Without any page the model knows nothing and
    keeps nothing.
    """
    html_text = F.left(pages[html_col].cast("string"), F.lit(longest_page))
    known = pages.select(html_text.alias("html")).where(F.length("html") > 0)
    sample = _training_pages(known, training_pages, most_blocks)
    rng, labelled, other, prose = random.Random(seed), [], ["Menu", "Home", "Search", "Share this page", "Log in"], []
    for page in sample:
        blocks = blocks_of(page)[:most_blocks]
        labels = label_by_markup(blocks)
        labelled.append((blocks, labels))
        other += [b.text for b, main in zip(blocks, labels, strict=True) if not main]
        prose += [b.text for b, main in zip(blocks, labels, strict=True) if main]
    mains = [[b.text for b, own in zip(blocks, labels, strict=True) if own] for blocks, labels in labelled]
    if not prose and len(other) > 5:
        texts = sorted(set(other[5:]), key=lambda t: (-len(t), t))
        prose = texts[: max(1, len(texts) // 2)]
        mains = [rng.choices(prose, k=rng.randint(2, 8)) for _ in range(training_pages)]
    for main in mains:
        for _ in range(variants if main else 0):
            labelled.append(varied_page(main, other, prose or other, rng))
    return train([(b, x) for b, x in labelled if any(x)])


def extract(
    pages: DataFrame, model: ChainModel, *, page_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars.

    Null and empty pages, and pages without a main block, have an empty text. Whole pages are
    parsed, whatever their length. Other columns are left out; rows that repeat stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.main_text(page or "") for page in batch.column("html").to_pylist()]
            arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            arrays.append(pa.array([len(t) for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    named = pages.select(
        pages[page_col].cast("long").alias("page_id"),
        pages[url_col].cast("string").alias("url"),
        pages[html_col].cast("string").alias("html"),
    )
    return named.mapInArrow(run, "page_id long, url string, text string, n_chars long")
