"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf texts in order, each with the tags (and class or id words) it
lies under.  Every leaf becomes a vector: hashed tag path, hashed words, and a few
measures such as length, link share and place.  A bidirectional LSTM in numpy reads the
whole sequence and labels every leaf as main text or not, so a leaf is judged by what
stands before and after it on the page.  The weights in ``block_labeller.npz`` come from
``train_blocks.py``, which trains on generated pages.

Defined results for odd input: a null or blank html gives an empty text; markup without
any main text likewise; broken markup is read as far as it goes; a null url or id is kept;
repeated rows each get their row; an empty table gives an empty result; further columns
are ignored.  A page is read in one pass however broken or deep its markup, and a very long one is labelled
piece by piece with the states of the network carried on; a leaf at exactly the threshold is main text.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

PATH_DIM, WORD_DIM, MEASURES = 96, 64, 8
DIM = PATH_DIM + WORD_DIM + MEASURES
HIDDEN = 24
#: Pages read at once.
READ_BYTES, READ_PAGES = 1 << 22, 256
WEIGHTS = Path(__file__).with_name("block_labeller.npz")

#: Fixed values of the HTML standard, as far as needed.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr"
    # Formulas and drawings, and what stands in place of media, are text of their block.
    " math semantics annotation mrow mi mn mo ms mtext mfrac msqrt mroot msub msup msubsup munder mover munderover"
    " svg g text tspan object canvas audio video picture slot meter progress output".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page: scripts, styles, and markup that is not shown.
SILENT = frozenset("script style template iframe head title".split())
RAW = frozenset("script style template iframe title textarea".split())
#: What a head may hold; any other tag ends it.
HEAD = frozenset("head html title meta link base style script template noscript".split())
#: A start tag closes an open element of these kinds, up to the nearest element that holds it.
CLOSES = {
    "p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
    **{t: ("p",) for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()},
}
HOLDS = frozenset("ul ol dl table div article section body html main aside nav header footer form td th blockquote".split())

_OPEN = re.compile(r"<(?:!--|(/?)([a-zA-Z][a-zA-Z0-9:-]*+)|[!?/])")
_STOP = re.compile(r"[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_SPACE = re.compile(r"\s+")


class Open:
    """An open element: what its path adds up to, so that a leaf need not walk it."""

    __slots__ = ("tag", "parent", "mask", "length", "last")

    def __init__(self, tag: str, names: tuple, parent: Open | None):
        self.tag, self.parent = tag, parent
        self.mask, self.length, self.last = (parent.mask, parent.length, parent.last) if parent else (0, 0, "")
        if tag not in INLINE:
            for x in (tag, *names):
                self.mask |= 1 << _slot("<" + x, PATH_DIM)
                self.length += 1
                self.last = x

    def within(self, tag: str) -> bool:
        at: Open | None = self
        while at and at.tag != tag:
            at = at.parent
        return at is not None


class Leaf:
    """``at``: the innermost element around it, None outside all."""

    __slots__ = ("text", "at", "linked")

    def __init__(self, text: str, at: Open | None, linked: int):
        self.text, self.at, self.linked = text, at, linked


class Tags:
    """Finds the tags of a page in one pass: no character is looked at again and again, however broken
    the markup is.  A tag ends at the first ``>`` outside quotes, or, if quotes stay open, at the first one."""

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        #: Opening quotes from which no end of a tag can be reached.
        self.dead: set[int] = set()

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose name ends at ``at``, or -1."""
        if at > self.last:
            return -1
        pos, passed = at, []
        while m := _STOP.search(self.html, pos):
            i = m.start()
            if m[0] == ">":
                return i
            if i in self.dead:
                break
            passed.append(i)
            pos = self.html.find(m[0], i + 1) + 1
            if not pos:
                break
        self.dead.update(passed)
        return self.html.find(">", at)

    def next(self, at: int) -> tuple[int, int, bool, str, str]:
        """Start, end, whether it closes, name and attributes of the next tag; name "" for comments
        and the like.  The page's end, if there is none."""
        html, n = self.html, len(self.html)
        while m := _OPEN.search(html, at):
            if html.startswith("<!--", m.start()):
                end = html.find("-->", m.end())
                return m.start(), (end + 3 if end >= 0 else n), False, "", ""
            if m[2] is None:
                end = html.find(">", m.end()) if m.end() <= self.last else -1
                if end >= 0:
                    return m.start(), end + 1, False, "", ""
            elif (end := self._end(m.end())) >= 0:
                return m.start(), end + 1, bool(m[1]), m[2].lower(), html[m.end() : end]
            elif m.end() > self.last:
                break
            at = m.end()
        return n, n, False, "", ""


def leaves(html: str | None) -> list[Leaf]:
    """Texts between block-level tags, in page order, with white space as single spaces."""
    html = html or ""
    tags, out = Tags(html), []
    stack: list[Open] = []
    #: Depths of the open elements of each tag, of those that hold others, and of those not inline.
    depths: dict[str, list[int]] = defaultdict(list)
    holds: list[int] = []
    outer: list[int] = []
    parts: list[str] = []
    linked = silent = at = 0

    def end_leaf() -> None:
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", html_lib.unescape("".join(parts))).strip()
            if text:
                out.append(Leaf(text, stack[-1] if stack else None, min(linked, len(text))))
            parts, linked = [], 0

    def close(depth: int) -> None:
        nonlocal silent
        while len(stack) > depth:
            tag = stack.pop().tag
            depths[tag].pop()
            silent -= tag in SILENT
            if tag in HOLDS:
                holds.pop()
            if tag not in INLINE:
                outer.pop()

    while True:
        start, end, closing, tag, attributes = tags.next(at)
        text = html[at:start]
        if text and not silent:
            parts.append(text)
            if depths["a"]:
                linked += len(text)
        if start == len(html):
            break
        at = end
        if not tag:
            continue
        if tag not in INLINE:
            end_leaf()
        if closing:
            # The end of an inline element does not reach beyond its block.
            if depths[tag] and (tag not in INLINE or not outer or depths[tag][-1] > outer[-1]):
                close(depths[tag][-1])
            continue
        if tag not in HEAD and depths["head"]:
            close(depths["head"][-1])
        for old in CLOSES.get(tag, ()):
            if depths[old] and (not holds or depths[old][-1] >= holds[-1]):
                close(depths[old][-1])
        if tag in VOID or attributes.endswith("/"):
            continue
        names = tuple(w for found in _NAMES.findall(attributes) for w in re.split(r"[\s_-]+", "".join(found).lower()) if w) if attributes else ()
        depths[tag].append(len(stack))
        if tag in HOLDS:
            holds.append(len(stack))
        if tag not in INLINE:
            outer.append(len(stack))
        stack.append(Open(tag, names, stack[-1] if stack else None))
        silent += tag in SILENT
        if tag in RAW:
            found = _RAW_END[tag].search(html, at)
            if not silent:
                parts.append(html[at : found.start() if found else len(html)])
            at = found.start() if found else len(html)
    end_leaf()
    return out


# --- vectors ----------------------------------------------------------------------------


@lru_cache(maxsize=200_000)
def _slot(token: str, size: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % size


@lru_cache(maxsize=20_000)
def _path_slots(mask: int, last: str) -> tuple[int, ...]:
    mask |= 1 << _slot("<<" + last, PATH_DIM) if last else 0
    return tuple(i for i in range(PATH_DIM) if mask >> i & 1)


_ENDS = re.compile(r"[.!?…]")
#: Odd factors by place in a word, for word hashes over whole pages at once.
_PLACES = (np.arange(1, 257, dtype=np.uint32) * np.uint32(2654435761)) | np.uint32(1)


def word_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the counts of hashed words, and the number of words (texts without line feeds)."""
    data = np.frombuffer("\n".join(texts).lower().encode("utf-8", "surrogatepass"), np.uint8)
    space = data <= 32
    starts = np.flatnonzero(~space & np.r_[True, space[:-1]])
    if not len(starts):
        return np.zeros((len(texts), WORD_DIM)), np.zeros(len(texts), np.int64)
    begin = np.r_[np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.r_[starts, len(data)]))]
    places = np.arange(len(data)) - begin
    terms = np.where(space, np.uint32(0), data * _PLACES[places & 255])
    hashed = np.add.reduceat(terms, starts).astype(np.uint32)
    slots = ((hashed * np.uint32(2246822519)) >> np.uint32(32 - 6)).astype(np.int64)
    owner = np.cumsum(data == 10)[starts]
    counts = np.bincount(owner * WORD_DIM + slots, minlength=len(texts) * WORD_DIM).reshape(len(texts), WORD_DIM)
    return counts, counts.sum(1)


def vectors(page: list[Leaf], first: int = 0, end: int | None = None) -> np.ndarray:
    """Of the leaves of a page from ``first`` to ``end``."""
    some = page[first:end]
    out = np.zeros((len(some), DIM), np.float32)
    if not some:
        return out
    counts, sizes = word_counts([leaf.text for leaf in some])
    out[:, PATH_DIM : PATH_DIM + WORD_DIM] = counts / np.maximum(sizes, 1)[:, None]
    measures = np.zeros((len(some), MEASURES))
    for i, leaf in enumerate(some):
        mask, length, last = (leaf.at.mask, leaf.at.length, leaf.at.last) if leaf.at else (0, 0, "")
        out[i, list(_path_slots(mask, last))] = 1.0
        text, n = leaf.text, sizes[i]
        ends = len(_ENDS.findall(text))
        measures[i] = (n, leaf.linked / len(text), min(ends, 10) / 10, ends > 0, (first + i) / len(page), min(length, 20) / 20, n <= 3, len(page))
    measures[:, [0, 7]] = np.log1p(measures[:, [0, 7]]) / 5
    out[:, PATH_DIM + WORD_DIM :] = measures
    return out


# --- the network ------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, live: np.ndarray, state: list | None = None) -> np.ndarray:
    """Hidden states over (page, step, feature); ``live`` masks steps beyond a page's end.
    ``state``, if given, holds the two states to go on from, and gets those reached."""
    pages, steps, _ = x.shape
    h = state[0] if state else np.zeros((pages, HIDDEN), np.float32)
    c = state[1] if state else np.zeros_like(h)
    out = np.zeros((pages, steps, HIDDEN), np.float32)
    z_in = x @ w + b
    for t in range(steps):
        z = z_in[:, t] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        keep = live[:, t : t + 1]
        c = np.where(keep, f * c + i * g, c)
        h = np.where(keep, o * np.tanh(c), h)
        out[:, t] = h
    if state is not None:
        state[:] = [h, c]
    return out


def label_long(page: list[Leaf], weights: dict[str, np.ndarray], *, cells: int) -> np.ndarray:
    """As ``label`` for one page of any length: its vectors are made ``cells`` leaves at a time."""
    cuts = [(a, min(a + cells, len(page))) for a in range(0, len(page), cells)]
    live = np.ones((1, cells), bool)
    both = np.zeros((len(page), 2 * HIDDEN), np.float32)
    state: list = []
    for a, b in cuts:
        state = state or [np.zeros((1, HIDDEN), np.float32)] * 2
        both[a:b, :HIDDEN] = lstm(vectors(page, a, b)[None], weights["wf"], weights["uf"], weights["bf"], live, state)[0]
    state = [np.zeros((1, HIDDEN), np.float32)] * 2
    for a, b in reversed(cuts):
        both[a:b, HIDDEN:] = lstm(vectors(page, a, b)[None, ::-1], weights["wb"], weights["ub"], weights["bb"], live, state)[0, ::-1]
    return _sigmoid(both @ weights["v"] + weights["c"])


def label(pages: list[list[Leaf]], weights: dict[str, np.ndarray], *, cells: int = 60_000) -> list[np.ndarray]:
    """Probability of main text for every leaf; pages of like length run together."""
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and len(pages[order[end]]) * (end + 1 - at) <= cells:
            end += 1
        group = order[at:end]
        at = end
        steps = len(pages[group[-1]])
        if not steps:
            continue
        if steps > cells:
            out[group[0]] = label_long(pages[group[0]], weights, cells=cells)
            continue
        x = np.zeros((len(group), steps, DIM), np.float32)
        live = np.zeros((len(group), steps), bool)
        for k, i in enumerate(group):
            if pages[i]:
                x[k, : len(pages[i])] = vectors(pages[i])
                live[k, : len(pages[i])] = True
        forward = lstm(x, weights["wf"], weights["uf"], weights["bf"], live)
        backward = lstm(x[:, ::-1], weights["wb"], weights["ub"], weights["bb"], live[:, ::-1])[:, ::-1]
        p = _sigmoid(np.concatenate([forward, backward], 2) @ weights["v"] + weights["c"])
        for k, i in enumerate(group):
            out[i] = p[k, : len(pages[i])]
    return out


def load_weights(path: Path = WEIGHTS) -> dict[str, np.ndarray]:
    with np.load(path) as stored:
        return {k: stored[k].astype(np.float32) for k in stored.files}


def main_text(pages: list[str | None], weights: dict[str, np.ndarray], *, threshold: float = 0.5) -> list[str]:
    read = [leaves(p) for p in pages]
    return [
        " ".join(leaf.text for leaf, p in zip(page, found, strict=True) if p >= threshold)
        for page, found in zip(read, label(read, weights), strict=True)
    ]


def extract(pages: DataFrame, *, threshold: float = 0.5, weights: Path = WEIGHTS) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``)."""
    known = load_weights(weights)

    def run(batches):
        def done(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = main_text(part.column(2).to_pylist(), known, threshold=threshold)
            n = pa.array([len(t) for t in texts], pa.int64())
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), n], ["page_id", "url", "text", "n_chars"])

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            first, held = 0, 0
            for i, size in enumerate(sizes):
                if i > first and (held + size > READ_BYTES or i - first >= READ_PAGES):
                    yield done(batch.slice(first, i - first))
                    first, held = i, 0
                held += size
            yield done(batch.slice(first))

    columns = [F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")]
    return pages.select(*columns).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op6_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(read_table(spark, sf_dir, "pages"))
