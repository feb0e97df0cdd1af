"""Main text of web pages: every leaf block is classified by a bidirectional LSTM over the page's blocks.

A page is cut into blocks, runs of text that no block-level tag interrupts. A block is described by hashed vectors of
its tag path (tags, classes, ids) and of all its words and by a few sizes. One LSTM reads the blocks forwards, one
backwards, and a logistic layer over both states says for each block whether it belongs to the article. The network is
trained here, on a bounded sample of pages: their own landmarks (article, nav, footer, ...) give the labels, and
copies with other layouts and with planted boilerplate (sidebars, notices, forms, reader comments, ...) teach what the
sample lacks.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.batches import texts_of

#: Pages the network is trained on, at most (those with the least hashes of their ids); blocks of each used for it.
SAMPLE, SAMPLE_BLOCKS = 150, 80
PATH_SIZE, WORD_SIZE, HIDDEN = 96, 24, 16
#: Pages of like length that go through the network together.
GROUP = 128

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
#: What may stand in a head; any other opening tag, or text, ends it.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes".split())
#: Opening tags that end an svg left open, as browsers do; not inside foreignObject.
_ENDS_SVG = frozenset(
    "article aside blockquote body center dd div dl dt embed footer form h1 h2 h3 h4 h5 h6 head header hr li main menu nav ol p "
    "pre section table ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the key ends an open element of these names.
_ENDS = {
    "li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
} | dict.fromkeys(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section "
    "table ul".split(), {"p"},
)
_SCOPES = frozenset("article aside body button div fieldset footer form header html main nav section table td th ul ol dl".split())
_RAW = frozenset("script style noscript template textarea title iframe annotation annotation-xml".split())
#: A tag without a "<" of its own, as nearly all are; it gives up at the next one.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+)>")
_NAME_END, _MARK, _LETTER = re.compile(r"[\s/>]"), re.compile(r"[>\"']"), re.compile("[a-zA-Z]")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PART = re.compile(r"[a-z]+")


class _Ahead:
    """The first place of a pattern from a place on, which only moves ahead: each stretch is searched once."""

    def __init__(self, pattern: re.Pattern[str], page: str):
        self.pattern, self.page, self.found = pattern, page, -1

    def at(self, place: int) -> int:
        if self.found < place:
            m = self.pattern.search(self.page, place)
            self.found = m.start() if m else len(self.page)
        return self.found


class Token(NamedTuple):
    """Markup from ``start`` to ``end``; comments and declarations have no tag, ``raw`` elements come with their content."""

    start: int
    end: int
    tag: str = ""
    closing: bool = False
    rest: str = ""
    raw: bool = False


def tokens_of(page: str) -> Iterator[Token]:
    """Comments, declarations, raw elements and tags in order, in time in proportion to the page.

    A tag ends at the first ``>`` outside quotes. One that never does is text, and so is all that a quote swallows: the
    opening quotes that lead to the end of the page are remembered, so that no later tag follows them again.
    """
    size = len(page)
    ends, marks, names = (_Ahead(x, page) for x in (re.compile(">"), _MARK, _NAME_END))
    closers: dict[str, re.Pattern[str]] = {}
    lost: set[int] = set()

    def tag_end(place: int) -> int:
        """The place of the ``>`` that ends a tag whose attributes begin here, or -1."""
        walked, mark = [], marks.at(place)
        while mark < size and page[mark] != ">" and mark not in lost:
            walked.append(mark)
            shut = page.find(page[mark], mark + 1)
            m = _MARK.search(page, shut + 1) if shut >= 0 else None
            mark = m.start() if m else size
        if mark < size and page[mark] == ">":
            return mark
        lost.update(walked)
        return -1

    at = page.find("<")
    while at >= 0:
        token, sign = None, page[at + 1 : at + 2]
        plain = _TAG.match(page, at)
        if plain and ((name := plain[2].lower()) not in _RAW or plain[1]):
            token = Token(at, plain.end(), name, bool(plain[1]), plain[3])
        elif page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            token = Token(at, end + 3 if end >= 0 else size)
        elif sign in ("!", "?"):
            end = ends.at(at + 2)
            token = Token(at, end + 1) if end < size else None
        elif sign:
            first = at + 1 + (sign == "/")
            if _LETTER.match(page, first) and (stop := names.at(first)) < size:
                name = page[first:stop].lower()
                if name in _RAW and sign != "/" and (end := ends.at(stop)) < size:
                    if name not in closers:
                        closers[name] = re.compile(rf"</{name}\s*+>", re.I)
                    m = closers[name].search(page, end + 1)
                    token = Token(at, m.end() if m else size, raw=True)
                elif (end := tag_end(stop)) >= 0:
                    token = Token(at, end + 1, name, sign == "/", page[stop:end])
        if token:
            yield token
        at = page.find("<", token.end if token else at + 1)


class _Open:
    """The open elements: where each name stands, and the distinct parts of the path."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.places: dict[str, list[int]] = {}
        self.parts: Counter[str] = Counter()
        self.known: tuple[str, ...] | None = ()

    def path(self) -> tuple[str, ...]:
        if self.known is None:
            self.known = tuple(self.parts)
        return self.known

    def _last(self, names: Iterable[str]) -> int:
        return max((self.places[x][-1] for x in names if self.places.get(x)), default=-1)

    def push(self, tag: str, parts: tuple[str, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, parts))
        for x in parts:
            if x not in self.parts:
                self.known = None
            self.parts[x] += 1

    def close(self, names: set[str], stop: frozenset[str]) -> None:
        """End the last element of these names, and all in it, unless one to stop at stands after it."""
        first = self._last(names)
        if first < 0 or (first < len(self.stack) - 1 and self._last(stop) > first):
            return
        while len(self.stack) > first:
            tag, parts = self.stack.pop()
            self.places[tag].pop()
            for x in parts:
                self.parts[x] -= 1
                if not self.parts[x]:
                    del self.parts[x]
                    self.known = None


@dataclass
class Block:
    """A run of text with the distinct parts of its tag path and the number of its characters inside links."""

    text: str
    path: tuple[str, ...]
    linked: int


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, without empty ones; scripts, styles, drawings and the like are none.

    Formulas are inline text. A head may lack its tags: it ends where something stands that may not stand in it.
    """
    out: list[Block] = []
    elements = _Open()
    buffer: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                out.append(Block(text, elements.path(), linked))
            buffer.clear()
        linked = 0

    at, in_head, svg, foreign = 0, False, 0, 0
    for token in chain(tokens_of(page), [None]):
        piece = page[at : token.start if token else len(page)]
        if in_head and piece.strip():
            in_head = False
        if piece and not in_head and not svg:
            buffer.append(piece)
            if elements.places.get("a"):
                linked += len(piece)
        if token is None:
            break
        at, tag = token.end, token.tag
        if not tag:
            if token.raw:
                buffer.append(" ")
            continue
        if svg and not token.closing and not foreign and tag in _ENDS_SVG:
            svg = 0
        if svg or tag == "svg":
            closed = token.rest.rstrip().endswith("/")
            step = 0 if closed and not token.closing else -1 if token.closing else 1
            if tag == "svg":
                svg = max(0, svg + step)
                buffer.append(" ")
            elif tag == "foreignobject":
                foreign = max(0, foreign + step)
            foreign = foreign if svg else 0
            in_head = False
            continue
        if tag == "head":
            in_head = not token.closing
        elif not token.closing and tag not in _IN_HEAD:
            in_head = False
        if tag == "br":
            buffer.append(" ")
        if tag not in _INLINE:
            flush()
        if token.closing:
            elements.close({tag}, frozenset() if tag in _SCOPES else _SCOPES)
        elif tag not in _VOID and not token.rest.rstrip().endswith("/"):
            if tag in _ENDS:
                elements.close(_ENDS[tag], _SCOPES - _ENDS[tag])
            names = [_PART.findall((a or b or c).lower()) for a, b, c in _NAMES.findall(token.rest)]
            elements.push(tag, (f"<{tag}>", *(x for n in names for x in n)))
    flush()
    return out


def _slot(text: str, size: int) -> int:
    return zlib.crc32(text.encode()) % size


class Describer:
    """Vectors of blocks; slots of path parts are remembered."""

    size = 2 * PATH_SIZE + WORD_SIZE + 8

    def __init__(self) -> None:
        self.slots: dict[tuple[str, ...], np.ndarray] = {}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        found = self.slots.get(path)
        if found is None:
            if len(self.slots) > 20_000:
                self.slots.clear()
            found = np.zeros(2 * PATH_SIZE)
            for x in path:
                found[_slot(x, PATH_SIZE)] = 1
                found[PATH_SIZE + _slot("2" + x, PATH_SIZE)] = 1
            self.slots[path] = found
        return found

    def rows(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), self.size))
        low = 2 * PATH_SIZE
        for i, b in enumerate(blocks):
            words = b.text.split()
            out[i, :low] = self._path(b.path)
            n = len(words)
            slots = [_slot(w.lower(), WORD_SIZE) for w in words]
            out[i, low : low + WORD_SIZE] = np.bincount(slots, minlength=WORD_SIZE) / max(1, n) ** 0.5
            out[i, low + WORD_SIZE :] = (
                min(n, 200) / 50, n < 4, min(b.linked / max(1, len(b.text)), 1), b.text[-1] in ".!?…",
                i < 3, i >= len(blocks) - 2, b.text[:1].isupper(), 1,
            )
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


Trace = list[tuple[np.ndarray, ...]]


@dataclass
class Direction:
    """An LSTM: gates (in, forget, out, new) from the block's vector and the state before it."""

    w: np.ndarray
    u: np.ndarray
    b: np.ndarray

    def run(self, x: np.ndarray, mask: np.ndarray, trace: Trace | None = None) -> np.ndarray:
        """States (pages, blocks, hidden); where the mask is 0 the state stays."""
        n, steps, _ = x.shape
        size = self.u.shape[0]
        gates = x @ self.w + self.b
        h = c = np.zeros((n, size))
        out = np.zeros((n, steps, size))
        for t in range(steps):
            z = gates[:, t] + h @ self.u
            ifo = _sigmoid(z[:, : 3 * size])
            i, f, o = ifo[:, :size], ifo[:, size : 2 * size], ifo[:, 2 * size :]
            g = np.tanh(z[:, 3 * size :])
            m = mask[:, t, None]
            new_c = m * (f * c + i * g) + (1 - m) * c
            tc = np.tanh(new_c)
            new_h = m * (o * tc) + (1 - m) * h
            if trace is not None:
                trace.append((h, c, i, f, o, g, tc, m))
            h, c = new_h, new_c
            out[:, t] = h
        return out

    def slopes(self, x: np.ndarray, trace: Trace, d_out: np.ndarray) -> tuple[np.ndarray, ...]:
        """Derivatives of the weights, given those of the states."""
        dz_all = np.zeros((*x.shape[:2], self.w.shape[1]))
        dh = dc = np.zeros((len(x), self.u.shape[0]))
        du = np.zeros_like(self.u)
        for t in range(x.shape[1] - 1, -1, -1):
            h, c, i, f, o, g, tc, m = trace[t]
            dh = dh + d_out[:, t]
            real = dh * m
            d_c = (dc * m) + real * o * (1 - tc**2)
            dz = np.concatenate([
                d_c * g * i * (1 - i), d_c * c * f * (1 - f), real * tc * o * (1 - o), d_c * i * (1 - g**2),
            ], axis=1)
            dz_all[:, t] = dz
            du += h.T @ dz
            dh = dz @ self.u.T + dh * (1 - m)
            dc = d_c * f + dc * (1 - m)
        flat = dz_all.reshape(-1, dz_all.shape[2])
        return x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(0)


@dataclass
class BlockLabeller:
    ahead: Direction
    back: Direction
    top: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.w, self.ahead.u, self.ahead.b, self.back.w, self.back.u, self.back.b, self.top, self.bias]

    def odds(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """The logit of each block's place in the article."""
        a = self.ahead.run(x, mask)
        b = self.back.run(x[:, ::-1], mask[:, ::-1])[:, ::-1]
        return np.concatenate([a, b], axis=2) @ self.top + self.bias

    def keep(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page, which of its blocks belong to the article."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        for at in range(0, len(order), GROUP):
            group = order[at : at + GROUP]
            x, mask = padded([pages[i] for i in group])
            odds = self.odds(x, mask)
            for row, i in enumerate(group):
                out[i] = odds[row, : len(pages[i])] > 0
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x, mask = np.zeros((len(pages), longest, Describer.size)), np.zeros((len(pages), longest))
    for i, p in enumerate(pages):
        x[i, : len(p)], mask[i, : len(p)] = p, 1
    return x, mask


def train_labeller(pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 12, batch: int = 32, rate: float = 0.01) -> BlockLabeller:
    """The network fitted to (vectors, labels) of pages by back-propagation through time with Adam."""
    random = np.random.default_rng(7)

    def direction() -> Direction:
        b = np.zeros(4 * HIDDEN)
        b[HIDDEN : 2 * HIDDEN] = 1
        shape = Describer.size, 4 * HIDDEN
        return Direction(random.normal(0, 0.08, shape), random.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)), b)

    net = BlockLabeller(direction(), direction(), random.normal(0, 0.2, 2 * HIDDEN), np.zeros(1))
    pages = [(x[:SAMPLE_BLOCKS], y[:SAMPLE_BLOCKS]) for x, y in pages if len(x)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    turn = 0
    for _ in range(rounds if pages else 0):
        for chosen in np.array_split(random.permutation(len(pages)), max(1, len(pages) // batch)):
            x, mask = padded([pages[i][0] for i in chosen])
            y = np.zeros(mask.shape)
            for row, i in enumerate(chosen):
                y[row, : len(pages[i][1])] = pages[i][1]
            trace_a: Trace = []
            trace_b: Trace = []
            a = net.ahead.run(x, mask, trace_a)
            xb, mb = x[:, ::-1], mask[:, ::-1]
            b = net.back.run(xb, mb, trace_b)
            states = np.concatenate([a, b[:, ::-1]], axis=2)
            error = (_sigmoid(states @ net.top + net.bias) - y) * mask / mask.sum()
            d_states = error[..., None] * net.top
            slopes = [
                *net.ahead.slopes(x, trace_a, d_states[..., :HIDDEN]),
                *net.back.slopes(xb, trace_b, d_states[:, ::-1, HIDDEN:]),
                np.einsum("nt,nth->h", error, states), error.sum(keepdims=True).ravel()[:1],
            ]
            turn += 1
            for w, slope, (m, v) in zip(net.weights(), slopes, moments, strict=True):
                m += 0.1 * (slope - m)
                v += 0.01 * (slope**2 - v)
                w -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return net


#: Landmarks that label a sampled page, and layouts and boilerplate planted in copies of it.
_BODY = ("<article>", "<main>")
_ASIDE = frozenset("<nav> <footer> <header> <aside> <form> <button> <select> ad ads advert comment comments sidebar menu cookie notice".split())
_LAYOUTS = (
    ('<article class="post">', "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"),
    ('<div class="content">', "</div>"), ('<div id="main" class="article-body">', "</div>"),
    ('<section class="story entry-content">', "</section>"), ('<div role="main">', "</div>"),
)
_OUTSIDE = (
    '<header class="site-header"><h1>{}</h1><p>{}</p></header>', '<header>{}</header>', '<aside><h3>{}</h3><p>{}</p></aside>',
    '<div class="sidebar"><p>{}</p><ul><li><a href="#">{}</a></li></ul></div>', '<aside class="sidebar">{}</aside>',
    '<div class="cookie-notice"><p>{}</p><button>OK</button></div>', '<div class="notice banner">{}</div>',
    '<div id="cookie-banner">{}</div>', '<form action="/s"><label>{}</label><input name="q"><button>{}</button></form>',
    '<div class="newsletter"><form><p>{}</p><button>{}</button></form></div>',
    '<section id="comments"><h2>{}</h2><div class="comment"><p>{}</p></div><div class="comment"><p>{}</p></div></section>',
    '<div class="comments"><p class="comment">{}</p></div>', '<ol class="comment-list"><li>{}</li><li>{}</li></ol>',
    '<div class="ad">{}</div>', '<div class="advert sponsored"><p>{}</p></div>', '<div class="ads"><a href="#">{}</a></div>',
    '<div class="related"><h3>{}</h3><ul><li><a href="#">{}</a></li></ul></div>', '<ul class="menu"><li><a href="#">{}</a></li></ul>',
    '<div class="menu nav"><a href="#">{}</a> <a href="#">{}</a></div>', '<nav class="breadcrumb"><a href="#">{}</a></nav>',
    '<div class="share social"><a href="#">{}</a></div>', '<div class="footer"><p>{}</p></div>', '<p class="copyright">{}</p>',
)
_INSIDE = (
    '<aside>{}</aside>', '<div class="ad">{}</div>', '<aside class="ad"><p>{}</p></aside>', '<form><p>{}</p><button>{}</button></form>',
    '<div class="notice">{}</div>', '<section class="comments"><p>{}</p></section>', '<nav><a href="#">{}</a></nav>',
    '<div class="share"><a href="#">{}</a></div>', '<footer>{}</footer>', '<header><p>{}</p></header>',
)


def by_landmarks(block: Block) -> bool:
    """Whether a sampled page's own markup puts a block into the article."""
    return any(x in block.path for x in _BODY) and not any(x in _ASIDE for x in block.path)


def altered(blocks: list[Block], random: np.random.Generator) -> list[tuple[Block, bool]] | None:
    """Blocks with labels of a copy of a page: its article in another layout, boilerplate of many kinds around and in it."""
    article = [b.text for b in blocks if by_landmarks(b)]
    other = [b.text for b in blocks if not by_landmarks(b)]
    if not article:
        return None
    texts = [*other, *article]

    def planted(kinds: tuple[str, ...], most: int) -> list[str]:
        out = []
        for k in random.integers(0, len(kinds), random.integers(0, most + 1)):
            pattern = kinds[k]
            fill = [entities.escape(texts[random.integers(len(texts))]) for _ in range(pattern.count("{}"))]
            fill = [" ".join(x.split()[: random.integers(1, 40)]) for x in fill]
            out.append(pattern.format(*fill))
        return out

    head, foot = _LAYOUTS[random.integers(len(_LAYOUTS))]
    kinds = ["p"] * 6 + ["h2", "blockquote", "li", "pre"]
    marked = ["<body>", *planted(_OUTSIDE, 5), head]
    for i, text in enumerate(article):
        tag = "h1" if i == 0 and random.random() < 0.5 else kinds[random.integers(len(kinds))]
        marked.append(f'<{tag} data-article="1">{entities.escape(text)}</{tag}>')
        if random.random() < 0.08:
            marked += planted(_INSIDE, 1)
    marked += [foot, *planted(_OUTSIDE, 6), "</body>"]
    page = "\n".join(marked)
    plain = blocks_of(page.replace(' data-article="1"', ""))
    labels = blocks_of(page.replace('data-article="1"', 'class="zzarticle"'))
    return [(a, "zzarticle" in b.path) for a, b in zip(plain, labels, strict=True)]


def fit_labeller(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> BlockLabeller:
    """The network trained on at most ``sample`` pages with landmarks, and on two altered copies of each.

    The pages are those whose ids have the least hashes; ids are chosen first, so that only chosen pages travel.
    Pages without an id or html play no part.
    """
    own = pages.where(F.col(html_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))
    chosen = own.select("_id").where("_id IS NOT NULL").orderBy(F.xxhash64("_id"), "_id").limit(sample).distinct()
    rows = own.join(F.broadcast(chosen), "_id").orderBy(F.xxhash64("_id"), "_id", "_html").select("_html")
    random, describer = np.random.default_rng(11), Describer()
    examples = []
    for row in rows.limit(sample).collect():
        blocks = blocks_of(row[0])
        if not any(map(by_landmarks, blocks)):
            continue
        for labelled in ([(b, by_landmarks(b)) for b in blocks], altered(blocks, random), altered(blocks, random)):
            examples.append((describer.rows([b for b, _ in labelled]), np.array([y for _, y in labelled], float)))
    return train_labeller(examples)


def main_text(html: Column, labeller: BlockLabeller) -> Column:
    """The text of the article's blocks, joined by newlines; empty for a null or empty page and where none is found.

    Character references are decoded, white space inside a block becomes one blank. Markup may be broken: elements
    left open end where the next one of their kind or their parent ends, tags that never end are text. Very long pages are
    read whole, in time in proportion to their length; repeated rows give the same text each, ties cannot arise.
    """
    def extract(column: pa.Array) -> pa.Array:
        describer, out = Describer(), []
        pages = texts_of(column)
        for at in range(0, len(pages), 512):
            blocks = [blocks_of(x) for x in pages[at : at + 512]]
            keep = labeller.keep([describer.rows(b) for b in blocks])
            out += ["\n".join(b.text for b, k in zip(own, ks, strict=True) if k) for own, ks in zip(blocks, keep, strict=True)]
        return pa.array(out, pa.string())

    return F.arrow_udf(extract, "string")(html)
