"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks, each with the path of elements above it. A bidirectional LSTM
in numpy reads hashed vectors of path and words, block after block in both directions, and
labels every block with the whole page in view. It is trained here on a bounded sample of
pages: blocks below elements that name their purpose are examples, blocks without such a
name are not. In training, names are hidden or exchanged for others of the same purpose, and
blocks of main text are put below elements of other purposes, so that names count where there
are any, and shape, words and neighbours where there are none.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.llm.labelled import sigmoid
from cliploom.llm.words import text_chunks, text_words

# Element names of the HTML standard and common names of page parts.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark picture q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template textarea title svg math iframe object canvas audio video noframes xmp".split())
RAW = frozenset("script style textarea title iframe noframes xmp".split())  # nothing but its own end tag ends one
SEALED = frozenset("noscript template object".split())  # end tags of outer elements do not count inside
DRAWN = frozenset("svg math".split())
LEAVES_DRAWN = frozenset(
    "article aside b big blockquote body br center code dd dialog div dl dt em embed fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr "
    "i img li listing main menu meta nav nobr ol p pre ruby s section small span strike strong sub sup table tt u ul var".split()
)
CLOSED_BY_OWN = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "table tr", "th": "table tr", "option": "select", "p": ""}
MAIN_TAGS = frozenset("article main".split())
MAIN_NAMES = ("article", "main", "content", "post", "entry", "story")
OTHER_TAGS = frozenset("nav footer aside form header menu dialog button select fieldset".split())
OTHER_NAMES = {
    "menu": ("nav", "menu", "navigation", "navbar", "breadcrumb", "breadcrumbs", "toc", "tabs", "pagination", "pager"),
    "header": ("header", "masthead", "topbar", "banner", "logo"),
    "footer": ("footer", "copyright", "legal", "colophon"),
    "sidebar": ("aside", "sidebar", "widget", "related", "recommended", "popular", "trending"),
    "notice": ("notice", "cookie", "cookies", "consent", "alert", "popup", "modal", "newsletter", "subscribe", "paywall"),
    "advert": ("ad", "ads", "advert", "advertisement", "adbox", "sponsor", "sponsored", "promo", "promotion"),
    "form": ("form", "search", "login", "signup", "register"),
    "comments": ("comments", "comment", "respond", "replies", "reply", "disqus", "discussion"),
    "share": ("share", "sharing", "social"),
}
_PURPOSE = {name: purpose for purpose, names in OTHER_NAMES.items() for name in names}

_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
PATH_BITS, WORD_BITS, SHAPE = 320, 32, 6


@dataclass(frozen=True)
class Settings:
    #: Pages that the fit reads at most, and blocks of a page that it unrolls at once.
    pages: int = 240
    unroll: int = 96
    hidden: int = 16
    steps: int = 900
    rate: float = 0.02
    seed: int = 3


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """Leaf blocks in page order: names on the path, text with single spaces, characters inside links.

    A comment or an element of ``RAW`` that never ends takes the rest of the page, as in a browser;
    another element of ``UNSEEN`` without an end tag ends with the element around it.
    """
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    in_head, links, linked = False, 0, 0
    inside: list[str] = []  # open elements from one of UNSEEN on, how many of each, and where its end tag is
    within: Counter[str] = Counter()
    limit = -1

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((tuple(n for _, names in stack for n in names), text, linked))
            parts.clear()
        linked = 0

    def data(a: int, b: int) -> None:
        nonlocal linked
        if b > a and not in_head and not inside:
            parts.append(page[a:b])
            linked += (b - a) * (links > 0)

    def end_of(tag: str, a: int, b: int) -> int:
        """Where the next end tag begins, or -1."""
        end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, a, b)
        return end.start() if end else -1

    def own_end(tag: str, a: int) -> int:
        """Where the end tag begins if it comes before another such element; no part is read twice."""
        again = re.compile(rf"<{re.escape(tag)}(?=[\s/>])", re.I).search(page, a, last)
        return end_of(tag, a, again.start() if again else last)

    def ends_outer(tag: str) -> bool:
        """Whether a start tag inside an element without end tag ends what is around that."""
        if inside[0] in DRAWN and tag in LEAVES_DRAWN or tag == "body":
            return True
        if len(inside) > 1 or not stack or tag in INLINE or tag in VOID or tag in UNSEEN:
            return False
        return stack[-1][0] == "p" or (tag in CLOSED_BY_OWN and stack[-1][0] == tag) or {tag, stack[-1][0]} in ({"dt", "dd"}, {"td", "th"})

    at, last = 0, page.rfind(">") + 1  # no tag ends behind that
    while m := _TOKEN.search(page, at, last):
        data(at, m.start())
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<!--") and not m[0].endswith(("-->", "--!>")):  # a comment that never ends
                at = len(page)
                break
            continue
        closing = bool(m[1] or m[4])
        alone = (m[3] or m[6] or "").endswith("/")
        if inside:
            if closing and within[tag]:
                while True:
                    gone = inside.pop()
                    within[gone] -= 1
                    if gone == tag:
                        break
                if not inside:
                    parts.append(" ")
                continue
            if closing:
                leaves = tag == "head" or any(t == tag for t, _ in stack) or (limit < 0 and tag in INLINE and tag not in VOID)
            else:
                leaves = limit < 0 and ends_outer(tag)
            if not leaves:
                if closing or tag in VOID or (alone and (inside[0] in DRAWN or tag in UNSEEN)):
                    continue
                if tag in RAW and inside[0] not in DRAWN:
                    end = end_of(tag, at, last if limit < 0 else limit)
                    at = page.find(">", end) + 1 if end >= 0 else len(page) if limit < 0 else limit
                    continue
                inside.append(tag)
                within[tag] += 1
                continue
            inside.clear()
            within.clear()
            parts.append(" ")
        if tag in UNSEEN:
            if not closing and not alone:
                end = end_of(tag, at, last) if tag in RAW else own_end(tag, at)
                if tag in RAW and end < 0:
                    at = len(page)
                elif tag in RAW or (tag in SEALED and end >= 0):
                    at = page.find(">", end) + 1
                else:
                    inside.append(tag)
                    within[tag], limit = 1, end
            if tag != "title":
                parts.append(" ")
            continue
        if tag == "head":
            in_head = not closing
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            elif tag == "br":
                parts.append(" ")
            continue
        if in_head and tag in ("meta", "link", "base"):
            continue
        in_head = False
        flush()
        links = 0
        if tag in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSED_BY_OWN and tag != "p":
            barrier = CLOSED_BY_OWN[tag].split()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in barrier:
                    break
                if stack[k][0] == tag or (tag, stack[k][0]) in (("dt", "dd"), ("dd", "dt"), ("td", "th"), ("th", "td")):
                    del stack[k:]
                    break
        if stack and stack[-1][0] == "p":  # a paragraph ends where another block begins
            stack.pop()
        named = {w for x in _NAMES.findall(m[3] or m[6] or "") for w in _WORD.findall("".join(x).lower())}
        stack.append((tag, (tag, *(f".{w}" for w in sorted(named)))))
    opened = page.find("<!--", at)  # in the rest, where no tag and no comment ends
    data(at, opened if opened >= 0 else len(page))
    flush()
    return out


def purpose(path: tuple[str, ...]) -> str | None:
    """``main``, another purpose, or None where no element names one."""
    main = False
    for name in path:
        word = name.lstrip(".")
        if word == "header" and main:
            continue
        if name in OTHER_TAGS or (name[0] == "." and word in _PURPOSE):
            return _PURPOSE.get(word, "form")
        main |= name in MAIN_TAGS or (name[0] == "." and word in MAIN_NAMES)
    return "main" if main else None


def disguised(path: tuple[str, ...], rng: np.random.Generator, hide: bool) -> tuple[str, ...]:
    """The path with its telling names hidden, or exchanged for others of the same purpose."""
    out = []
    for name in path:
        word = name.lstrip(".")
        if word in _PURPOSE or word in MAIN_NAMES or name in OTHER_TAGS or name in MAIN_TAGS:
            if hide:
                out += ["div"] if name[0] != "." else []
            elif name in MAIN_TAGS and rng.random() < 0.4:
                out.append(("article", "main")[rng.integers(2)])
            elif rng.random() < 0.5:
                same = OTHER_NAMES[_PURPOSE[word]] if word in _PURPOSE else MAIN_NAMES if word in MAIN_NAMES else OTHER_NAMES["form"]
                out += ["div", f".{same[rng.integers(len(same))]}"]
            else:
                out.append(name)
        else:
            out.append(name)
    return tuple(out)


_paths: dict[tuple[str, ...], np.ndarray] = {}


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Hashed names of the path, the innermost one once more."""
    if path not in _paths:
        if len(_paths) > 20_000:
            _paths.clear()
        v = np.zeros(PATH_BITS, np.float32)
        for name in path:
            v[zlib.crc32(name.encode()) % PATH_BITS] = 1
        if path:
            v[zlib.crc32(b"in " + path[-1].encode()) % PATH_BITS] = 1
        _paths[path] = v
    return _paths[path]


def block_vectors(texts: list[str], linked: list[int]) -> np.ndarray:
    """Shares of hashed words, then length, link share, marks and capitals of each block."""
    words, first = text_words(pa.array(texts, pa.large_string()), lower=True)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    bag = np.bincount(owner * WORD_BITS + (words % np.uint64(WORD_BITS)).astype(np.int64), minlength=len(n) * WORD_BITS).reshape(len(n), WORD_BITS)
    size = np.array([len(t) for t in texts])
    shape = np.stack((
        np.log1p(n) / 4, np.log1p(size) / 6, np.minimum(1, np.array(linked) / np.maximum(size, 1)), [t[-1] in ".!?…\"”»" for t in texts],
        [t[:1].isupper() for t in texts], n < 4,
    ), axis=1)
    return np.concatenate((bag / np.maximum(np.sqrt(n), 1)[:, None], shape), axis=1).astype(np.float32)


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences side by side, time first, and where they are."""
    longest = max(len(r) for r in rows)
    x = np.zeros((longest, len(rows), rows[0].shape[1]), np.float32)
    mask = np.zeros((longest, len(rows), 1), np.float32)
    for k, r in enumerate(rows):
        x[: len(r), k], mask[: len(r), k] = r, 1
    return x, mask


class Labeller:
    """Bidirectional LSTM with one output for each block."""

    def __init__(self, width: int, hidden: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        shape = (width + hidden, 4 * hidden)
        self.p = {f"w{d}": (rng.standard_normal(shape) / np.sqrt(width + hidden)).astype(np.float32) for d in "fb"}
        self.p |= {f"b{d}": np.repeat(np.float32([0, 1, 0, 0]), hidden) for d in "fb"}
        self.p |= {"v": (rng.standard_normal(2 * hidden) / np.sqrt(2 * hidden)).astype(np.float32), "c": np.zeros(1, np.float32)}

    def walk(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States of one direction, and what the way back needs."""
        h = c = np.zeros((x.shape[1], self.hidden), np.float32)
        n, w = x.shape[2], self.p[f"w{d}"]
        inputs = x @ w[:n] + self.p[f"b{d}"]
        out, kept = np.empty((*x.shape[:2], self.hidden), np.float32), []
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            i, f, o, g = np.split(inputs[t] + h @ w[n:], 4, axis=1)
            i, f, o, g = sigmoid(i), sigmoid(f), sigmoid(o), np.tanh(g)
            new = f * c + i * g
            squashed = np.tanh(new)
            kept.append((t, h, c, i, f, o, g, squashed))
            h = mask[t] * (o * squashed) + (1 - mask[t]) * h
            c = mask[t] * new + (1 - mask[t]) * c
            out[t] = h
        return out, kept

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probability that each block belongs to the main text."""
        both = np.concatenate((self.walk(x, mask, "f")[0], self.walk(x, mask, "b")[0]), axis=2)
        return sigmoid(both @ self.p["v"] + self.p["c"])

    def slopes(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the weighted logistic loss."""
        ways = {d: self.walk(x, mask, d) for d in "fb"}
        both = np.concatenate((ways["f"][0], ways["b"][0]), axis=2)
        error = (sigmoid(both @ self.p["v"] + self.p["c"]) - label) * weight
        out = {"v": np.tensordot(error, both, 2), "c": error.sum(keepdims=True).reshape(1)}
        for k, d in enumerate("fb"):
            w, n, size = self.p[f"w{d}"], x.shape[2], self.hidden
            came = error[..., None] * self.p["v"][k * size : (k + 1) * size]
            gates = np.zeros((*x.shape[:2], 4 * size), np.float32)
            before = np.zeros((*x.shape[:2], size), np.float32)
            dh = dc = np.zeros((x.shape[1], size), np.float32)
            for t, h, c, i, f, o, g, squashed in reversed(ways[d][1]):
                dh = dh + came[t]
                m = mask[t]
                inner = m * dc + m * dh * o * (1 - squashed**2)
                gates[t] = np.concatenate((inner * g * i * (1 - i), inner * c * f * (1 - f), m * dh * squashed * o * (1 - o), inner * i * (1 - g**2)), axis=1)
                before[t] = h
                dc = inner * f + (1 - m) * dc
                dh = gates[t] @ w[n:].T + (1 - m) * dh
            out[f"w{d}"] = np.concatenate((np.tensordot(x, gates, ((0, 1), (0, 1))), np.tensordot(before, gates, ((0, 1), (0, 1)))))
            out[f"b{d}"] = gates.sum(axis=(0, 1))
        return out

    def packed(self) -> bytes:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)]).astype(np.float32).tobytes()

    def unpacked(self, raw: bytes) -> Labeller:
        flat, at = np.frombuffer(raw, np.float32), 0
        for k in sorted(self.p):
            self.p[k] = flat[at : at + self.p[k].size].reshape(self.p[k].shape)
            at += self.p[k].size
        return self


WIDTH = PATH_BITS + WORD_BITS + SHAPE


OTHER_PLACES = tuple((tag,) for tag in ("aside", "footer", "nav", "form", "header")) + tuple(
    (tag, f".{name}") for names in OTHER_NAMES.values() for name in names for tag in ("div", "section")
)


# What a block may be inside any part of a page.
INNER = (
    ("p",), ("p",), ("div",), ("ul", "li"), ("ol", "li"), ("li",), ("blockquote",), ("blockquote", "p"), ("pre",), ("h2",), ("h3",), ("h4",), ("h5",), ("h6",), ("section", "p"),
    ("section", "h2"), ("div", "p"), ("table", "tr", "td"), ("table", "tbody", "tr", "td"), ("table", "tr", "th"), ("figure", "figcaption"), ("dl", "dt"), ("dl", "dd"), (),
)
WRAPPERS = ((), ("div",), ("div", ".wrap"), ("div", ".page", ".wrap"), ("div", ".container"), ("div", ".outer", "div", ".inner"), ("section",), ("div", "div", ".row"), ("center",))


def named_depth(path: tuple[str, ...]) -> int:
    """Names of the path up to the innermost one that names main text."""
    return max((i + 1 for i, name in enumerate(path) if name in MAIN_TAGS or (name[0] == "." and name[1:] in MAIN_NAMES)), default=0)


def any_inner(rng: np.random.Generator) -> tuple[str, ...]:
    return INNER[rng.integers(len(INNER))]


def strangers(path: tuple[str, ...], pool: list[np.ndarray], rng: np.random.Generator) -> tuple[list[tuple[str, ...]], list[np.ndarray]]:
    """One to four blocks of main text moved below an element that names another purpose."""
    place, inner = OTHER_PLACES[rng.integers(len(OTHER_PLACES))], any_inner(rng)
    n = 1 + int(rng.integers(4))
    return [(*path, *place, *inner)] * n, [pool[k] for k in rng.integers(len(pool), size=n)]


def varied(paths: list, vectors: np.ndarray, told: list, pool: list[np.ndarray], short: list[np.ndarray], rng: np.random.Generator) -> tuple[np.ndarray, list]:
    """Input rows and purposes of one training page under new names.

    Strangers stand before, behind and inside its main text; where names are kept, blocks that look
    like other parts of a page stand inside it. Blocks of main text become items, quotations,
    code, subheads, cells, captions and so on, alone or in stretches, as others may be, and the
    whole page may lie in wrappers: what a block is tells little, where it stands much.
    """
    hide = rng.random() < 0.3
    paths = list(paths)
    main = [k for k, t in enumerate(told) if t == "main"]
    if main and rng.random() < 0.7:
        inner, left = (), 0
        for k in main:
            if not left and rng.random() < 0.35:
                inner, left = any_inner(rng), 1 + int(rng.integers(5))
            if left:
                left -= 1
                paths[k] = (*paths[k][: named_depth(paths[k])], *inner)
    wrapper = WRAPPERS[rng.integers(len(WRAPPERS))]
    if wrapper:
        stop = next((i for i, name in enumerate(paths[0]) if name == "body"), -1) + 1 if paths else 0
        paths = [(*p[:stop], *wrapper, *p[stop:]) for p in paths]
    seen = [disguised(p, rng, hide) for p in paths]
    inputs, told = list(vectors), list(told)
    start = paths[main[0]] if main else ()
    if main and pool:
        if short and not hide and rng.random() < 0.5:
            k, n = main[rng.integers(len(main))] + 1, 1 + int(rng.integers(6))
            whose = (*paths[main[-1]][: named_depth(paths[main[-1]])], *any_inner(rng))
            seen[k:k], inputs[k:k], told[k:k] = [disguised(whose, rng, False)] * n, [short[j] for j in rng.integers(len(short), size=n)], ["main"] * n
            main = [j for j, t in enumerate(told) if t == "main"]
        if not hide and len(main) > 1 and rng.random() < 0.5:  # another part in the midst, after which main text goes on
            k = main[1 + rng.integers(len(main) - 1)]
            new, moved = strangers(start[: named_depth(start)], pool, rng)
            seen[k:k], inputs[k:k], told[k:k] = new, moved, ["other"] * len(new)
            main = [j for j, t in enumerate(told) if t == "main"]
        for k in (main[-1] + 1, main[0]):
            if rng.random() < 0.6:
                around = start
                stop = next((i for i, name in enumerate(around) if name in MAIN_TAGS or name.lstrip(".") in MAIN_NAMES), 0)
                new, moved = strangers(around[: stop + int(rng.random() < 0.3)], pool, rng)
                seen[k:k], inputs[k:k], told[k:k] = new, moved, ["other"] * len(new)
    return np.concatenate((np.array([path_vector(p) for p in seen]), np.array(inputs)), axis=1), told


def fit(pages: list[str], settings: Settings) -> Labeller:
    """The labeller after slope steps with momentum and scaling (Adam) on the pages' telling blocks."""
    net, rng = Labeller(WIDTH, settings.hidden, settings.seed), np.random.default_rng(settings.seed)
    cut, pool, short = [], [], []
    for page in pages:
        found = blocks(page)
        for a in range(0, len(found), settings.unroll):
            some = found[a : a + settings.unroll]
            told = [purpose(path) for path, _, _ in some]
            if any(told):
                cut.append(([path for path, _, _ in some], block_vectors([t for _, t, _ in some], [n for *_, n in some]), told))
                pool += [v for v, t in zip(cut[-1][1], told, strict=True) if t == "main"][:8]
                short += [v for v, t in zip(cut[-1][1], told, strict=True) if t not in ("main", None)][:8]
    if not cut:
        net.p["v"][:] = 0
        return net
    cut.sort(key=lambda page: len(page[0]))
    speed, size = {k: 0.0 for k in net.p}, {k: 0.0 for k in net.p}
    groups = [cut[a : a + 40] for a in range(0, len(cut), 40)]  # of like length
    for step in range(1, settings.steps + 1):
        if step % len(groups) == 1 % len(groups):
            turns = rng.permutation(len(groups)).tolist()
        rows, purposes = zip(*(varied(*page, pool, short, rng) for page in groups[turns.pop()]), strict=True)
        x, mask = padded(list(rows))
        label, weight = np.zeros(mask.shape[:2], np.float32), np.zeros(mask.shape[:2], np.float32)
        for k, told in enumerate(purposes):
            label[: len(told), k] = [t == "main" for t in told]
            weight[: len(told), k] = [t is not None for t in told]
        weight /= max(weight.sum(), 1)
        rate = settings.rate * min(1, 2 * (1 - (step - 1) / settings.steps))
        for k, s in net.slopes(x, mask, label, weight).items():
            speed[k] = 0.9 * speed[k] + 0.1 * s
            size[k] = 0.99 * size[k] + 0.01 * s**2
            net.p[k] = (net.p[k] - rate * (speed[k] / (1 - 0.9**step)) / (np.sqrt(size[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def train(pages: DataFrame, settings: Settings = Settings(), page_id: str = "page_id") -> Labeller:
    """Fit on at most ``settings.pages`` rows of ``pages(page_id, html)``, the first ones by a hash, in one task."""
    sample = pages.where("html is not null").select(page_id, "html").orderBy(F.xxhash64(page_id), page_id, F.xxhash64("html")).limit(settings.pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for batch in batches for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([fit(texts, settings).packed()], pa.binary())], names=["net"])

    found = sample.select("html").coalesce(1).mapInArrow(run, "net binary").collect()
    net = Labeller(WIDTH, settings.hidden, settings.seed)
    if found:
        return net.unpacked(found[0]["net"])
    net.p["v"][:] = 0
    return net


def labelled_pages(pages: list[str], net: Labeller) -> list[list[tuple[str, float]]]:
    """Text and probability of every block of each page."""
    found = [blocks(page) for page in pages]
    flat = [b for page in found for b in page]
    if not flat:
        return [[] for _ in pages]
    vectors = np.concatenate((np.array([path_vector(p) for p, _, _ in flat]), block_vectors([t for _, t, _ in flat], [n for *_, n in flat])), axis=1)
    ends = np.cumsum([len(page) for page in found])
    scores = np.empty(len(flat))
    order = [k for k in np.argsort([len(page) for page in found], kind="stable").tolist() if found[k]]
    at = 0
    while at < len(order):  # pages of like length together, a bounded number of padded blocks
        longest = at + 1
        while longest < len(order) and longest - at < 256 and len(found[order[longest]]) * (longest + 1 - at) <= 40_000:
            longest += 1
        own = order[at:longest]
        result = net.scores(*padded([vectors[ends[k] - len(found[k]) : ends[k]] for k in own]))
        for column, k in enumerate(own):
            scores[ends[k] - len(found[k]) : ends[k]] = result[: len(found[k]), column]
        at = longest
    return [[(t, s) for (_, t, _), s in zip(page, scores[e - len(page) : e].tolist(), strict=True)] for page, e in zip(found, ends.tolist(), strict=True)]


def main_text(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks`` for each row of ``pages(page_id, url, html)``.

    Blocks that score one half or more are joined by newlines; a page without any has empty
    text, as has null html. Where no page of the sample names a purpose every block is kept.
    Repeated rows are extracted alike; an empty table gives no rows; other columns are ignored.
    """
    net = train(pages, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "html"):
            found = labelled_pages([page or "" for page in chunk.column("html").to_pylist()], net)
            texts = ["\n".join(t for t, s in page if s >= 0.5) for page in found]
            yield pa.RecordBatch.from_arrays([
                chunk.column("page_id"), chunk.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(page) for page in found], pa.int32()),
            ], names=["page_id", "url", "text", "n_chars", "n_blocks"])

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, n_blocks int")
