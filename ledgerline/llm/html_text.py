"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, with the path of open
elements above them.  A bidirectional LSTM in numpy reads, block by block, the path (tag names
and the words of class, id and role, hashed), hashed words of the text and a few numbers
(length, share of links, punctuation), and labels every block with the whole page as
context.  The text of a page is its blocks labelled as article, in page order.

What marks boilerplate is a tag name, or a class, id or role token whose words all name
boilerplate or its place (``site-header``, ``comment-list``): a token that only mentions it
(``with-sidebar``, ``ad-free``, ``comment-open``) is dropped, as are the tokens of html and body.  An
element that holds more than half of the page's text, and an h1 if the page has any, is no
boilerplate whatever it is called.

There are no gold labels, so the network is trained here on at most SAMPLE pages taken by
hash, labelled by what their paths say (``path_label``); stretches of boilerplate with every
word of BOILERPLATE as tag, class or id are put between their blocks, and article wrappers
are renamed, so that the network meets markup which the sample lacks.

Cases: null and empty html give an empty text; markup that breaks off, unclosed and stray tags
are read as far as they go; script, style and the like, comments and what stands in a head
never yield blocks; a head ends at the first tag that cannot stand in it, svg and math at '/>'
or at a tag of the page, and unclosed script, style, textarea and title at the next tag of the
page; of other unclosed raw elements only the start tag is dropped; repeated rows get the same text; pages of any length are read whole (memory follows
the longest page); a null page_id or url stays null; extra columns are ignored; without any
page the result is empty.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, small_batches, text_udf
from ledgerline.llm.textcodes import DIGIT, LETTER, Codes

# Element names.
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "title", "math")
#: Raw elements that hold text and no tags, and those that end at '/>' or at a tag of the page.
TEXT_ONLY, FOREIGN = ("script", "style", "textarea", "title"), ("svg", "math")
#: Tags that can stand in a head besides raw elements.
HEAD = frozenset("base link meta".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr img picture source br""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
#: Tag names and words of class, id or role that mark what is no article.
BOILERPLATE = """nav header footer aside form menu menubar sidebar ad ads advert advertisement adverts banner sponsor sponsored promo
cookie consent notice alert popup modal overlay comment comments reply replies disqus breadcrumb breadcrumbs share
sharing social related recommended newsletter subscribe signup login search widget widgets toolbar pagination pager
copyright legal disclaimer button select option fieldset navigation topbar masthead complementary contentinfo dialog
feedback tags skip""".split()
#: Words that may stand beside one of BOILERPLATE in a token that marks it.
PLACE = """area bar block body bottom box button buttons col column container content entry global group header inner item
items left link links list main meta module outer page panel post posts primary right row secondary section site
text top widget wrap wrapper""".split()
CONTENT = ("article", "main", "section", "content", "post", "entry", "story", "body", "text", "page", "wrapper", "container")

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(RAW)})\b(?:\"[^\"]*\"|'[^']*'|[^<>\"'])*+>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^<>\"'])*+)(?:>|\Z)|<[!?/][^<>]*(?:>|\Z)", re.S | re.I)
#: Tags of the page, which end a foreign element and what text-only elements leave unclosed.
PAGE_TAG = re.compile(r"""</?(?:html|head|body|article|section|main|header|footer|nav|aside|form|div|p|h[1-6]|ul|ol|li|dl|dt|dd|table
|tr|td|th|blockquote|pre|figure|hr|img)(?=[\s/>])""".replace("\n", ""), re.I)
INTEGRATION = re.compile(r"<(?:foreignObject|desc|annotation-xml|mtext)\b", re.I)
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
NAMING = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

PATHS, WORDS, NUMBERS, HIDDEN = 2048, 64, 4, 16
INNER, OUTER = 16, 8         # elements of a path that are read
HIDE = 0.5                   # share of blocks whose words are hidden in a training step
SAMPLE = 300                 # pages to train on
SAMPLE_CHARS = 200_000       # longer pages are labelled but not trained on
CHUNK = 1 << 14              # blocks whose inputs are made at once
SEED = 5
_BINS = 1 << 20


# ------------------------------------------------------------------ blocks
@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int               # characters inside links


@dataclass
class Element:
    """An open element: its names for paths, whether they mark boilerplate, and the text and h1 inside
    (negative or running counts while it is open)."""
    tag: str
    names: tuple[str, ...]
    marked: bool
    chars: int
    heads: int


_BAD = frozenset(BOILERPLATE)
_BESIDE = _BAD | frozenset(PLACE)


def _element(tag: str, attrs: str, chars: int, heads: int) -> Element:
    """``chars``, ``heads``: the page's counts where the element begins."""
    names = [tag]
    for value in NAMING.findall(attrs) if tag not in ("html", "body") else ():
        for token in "".join(value).split():
            words = [w.lower() for w in re.findall(r"[A-Za-z]+", token)]
            if _BAD.isdisjoint(words) or _BESIDE.issuperset(words):
                names += words
    return Element(tag, tuple(dict.fromkeys(names)), not _BAD.isdisjoint(names), -chars, -heads)


def _raw_end(page: str, name: str, at: int, ends: dict[str, re.Match | None]) -> int:
    """Where a raw element whose start tag ends at ``at`` ends; ``ends``: the next end tag of each
    name as last searched (None: no more), so that no part of a page is searched twice."""
    if name in FOREIGN and page[at - 2] == "/":
        return at
    if name not in ends or ends[name] and ends[name].start() < at:
        ends[name] = ENDS[name].search(page, at)
    end = ends[name]
    if end is None:
        if name not in TEXT_ONLY:
            return at                                     # its children are read as the page's
        found = PAGE_TAG.search(page, at)
        return found.start() if found else len(page)
    if name in FOREIGN and (out := PAGE_TAG.search(page, at, end.start())) and not INTEGRATION.search(page, at, out.start()):
        return out.start()
    return end.end()


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page, in order."""
    page = page or ""
    stack: list[Element] = []
    found: list[tuple[str, list[Element], int]] = []
    parts: list[str] = []
    ends: dict[str, re.Match | None] = {}
    linked = links = at = chars = heads = 0

    def shut(k: int) -> None:
        """Close the elements from place k of the stack."""
        for e in stack[k:]:
            e.chars += chars
            e.heads += heads
        del stack[k:]

    def flush() -> None:
        nonlocal linked, chars, heads
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append((text, stack[:min(OUTER, max(len(stack) - INNER, 0))] + stack[-INNER:], min(linked, len(text))))
            chars += len(text)
            heads += stack[-1].tag == "h1" if stack else 0
        parts.clear()
        linked = 0

    while m := TOKEN.search(page, at):
        if m.start() > at:
            parts.append(page[at:m.start()])
            linked += (m.start() - at) * (links > 0)
        at = _raw_end(page, m["raw"].lower(), m.end(), ends) if m["raw"] else m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if stack and stack[-1].tag == "head" and tag not in HEAD and not m["close"]:
            shut(len(stack) - 1)
        if tag == "a":
            links = 0 if m["close"] else 1
        if tag == "br":
            parts.append(" ")
        if tag in INLINE:
            continue
        flush()
        links = 0
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    shut(k)
                    break
        elif tag not in VOID:
            if tag in SELF_CLOSING and stack and stack[-1].tag == tag:
                shut(len(stack) - 1)
            stack.append(_element(tag, m["attrs"], chars, heads))
    parts.append(page[at:])
    flush()
    shut(0)

    def names(e: Element) -> tuple[str, ...]:
        wraps = e.marked and 2 * e.chars > chars and (e.heads > 0 or not heads)
        return tuple(n for n in ("div" if e.tag in _BAD else e.tag, *e.names[1:]) if n not in _BAD) if wraps else e.names
    return [Block(text, tuple(dict.fromkeys(n for e in path for n in names(e))), link) for text, path, link in found]


_STORY = frozenset(("article", "main", "post", "entry", "story"))


def path_label(path: tuple[str, ...]) -> int:
    """1 if nothing in the path marks boilerplate (a headline's header inside an article is none)."""
    bad = _BAD.intersection(path)
    return int(not bad or bad == {"header"} and "h1" in path and not _STORY.isdisjoint(path))


# ------------------------------------------------------------------ inputs
def _slot(name: str) -> int:
    return 1 + zlib.crc32(name.encode()) % (PATHS - 1)


def inputs(found: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Path slots (0: none) and dense inputs of each block."""
    width = max([1, *(len(b.path) for b in found)])
    paths = np.zeros((len(found), width), dtype=np.int64)
    for i, b in enumerate(found):
        paths[i, :len(b.path)] = [_slot(n) for n in b.path]
    c = Codes([b.text for b in found])
    start, end = c.runs((c.kind & (LETTER | DIGIT)) > 0)
    of = c.text_of(start)
    words = np.zeros((len(found), WORDS + NUMBERS))
    np.add.at(words, (of, (c.hashes(start, end) & np.uint64(WORDS - 1)).astype(np.int64)), 1)
    n = np.bincount(of, minlength=len(found))
    words[:, :WORDS] = np.sqrt(words[:, :WORDS]) / np.sqrt(np.maximum(n, 1))[:, None]
    points = np.isin(c.codes, [ord(x) for x in ".,!?;:"])
    per = np.add.reduceat(points.astype(np.int64), c.starts) if len(found) else np.zeros(0)
    words[:, WORDS:] = np.stack([np.log1p(n) / 5, np.array([b.linked for b in found]) / np.maximum(c.lengths, 1),
                                 per / np.maximum(n, 1), np.ones(len(found))], axis=1)
    return paths, words


# ------------------------------------------------------------------ the network
def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Labeller:
    """Bidirectional LSTM; gates in the order input, forget, output, candidate."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        h = HIDDEN
        self.p = {"path": rng.normal(0, 0.1, (PATHS, 8 * h)), "dense": rng.normal(0, 0.1, (WORDS + NUMBERS, 8 * h)),
                  "f": rng.normal(0, h ** -0.5, (h, 4 * h)), "b": rng.normal(0, h ** -0.5, (h, 4 * h)),
                  "out": rng.normal(0, 0.3, 2 * h), "bias": np.zeros(1)}
        self.p["path"][0] = 0

    def project(self, paths: np.ndarray, dense: np.ndarray) -> np.ndarray:
        out = dense @ self.p["dense"]
        for k in range(paths.shape[1]):
            out += self.p["path"][paths[:, k]]
        return out

    def run(self, x: np.ndarray, rows: np.ndarray, w: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states of one direction.  x: gate inputs of all blocks; rows[s, t]: block of
        sequence s at step t, -1 beyond its end; sequences are ordered longest first."""
        out = np.zeros((len(x), HIDDEN))
        h, c = np.zeros((len(rows), HIDDEN)), np.zeros((len(rows), HIDDEN))
        for t in range(rows.shape[1]):
            n = int((rows[:, t] >= 0).sum())
            at = rows[:n, t]
            g = x[at] + h[:n] @ w
            gates, cand = _sigmoid(g[:, :3 * HIDDEN]), np.tanh(g[:, 3 * HIDDEN:])
            i, f, o = np.split(gates, 3, axis=1)
            before, past = c[:n], h[:n]
            now = f * before + i * cand
            after = np.tanh(now)
            if keep is not None:
                keep.append((at, i, f, o, cand, before, past, after))
            c = np.concatenate([now, c[n:]])
            h = np.concatenate([o * after, h[n:]])
            out[at] = h[:n]
        return out

    @staticmethod
    def rows(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Blocks by (sequence, step), forward and backward, longest sequence first."""
        first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        order = np.argsort(-np.asarray(sizes), kind="stable")
        size, first = np.asarray(sizes)[order], first[order]
        step = np.arange(int(size.max(initial=0)))[None]
        inside = step < size[:, None]
        return np.where(inside, first[:, None] + step, -1), np.where(inside, (first + size - 1)[:, None] - step, -1)

    def logits(self, found: list[Block], sizes: list[int]) -> np.ndarray:
        """Scores of the blocks of several pages (sizes: blocks of each page)."""
        if not found:
            return np.zeros(0)
        x = np.concatenate([self.project(*inputs(found[i:i + CHUNK])) for i in range(0, len(found), CHUNK)])
        ahead, behind = self.rows([s for s in sizes if s])
        h = 4 * HIDDEN
        both = [self.run(x[:, :h], ahead, self.p["f"]), self.run(x[:, h:], behind, self.p["b"])]
        return np.concatenate(both, axis=1) @ self.p["out"] + self.p["bias"]

    def _back(self, kept: list, grad: np.ndarray, w: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the gate inputs and of the recurrent weights."""
        dx, dw = np.zeros((len(grad), 4 * HIDDEN)), np.zeros_like(w)
        dh, dc = np.zeros((n_rows, HIDDEN)), np.zeros((n_rows, HIDDEN))
        for at, i, f, o, cand, before, past, after in reversed(kept):
            n = len(at)
            d = dh[:n] + grad[at]
            c = dc[:n] + d * o * (1 - after * after)
            g = np.concatenate([c * cand * i * (1 - i), c * before * f * (1 - f), d * after * o * (1 - o), c * i * (1 - cand * cand)], axis=1)
            dx[at] = g
            dw += past.T @ g
            dh[:n], dc[:n] = g @ w.T, c * f
        return dx, dw

    def fit(self, pages: list[tuple[list[Block], np.ndarray]], epochs: int = 20, batch: int = 32, rate: float = 0.01) -> None:
        rng = np.random.default_rng(SEED)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        made = [(*inputs(b), y) for b, y in pages]
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(made))
            for a in range(0, len(order), batch):
                some = [made[i] for i in order[a:a + batch]]
                width = max(p.shape[1] for p, _, _ in some)
                paths = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p, _, _ in some])
                dense, y = (np.concatenate([s[k] for s in some]) for k in (1, 2))
                dense[:, :WORDS] *= rng.random((len(dense), 1)) >= HIDE       # markup must do for many blocks
                x = self.project(paths, dense)
                ahead, behind = self.rows([len(s[2]) for s in some])
                kf, kb, h = [], [], 4 * HIDDEN
                both = np.concatenate([self.run(x[:, :h], ahead, self.p["f"], kf), self.run(x[:, h:], behind, self.p["b"], kb)], axis=1)
                e = (_sigmoid(both @ self.p["out"] + self.p["bias"]) - y) / len(y)
                back = np.outer(e, self.p["out"])
                dxf, dwf = self._back(kf, back[:, :HIDDEN], self.p["f"], len(ahead))
                dxb, dwb = self._back(kb, back[:, HIDDEN:], self.p["b"], len(ahead))
                dx = np.concatenate([dxf, dxb], axis=1)
                dp = np.zeros_like(self.p["path"])
                for k in range(width):
                    np.add.at(dp, paths[:, k], dx)
                dp[0] = 0
                t += 1
                for k, g in {"path": dp, "dense": dense.T @ dx, "f": dwf, "b": dwb, "out": both.T @ e, "bias": e.sum(keepdims=True)}.items():
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)


# ------------------------------------------------------------------ training pages
def varied(found: list[Block], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A training page: the blocks with renamed article wrappers and stretches of boilerplate
    between them, and their labels."""
    wrap = {"article": CONTENT[rng.integers(len(CONTENT))]} if rng.random() < 0.5 else {}
    wrap |= {"h1": f"h{rng.integers(1, 5)}"} if rng.random() < 0.5 else {}
    bare = rng.random() < 0.1                                    # a fragment without wrappers
    around = ("div", CONTENT[rng.integers(len(CONTENT))])[:rng.integers(3)]          # wrappers of the whole page
    found = [Block(b.text, tuple(dict.fromkeys((*around, *(wrap.get(n, n) for n in b.path if not bare or n in _BAD)))), b.linked) for b in found]
    a, n = (int(rng.integers(len(found))), int(rng.integers(1, 6))) if found and rng.random() < 0.3 else (0, 200)
    found = found[a:a + n]
    stretches: dict[int, list[Block]] = {}
    for _ in range(int(rng.integers(3, 9)) if found else 0):
        at, word = int(rng.integers(len(found) + 1)), BOILERPLATE[rng.integers(len(BOILERPLATE))]
        outer = found[min(at, len(found) - 1)].path if rng.random() < 0.5 else ("html", "body", *around)
        tag = [("div", word), ("section", word), (word,), ("ul", word, "li"), ("div", word, "p"), ("div", word, "h3")][rng.integers(6)]
        for _ in range(int(rng.integers(1, 5))):
            words = found[rng.integers(len(found))].text.split()
            some = " ".join(words[:int(rng.choice([2, 6, 20, 60]))])
            stretches.setdefault(at, []).append(Block(some, tuple(dict.fromkeys(outer + tag)), len(some) * (rng.random() < 0.3)))
    out = [b for i in range(len(found) + 1) for b in [*stretches.get(i, []), *found[i:i + 1]]]
    return out, np.array([path_label(b.path) for b in out], dtype=np.float64)


def train(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    """Train on a bounded sample of pages."""
    rows = pages.select(col(pages, "html").alias("html")).where(f"html <> '' and length(html) <= {SAMPLE_CHARS}")
    share = min(_BINS, 2 * _BINS * sample // max(rows.count(), 1) + 1)
    key = F.xxhash64("html")
    got = rows.where(F.pmod(key, F.lit(_BINS)) < share).select(key.alias("h"), "html").distinct().limit(4 * sample).collect()
    rng = np.random.default_rng(SEED)
    found = [b for r in sorted(got, key=lambda r: r["h"])[:sample] if (b := blocks(r["html"]))]
    made = [varied(found[i % len(found)], rng) for i in range(sample if found else 0)]      # few pages are varied often
    out = Labeller()
    if found:
        out.fit(made)
    return out


# ------------------------------------------------------------------ extraction
def extract(labeller: Labeller, pages: list[str | None]) -> Iterator[str]:
    """Main text of each page; pages are labelled together up to CHUNK blocks."""
    held: list[list[Block]] = []

    def label() -> Iterator[str]:
        flat = [b for page in held for b in page]
        keep = labeller.logits(flat, [len(page) for page in held]) > 0
        at = 0
        for page in held:
            yield " ".join(b.text for b, k in zip(page, keep[at:at + len(page)], strict=True) if k)
            at += len(page)

    size = 0
    for page in pages:
        held.append(blocks(page))
        size += len(held[-1])
        if size >= CHUNK:
            yield from label()
            held, size = [], 0
    yield from label()


def text_column(labeller, page: Column) -> Column:
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(list(extract(labeller.value, s.tolist())), dtype=object)
    return text_udf(run, "string")(page)


def query(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    small_batches(pages.sparkSession)
    labeller = pages.sparkSession.sparkContext.broadcast(train(pages))
    out = pages.select(col(pages, "page_id").alias("page_id"), col(pages, "url").alias("url"),
                       text_column(labeller, col(pages, "html")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
