"""Secret scan: base patterns and a linear-chain conditional random field.

The base patterns (assignments, access keys, hexadecimal runs) always count.  The random field
tags the tokens of the whole text as begin, inside or outside of a secret, from each token's
shape, its neighbouring words and features of the file, and is decoded by Viterbi; its spans
that overlap no base span are added as kind ``crf``.

The field is trained here by maximum likelihood (forward-backward in numpy, on the driver) on
at most SEGMENTS stretches of LENGTH tokens, tagged by the secret parts of base matches.  They come
from two bounded samples by hash, of the documents with a base match and of the others (one stretch
each), so the field learns however rare secrets are.  In a share of the stretches the neighbouring
words are hidden, so that shapes must do where no known keyword stands.
Its weights are a table of FEATURES x 3 and are broadcast.

Decoding is exact and takes few steps in Python: a token whose outside score leads by more
than any neighbours could make up by transitions is outside in the best path whatever the
rest, so the chain falls apart there, and only the stretches between are decoded, all of a
batch side by side.

Cases: null text counts as empty (no spans, digest of the empty string); without any base
match in the table the field adds nothing; repeated rows and ties get the same result (ties
go to outside, then begin); texts of any length are scanned whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, materialize, small_batches, text_udf
from ledgerline.llm.textcodes import DIGIT, LETTER, SPACE, UPPER, Codes, portions

# The base patterns, and the least length of each kind's checked part.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGNED = 12
#: The same as one pattern for Spark, for whether a text has a match.
ANY = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}"""
       r"|AKIA[A-Z0-9]{14}|[0-9a-f]{16}")
KINDS = ("assign", "access", "hex")

OUTSIDE, BEGIN, INSIDE = range(3)
SAMPLE = 4_000               # documents that training stretches are taken from, half of them with a base match
HIDE = 0.25                  # share of stretches whose neighbouring words are hidden
SEGMENTS = 3_000
LENGTH = 32
NEIGHBOURS = (-3, -2, -1, 1)
WORDS = 512
SHAPES, TURNS, FILES = 9 * 32, 9 * 8, 32
FEATURES = SHAPES + TURNS + FILES + len(NEIGHBOURS) * WORDS
PER_TOKEN = 3 + len(NEIGHBOURS)
SEED = 7
_BINS = 1 << 20


# ------------------------------------------------------------------ base patterns
def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, index of the kind, end, start of the secret part), sorted.  Hexadecimal and
    access runs are maximal, so a least length in the pattern drops just the short ones."""
    out = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGNED]
    out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


# ------------------------------------------------------------------ tokens and features
class Tokens:
    """Tokens of several texts (words with inner - + / . and runs of symbols) and their
    PER_TOKEN feature numbers."""

    def __init__(self, texts: list[str]):
        c = Codes(texts)
        core = ((c.kind & (LETTER | DIGIT)) > 0) | (c.codes == ord("_"))
        word = core.copy()
        joint = np.flatnonzero(np.isin(c.codes[1:-1], [ord(x) for x in "-+/."])) + 1
        word[joint[core[joint - 1] & core[joint + 1]]] = True
        runs = [c.runs(word), c.runs(~word & ((c.kind & SPACE) == 0))]
        start, end = (np.concatenate([r[k] for r in runs]) for k in range(2))
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
        self.text = c.text_of(start)
        self.edges = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.start, self.end = start - c.starts[self.text], end - c.starts[self.text]

        def count(flag: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flag, dtype=np.int32)])
            return sums[end] - sums[start]

        digit, upper, letter = ((c.kind & k) > 0 for k in (DIGIT, UPPER, LETTER))
        hexadecimal = digit & (c.codes < 128) | (c.lower >= ord("a")) & (c.lower <= ord("f"))
        size = end - start
        length = np.searchsorted([2, 3, 5, 8, 12, 16, 24, 40], size, side="right")
        shape = (count(digit) > 0) + 2 * (count(upper) > 0) + 4 * (count(letter & ~upper) > 0) \
            + 8 * (count(~(letter | digit)) > 0) + 16 * (count(hexadecimal) == size)
        turn = np.minimum(count(np.concatenate([[False], digit[1:] != digit[:-1]])), 7)
        # the file: share of symbols, share of digits, many lines
        long = np.maximum(c.lengths, 1)
        per = [np.add.reduceat(f.astype(np.int64), c.starts) / long if len(texts) else np.zeros(0)
               for f in (~(letter | digit | ((c.kind & SPACE) > 0)), digit)]
        file = np.searchsorted([0.02, 0.06, 0.15], per[0]) * 8 + np.searchsorted([0.001, 0.01, 0.05], per[1]) * 2 + (c.lengths > 2000)
        words = (c.hashes(start, end) & np.uint64(WORDS - 1)).astype(np.int32)
        cols = [length * 32 + shape, SHAPES + length * 8 + turn, SHAPES + TURNS + file[self.text]]
        at, n = np.arange(len(start)), len(start)
        for k, off in enumerate(NEIGHBOURS):
            j = np.clip(at + off, 0, max(n - 1, 0))
            known = (at + off == j) & (self.text[j] == self.text) if n else np.zeros(0, dtype=bool)
            cols.append(SHAPES + TURNS + FILES + k * WORDS + np.where(known, words[j] if n else 0, 0))
        self.features = np.stack(cols, axis=1).astype(np.int32)

    def tags(self, texts: list[str]) -> np.ndarray:
        """Tags by the secret parts of base matches."""
        out = np.zeros(len(self.start), dtype=np.int8)
        for i, t in enumerate(texts):
            a, b = self.edges[i], self.edges[i + 1]
            for _, _, end, secret in base_spans(t):
                first = a + np.searchsorted(self.end[a:b], secret, side="right")
                last = a + np.searchsorted(self.start[a:b], end)
                if out[first:last].any():
                    continue
                out[first:last] = INSIDE
                out[first:first + 1] = BEGIN
        return out


# ------------------------------------------------------------------ the random field
@dataclass
class Field:
    weights: np.ndarray       # FEATURES x 3
    steps: np.ndarray         # 3 x 3: from, to
    first: np.ndarray         # 3

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = self.weights[features[:, 0]].copy()
        for k in range(1, features.shape[1]):
            out += self.weights[features[:, k]]
        return out

    def decode(self, scores: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Viterbi tags of consecutive chains (edges: their bounds)."""
        n = len(scores)
        tags = np.zeros(n, dtype=np.int8)
        if not n:
            return tags
        starts = np.zeros(n + 1, dtype=bool)
        starts[edges] = True
        # what a tag other than outside can gain over outside from its neighbours
        gain_in = max((self.steps[:, 1:] - self.steps[:, :1]).max(), (self.first[1:] - self.first[0]).max())
        gain_out = max((self.steps[1:] - self.steps[:1]).max(), 0.0)
        undecided = scores[:, 0] - scores[:, 1:].max(axis=1) <= gain_in + gain_out + 1e-6
        begin = np.flatnonzero(undecided & (starts[:-1] | ~np.concatenate([[False], undecided[:-1]])))
        stop = np.flatnonzero(undecided & (starts[1:] | ~np.concatenate([undecided[1:], [False]]))) + 1
        order = np.argsort(begin - stop, kind="stable")          # longest first
        begin, stop = begin[order], stop[order]
        size = stop - begin
        if not len(begin):
            return tags
        at_start = starts[begin][:, None]
        best = scores[begin] + np.where(at_start, self.first, self.steps[0])
        back = []
        for k in range(1, int(size[0])):
            live = int(np.searchsorted(-size, -k))               # chains longer than k
            via = best[:live, :, None] + self.steps
            back.append(via.argmax(axis=1).astype(np.int8))
            best[:live] = np.take_along_axis(via, back[-1][:, None, :].astype(np.int64), axis=1)[:, 0] + scores[begin[:live] + k]
        to_end = starts[stop][:, None]
        tag = (best + np.where(to_end, 0.0, self.steps[:, 0])).argmax(axis=1)
        for k in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -k))
            tags[begin[:live] + k] = tag[:live]
            if k:
                tag[:live] = back[k - 1][np.arange(live), tag[:live]]
        return tags


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(features: np.ndarray, tags: np.ndarray, rounds: int = 50, rate: float = 0.15) -> Field | None:
    """Maximum likelihood with Adam; features: stretches x LENGTH x PER_TOKEN, -1 beyond the
    end of a stretch (tags -1 there)."""
    if not (tags == BEGIN).any():
        return None
    s, length = tags.shape
    real = tags >= 0
    index = np.where(real[:, :, None] & (features >= 0), features, FEATURES)       # one more row that stays zero
    params = [np.zeros((FEATURES + 1, 3)), np.zeros((3, 3)), np.zeros(3)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat, gold = index.reshape(-1), np.eye(3)[np.maximum(tags, 0)] * real[:, :, None]
    for t in range(1, rounds + 1):
        w, steps, first = params
        e = w[index].sum(axis=2)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + first
        for k in range(1, length):
            alpha[:, k] = np.where(real[:, k, None], _logsumexp(alpha[:, k - 1, :, None] + steps, 1) + e[:, k], alpha[:, k - 1])
        z = _logsumexp(alpha[:, -1], 1)
        pair = np.zeros((3, 3))
        for k in range(length - 1, 0, -1):
            on = real[:, k]
            after = e[on, k] + beta[on, k]
            joint = np.exp(alpha[on, k - 1, :, None] + steps + after[:, None, :] - z[on, None, None])
            pair += joint.sum(axis=0) - np.einsum("si,sj->ij", gold[on, k - 1], gold[on, k])
            beta[:, k - 1] = beta[:, k]
            beta[on, k - 1] = _logsumexp(steps + after[:, None, :], 2)
        over = (np.exp(alpha + beta - z[:, None, None]) * real[:, :, None] - gold)
        each = np.repeat(over.reshape(-1, 3), PER_TOKEN, axis=0)
        grad = np.stack([np.bincount(flat, weights=each[:, c], minlength=FEATURES + 1) for c in range(3)], axis=1)
        grad[-1] = 0
        for i, g in enumerate((grad / s + 1e-4 * w, pair / s + 1e-4 * steps, over[:, 0].sum(axis=0) / s + 1e-4 * first)):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            params[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return Field(params[0][:-1].astype(np.float32), params[1], params[2])


# ------------------------------------------------------------------ on Spark
def train(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Fit the field on stretches of a bounded sample of documents."""
    rows = docs.select(F.xxhash64(col(docs, "doc_id"), col(docs, "text")).alias("h"), col(docs, "text").alias("text")) \
        .where("text is not null")
    hit = F.col("text").rlike(ANY)
    n = {r["hit"]: r["count"] for r in rows.groupBy(hit.alias("hit")).count().collect()}          # two rows
    share, rest = (min(_BINS, _BINS * (sample // 2) // max(n.get(k, 0), 1) + 1) for k in (True, False))
    place = F.pmod("h", F.lit(_BINS))
    sampled = rows.where((place < max(share, rest)) & (place < F.when(hit, share).otherwise(rest)))

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, texts in portions(batch["text"].tolist()):
                t = Tokens(texts)
                tags, found = t.tags(texts), []
                for i in range(len(texts)):
                    a, b = t.edges[i], t.edges[i + 1]
                    h = int(batch["h"].iloc[first + i])
                    begins = a + np.flatnonzero(tags[a:b] == BEGIN)[:8] if a < b else []
                    spots = [max(a, p - (h + p) % (LENGTH - 8)) for p in begins] or ([a + h % (b - a)] if a < b else [])
                    for p in spots:
                        q = min(b, p + LENGTH)
                        x = np.full((LENGTH, PER_TOKEN), -1, dtype=np.int32)
                        y = np.full(LENGTH, -1, dtype=np.int8)
                        x[:q - p], y[:q - p] = t.features[p:q], tags[p:q]
                        found.append((h, int(p - a), bool(len(begins)), x.tobytes(), y.tobytes()))
                yield pd.DataFrame(found, columns=["h", "p", "some", "x", "y"])

    picked = materialize(docs.sparkSession, sampled.mapInPandas(
        stretches, "h long, p long, some boolean, x binary, y binary").dropDuplicates(["h", "p"]), "stretches")
    with_secret = picked.where("some").orderBy("h", "p").limit(SEGMENTS // 2).collect()
    got = with_secret + picked.where("not some").orderBy("h", "p").limit(SEGMENTS - len(with_secret)).collect()
    if not with_secret:
        return None
    x = np.stack([np.frombuffer(r["x"], dtype=np.int32).reshape(LENGTH, PER_TOKEN) for r in got])
    x[np.random.default_rng(SEED).random(len(x)) < HIDE, :, PER_TOKEN - len(NEIGHBOURS):] = -1
    return fit(x,
               np.stack([np.frombuffer(r["y"], dtype=np.int8) for r in got]))


def crf_spans(field: Field | None, texts: list[str]) -> list[list[tuple[int, int]]]:
    """Spans (start, end) of each text that the field tags as secrets."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if field is None:
        return out
    t = Tokens(texts)
    tags = field.decode(field.emissions(t.features).astype(np.float64), t.edges)
    some = np.flatnonzero(tags != OUTSIDE)
    for i in some:
        spans = out[t.text[i]]
        goes_on = tags[i] == INSIDE and i > t.edges[t.text[i]] and tags[i - 1] != OUTSIDE
        if goes_on:
            spans[-1] = (spans[-1][0], int(t.end[i]))
        else:
            spans.append((int(t.start[i]), int(t.end[i])))
    return out


def scan(field: Field | None, texts: list[str]) -> list[tuple]:
    """(n_assign, n_access, n_hex, base_sha256, spans) of each text."""
    rows = []
    for text, more in zip(texts, crf_spans(field, texts), strict=True):
        base = base_spans(text)
        counts = [sum(b[1] == k for b in base) for k in range(len(KINDS))]
        named = [(s, k, f"{KINDS[k]}:{s}:{e}") for s, k, e, _ in base]
        digest = hashlib.sha256(",".join(x[2] for x in named).encode()).hexdigest()
        named += [(s, len(KINDS), f"crf:{s}:{e}") for s, e in _apart(more, base)]
        rows.append((*counts, digest, ",".join(x[2] for x in sorted(named))))
    return rows


def _apart(spans: list[tuple[int, int]], base: list[tuple]) -> list[tuple[int, int]]:
    """The spans that overlap none of base (both sorted by start)."""
    out, i, reach = [], 0, 0
    for s, e in spans:
        while i < len(base) and base[i][0] < e:
            reach = max(reach, base[i][2])
            i += 1
        if reach <= s:
            out.append((s, e))
    return out


def scan_column(field, text: Column) -> Column:
    """struct of ``scan``; ``field`` is a broadcast."""
    def run(s: pd.Series) -> pd.DataFrame:
        rows = [r for _, texts in portions(s.tolist()) for r in scan(field.value, texts)]
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return text_udf(run, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")(text)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    small_batches(docs.sparkSession)
    field = docs.sparkSession.sparkContext.broadcast(train(docs))
    out = docs.select(col(docs, "doc_id").alias("doc_id"), scan_column(field, col(docs, "text")).alias("_s"))
    return out.select("doc_id", *[F.col(f"_s.{c}") for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")])
