"""Quality classifier on random-indexing word vectors.

Words (and runs of symbols) are hashed to WORDS buckets; words in capitals count apart.  Every
bucket has a fixed sparse index vector of DIMS entries, four of them +1 or -1, drawn from a
seed.  A bucket's word vector is the sum of the index vectors of the words up to SPAN places
around its occurrences in all documents: each task adds up its part, Spark adds up the
tasks' sums by bucket, and the driver gets WORDS rows whatever the corpus.  A document is
pooled to the mean and the deviation of its words' vectors, with its length and share of
distinct words.  A two-layer numpy network scores the pooled vector, and a temperature fitted
on rows that it was not trained on calibrates the probability.

The network learns from at most SAMPLE labelled rows (taken by hash, whole texts), outside the
held-out fold.  Word vectors and scores use all documents.  Two scans and no shuffle of
texts: only task sums and the bounded sample move.

Cases: null text counts as empty; an empty text has the zero vector and gets the score that
the network gives it; rows with a null label or id are not learned from; repeated label rows
count repeatedly; without labels every score is 0.5 (predicted 1), with labels of one class
the network learns that class; texts are read whole; the input's other columns never reach
the network.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, crc_mod, small_batches, text_udf
from ledgerline.llm.textcodes import DIGIT, LETTER, SPACE, UPPER, Codes, mix, portions

WORDS, DIMS, NONZERO, SPAN = 1 << 13, 32, 4, 2
POOLED = 2 * DIMS + 2
HIDDEN = 32
SAMPLE = 20_000
CALIBRATION = 5              # every fifth sampled row sets the temperature
FOLDS, HELD_OUT = 3, 1
SEED = 11
_BINS = 1 << 20


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    out = np.zeros((WORDS, DIMS), dtype=np.int8)
    place = rng.permuted(np.tile(np.arange(DIMS), (WORDS, 1)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, place, rng.choice([-1, 1], (WORDS, NONZERO)).astype(np.int8), axis=1)
    return out


def word_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text index of every word and run of symbols, in order."""
    c = Codes(texts)
    word = (c.kind & (LETTER | DIGIT)) > 0
    runs = [c.runs(word), c.runs(~word & ((c.kind & SPACE) == 0))]
    start, end = (np.concatenate([r[k] for r in runs]) for k in range(2))
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    upper = np.concatenate([[0], np.cumsum((c.kind & UPPER) > 0)])
    capitals = (upper[end] - upper[start] == end - start) & (end - start > 1)
    h = c.hashes(start, end) ^ capitals.astype(np.uint64)
    return (mix(h) & np.uint64(WORDS - 1)).astype(np.int64), c.text_of(start)


def context_sums(texts: list[str], index: np.ndarray) -> np.ndarray:
    """WORDS x DIMS sums of the index vectors around each bucket's occurrences."""
    w, text = word_buckets(texts)
    around = np.zeros((len(w), DIMS), dtype=np.int8)
    for k in range(1, SPAN + 1):
        near = (text[k:] == text[:-k])[:, None]
        around[:-k] += index[w[k:]] * near
        around[k:] += index[w[:-k]] * near
    return np.stack([np.bincount(w, weights=around[:, d], minlength=WORDS) for d in range(DIMS)], axis=1).astype(np.int64)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit word vectors of all buckets, from the whole texts of all documents."""
    names = [f"d{d}" for d in range(DIMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((WORDS, DIMS), dtype=np.int64)
        for batch in batches:
            for _, texts in portions(batch.column(0).to_pylist()):
                total += context_sums(texts, index)
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some)] + [pa.array(total[some, d]) for d in range(DIMS)], names=["bucket", *names])

    sums = docs.select(col(docs, "text").alias("text")).mapInArrow(run, ", ".join(f"{n} long" for n in ["bucket", *names]))
    rows = sums.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).collect()      # WORDS at most
    out = np.zeros((WORDS, DIMS))
    for r in rows:
        out[r["bucket"]] = r[1:]
    common = out.sum(axis=0)
    out -= np.outer(out @ common, common) / max(common @ common, 1e-9)                    # what all words share
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """POOLED features of each text."""
    w, text = word_buckets(texts)
    n = np.bincount(text, minlength=len(texts)).astype(np.float64)
    out = np.zeros((len(texts), POOLED))
    some = np.flatnonzero(n > 0)
    if len(some):
        v = vectors[w]
        first = np.searchsorted(text, some)
        mean = np.add.reduceat(v, first, axis=0) / n[some, None]
        square = np.add.reduceat(v * v, first, axis=0) / n[some, None]
        out[some, :DIMS], out[some, DIMS:2 * DIMS] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
        distinct = np.unique(text * WORDS + w) // WORDS
        out[some, -2] = np.log1p(n[some])
        out[some, -1] = np.bincount(distinct, minlength=len(texts))[some] / n[some]
    return out


class Network:
    """Two layers: tanh hidden units and one logistic output, on standardised inputs."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 3e-3):
        rng = np.random.default_rng(SEED)
        self.temperature = 1.0
        d = x.shape[1]
        self.center, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(d), np.ones(d))
        p = self.params = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)]
        p[2] += rng.normal(0, HIDDEN ** -0.5, HIDDEN) * (len(x) > 0)
        fold = np.arange(len(x)) % CALIBRATION == 0
        train, held = np.flatnonzero(~fold), np.flatnonzero(fold)
        z = (x - self.center) / self.scale
        m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(epochs):
            for some in np.array_split(rng.permutation(train), max(1, len(train) // batch)) if len(train) else []:
                h = np.tanh(z[some] @ p[0] + p[1])
                e = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - y[some]) / len(some)
                back = np.outer(e, p[2]) * (1 - h * h)
                grads = [z[some].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ e + 1e-4 * p[2], e.sum(keepdims=True)]
                t += 1
                for i, g in enumerate(grads):
                    m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                    p[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        if len(held):
            logit, want = self.logits(x[held]), y[held]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
            self.temperature = float(min(grid, key=lambda c: np.logaddexp(0, np.where(want > 0, -1, 1) * logit / c).mean()))

    def logits(self, x: np.ndarray) -> np.ndarray:
        p = self.params
        return np.tanh((x - self.center) / self.scale @ p[0] + p[1]) @ p[2] + p[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, vectors, sample: int = SAMPLE) -> Network:
    """Train on a bounded sample of the labelled rows (columns id, label)."""
    known = labels.where("id is not null and label is not null")
    n = known.count()
    share = min(_BINS, 2 * _BINS * sample // max(n, 1) + 1)
    picked = known.where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(_BINS)) < share).limit(2 * sample)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, texts in portions(batch["text"].tolist()):
                some = batch.iloc[first:first + len(texts)]
                yield pd.DataFrame({"h": some["h"], "label": some["label"],
                                    "x": [v.tobytes() for v in pooled(texts, vectors.value).astype(np.float32)]})

    texts = docs.select(col(docs, "doc_id").alias("id"), col(docs, "text").alias("text"))
    rows = texts.join(F.broadcast(picked), "id").select(F.xxhash64("id", "text").alias("h"), "label", "text") \
        .mapInPandas(run, "h long, label int, x binary").limit(2 * sample).collect()
    rows = sorted((r["h"], r["label"], r["x"]) for r in rows)[:sample]
    x = np.stack([np.frombuffer(r[2], dtype=np.float32) for r in rows]).astype(np.float64) if rows else np.zeros((0, POOLED))
    return Network(x, np.array([float(r[1] > 0) for r in rows]))


def score_column(vectors, network, text: Column) -> Column:
    """Probability of label 1; both models are broadcasts."""
    def run(s: pd.Series) -> pd.Series:
        out = [np.zeros(0)]
        for _, texts in portions(s.tolist()):
            out.append(network.value.scores(pooled(texts, vectors.value)))
        return pd.Series(np.concatenate(out))
    return text_udf(run, "double")(text)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    small_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    vectors = sc.broadcast(word_vectors(docs))
    known = labels.select(col(labels, "doc_id").alias("id"), col(labels, "quality").cast("int").alias("label"))
    network = sc.broadcast(fit(docs, known.where(crc_mod(F.col("id"), FOLDS) != HELD_OUT), vectors))
    own = col(docs, "doc_id")
    out = docs.select(own.alias("doc_id"), F.coalesce(crc_mod(own, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      score_column(vectors, network, col(docs, "text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
