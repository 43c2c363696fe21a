"""Language identification with error-correcting output codes.

Every language gets a codeword of +1 and -1.  For each bit a binary classifier (logistic,
on hashed character n-grams of one to three) tells on which side of the bit's split a text
lies.  Decoding is loss-weighted: for each language the logistic losses of the bits against
its codeword are summed, each weighted by how well that bit's classifier did on that
language's training texts, and the nearest codeword wins.  A text whose best two
codewords are closer than MARGIN is flagged ambiguous.

Every text with a letter gets the learned language of the nearest codeword.  Whether a document
is in any learned language is a matter for ``keep_identified`` alone, and there only for the
decoder's own evidence: a text goes if its bits abstain (their mean margin is under ABSTAIN, as
in a script that was never learned) or contradict every codeword (the distance to the nearest one
is at least log 2, that of bits that know nothing).  Both limits ease continuously for
short texts, which show little: a text of DOUBT letters is never judged by its margin.  Such
a text is looked at again in stretches of STRETCH characters and stays if the bits speak in any,
so a text in several learned languages, whose bits cancel out over the whole, stays; so does
text of a foreign language in a learned script that looks like one of the learned.

The classifiers are fitted on the driver on at most SAMPLE_PER_LANGUAGE labelled texts a
language (taken by hash, whole texts; their n-gram vectors are made by Spark tasks, DIMS
floats each).  The model is a few hundred KB and is broadcast; prediction is one scan
without a shuffle.

Cases: a null text or one without a letter is ``und`` with score 0, as is every text when
nothing was learned (``keep_identified`` then keeps all with a letter); one learned language
is predicted for all other texts, and nothing with a letter goes; rows with a null label, text
or id are not learned from; repeated rows are predicted alike; texts of any length are read
whole; ties go to the first language by name; the input's other columns, whatever their
names, never reach the classifier.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, crc_mod, free_name, small_batches, text_udf
from ledgerline.llm.textcodes import LETTER, Codes, portions

DIMS = 1 << 12
SAMPLE_PER_LANGUAGE = 300
MAX_LANGUAGES = 1 << 10
MARGIN = 0.02
ABSTAIN = 1.25               # mean margin of the bits (log odds) under which they do not speak
DOUBT = 30                   # letters; limits of a text of n letters are eased by DOUBT / n
STRETCH = 400                # characters of the stretches that a silent text is looked at in
FOLDS, HELD_OUT = 4, 2
UNDETERMINED = "und"
_BINS = 1 << 20


# ------------------------------------------------------------------ features
def ngram_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of root-scaled, unit-length hashed n-gram counts, and each text's number of letters.
    Letters are lower-cased; every run of other characters counts as one space."""
    c = Codes(texts)
    letter = (c.kind & LETTER) > 0
    codes = np.where(letter, c.lower, np.uint32(32)).astype(np.uint64)
    keep = letter | np.concatenate([[True], letter[:-1]])
    text = np.repeat(np.arange(len(texts)), c.lengths + 1)[keep]
    codes = codes[keep]
    counts = np.zeros((len(texts), DIMS), dtype=np.float32)
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in (1, 2, 3):
        h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:] + np.uint64(n)
        cell = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 12)).astype(np.int64)
        for i in range(len(texts)):
            if (b := edges[i + 1] - n + 1) > edges[i]:
                counts[i] += np.bincount(cell[edges[i]:b], minlength=DIMS)
    counts = np.sqrt(counts)
    norm = np.linalg.norm(counts, axis=1, keepdims=True)
    letters = np.add.reduceat(letter.astype(np.int64), c.starts) if len(texts) else np.zeros(0, dtype=np.int64)
    return counts / np.maximum(norm, 1e-9), letters


# ------------------------------------------------------------------ codewords and training
def codewords(k: int) -> np.ndarray:
    """k codewords: all splits of the languages for up to 5, rows of a Hadamard matrix beyond."""
    if k < 2:
        return np.ones((k, 0))
    if k <= 5:
        splits = [[1] + [1 if s >> i & 1 else -1 for i in range(k - 1)] for s in range((1 << (k - 1)) - 1)]
        return np.array(splits, dtype=np.float64).T
    h = np.ones((1, 1))
    while len(h) < max(16, k):
        h = np.block([[h, h], [h, -h]])
    h = h[:k, 1:]
    return h[:, np.abs(h.sum(axis=0)) < k]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray          # languages x bits
    weights: np.ndarray       # DIMS + 1 x bits
    trust: np.ndarray         # languages x bits, rows sum to 1


def fit(x: np.ndarray, labels: list[str], steps: int = 150, rate: float = 0.3) -> Model:
    """Fit all bit classifiers together by Adam on the regularised logistic loss, languages
    weighted equally."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    y = np.searchsorted(languages, labels) if len(labels) else np.zeros(0, dtype=np.int64)
    x = np.concatenate([x, np.ones((len(x), 1), dtype=np.float32)], axis=1)
    w = np.zeros((x.shape[1], code.shape[1]))
    if code.shape[1]:
        share = (1 / np.bincount(y, minlength=len(languages)) / len(languages))[y][:, None]
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, steps + 1):
            s = code[y]
            g = x.T @ (-s / (1 + np.exp(np.clip(s * (x @ w), -30, 30))) * share) + 1e-5 * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        right = (code[y] * (x @ w) > 0).astype(np.float64)
        trust = np.stack([right[y == i].mean(axis=0) for i in range(len(languages))]) + 1e-3
        trust /= trust.sum(axis=1, keepdims=True)
    else:
        trust = np.ones_like(code)
    return Model(languages, code, w.astype(np.float32), trust)


@dataclass
class Decoded:
    best: np.ndarray          # index of the nearest codeword
    score: np.ndarray         # its share of exp(-bits * distance)
    ambiguous: np.ndarray
    distance: np.ndarray      # to the nearest codeword
    margin: np.ndarray        # mean size of the bits' log odds

    def speaks(self, letters: np.ndarray) -> np.ndarray:
        """Whether the bits stand behind some codeword, given each text's letters."""
        ease = DOUBT / np.maximum(letters, 1)
        return (self.margin >= ABSTAIN * (1 - ease)) & (self.distance < np.log(2) * (1 + ease))


def decode(model: Model, x: np.ndarray) -> Decoded:
    n, k = len(x), len(model.languages)
    if model.code.shape[1] == 0:
        return Decoded(np.zeros(n, dtype=np.int64), np.full(n, float(k > 0)), np.zeros(n, dtype=bool), np.zeros(n), np.full(n, np.inf))
    f = x @ model.weights[:-1] + model.weights[-1]
    loss = np.logaddexp(0, -model.code[None] * f[:, None, :])
    distance = (loss * model.trust[None]).sum(axis=2)
    order = np.sort(distance, axis=1)
    odds = np.exp(-model.code.shape[1] * (distance - order[:, :1]))
    return Decoded(distance.argmin(axis=1), 1 / odds.sum(axis=1), order[:, 1] - order[:, 0] < MARGIN, order[:, 0], np.abs(f).mean(axis=1))


def speaks(model: Model, texts: list[str], found: Decoded, letters: np.ndarray) -> np.ndarray:
    """Whether the bits speak for a learned language, over the whole of a text or in a stretch of it."""
    out = found.speaks(letters)
    for i in np.flatnonzero(~out & (letters > 0)).tolist():
        for _, parts in portions([texts[i][a:a + STRETCH] for a in range(0, len(texts[i]), STRETCH)]):
            x, n = ngram_vectors(parts)
            if decode(model, x).speaks(n)[n > DOUBT].any():
                out[i] = True
                break
    return out


# ------------------------------------------------------------------ on Spark
def train(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on a bounded sample of rows with columns id, text and lang."""
    rows = labelled.where("id is not null and text is not null and lang is not null")
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return fit(np.zeros((0, DIMS), dtype=np.float32), [])
    bins = {lang: min(_BINS, 2 * _BINS * per_language // n + 1) for lang, n in counts.items()}
    share = F.create_map(*[F.lit(v) for kv in bins.items() for v in kv])[F.col("lang")]
    picked = rows.withColumn("_h", F.xxhash64("id", "text")).where(F.pmod(F.col("_h"), F.lit(_BINS)) < share)
    picked = picked.dropDuplicates(["_h", "lang"])          # about twice per_language a language, however often a row is repeated

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, texts in portions(batch["text"].tolist()):
                some = batch.iloc[first:first + len(texts)]
                yield pd.DataFrame({"h": some["_h"], "lang": some["lang"],
                                    "x": [v.tobytes() for v in ngram_vectors(texts)[0].astype(np.float32)]})

    got = sorted((r["lang"], r["h"], r["x"]) for r in picked.select("_h", "lang", "text").mapInPandas(
        vectors, "h long, lang string, x binary").collect())
    seen: Counter = Counter()
    kept = []
    for lang, _, x in got:
        seen[lang] += 1
        if seen[lang] <= per_language:
            kept.append((lang, np.frombuffer(x, dtype=np.float32)))
    return fit(np.stack([x for _, x in kept]) if kept else np.zeros((0, DIMS), dtype=np.float32), [lang for lang, _ in kept])


def language_column(model, text: Column) -> Column:
    """struct(lang_pred, score, ambiguous, letters, speaks); ``model`` is a broadcast Model.
    ``speaks``: whether the decoder's bits stand behind a learned language."""
    def run(s: pd.Series) -> pd.DataFrame:
        m: Model = model.value
        out = [pd.DataFrame({"lang_pred": [], "score": [], "ambiguous": [], "letters": [], "speaks": []})]
        for _, texts in portions(s.tolist()):
            for i in range(0, len(texts), 512):
                x, letters = ngram_vectors(texts[i:i + 512])
                found = decode(m, x)
                known = (letters > 0) & (len(m.languages) > 0)
                names = np.array([*m.languages, UNDETERMINED], dtype=object)
                out.append(pd.DataFrame({"lang_pred": names[np.where(known, found.best, len(m.languages))],
                                         "score": np.where(known, found.score, 0.0), "ambiguous": found.ambiguous & known,
                                         "letters": letters > 0, "speaks": known & speaks(m, texts[i:i + 512], found, letters)}))
        return pd.concat(out, ignore_index=True).astype({"score": float, "ambiguous": bool, "letters": bool, "speaks": bool})
    return text_udf(run, "lang_pred string, score double, ambiguous boolean, letters boolean, speaks boolean")(text)


def fitted(docs: DataFrame):
    """Broadcast model learned from ``docs`` outside the held-out fold."""
    small_batches(docs.sparkSession)
    own = docs.select(col(docs, "doc_id").alias("id"), col(docs, "text").alias("text"), col(docs, "lang").alias("lang"))
    return docs.sparkSession.sparkContext.broadcast(train(own.where(crc_mod(F.col("id"), FOLDS) != HELD_OUT)))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every document."""
    own = col(docs, "doc_id")
    out = docs.select(own.alias("doc_id"), F.coalesce(crc_mod(own, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      language_column(fitted(docs), col(docs, "text")).alias("_l"))
    return out.select("doc_id", "held_out", F.col("_l.lang_pred"), F.col("_l.score"), F.col("_l.ambiguous"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without texts that have no letter or in which the decoder's bits do not speak
    for any learned language.  Ambiguous texts stay: they are in one or two of the learned
    languages.  If none was learned, all texts with a letter stay."""
    name = free_name(docs, "_language")
    model = fitted(docs)
    out = docs.withColumn(name, language_column(model, col(docs, "text")))
    found = col(out, name)
    return out.where(found["speaks"] if model.value.languages else found["letters"]).drop(name)
