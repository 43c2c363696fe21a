"""Benchmark decontamination by template canonicalisation.

Every token of a text becomes itself in lower case or a typed placeholder: a number (it
starts with a digit or is one of NUMBER_WORDS), a unit (a word of UNITS after a number) or a name
(a capitalised word that does not begin a sentence).  A run of names or of numbers, with no more than
a space, hyphen or slash between, is one placeholder whose value is the run: "Mary Ann" may
stand for "Tom", "3 1/2" or "twenty five" for "7".  Whether a capitalised word that begins a sentence is a name
cannot be seen, so a text is read in three ways: such words are literals, all are names, or
those are that are names elsewhere in the text.  Windows of ``WINDOW`` template tokens are hashed on both
sides, reading by reading, and joined on the hash; windows with fewer than ``MIN_LITERALS`` tokens that are no
placeholder are too general and not used.  An item shorter than a window is one window.

Slot consistency: windows of one document and item on the same alignment (document place
minus item place, both counted in placeholders and literals) must fill each of the item's slot values with one value throughout, as a
re-parameterised question does; an alignment that does so in no reading is dropped.  A document contains
an item if consistent windows of any reading cover MIN_COVERED of the item's tokens, or all of a shorter
item.  ``kind`` is verbatim if all slots of an alignment are filled as in the item, else
reparameterised.

A fourth, plain reading takes all tokens as they are in lower case, without a least number of
literals; it finds verbatim copies whatever their case and line breaks, and those of items
without usable template windows.

The benchmark's window hashes are broadcast as a prefilter while they are at most
MAX_BROADCAST, and its window rows while they are at most MAX_BROADCAST_ROWS
(both counted first); without them, all windows of all documents are shuffled on the
hash, with the same result.  A passage that very many documents hold only repeats a key on
the documents' side of the join, which Spark can split; from there on keys are document and
item.

Cases: null and empty texts hold nothing and are in no item; items of one token or of
numbers alone match nothing; rows with a null item_id are left out; repeated document rows (same doc_id and
text) are one; a null doc_id is told apart by its text's hash; extra columns are ignored by
``contaminated`` and kept by ``remove_contaminated``; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, free_name, materialize, small_batches
from ledgerline.llm.textcodes import DIGIT, LETTER, UPPER, Codes, mix, portions

WINDOW = 8
MIN_LITERALS = 4
MIN_COVERED = 13
MAX_BROADCAST = 1 << 21      # window hashes, 8 bytes each
MAX_BROADCAST_ROWS = 1 << 17  # window rows, about 100 bytes each

#: Units that count as such after a number.
UNITS = ("mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "foot", "yard", "yards", "mile", "miles",
         "mg", "g", "kg", "t", "ton", "tons", "oz", "ounce", "ounces", "lb", "lbs", "pound", "pounds",
         "ml", "cl", "l", "liter", "liters", "litre", "litres", "gallon", "gallons",
         "ms", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hr", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years",
         "percent", "degree", "degrees", "dollar", "dollars", "cent", "cents", "euro", "euros",
         "kb", "mb", "gb", "tb", "hz", "khz", "mhz", "ghz", "w", "kw", "v", "a", "j", "kj", "n", "pa", "mph")
#: Code points after which a word begins a sentence.
SENTENCE_ENDS = '.!?:;\n\r"“”„«»'
#: Words that are numbers.
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve",
                "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty",
                "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion")
LITERAL, NUMBER, UNIT, NAME = range(4)
#: Readings of a capitalised word that begins a sentence, and the plain one.
AS_LITERAL, AS_NAME, AS_KNOWN, PLAIN = range(4)


class Template:
    """Tokens of several texts (start, end, text index, place), and by reading the template: of
    each placeholder or literal its first and last token, kind and hash."""

    def __init__(self, texts: list[str]):
        c = self.codes = Codes(texts)
        word = (c.kind & (LETTER | DIGIT)) > 0
        digit = (c.kind & DIGIT) > 0
        point = np.flatnonzero(np.isin(c.codes[1:-1], [ord("."), ord(",")])) + 1
        word[point[digit[point - 1] & digit[point + 1]]] = True         # 1,000.5 is one number
        self.start, self.end = c.runs(word)
        self.text = c.text_of(self.start)
        hashes = c.hashes(self.start, self.end)
        ends = np.cumsum(np.isin(c.codes, [ord(x) for x in SENTENCE_ENDS]))
        first = np.concatenate([[True], self.text[1:] != self.text[:-1]])[: len(self.start)]
        before = np.concatenate([[0], ends[self.end[:-1] - 1]])[: len(self.start)]
        begins = first | (ends[self.start] > before)
        upper = (c.kind & UPPER) > 0
        second = np.minimum(self.start + 1, len(c.codes) - 1)
        capital = upper[self.start] & (self.end - self.start > 1) & ~upper[second] & ((c.kind[second] & LETTER) > 0)
        owned = hashes + mix(self.text.astype(np.uint64))             # a word of a text
        known = np.zeros(len(self.start), dtype=bool)
        known[capital & begins] = np.isin(owned[capital & begins], owned[capital & ~begins])
        digits = digit[self.start]
        words = np.isin(hashes, _word_hashes(NUMBER_WORDS))
        number = digits | words
        unit = np.concatenate([[False], number[:-1] & ~first[1:]])[: len(number)] & np.isin(hashes, _word_hashes(UNITS)) & ~number
        # what may stand between the tokens of a run
        between = c.codes[self.end[:-1]]
        near = (self.start[1:] == self.end[:-1] + 1) & (self.text[1:] == self.text[:-1])
        space, hyphen = between == ord(" "), between == ord("-")
        numbers = near & (space | (between == ord("/")) | hyphen & (words[1:] | words[:-1]))
        names = near & (space | hyphen | (between == ord("\n")))
        self.kind, self.hash, self.first, self.last = [], [], [], []
        for name in (capital & ~begins, capital, capital & ~begins | known):
            kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, LITERAL)))
            run = (kind[1:] == kind[:-1]) & ((kind[1:] == NUMBER) & numbers | (kind[1:] == NAME) & names)
            self._reading(np.concatenate([[False], run])[: len(kind)], kind,
                          np.where(kind == LITERAL, hashes, mix(kind.astype(np.uint64))))
        self._reading(np.zeros(len(number), dtype=bool), np.full(len(number), LITERAL), hashes)
        # places of tokens for alignments are counted in the template with all names, in every reading
        head = np.zeros(len(number), dtype=np.int64)
        head[self.first[AS_NAME]] = 1
        self.place = np.cumsum(head)
        count = np.bincount(self.text, minlength=len(texts))
        #: texts whose plain windows say enough: more than one token, not numbers alone
        self.telling = (count > 1) & (np.bincount(self.text[digits], minlength=len(texts)) < count)

    def _reading(self, joined: np.ndarray, kind: np.ndarray, hashes: np.ndarray) -> None:
        """``joined``: tokens that go on the placeholder of the token before."""
        first = np.flatnonzero(~joined)
        self.first.append(first)
        self.last.append(np.concatenate([first[1:], [len(joined)]])[: len(first)] - 1)
        self.kind.append(kind[first])
        self.hash.append(hashes[first])

    def windows(self, n: int, reading: int) -> tuple[np.ndarray, np.ndarray]:
        """First elements of the reading's template and hashes of its usable windows of n."""
        text = self.text[self.first[reading]]
        k = len(text) - n + 1
        if k <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        h = np.full(k, n + (reading << 32), dtype=np.uint64)
        for i in range(n):
            h = h * np.uint64(0x2545F4914F6CDD1D) + self.hash[reading][i:i + k]
        usable = text[n - 1:] == text[:k]
        if reading != PLAIN:
            literal = np.concatenate([[0], np.cumsum(self.kind[reading] == LITERAL)])
            usable &= literal[n:] - literal[:k] >= MIN_LITERALS
        at = np.flatnonzero(usable)
        return at, mix(h[at])

    def slots(self, texts: list[str], at: int, n: int, reading: int) -> list[str]:
        """Kind and value of each placeholder of the window of n from element ``at``."""
        out, kind, first, last = [], self.kind[reading], self.first[reading], self.last[reading]
        for i in range(at, at + n):
            if kind[i] != LITERAL:
                text = self.text[first[i]]
                base = self.codes.starts[text]
                out.append(f"{kind[i]}:{' '.join(texts[text][self.start[first[i]] - base:self.end[last[i]] - base].lower().split())}")
        return out


_HASHES: dict[tuple[str, ...], np.ndarray] = {}


def _word_hashes(words: tuple[str, ...]) -> np.ndarray:
    if words not in _HASHES:
        c = Codes(list(words))
        _HASHES[words] = c.hashes(c.starts, c.starts + c.lengths)
    return _HASHES[words]


def _windows(rows: DataFrame, keys: list[str], lengths: list[int], short: bool, wanted=None) -> DataFrame:
    """``keys``, n_tokens (of the text), place, first and last token, length, reading, hash and slots of the
    windows of column ``text``: of each of ``lengths``, or if ``short`` of WINDOW or a whole shorter template.
    ``wanted``: broadcast of the sorted hashes outside which windows are not needed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in portions(batch.column(len(keys)).to_pylist()):
                t = Template(texts)
                count = np.bincount(t.text, minlength=len(texts))
                token0 = np.concatenate([[0], np.cumsum(count)])
                found = []
                for reading in (AS_LITERAL, AS_NAME, AS_KNOWN, PLAIN):
                    of = t.text[t.first[reading]]
                    size = np.bincount(of, minlength=len(texts))
                    for n in sorted({WINDOW, *(set(size[size < WINDOW].tolist()) - {0} if short else lengths)}):
                        at, h = t.windows(n, reading)
                        if short and n < WINDOW:
                            keep = size[of[at]] == n
                            at, h = at[keep], h[keep]
                        if short and reading == PLAIN:
                            keep = t.telling[of[at]]
                            at, h = at[keep], h[keep]
                        if wanted is not None:
                            keep = _contains(wanted.value, h)
                            at, h = at[keep], h[keep]
                        found.append((at, t.first[reading][at], t.last[reading][at + n - 1], h, np.full(len(at), n), np.full(len(at), reading)))
                at, first, last, h, n, reading = (np.concatenate(x) for x in zip(*found, strict=True))
                of = t.text[first]
                places = t.place[first] - t.place[token0[of]] if len(first) else first
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).take(pa.array(of + begin)) for k in range(len(keys))]
                    + [pa.array(x.astype(np.int32)) for x in (count[of], places, first - token0[of], last - token0[of], n, reading)]
                    + [pa.array(h.view(np.int64)),
                       pa.array([t.slots(texts, int(a), int(k), int(r)) for a, k, r in zip(at, n, reading, strict=True)],
                                pa.list_(pa.string()))],
                    names=[*keys, "n_tokens", "place", "first", "last", "length", "reading", "hash", "slots"])

    kinds = dict(rows.dtypes)
    schema = ", ".join([f"{k} {kinds[k]}" for k in keys]
                       + ["n_tokens int, place int, first int, last int, length int, reading int, hash long, slots array<string>"])
    return rows.select(*keys, "text").mapInArrow(run, schema)


def _contains(wanted: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of h are in the sorted ``wanted``: a table of their low bits first, then a search."""
    table = np.zeros(1 << 22, dtype=bool)
    table[wanted & np.uint64((1 << 22) - 1)] = True
    out = table[h & np.uint64((1 << 22) - 1)]
    some = np.flatnonzero(out)
    if len(some):
        out[some] = wanted[np.minimum(np.searchsorted(wanted, h[some]), len(wanted) - 1)] == h[some]
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """A row for every document and benchmark item that it contains: doc_id, text_key (hash of
    the text), item_id, n_item_tokens, n_covered, kind."""
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(col(benchmark, "item_id").alias("item_id"), col(benchmark, "text").alias("text")) \
        .where("item_id is not null")
    items = materialize(spark, _windows(items, ["item_id"], [], short=True), "benchmark-windows")
    items = items.select("item_id", F.col("n_tokens").alias("n_item_tokens"), F.col("place").alias("item_place"),
                         F.struct("first", "last").alias("item_span"), "length", "reading", "hash", F.col("slots").alias("item_slots")).distinct()
    lengths = [r[0] for r in items.select("length").distinct().collect()]           # WINDOW of them at most
    wanted = None
    hashes = items.select("hash").distinct().limit(max_broadcast + 1)
    if hashes.count() <= max_broadcast:
        found = np.array([r[0] for r in hashes.collect()], dtype=np.int64).view(np.uint64)
        wanted = spark.sparkContext.broadcast(np.sort(found))
    if items.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        items = F.broadcast(items)
    rows = docs.select(col(docs, "doc_id").alias("doc_id"), F.xxhash64(col(docs, "text")).alias("text_key"),
                       col(docs, "text").alias("text")).where("text is not null")
    if not lengths:
        rows = rows.limit(0)
    # repeated rows of a document give the same windows; sets below make them one
    pairs = _windows(rows, ["doc_id", "text_key"], lengths, short=False, wanted=wanted).drop("first", "last").join(items, ["hash", "length", "reading"])
    value = F.zip_with("item_slots", "slots", lambda i, d: F.struct(i.alias("item"), d.alias("doc")))
    line = ["doc_id", "text_key", "item_id", "n_item_tokens", "length", "_line"]
    lined = pairs.withColumn("_line", F.col("place") - F.col("item_place")).groupBy(*line, "reading").agg(
        F.collect_set("item_span").alias("spans"),
        F.array_distinct(F.flatten(F.collect_set(value))).alias("filled"))
    consistent = F.size("filled") == F.size(F.array_distinct(F.transform("filled", lambda x: x["item"])))
    tokens = F.array_distinct(F.flatten(F.transform("spans", lambda p: F.sequence(p["first"], p["last"]))))
    plain, same = F.col("reading") == PLAIN, F.forall("filled", lambda x: x["item"] == x["doc"])
    # an alignment of which no template reading is consistent has no plain windows either
    aligned = lined.withColumn("_ok", consistent).groupBy(*line).agg(
        F.flatten(F.collect_set(F.when(F.col("_ok") & ~plain, tokens))).alias("_template"),
        F.flatten(F.collect_set(F.when(plain, tokens))).alias("_plain"),
        F.max(F.when(~plain, F.col("_ok"))).alias("_any"), F.min(F.when(F.col("_ok") & ~plain, same)).alias("_same"))
    aligned = aligned.where(F.coalesce("_any", F.lit(True)))
    covered = aligned.groupBy("doc_id", "text_key", "item_id", "n_item_tokens").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(F.array_distinct(F.concat("_template", "_plain")))))).cast("long").alias("n_covered"),
        F.coalesce(F.max("_same"), F.lit(True)).alias("_same"))
    return covered.where(F.col("n_covered") >= F.least(F.lit(MIN_COVERED), F.col("n_item_tokens"))).select(
        "doc_id", "text_key", "item_id", F.col("n_item_tokens").cast("long").alias("n_item_tokens"), "n_covered",
        F.when(F.col("_same"), "verbatim").otherwise("reparameterised").alias("kind"))


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item_tokens, n_covered, kind for every contained item."""
    return contaminated(docs, benchmark).drop("text_key").distinct()


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")).distinct()
    bad = materialize(docs.sparkSession, bad, "contaminated")
    name = free_name(docs, "_text_key")
    rows = docs.withColumn(name, F.xxhash64(col(docs, "text")))
    same = col(rows, "doc_id").eqNullSafe(bad["_bad_id"]) & (col(rows, name) == bad["_bad_key"])
    return rows.join(bad, same, "left_anti").drop(name)
