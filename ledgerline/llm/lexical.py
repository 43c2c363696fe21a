"""Ranked lexical search over posting lists cut into geometric blocks.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
lower-cased.  A document's score for an item is the sum over the item's terms, once each, of
weight times impact, all in integers (``weights`` and ``impacts``).

Three Spark stages:

1. one pass over the texts writes the forward table: length and term frequencies, of the
   terms that some item asks for;
2. aggregates of it give the document count, the total length and the document frequencies;
3. a pass over the forward table searches it shard by shard.  A shard holds a bounded number
   of documents, wherever they lie, so a term that every document has is dealt over all
   shards.  In a shard each term's posting list is clustered by document similarity (nearest
   of evenly chosen members, on a random projection of the weighted impacts) into blocks of
   about BLOCK documents.  A block's summary is the coordinatewise maximum of its documents'
   impacts, over all terms that items with this term hold.  Summary times weights bounds every
   document of the block; a block is skipped for an item only if that bound is below the
   item's k-th best score so far.  A bound equal to it is looked into, as ties go by id.

Every document with a score above 0 stands in a posting list of each of its item's terms, so
it is skipped only where its own score cannot reach the best k: results are exact.  Tasks send
k rows an item, ranked by one window.  Items go in blocks of ITEMS, each searched against all
documents; a block's vocabulary is what is broadcast.

Cases: null or empty texts have no term and do not count as documents; items without terms and
items that no document matches give no rows; rows with one item_id are one item (their terms
together); a null item_id is an item; repeated documents are documents of their own; equal
scores rank by ascending doc_id, null last; long texts are read whole; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import col, materialize, small_batches

TOP = 10
BLOCK = 64                   # documents of a block, on average
ITEMS = 512                  # items that are searched together
SHARD_DOCS, SHARD_CELLS = 4096, 1 << 24
PROJECTED = 16
EXACT = 1 << 53              # sums below this are exact in doubles

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
FORWARD = "doc_id long, n long, terms array<int>, counts array<long>"
FOUND = "item int, doc_id long, score long"


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_LOWER))


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """Impact of a term that occurs tf times in a document of n terms."""
    m = 100 - 90 + (90 * n * n_docs) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# ------------------------------------------------------------------ forward table
def forward_table(docs: DataFrame, vocabulary) -> DataFrame:
    """Length, term ids and term frequencies of the documents that have a term.
    ``vocabulary``: broadcast {term: id}."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            ids, lengths, found, counts = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if n := len(held := terms(text.as_py())):
                    own = sorted((known[t], c) for t, c in Counter(held).items() if t in known)
                    ids.append(doc)
                    lengths.append(n)
                    found.append([t for t, _ in own])
                    counts.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "counts"])

    return docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), col(docs, "text").alias("text")).mapInArrow(run, FORWARD)


# ------------------------------------------------------------------ a shard
class Best:
    """The best k (score, document) of each item so far, documents ordered by id with null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool))] * items
        self.least = np.ones(items, dtype=np.int64)          # scores below this cannot enter

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        if not (keep := score >= self.least[item]).any():
            return
        s, i, z = (np.concatenate([a, b[keep]]) for a, b in zip(self.rows[item], (score, ids, null), strict=True))
        order = np.lexsort((i, z, -s))[: self.k]
        self.rows[item] = s[order], i[order], z[order]
        if len(order) == self.k:
            self.least[item] = s[order[-1]]


class Queries:
    """Items as a weight matrix (items x terms) and the items of each term."""

    def __init__(self, asked: list[np.ndarray], weight: np.ndarray):
        self.asked = [t[weight[t] > 0] for t in asked]
        exact = all(int(weight[t].sum()) * 1_000_000 < EXACT for t in asked)
        self.weight = weight
        self.matrix = np.zeros((len(asked), len(weight)), dtype=np.float64 if exact else np.int64)
        for i, t in enumerate(self.asked):
            self.matrix[i, t] = weight[t]
        holders = [[] for _ in range(len(weight))]
        for i, t in enumerate(self.asked):
            for x in t.tolist():
                holders[x].append(i)
        self.holders = [np.array(h, dtype=np.int64) for h in holders]
        self.order = sorted((t for t, h in enumerate(holders) if h), key=lambda t: -weight[t])   # rare terms first
        self.projection = np.random.default_rng(7).choice(np.float32([-1, 1]), (len(weight), PROJECTED)) * weight[:, None].astype(np.float32)


def blocks_of(points: np.ndarray, size: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points and the starts of blocks: each point joins the most similar of evenly
    chosen members; clusters longer than twice ``size`` are cut."""
    n = len(points)
    if n <= size:
        return np.arange(n), np.zeros(1, dtype=np.int64)
    leaders = points[np.linspace(0, n - 1, -(-n // size)).astype(np.int64)]
    cluster = (points @ leaders.T).argmax(axis=1)
    order = np.argsort(cluster, kind="stable")
    first = np.flatnonzero(np.diff(cluster[order], prepend=-1))
    inside = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return order, np.flatnonzero(inside % (2 * size) == 0)


def search_shard(q: Queries, ids: np.ndarray, null: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray,
                 best: Best, seen: Counter | None = None) -> None:
    """Add a shard's documents to ``best``.  doc, term, impact: its postings by document.
    ``seen`` counts the documents scored and the block visits skipped."""
    n = len(ids)
    dense = np.zeros((n, len(q.weight)), dtype=np.float32)     # impacts are at most 10^6, exact in float32
    dense[doc, term] = impact
    points = np.zeros((n, PROJECTED), dtype=np.float32)
    if len(doc):
        own, at = np.unique(doc, return_index=True)
        points[own] = np.add.reduceat(q.projection[term] * impact[:, None].astype(np.float32), at, axis=0)
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    by_term = np.argsort(term, kind="stable")
    edges = np.searchsorted(term[by_term], np.arange(len(q.weight) + 1))
    done = np.zeros((len(q.asked), n), dtype=bool)
    for t in q.order:
        members = doc[by_term[edges[t]:edges[t + 1]]]
        if not len(members):
            continue
        holders = q.holders[t]
        order, starts = blocks_of(points[members])
        members = members[order]
        asked = np.unique(np.concatenate([q.asked[i] for i in holders]))
        summary = np.maximum.reduceat(dense[np.ix_(members, asked)], starts, axis=0).astype(q.matrix.dtype)
        bound = summary @ q.matrix[np.ix_(holders, asked)].T                       # blocks x items, exact
        alive = bound >= best.least[holders]
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(members))))
        for j, i in enumerate(holders.tolist()):
            if seen is not None:
                seen["skipped"] += int((~alive[:, j]).sum())
            if not alive[:, j].any():
                continue
            some = members[alive[of, j] & ~done[i, members]]
            if len(some):
                done[i, some] = True
                score = dense[np.ix_(some, q.asked[i])].astype(np.int64) @ q.weight[q.asked[i]]
                best.add(i, score, ids[some], null[some])
                if seen is not None:
                    seen["scored"] += len(some)


# ------------------------------------------------------------------ on Spark
def search_block(forward: DataFrame, asked: list[np.ndarray], weight: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best k documents of every item."""
    model = forward.sparkSession.sparkContext.broadcast((asked, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Queries(*model.value)
        best = Best(len(q.asked), k)
        size = max(BLOCK, min(SHARD_DOCS, SHARD_CELLS // max(1, len(q.weight))))
        held, rows = [], 0

        def flush() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            null = table["doc_id"].is_null().to_numpy()
            ids = table["doc_id"].fill_null(0).to_numpy()
            found, counts = (pa.concat_arrays(table[c].chunks) for c in ("terms", "counts"))
            doc = np.repeat(np.arange(len(ids)), found.value_lengths().to_numpy())
            value = impacts(counts.flatten().to_numpy(), table["n"].to_numpy()[doc], n_docs, total)
            search_shard(q, ids, null, doc, found.flatten().to_numpy(), value, best)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(part := batch.slice(at, size - rows))
                at, rows = at + part.num_rows, rows + part.num_rows
                if rows == size:
                    flush()
                    held, rows = [], 0
        if rows:
            flush()
        item = np.repeat(np.arange(len(best.rows)), [len(r[0]) for r in best.rows])
        score, ids, null = (np.concatenate([r[c] for r in best.rows] or [np.zeros(0)]) for c in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(ids.astype(np.int64), mask=null.astype(bool)),
                                          pa.array(score.astype(np.int64))], names=["item", "doc_id", "score"])

    return forward.where(F.size("terms") > 0).select("doc_id", "n", "terms", "counts").mapInArrow(run, FOUND)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and its distinct terms."""
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(set(terms(t))))
    found = items.select(col(items, "item_id").alias("item_id"), F.explode(F.pandas_udf(run, "array<string>")(col(items, "text"))).alias("t"))
    return found.groupBy("item_id").agg(F.sort_array(F.collect_set("t")).alias("terms"))


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item, scores above 0."""
    spark = docs.sparkSession
    small_batches(spark)
    queries = materialize(spark, item_terms(items), "lexical-items")
    blocks = max(1, -(-queries.count() // ITEMS))
    out = []
    for b in range(blocks):
        # about ITEMS rows, and their vocabulary, are what a block brings to the driver
        rows = sorted((r for r in queries.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()),
                      key=lambda r: (r["item_id"] is None, r["item_id"] or 0))
        vocabulary = {t: i for i, t in enumerate(sorted({t for r in rows for t in r["terms"]}))}
        asked = [np.array(sorted(vocabulary[t] for t in r["terms"]), dtype=np.int64) for r in rows]
        forward = materialize(spark, forward_table(docs, spark.sparkContext.broadcast(vocabulary)), "lexical-forward")
        n_docs, total = forward.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for t, n in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():     # a row a term at most
            df[t] = n
        found = search_block(forward, asked, weights(n_docs, df), n_docs, total or 0, k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                      f"item int, item_id {queries.schema['item_id'].dataType.simpleString()}")
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        out.append(materialize(spark, ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "lexical-found"))
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return search(docs, items)


ORACLE_SQL = r"""
WITH tok AS (
  SELECT doc_id, rowid AS r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
), tf AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM tok GROUP BY r, term),
len AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
st AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM len),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * (SELECT nd FROM st) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
sc AS (
  SELECT q.item_id, tf.r, any_value(tf.doc_id) AS doc_id,
         CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + ((90 * len.n * st.nd) // st.l))))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN len ON len.r = tf.r CROSS JOIN st GROUP BY q.item_id, tf.r
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM sc WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""
