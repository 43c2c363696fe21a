"""Vector codes by product quantisation, the nearest entry found in a geometric near-neighbour tree.

A vector's components become integers, it is cut into equal parts, and each part is coded by
the nearest entry of that position's codebook (squared distance, ties to the lower index).
Codebooks start from the vectors with the smallest ids and are refined in a fixed number of
rounds of assignment and componentwise floored means.

The nearest entry is found in a GNAT over each codebook: a node holds some entries as split
points, every other entry belongs to the nearest of them, and each split point keeps, for
every child of the node, the range of its distances to that child's entries.  With the
distance from the query to a split point, the triangle inequality bounds the distance to all
entries of a child from below; the whole child is left out if that bound is strictly beyond
the nearest entry so far.  Distances are rounded outwards before they are compared, squared
distances stay integers, and the winner is chosen by (squared distance, index), so the result
equals that of comparing all entries.  The tree works on all parts of an Arrow batch at once.

On Spark each round is one scan: tasks send one row of sums for each part and entry, which are
added up by key; the codebooks (parts x entries x width integers, whatever the table holds)
are what the driver sees and broadcasts.  Label totals are aggregated before they are joined
back, and both sides of that join are written first, so that a label with most rows can be
split by adaptive execution.

Cases: rows whose vector is null or holds a null or a non-finite component are dropped, as are
those of another length than the vector with the smallest id (null ids last); components of
2^19 or more in size raise an error, as sums of squares would leave 64 bits (ANSI arithmetic);
a length that the parts do not divide raises an error; fewer vectors than entries make
smaller codebooks; equal entries never both get parts (lower index); repeated rows count and
are coded each; null labels are one label; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, materialize, small_batches

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 1 << 27              # of an integer component: 64 squared differences stay below 2^62
BRANCH = 8                   # split points of a node
_OUT = 2.0 ** -48            # relative slack of a distance, far over the error of a square root


# ------------------------------------------------------------------ the tree
def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, points x entries, in 64-bit integers."""
    out = np.zeros((len(points), len(entries)), dtype=np.int64)
    for i in range(points.shape[1]):
        diff = points[:, i, None] - entries[None, :, i]
        out += diff * diff
    return out


class Node:
    """``index`` of the entries that are split points, and a child for each: the entries
    nearest to it.  ``low`` and ``high`` (split x child): distances from the split point to
    the child's entries, rounded outwards; an empty child has low = inf."""

    def __init__(self, entries: np.ndarray, index: np.ndarray):
        if len(index) <= BRANCH:
            self.index, self.children, self.points = index, [], entries[index]
            return
        chosen = [0]                                             # split points far from each other
        nearest = squared(entries[index], entries[index[:1]])[:, 0]
        while len(chosen) < BRANCH:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squared(entries[index], entries[index[chosen[-1:]]])[:, 0])
        self.index = index[chosen]
        self.points = entries[self.index]
        rest = np.delete(index, chosen)
        d = squared(entries[rest], self.points)
        home = d.argmin(axis=1)
        root = np.sqrt(d.astype(np.float64))
        self.children, lows, highs = [], [], []
        for j in range(len(chosen)):
            own = home == j
            self.children.append(Node(entries, rest[own]) if own.any() else None)
            lows.append(root[own].min(axis=0) * (1 - _OUT) if own.any() else np.full(len(chosen), np.inf))
            highs.append(root[own].max(axis=0) * (1 + _OUT) if own.any() else np.full(len(chosen), -np.inf))
        self.low, self.high = np.stack(lows, axis=1), np.stack(highs, axis=1)

    def search(self, queries: np.ndarray, at: np.ndarray, best: np.ndarray, found: np.ndarray, seen: list | None = None) -> None:
        """Improve best (squared distance) and found (index) of the queries ``at``."""
        d = squared(queries[at], self.points)
        if seen is not None:
            seen.append(d.size)
        for j, index in enumerate(self.index.tolist()):
            better = (d[:, j] < best[at]) | ((d[:, j] == best[at]) & (index < found[at]))
            best[at[better]], found[at[better]] = d[better, j], index
        if not self.children:
            return
        root = np.sqrt(d.astype(np.float64))
        near, far = root * (1 - _OUT), root * (1 + _OUT)
        home = d.argmin(axis=1)
        floor = [np.maximum(near - self.high[None, :, j], self.low[None, :, j] - far).max(axis=1) * (1 - _OUT)
                 if child else None for j, child in enumerate(self.children)]
        for first in (True, False):                              # each query's own child first
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                mine = np.flatnonzero((home == j) == first)
                reach = np.sqrt(best[at[mine]].astype(np.float64)) * (1 + _OUT)
                alive = at[mine[~(floor[j][mine] > reach)]]      # only strictly farther children go
                if len(alive):
                    child.search(queries, alive, best, found, seen)


class Codebook:
    """The entries of one part position and the tree over them."""

    def __init__(self, entries: np.ndarray):
        _, first = np.unique(entries, axis=0, return_index=True)     # of equal entries only the lowest can win
        self.root = Node(entries, np.sort(first))

    def nearest(self, parts: np.ndarray, seen: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lowest) and the squared distance."""
        best = np.full(len(parts), np.iinfo(np.int64).max)
        found = np.full(len(parts), np.iinfo(np.int64).max)
        if len(parts):
            self.root.search(parts, np.arange(len(parts)), best, found, seen)
        return found, best


# ------------------------------------------------------------------ on Spark
def integers(vector: Column) -> Column:
    """Components as floor(SCALE * x), 64-bit."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) and label of the rows whose vector is finite throughout."""
    v = col(vectors, "embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.where(v.isNotNull() & F.coalesce(finite, F.lit(False))).select(
        col(vectors, "vec_id").alias("vec_id"), v.cast("array<double>").alias("v"), col(vectors, "label").alias("label"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    x = np.asarray(batch.column(batch.schema.get_field_index("v")).flatten(), dtype=np.float64).reshape(-1, dims)
    v = np.floor(SCALE * x)
    if len(v) and np.abs(v).max() >= LIMIT:
        raise OverflowError(f"a component of {LIMIT // SCALE} or more")
    return v.astype(np.int64)


def _sums(kept: DataFrame, model, dims: int, parts: int) -> DataFrame:
    """(part, entry, pos, n, total): counts and component sums of the parts nearest to an entry."""
    width = dims // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in model.value]
        size = len(model.value[0])
        count, total = np.zeros((parts, size), dtype=np.int64), np.zeros((parts, size, width), dtype=np.int64)
        for batch in batches:
            m = _matrix(batch, dims)
            for p in range(parts):
                own = m[:, p * width:(p + 1) * width]
                index, _ = books[p].nearest(own)
                count[p] += np.bincount(index, minlength=size)
                np.add.at(total[p], index, own)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(part, width)), pa.array(np.repeat(entry, width)), pa.array(np.tile(np.arange(width), len(part))),
            pa.array(np.repeat(count[part, entry], width)), pa.array(total[part, entry].reshape(-1))],
            names=["part", "entry", "pos", "n", "total"])

    return kept.mapInArrow(run, "part long, entry long, pos long, n long, total long") \
        .groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts x entries x width), or None without vectors."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return None
    dims = len(first[0]["v"])
    if dims == 0 or dims % parts:
        raise ValueError(f"{dims} components cannot be cut into {parts} equal parts")
    start = np.floor(SCALE * np.array([r["v"] for r in first if len(r["v"]) == dims], dtype=np.float64))
    if np.abs(start).max() >= LIMIT:
        raise OverflowError(f"a component of {LIMIT // SCALE} or more")
    books = start.astype(np.int64).reshape(len(start), parts, dims // parts).transpose(1, 0, 2).copy()
    sc = kept.sparkSession.sparkContext
    same = kept.where(F.size("v") == dims)
    for _ in range(rounds):
        for r in _sums(same, sc.broadcast(books), dims, parts).collect():       # parts x entries x width rows at most
            books[r["part"], r["entry"], r["pos"]] = r["total"] // r["n"]
    return books


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (array<int>) and error of every vector of the codebooks' length."""
    parts, _, width = books.shape
    model = kept.sparkSession.sparkContext.broadcast(books)
    label = kept.schema["label"].dataType.simpleString()
    identity = kept.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Codebook(b) for b in model.value]
        for batch in batches:
            m = _matrix(batch, parts * width)
            code, error = np.zeros((len(m), parts), dtype=np.int32), np.zeros(len(m), dtype=np.int64)
            for p in range(parts):
                index, d = found[p].nearest(m[:, p * width:(p + 1) * width])
                code[:, p], error = index, error + d
            codes = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * parts), pa.array(code.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), codes, pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])

    return kept.where(F.size("v") == parts * width).mapInArrow(
        run, f"vec_id {identity}, label {label}, code array<int>, error long")


def decode(books: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The vectors that codes (rows x parts) stand for."""
    return np.concatenate([books[p][codes[:, p]] for p in range(len(books))], axis=1) / SCALE


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def query(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every whole vector."""
    spark = vectors.sparkSession
    small_batches(spark)
    kept = whole_vectors(vectors)
    books = train(kept)
    if books is None:
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"),
                           F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = materialize(spark, encode(kept, books), "vector-codes")
    totals = materialize(spark, coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"),
                         "vector-labels")
    text = F.concat_ws("", F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    return coded.join(totals, coded["label"].eqNullSafe(totals["_label"])).select(
        "vec_id", text.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same rounds with all entries compared, a CTE a step."""
    near = """SELECT r, part, min_by(entry, d * 64 + entry) AS entry, min(d) AS d FROM (
      SELECT p.r, p.part, b.entry, CAST(sum((p.x - b.x) * (p.x - b.x)) AS BIGINT) AS d FROM comp p JOIN {book} b ON b.part = p.part AND b.pos = p.pos
      GROUP BY p.r, p.part, b.entry) GROUP BY r, part"""
    steps = []
    for k in range(ROUNDS):
        steps.append(f"a{k} AS MATERIALIZED (" + near.format(book=f"b{k}") + ")")
        steps.append(f"""b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, CASE WHEN s.n IS NULL THEN b.x
      ELSE CAST((s.t - ((s.t % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x FROM b{k} b LEFT JOIN (
      SELECT c.part, a.entry, c.pos, count(*) AS n, CAST(sum(c.x) AS BIGINT) AS t FROM comp c JOIN a{k} a ON a.r = c.r AND a.part = c.part
      GROUP BY c.part, a.entry, c.pos) s ON s.part = b.part AND s.entry = b.entry AND s.pos = b.pos)""")
    return f"""
WITH good AS MATERIALIZED (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), comp AS MATERIALIZED (
  SELECT r, i // (d // {PARTS}) AS part, i % (d // {PARTS}) AS pos, CAST(floor({SCALE} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, embedding, len(embedding) AS d, unnest(range(len(embedding))) AS i FROM good)
), b0 AS MATERIALIZED (SELECT part, r AS entry, pos, x FROM comp WHERE r < {ENTRIES}),
{', '.join(steps)}, fin AS MATERIALIZED ({near.format(book=f'b{ROUNDS}')}),
cb AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{ROUNDS}),
done AS (SELECT r, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM fin GROUP BY r)
SELECT g.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY g.label) AS BIGINT) AS label_error, codebooks_sha256
FROM good g JOIN done USING (r) CROSS JOIN cb"""


ORACLE_SQL = _sql()
