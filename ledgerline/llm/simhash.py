"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; two link at ``max_distance`` or fewer differing bits (0 to 3).
Both ends of a link move half the way: every distinct fingerprint emits all variants within
distance 1, half of the radius rounded down, and linked fingerprints share a variant.  The
odd third bit is absorbed by leaving out one of four 16-bit blocks: in the view that leaves
out block b, a variant is the other 48 bits with none or one of the bits above block b
flipped.

Why every link is found: take the lowest block in which the two differ and leave it out.  At
most two bits still differ, all above that block; if two, each end flips one of them, if
one, one end flips it, if none, neither does.  That is 49 + 33 + 17 + 1 = 100 variants for
each fingerprint.  (Whole 64-bit balls of radius 2 would be 2,081 variants.)

The variants are shuffled on (view, variant).  Two members of a bucket that flipped e and f
bits (0 or 1) and differ in c bits of the left-out block differ in c + e + f bits at most, so
they are linked if that is within ``max_distance``; this is the verification, and it is exact,
as members with the same flip meet unflipped in another bucket.  A bucket is never expanded
into pairs: members with the same block value form a class, and the classes near a class are
looked up among the 697 masks of up to three bits, so the work is linear.  A bucket cannot
hold more than 2^16 * 49 fingerprints however skewed the documents are.

Exact copies collapse before the variants are made; components come from star rounds.

Cases: null text counts as empty; texts without words have fingerprint 0, linked like any
other; a null doc_id is never a component id unless all ids of its component are null;
repeated rows are copies of each other; ties do not arise (ids are ordered); an empty table
gives an empty result; extra columns are ignored by the query and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, free_name, materialize, small_batches, text_udf
from ledgerline.llm.components import components

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
BLOCK_BITS, VIEWS = 16, 4
KEY_BITS = 64 - BLOCK_BITS
HASH_BLOCK = 1 << 16         # shingles that are counted at once
PAIRWISE = 8                 # larger buckets are linked class by class

#: Masks of one block by their number of bits.
MASKS = [np.array([sum(1 << b for b in bits) for bits in combinations(range(BLOCK_BITS), n)], dtype=np.int64)
         for n in range(MAX_DISTANCE + 1)]


# ------------------------------------------------------------------ fingerprints
def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles (repeats counted)."""
    words = (text or "").encode().lower().split()      # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = max(1, len(words) - shingle + 1)
    first, last = starts[:k].tolist(), ends[-k:].tolist()
    of, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, k, HASH_BLOCK):
        some = slice(at, at + HASH_BLOCK)
        h = np.array([of(joined[a:b], SEED) for a, b in zip(first[some], last[some], strict=True)], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > k, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Signed 64-bit form of the fingerprint (Spark has no unsigned type)."""
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in s], dtype=np.uint64).view(np.int64))
    return text_udf(run, "long")(text)


# ------------------------------------------------------------------ variants and buckets
def variants(fp: Column) -> Column:
    """Array of bucket keys: the view in the bits from 48 on, the variant below them."""
    keys = []
    for b in range(VIEWS):
        low = b * BLOCK_BITS
        rest = fp.bitwiseAND(F.lit((1 << low) - 1))
        if b < VIEWS - 1:
            above = F.shiftrightunsigned(fp, low + BLOCK_BITS)
            rest = rest.bitwiseOR(F.shiftleft(above, low))
        base = rest.bitwiseOR(F.lit(b << KEY_BITS))
        flips = F.array(*[F.lit(m).cast("long") for m in [0, *(1 << p for p in range(low, KEY_BITS))]])
        keys.append(F.transform(flips, base.bitwiseXOR))
    return F.concat(*keys)


def _split(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value of the left-out block, and 1 where the variant has a flipped bit."""
    low = (key >> KEY_BITS) * BLOCK_BITS
    u = fp.view(np.uint64)
    block = ((u >> low.astype(np.uint64)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
    above = np.where(low < KEY_BITS, (u >> np.minimum(low + BLOCK_BITS, 63).astype(np.uint64)).astype(np.int64), 0)
    rest = (fp & ((np.int64(1) << low) - 1)) | (above << low)
    return block, ((key & ((1 << KEY_BITS) - 1)) != rest).astype(np.int64)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component, for edges a-b among 0..n-1."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def link_bucket(block: np.ndarray, flipped: np.ndarray, radius: int) -> np.ndarray:
    """Component (smallest index) of each member of one bucket, without making pairs."""
    n, size = len(block), 1 << BLOCK_BITS
    at = [np.full(size, -1, dtype=np.int64) for _ in range(2)]
    own, a, b = np.arange(n), [], []
    for e in (1, 0):
        at[e][block[flipped == e]] = own[flipped == e]
    if radius >= 2:                                     # members of a class with one flip each
        ones = own[flipped == 1]
        a, b = [ones], [at[1][block[ones]]]
    for e, f in ((0, 0), (0, 1), (1, 1)):
        mine = own[flipped == e] if not (e and f) else np.unique(at[1][block[flipped == 1]])
        for masks in MASKS[: max(0, radius - e - f + 1)]:
            for m in masks:
                near = at[f][block[mine] ^ m]
                a.append(mine[near >= 0])
                b.append(near[near >= 0])
                if sum(map(len, a[-64:])) > 1 << 18:
                    root = forest(n, np.concatenate(a), np.concatenate(b))
                    a, b = [own], [root]
    if radius == 1:                                     # each flipped member with the unflipped one of its class
        ones = own[flipped == 1]
        base = at[0][block[ones]]
        a.append(ones[base >= 0])
        b.append(base[base >= 0])
    return forest(n, np.concatenate(a), np.concatenate(b)) if a else own


def link_runs(key: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Edges (rows of two fingerprints, larger first) of the buckets of key-sorted members."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    block, flipped = _split(key, fp)
    found = []
    small = np.repeat(np.where(sizes <= PAIRWISE, sizes, 0), sizes)
    place = np.arange(len(key)) - np.repeat(starts, sizes)
    for lag in range(1, PAIRWISE):
        i = np.flatnonzero(place + lag < small)
        if not len(i):
            break
        j = i + lag
        near = _popcount(block[i] ^ block[j]) + flipped[i] + flipped[j] <= radius
        found.append(np.stack([fp[i[near]], fp[j[near]]], axis=1))
    for s, n in zip(starts[sizes > PAIRWISE], sizes[sizes > PAIRWISE], strict=True):
        root = link_bucket(block[s:s + n], flipped[s:s + n], radius)
        moved = np.flatnonzero(root != np.arange(n))
        found.append(np.stack([fp[s + moved], fp[s + root[moved]]], axis=1))
    pairs = np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)
    pairs.sort(axis=1)
    return np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0) if len(pairs) else pairs


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all links;
    within a bucket a spanning forest may stand for them."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"max_distance must be 0 to {MAX_DISTANCE}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, dtype=np.int64)] * 2

        def out(key, fp):
            e = link_runs(key, fp, max_distance) if len(key) > 1 else np.empty((0, 2), dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["a", "b"])

        waiting: list[list[np.ndarray]] = []
        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(2)]
            if not len(new[0]):
                continue
            waiting.append(new)
            if new[0][0] == new[0][-1] and len(waiting) > 1 and waiting[0][0][0] == new[0][-1]:
                continue                                # one bucket goes on
            key, fp = (np.concatenate([held[k], *[w[k] for w in waiting]]) for k in range(2))
            cut = int(np.searchsorted(key, key[-1]))    # the last bucket may go on in the next batch
            held, waiting = [key[cut:], fp[cut:]], []
            yield out(key[:cut], fp[:cut])
        key, fp = (np.concatenate([held[k], *[w[k] for w in waiting]]) for k in range(2))
        yield out(key, fp)

    keyed = prints.select(F.explode(variants(F.col("fp"))).alias("key"), "fp")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


# ------------------------------------------------------------------ the operator
def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fp (signed), root (fp that stands for the component), component_id: a row for every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    prints = materialize(spark, docs.select(
        col(docs, "doc_id").alias("doc_id"), fingerprint_column(col(docs, "text"), shingle).alias("fp")), "prints")
    heads = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = components(spark, links(heads.select("fp"), max_distance))
    labels = heads.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    labels = materialize(spark, labels, "labels")
    first = labels.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(labels.drop("first_id").join(first, "root"), "fp").select("doc_id", "fp", "root", "component_id")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The row of ``docs`` with the smallest doc_id of every group, all columns kept.

    Rows are named by doc_id.  Where a doc_id repeats (or is null), the rows with it are
    told apart by their fingerprints, and one row of each kept (doc_id, fingerprint) stays."""
    spark = docs.sparkSession
    found = materialize(spark, near_duplicates(docs, shingle, max_distance), "groups")
    keep = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("k")) \
        .select("k.doc_id", "k.fp")
    repeated = materialize(spark, found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    own = col(docs, "doc_id")
    if repeated.isEmpty():
        ids = keep.select(F.col("doc_id").alias("_kept_id"))
        return docs.join(ids, own.eqNullSafe(ids["_kept_id"]), "left_semi")
    ids = keep.join(repeated, keep["doc_id"].eqNullSafe(repeated["doc_id"]), "left_anti").select(F.col("doc_id").alias("_kept_id"))
    single = docs.join(ids, own.eqNullSafe(ids["_kept_id"]), "left_semi")
    again = repeated.select(F.col("doc_id").alias("_kept_id"))
    rows = docs.join(again, own.eqNullSafe(again["_kept_id"]), "left_semi")
    name = free_name(docs, "_fp")
    rows = rows.withColumn(name, fingerprint_column(col(rows, "text"), shingle))
    kept = keep.select(F.col("doc_id").alias("_kept_id"), F.col("fp").alias("_kept_fp"))
    rows = rows.join(kept, col(rows, "doc_id").eqNullSafe(kept["_kept_id"]) & (col(rows, name) == kept["_kept_fp"]), "left_semi")
    whole = F.struct(*[col(rows, c).alias(c) for c in docs.columns])
    one = rows.groupBy(col(rows, "doc_id").alias("_id"), col(rows, name).alias("_f")).agg(F.first(whole).alias("_row")).select("_row.*")
    return single.unionByName(one)
