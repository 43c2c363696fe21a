import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash
from ledgerline.llm.components import components
from tests.llm.data import awkward, frame, with_clash


def brute_fingerprint(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius):
    """Smallest index of each fingerprint's component, all pairs compared."""
    fps = np.array(fps, dtype=np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= radius):
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(fps))]


def clusters(seed, n, low, high):
    rng = np.random.default_rng(seed)
    out = [int(x) for x in rng.integers(0, 2 ** 64, 20, dtype=np.uint64)]
    while len(out) < n:
        x = out[int(rng.integers(len(out)))]
        for _ in range(int(rng.integers(1, 5))):
            x ^= 1 << int(rng.integers(low, high))
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("text", ["", None, " ", "One", "one TWO", "a b c", "É\x85e f g É", "a b c a b c a b c", "x " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(map(str, range(300)))
    monkeypatch.setattr(simhash, "HASH_BLOCK", 7)
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("low,high", [(0, 64), (20, 36)])      # wide clusters, and dense ones with large buckets
def test_links(spark, radius, low, high):
    fps = clusters(radius + low, 400, low, high)
    signed = [int(x) for x in np.array(fps, dtype=np.uint64).view(np.int64)]
    found = components(spark, simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius))
    root = {r.node: r.root for r in found.collect()}
    got = [root.get(x, x) for x in signed]
    want = brute_components(fps, radius)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_every_single_link():
    """Two fingerprints alone, differing in any bits of up to three blocks, always meet."""
    rng = np.random.default_rng(3)
    spots = [0, 1, 15, 16, 17, 31, 32, 47, 48, 49, 62, 63]
    for bits in [(a, b, c) for a in spots for b in spots for c in spots]:
        x = int(rng.integers(0, 2 ** 64, dtype=np.uint64))
        y = x
        for b in set(bits):
            y ^= 1 << b
        rows = sorted((k, f) for f in (x, y) for k in keys(f))
        key, fp = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.uint64).view(np.int64)
        assert len(simhash.link_runs(key, fp, 3)) == 1


def keys(fp):
    out = []
    for b in range(4):
        low = 16 * b
        rest = fp & ((1 << low) - 1) | fp >> (low + 16) << low
        out += [b << 48 | rest ^ m for m in [0, *(1 << p for p in range(low, 48))]]
    return out


def test_variants_on_spark(spark):
    fps = [0, 1, 2 ** 63, 2 ** 64 - 1, 0x123456789ABCDEF0]
    signed = [int(x) for x in np.array(fps, dtype=np.uint64).view(np.int64)]
    rows = spark.createDataFrame([(x,) for x in signed], "fp long").select("fp", simhash.variants(F.col("fp")).alias("v")).collect()
    got = {r.fp: sorted(r.v) for r in rows}
    assert all(got[s] == sorted(keys(f)) for s, f in zip(signed, fps, strict=True))


def test_bucket_over_batches(spark):
    """A bucket longer than an Arrow batch stays one bucket."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        test_links(spark, 3, 20, 36)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 500), (700, 701), (701, 700)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {701: 700}


def test_query(spark):
    rows = awkward()
    got = simhash.query(with_clash(frame(spark, rows), "fp", "root", "component_id", "key")).collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = brute_components(fps, 3)
    first = {}
    for r, c in zip(rows, root, strict=True):
        first[c] = min((x for x in (first.get(c), r[0]) if x is not None), default=None)
    want = Counter((r[0], f"{f:016x}", first[c]) for r, f, c in zip(rows, fps, root, strict=True))
    assert Counter(map(tuple, got)) == want
    assert simhash.query(frame(spark, [])).count() == 0


def test_deduplicate(spark):
    rows = awkward()
    df = with_clash(frame(spark, rows), "_fp", "_kept_id")
    got = simhash.deduplicate(df)
    assert got.columns == df.columns
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = brute_components(fps, 3)
    kept = got.collect()
    assert len(kept) == len(set(root))
    where = {}
    for r, c in zip(rows, root, strict=True):
        where.setdefault(tuple(r), c)
    assert len({where[tuple(k)[:5]] for k in kept}) == len(kept)
    assert simhash.deduplicate(frame(spark, [])).count() == 0
