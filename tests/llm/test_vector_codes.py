import hashlib
import math

import numpy as np
import pytest

from ledgerline.llm import vector_codes as V
from tests.llm.data import with_clash

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(n=300, dims=64, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, np.float32(rng.normal(0, 0.15, dims)).tolist(), int(rng.integers(0, 4))) for i in range(n)]


def brute(rows):
    """All entries compared, in Python integers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vecs = [[math.floor(256 * x) for x in r[1]] for r in rows]
    width = len(vecs[0]) // 16
    parts = [[v[p * width:(p + 1) * width] for v in vecs] for p in range(16)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))
    books = [[list(x) for x in parts[p][:64]] for p in range(16)]
    for _ in range(2):
        for p in range(16):
            home = {}
            for x in parts[p]:
                home.setdefault(near(x, books[p])[1], []).append(x)
            for i, xs in home.items():
                books[p][i] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    found = [[near(parts[p][i], books[p]) for p in range(16)] for i in range(len(rows))]
    error = [sum(d for d, _ in f) for f in found]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{i:02x}" for _, i in f), e, sum(x for x, s in zip(error, rows, strict=True) if s[2] == r[2]), sha)
                   for r, f, e in zip(rows, found, error, strict=True)), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_awkward_rows(spark):
    rows = table()
    rows += [(900, None, 1), (901, [0.5] * 63 + [None], 1), (902, [float("nan")] + [0.0] * 63, 2), (903, [float("inf")] * 64, 0),
             (904, [-float("inf")] + [0.0] * 63, None), (None, rows[5][1], None), (905, rows[6][1], None), rows[7], rows[7],
             (2, None, 3), (906, [0.0] * 64, 1), (907, [1000.0, -1000.0] * 32, 1)]
    df = with_clash(spark.createDataFrame(rows, SCHEMA).repartition(3), "code", "error", "_label", "v")
    assert got(V.query(df)) == brute(rows)


def test_few_or_equal_vectors(spark):
    rows = table(20)
    assert got(V.query(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    same = [(i, rows[i % 3][1], None) for i in range(200)]
    assert got(V.query(spark.createDataFrame(same, SCHEMA))) == brute(same)
    assert V.query(spark.createDataFrame([], SCHEMA)).collect() == []
    assert V.query(spark.createDataFrame([(1, None, 1)], SCHEMA)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_other_lengths(spark):
    rows = table(30)
    assert got(V.query(spark.createDataFrame([*rows, (500, [0.5] * 32, 1), (501, [], 1)], SCHEMA))) == brute(rows)
    with pytest.raises(ValueError):
        V.query(spark.createDataFrame([(1, [0.5] * 17, 1)], SCHEMA))
    with pytest.raises(Exception, match="component"):
        V.query(spark.createDataFrame([*rows, (800, [2.0 ** 19] * 64, 1)], SCHEMA)).collect()


@pytest.mark.parametrize("scale", [3, 60, 10 ** 7])
@pytest.mark.parametrize("entries", [1, 2, 7, 64, 300])
def test_tree_equals_all_pairs(scale, entries):
    """Ties included: with small integers many entries are equally near or equal."""
    rng = np.random.default_rng(entries)
    book, points = rng.integers(-scale, scale + 1, (entries, 4)), rng.integers(-scale, scale + 1, (2000, 4))
    seen = []
    index, best = V.Codebook(book).nearest(points, seen)
    d = V.squared(points, book)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    if entries >= 64 and scale > 3:
        assert sum(seen) < (0.95 if entries == 64 else 0.6) * 2000 * entries        # subtrees are left out


def test_clustered_entries_leave_out_most_subtrees():
    rng = np.random.default_rng(0)
    centers = rng.integers(-5000, 5000, (8, 4))
    book = np.repeat(centers, 8, axis=0) + rng.integers(-40, 40, (64, 4))
    points = centers[rng.integers(0, 8, 3000)] + rng.integers(-40, 40, (3000, 4))
    seen = []
    index, _ = V.Codebook(book).nearest(points, seen)
    assert (index == V.squared(points, book).argmin(axis=1)).all() and sum(seen) < 0.45 * 3000 * 64


def test_decode_is_near(spark):
    kept = V.whole_vectors(spark.createDataFrame(table(400), SCHEMA))
    books = V.train(kept)
    rows = V.encode(kept, books).join(kept, "vec_id").select("v", "code").collect()
    back = V.decode(books, np.array([r["code"] for r in rows]))
    assert np.abs(back - np.array([r["v"] for r in rows])).mean() < 0.1
