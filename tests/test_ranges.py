"""Byte ranges: each is read once, by one task, whatever the files look like."""
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import ranges as R

SCHEMA = "slot long, path string, offset long, size long"


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root, rng = tmp_path_factory.mktemp("ranges"), random.Random(1)
    made = {}
    for name, n in (("hot file.bin", 300_000), ("b.bin", 5_000), ("c.bin", 10), ("empty.bin", 0)):
        (root / name).write_bytes(rng.randbytes(n))
        made[f"file:{root}/{name}"] = (root / name).read_bytes()
    return made


def entries(files, seed=2):
    """Gapless, far apart, overlapping, repeated and empty ranges."""
    rng, out = random.Random(seed), []
    for path, data in files.items():
        n, at = len(data), 0
        while at < n:
            size = min(rng.choice((0, 1, 7, 500, 3_000)), n - at)
            out.append((path, at, size))
            at += size + rng.choice((0, 0, 1, 90_000))
        out += [(path, 0, n), (path, n, 0), (path, 0, n // 2), (path, n // 3, n // 2)] * 2
    rng.shuffle(out)
    return [(i, p, o, s) for i, (p, o, s) in enumerate(out)]


@pytest.mark.parametrize("pack_bytes", [1, 4_000, 1 << 30])
def test_content(spark, files, pack_bytes):
    rows = entries(files)[:: 20 if pack_bytes == 1 else 1][:60 if pack_bytes == 1 else None]
    df = spark.createDataFrame(rows, SCHEMA).where("size > 0" if pack_bytes == 1 else "true")
    if pack_bytes == 1:
        df = df.where("size < 50")                    # a pack a byte
    got = R.read_ranges(df, pack_bytes).select("*", F.spark_partition_id().alias("task")).collect()
    assert len(got) == df.count() and len({r.slot for r in got}) == len(got)
    assert all(bytes(r.content) == files[r.path][r.offset:r.offset + r.size] for r in got)
    assert all(r.task == r.pack for r in got)


def test_packs_are_bounded_by_bytes(spark, files):
    """A hot file is cut into many packs, small neighbours share one."""
    df = spark.createDataFrame([(i, "file:/hot", i * 100, 100) for i in range(1000)]
                               + [(1000 + i, f"file:/small{i:03d}", 0, 10) for i in range(100)], SCHEMA)
    packs = R.pack_ranges(df, 2_000).groupBy("pack").agg(F.sum("size").alias("bytes"), F.countDistinct("path").alias("paths"))
    got = {r.pack: (r.bytes, r.paths) for r in packs.collect()}
    assert sorted(got) == list(range(51)) and all(b <= 2_000 + 100 for b, _ in got.values())
    assert got[0] == (2_000, 1) and got[50] == (1_000, 100)


def test_requests():
    """Near neighbours are one request, far ones and long ones are not."""
    far, long = 10 + R.GAP + 1, R.SPAN
    paths, offsets, sizes = ["a", "a", "a", "a", "b"], [0, 10, far + 10, far + 20, 0], [10, 5, 5, long, 3]
    assert list(R._spans(paths, offsets, sizes)) == [(0, 2, 0, 15), (2, 3, far + 10, far + 15), (3, 4, far + 20, far + 20 + long), (4, 5, 0, 3)]


def test_no_ranges(spark, files):
    rows = [(1, None, 0, 1), (2, next(iter(files)), None, 1), (3, next(iter(files)), 0, None)]
    got = R.read_ranges(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["slot", "path", "offset", "size", "pack", "content"] and got.count() == 0


def test_cut_file_fails(spark, files):
    path = next(p for p in files if p.endswith("c.bin"))
    with pytest.raises(Exception, match="10 of 11 bytes at 0"):
        R.read_ranges(spark.createDataFrame([(1, path, 0, 11)], SCHEMA)).collect()


def test_too_large_range_fails_before_reading(spark):
    with pytest.raises(ValueError, match="bytes"):
        R.read_ranges(spark.createDataFrame([(1, "file:/none", 0, 1 << 31)], SCHEMA))
