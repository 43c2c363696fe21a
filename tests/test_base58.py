import os
import random

from ledgerline.functions.base58 import ALPHABET, b58encode, base58, encode_many


def plain_b58(b: bytes) -> str:
    n = int.from_bytes(b, "big")
    out = ""
    while n:
        n, r = divmod(n, 58)
        out = chr(ALPHABET[r]) + out
    return "1" * (len(b) - len(b.lstrip(b"\0"))) + out


def test_known_vectors():
    assert b58encode(bytes(32)) == "1" * 32
    assert b58encode(b"") == ""
    assert b58encode(b"\x61") == "2g"
    assert b58encode(b"\x62\x62\x62") == "a3gV"
    assert b58encode(b"hello world") == "StV1DL6CwTryKyV"
    assert b58encode(b"\x00\x00\x01") == "112"


def test_random_against_plain():
    rng = random.Random(42)
    vals = []
    for _ in range(500):
        n = rng.choice([0, 1, 2, 5, 31, 32, 33, 64])
        b = bytes(rng.getrandbits(8) for _ in range(n))
        if n and rng.random() < 0.3:
            b = bytes(rng.randint(1, 4)) + b
        vals.append(b)
    vals.append(None)
    got = encode_many(vals)
    assert got[-1] is None
    assert got[:-1] == [plain_b58(v) for v in vals[:-1]]


def test_spark_udf(spark):
    keys = [os.urandom(32) for _ in range(50)] + [bytes(32), os.urandom(64)]
    df = spark.createDataFrame([(k,) for k in keys], "k binary")
    got = {bytes(r.k): r.a for r in df.select("k", base58("k").alias("a")).collect()}
    assert got == {k: plain_b58(k) for k in keys}


def test_start_slot_and_suffix(spark):
    from ledgerline.functions.scalars import start_slot, strip_repeated_suffix
    df = spark.createDataFrame([("123_456",), ("+5_1",), ("slot7_8",), ("18446744073709551615_x",),
                                ("18446744073709551616_x",), ("007_1",), ("",)], "p string")
    got = [None if r.s is None else int(r.s) for r in df.select(start_slot("p").alias("s")).collect()]
    assert got == [123, 5, None, 18446744073709551615, None, 7, None]
    names = spark.createDataFrame([("a.meta.meta",), ("b.meta",), (".meta",), ("c.bin.meta",)], "n string")
    assert [r.p for r in names.select(strip_repeated_suffix("n", ".meta").alias("p")).collect()] == ["a", "b", "", "c.bin"]
