import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions.scalars import authority_level
from ledgerline.operators import envelope as V


def test_authority_levels(spark):
    df = spark.createDataFrame([("lv3",), ("LV5",), ("x",), ("Lv0",)], "a string")
    assert [r.n for r in df.select(authority_level("a").alias("n")).collect()] == [3, 5, 0, 0]


def env(spark, n, base=dt.datetime(2024, 1, 1)):
    rows = [(1, base + dt.timedelta(seconds=i // 100), f"u{i:06d}", 10) for i in range(n)]
    return spark.createDataFrame(rows, "channel long, ts timestamp_ntz, uuid string, payload_bytes long")


def test_retention_count_ttl_bytes(spark):
    e = env(spark, 10_001)
    as_of = "2024-01-01 00:01:40"
    kept = V.retain(e, as_of, ttl_seconds=300, max_msgs=10_000)
    assert kept.count() == 10_000
    assert kept.where(F.col("uuid") == "u000000").count() == 0          # oldest dropped
    assert V.retain(e, as_of, ttl_seconds=300, max_msgs=-1, max_bytes=50).count() == 5
    assert V.retain(e, as_of, ttl_seconds=300, max_msgs=100, max_bytes=50).count() == 5


def test_byte_limit_keeps_the_same_messages_with_and_without_a_message_limit(spark):
    at = dt.datetime(2024, 1, 1)
    e = spark.createDataFrame([(1, at, f"u{i}", 10) for i in range(6)] + [(2, at, "x", 31), (2, at - dt.timedelta(seconds=1), "y", 1)],
                              "channel long, ts timestamp_ntz, uuid string, payload_bytes long")
    kept = [sorted(r.uuid for r in V.retain(e, "2024-01-01 00:00:01", 300, m, 30).collect()) for m in (100, -1)]
    assert kept == [["u3", "u4", "u5"]] * 2


def test_ttl_drops_old(spark):
    e = env(spark, 3)
    assert V.retain(e, "2024-01-01 00:05:01", ttl_seconds=300).count() == 0
    assert V.retain(e, "2024-01-01 00:05:00", ttl_seconds=300).count() == 3


def test_route_subscribe_sequence(spark):
    msgs = spark.createDataFrame([(1, 0, "a"), (1, 3, "b"), (2, 5, "c")], "channel long, authority int, uuid string")
    routed = V.route(msgs)
    assert sorted(r.subject for r in routed.collect()) == ["telepath_1.lv0", "telepath_1.lv3", "telepath_2.lv5"]
    subs = spark.createDataFrame([("s", 1)], "subscriber string, channel long")
    assert sorted(r.uuid for r in V.subscribe(routed, subs).collect()) == ["a", "b"]
    e = env(spark, 500)
    seq = V.sequence(e).orderBy("uuid").collect()
    assert [r.seq for r in seq] == list(range(1, 501))
