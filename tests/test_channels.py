import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import envelope as V
from ledgerline.operators import keys as D
from ledgerline.session import scratch_dir
from ledgerline.sources import archive as A
from ledgerline.sources import files as W
from ledgerline.streaming import channels as C
from ledgerline.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)


def messages(spark, rows):
    """(channel, seconds, text) as envelopes."""
    df = spark.createDataFrame([(c, T0 + dt.timedelta(seconds=s), t) for c, s, t in rows], "c string, at timestamp_ntz, text string")
    env = V.build_envelopes(df, channel="c", ts="at", payload=F.col("text"), id_cols=["c", "at", "text"], authority_text=F.lit("lv1"), sender_agent="t")
    return env.withColumn("payload_bytes", F.length("payload").cast("bigint"))


def numbers(spark, root, schema):
    return sorted((r.channel, r.seq, bytes(r.payload).decode()) for r in C.read_messages(spark, root, schema).collect())


def test_numbers_go_on_over_batches_and_runs(spark):
    root = scratch_dir(spark, "ch")
    first = messages(spark, [("a", 1, "x"), ("a", 2, "y"), ("b/c", 1, "z"), ("a", 2, "y")])          # one message twice
    schema = C.message_schema(first.schema)
    for _ in range(2):
        C.publish_batch(spark, root, "r1")(first, 0)
        assert numbers(spark, root, schema) == [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "y"), ("b/c", 1, "z")]
    C.publish_batch(spark, root, "r1")(messages(spark, []), 1)
    C.publish_batch(spark, root, "r2")(messages(spark, [("a", 0, "late"), ("d", 5, "w")]), 0)         # another run goes on
    assert numbers(spark, root, schema)[3:] == [("a", 4, "late"), ("b/c", 1, "z"), ("d", 1, "w")]


def test_expiry_drops_folders_and_rewrites_the_boundary(spark):
    root = scratch_dir(spark, "exp")
    env = messages(spark, [("a", s, f"m{s}") for s in range(0, 600, 10)] + [("b", 5, "old"), ("b", 400, "new"), ("b", 700, "not due")])
    schema = C.message_schema(env.schema)
    C.publish_batch(spark, root, "r")(env, 0)
    as_of = "2024-01-01 00:10:00"
    out = C.expire(spark, root, schema, as_of, ttl_seconds=245, max_msgs=20, bucket_seconds=60)
    want = V.retain(env, as_of, 245, 20).select("channel", "ts").collect()
    got = C.read_messages(spark, root, schema).select("channel", "ts").collect()
    assert sorted(map(tuple, got)) == sorted([*map(tuple, want), ("b", T0 + dt.timedelta(seconds=700))])
    assert out["dropped"] and len(out["rewritten"]) == 1
    left = W.partitions(spark, f"{root}/messages", C.PARTITIONS)
    assert min(int(b) for _, b in left) >= 1704067200 + 360 and not any(f in left.values() for f in out["dropped"])
    assert C.expire(spark, root, schema, as_of, 245, 20, bucket_seconds=60) == {"dropped": [], "rewritten": []}
    assert C.expire(spark, root, schema, "2025-01-01 00:00:00", 1)["rewritten"] == [] and C.read_messages(spark, root, schema).count() == 0


def test_delivery_once_with_restart_and_changing_subscriptions(spark):
    root, sink, ckpt = scratch_dir(spark, "dl"), scratch_dir(spark, "dl-sink"), scratch_dir(spark, "dl-ckpt")
    one = messages(spark, [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")])
    schema, subs = C.message_schema(one.schema), [("s1", "a")]

    def run():
        C.deliver(spark, root, schema, lambda: spark.createDataFrame(subs, "subscriber string, channel string"), sink, ckpt)
        return sorted((r.subscriber, r.channel, r.seq) for r in spark.read.parquet(sink).collect())
    C.publish_batch(spark, root, "r")(one, 0)
    assert run() == [("s1", "a", 1), ("s1", "a", 2)]
    C.publish_batch(spark, root, "r")(one, 0)                         # published again: new files, the same numbers
    subs.append(("s2", "b"))
    assert run() == [("s1", "a", 1), ("s1", "a", 2)]
    C.publish_batch(spark, root, "r")(messages(spark, [("a", 9, "v"), ("b", 9, "w")]), 1)
    C.expire(spark, root, schema, "2024-01-01 00:00:09", 7, 1, bucket_seconds=60)                     # rewrites what was delivered
    subs.remove(("s1", "a"))
    assert run() == [("s1", "a", 1), ("s1", "a", 2), ("s2", "b", 2)]


def test_late_half_of_a_pair_stays_pending(spark):
    """A .bin that comes a week after its .meta is not joined by the stream; a full scan finds it."""
    root, ckpt, got = scratch_dir(spark, "late"), scratch_dir(spark, "late-ckpt"), []

    def put(name, day):
        W.write_text(spark, f"{root}/{name}", "x")
        fs, p = W.fs_of(spark, f"{root}/{name}")
        fs.setTimes(p, 1_700_000_000_000 + 86_400_000 * day, -1)

    def run():
        J.run_foreach(J.completed_pairs(spark, root, "2 days"), lambda b, _: got.extend(r.prefix for r in b.collect()), ckpt)
    put("1_2.meta", 0), put("3_4.bin", 0), put("5_6.meta.meta", 0)
    run()
    assert got == []
    put("3_4.meta", 1), put("5_6.bin", 1)
    run()
    assert sorted(got) == ["3_4", "5_6"]
    put("1_2.bin", 7)
    run()
    assert sorted(got) == ["3_4", "5_6"]
    assert sorted(r.prefix for r in A.archive_pairs(A.list_files(spark, root)).collect()) == ["1_2", "3_4", "5_6"]


def test_ledger_rewrite_that_fails_leaves_the_ledger(spark, monkeypatch):
    import pytest
    path = scratch_dir(spark, "lr")
    for n in range(3):
        A.append_lines(spark.createDataFrame([(f"2024-01-0{n + 1},p{n % 2},completed",), ("# note",)], "value string"), path)
    monkeypatch.setattr(A, "compact_ledger", lambda *_: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        A.rewrite_ledger(spark, path)
    monkeypatch.undo()
    assert spark.read.text(path).count() == 6
    A.rewrite_ledger(spark, path)
    A.rewrite_ledger(spark, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["# note"] * 3 + ["2024-01-01,p0,completed", "2024-01-02,p1,completed"]
    A.rewrite_ledger(spark, scratch_dir(spark, "no-ledger"))


def test_dictionary_is_kept_and_joined_back(spark):
    from ledgerline.functions.base58 import base58
    path = scratch_dir(spark, "dict") + "/keys"
    rows = spark.range(50).selectExpr("id", "unhex(lpad(hex(id % 7), 64, '0')) a", "IF(id % 3 = 0, NULL, unhex(lpad(hex(id), 64, '0'))) b")
    before = D.extend_dictionary(spark, path, rows.where("id < 20"), ["a", "b"], "r1")
    assert before == D.read_dictionary(spark, path).count() > 0
    added = D.extend_dictionary(spark, path, rows, ["a", "b"], "r2")
    assert D.read_dictionary(spark, path).count() == before + added == D.distinct_keys(rows, ["a", "b"]).count()
    assert D.extend_dictionary(spark, path, rows, ["a", "b"], "r3") == 0
    got = D.resolve(rows, ["id"], ["a", "b"], D.read_dictionary(spark, path)).orderBy("id").collect()
    assert got == rows.select("id", base58("a").alias("a"), base58("b").alias("b")).orderBy("id").collect()
