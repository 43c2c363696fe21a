import pytest
from pyspark.sql import functions as F

from ledgerline.plans import standins as S
from ledgerline.schemas import TABLES
from ledgerline.session import scratch_dir
from ledgerline.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def test_failed_batch_is_not_committed(spark):
    """H1/H2: an exception stops the query without committing; the rerun on the
    same checkpoint processes the batch once."""
    schema = S.table(spark, SF, "events").schema
    sink, ckpt = scratch_dir(spark, "fail"), scratch_dir(spark, "fail-ckpt")

    def bad(batch, batch_id):
        J.write_batch(batch.select("event_id"), sink, J.run_id(ckpt), batch_id, [])
        raise RuntimeError("downstream refused")

    with pytest.raises(Exception):
        J.run_foreach(J.file_stream(spark, SF, schema, "events.parquet"), bad, ckpt)

    def good(batch, batch_id):
        J.write_batch(batch.select("event_id"), sink, J.run_id(ckpt), batch_id, [])

    J.run_foreach(J.file_stream(spark, SF, schema, "events.parquet"), good, ckpt)
    J.run_foreach(J.file_stream(spark, SF, schema, "events.parquet"), good, ckpt)
    out = spark.read.parquet(sink)
    n = S.table(spark, SF, "events").count()
    assert out.count() == n and out.select("event_id").distinct().count() == n


def test_watermark_distinct_closed_windows_only(spark):
    schema = S.table(spark, SF, "events").schema
    sink, ckpt = scratch_dir(spark, "wm"), scratch_dir(spark, "wm-ckpt")
    st = J.file_stream(spark, SF, schema, "events.parquet").withColumn("event_ts", F.col("ts").cast("timestamp"))
    J.run_append(J.distinct_per_window(st, ["user_id"], "event_ts", "1 hour", "2 hours"), sink, ckpt)
    got = spark.read.parquet(sink)
    ev = S.table(spark, SF, "events")
    max_s = ev.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).collect()[0][0] / 1e6
    assert got.where(F.col("window_start") + 3600 > max_s - 7200).count() == 0
    assert got.count() > 0


def test_second_checkpoint_keeps_stored_batches(spark):
    sink = scratch_dir(spark, "two")
    for n in (10, 15):
        J.write_batch(spark.range(n), sink, J.run_id(f"ckpt-{n}"), 0, [])
        J.write_batch(spark.range(n), sink, J.run_id(f"ckpt-{n}"), 0, [])       # a replay
    assert spark.read.parquet(sink).count() == 25


def test_configured_table_names(spark):
    tx = S.transactions(spark, SF)
    sink = scratch_dir(spark, "names")
    names = {t.name: f"my_{t.name}" for t in TABLES}
    handle = J.fanout_batch(lambda x: x, sink, names)
    handle(tx, 0)
    before = {t.name: J.read_sink(spark, sink, t.name, names).count() for t in TABLES}
    handle(tx, 1)                                                                # redelivered
    assert before == {t.name: J.read_sink(spark, sink, t.name, names).count() for t in TABLES} and sum(before.values()) > 0
    assert J.read_sink(spark, sink, "trade").count() == 0                        # nothing under the default name
