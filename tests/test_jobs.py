import os
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.plans import jobs
from ledgerline.operators import reconcile as R
from ledgerline.schemas import TRANSACTION_SCHEMA, T
from ledgerline.session import scratch_dir


def _tx_rows():
    ins = ("PumpFunBuy", "PumpfunBuy", None, None, None)
    ev = ("PumpFunTradeEvent", "PumpfunTradeEvent", {"timestamp": 1736899200 + 5, "is_buy": True}, None, None)
    return [(bytes([1]) * 64, Decimal(100), 0, [ins, ev], "100_199"),
            (bytes([2]) * 64, Decimal(300), 1, [ins, ev, ev], "300_399")]


def test_ingest_batch_no_reprocessing(spark):
    d = scratch_dir(spark, "archive")
    for name in ["100_199.meta", "100_199.bin", "300_399.meta", "300_399.bin", "junk.txt"]:
        with open(os.path.join(d.replace("file:", "", 1), name), "wb") as f:
            f.write(b"x" * 17)
    ledger = scratch_dir(spark, "ledger")
    sink = scratch_dir(spark, "sink")
    schema = T.StructType(list(TRANSACTION_SCHEMA.fields) + [T.StructField("prefix", T.StringType())])
    txs = spark.createDataFrame(_tx_rows(), schema)
    first = sorted(r.prefix for r in jobs.ingest_batch(spark, d, ledger, txs, sink, "2025-01-15T00:00:00Z").collect())
    assert first == ["100_199", "300_399"]
    trade = spark.read.parquet(f"{sink}/pumpfun_trade_event_v2")
    assert trade.count() == 2
    second = jobs.ingest_batch(spark, d, ledger, txs, sink, "2025-01-15T01:00:00Z").collect()
    assert second == []
    assert spark.read.parquet(f"{sink}/pumpfun_trade_event_v2").count() == 2


def test_reconcile_and_repair_applies_missing_only(spark):
    H = 1704067200
    schema = "signature string, instruction_index long, timestamp long"
    local = spark.createDataFrame([(f"s{k}", k, H + 60 + k) for k in range(10)], schema)
    remote_path = scratch_dir(spark, "remote") + "/t"
    local.where(F.col("instruction_index") % 3 != 0).write.parquet(remote_path)
    remote = spark.read.schema(schema).parquet(remote_path)
    res = jobs.reconcile_and_repair({"t": (local, remote, remote_path)}, as_of="2024-01-02T02:00:00",
                                    check_days=1, apply=True)
    row = res.summary.collect()[0]
    assert (row.diff_hours, row.diff_minutes, row.synced_records) == (1, 1, 4)
    after = spark.read.schema(schema).parquet(remote_path)
    assert after.count() == 10
    start, end = R.time_window("2024-01-02T02:00:00", 2, 1)
    assert R.reconcile_hours(local, after, start, end).count() == 0


def test_ingest_rerun_after_lost_ledger_is_idempotent(spark):
    d = scratch_dir(spark, "archive2")
    for name in ["100_199.meta", "100_199.bin", "300_399.meta", "300_399.bin"]:
        with open(os.path.join(d.replace("file:", "", 1), name), "wb") as f:
            f.write(b"x")
    sink = scratch_dir(spark, "sink2")
    schema = T.StructType(list(TRANSACTION_SCHEMA.fields) + [T.StructField("prefix", T.StringType())])
    txs = spark.createDataFrame(_tx_rows(), schema)
    jobs.ingest_batch(spark, d, scratch_dir(spark, "ledgerA"), txs, sink, "t1")
    # crash before the ledger line: a fresh ledger makes every pair pending again
    jobs.ingest_batch(spark, d, scratch_dir(spark, "ledgerB"), txs, sink, "t2")
    assert spark.read.parquet(f"{sink}/pumpfun_trade_event_v2").count() == 2


def test_doubled_input_is_written_once(spark):
    sink = scratch_dir(spark, "doubled")
    rows = [r[:4] for r in _tx_rows()]
    jobs.write_tables_from_transactions(spark.createDataFrame(rows + rows, TRANSACTION_SCHEMA), sink, dedupe=True)
    assert spark.read.parquet(f"{sink}/pumpfun_trade_event_v2").count() == 2


def test_ledger_read_errors_are_not_an_empty_ledger(spark, monkeypatch):
    import pytest
    from ledgerline.sources import archive as A
    ledger = scratch_dir(spark, "ledger-bad")
    A.append_lines(spark.createDataFrame([("t,1_2,completed",)], "value string"), ledger)

    def broken(*_):
        raise OSError("no access")
    monkeypatch.setattr(A, "read_ledger_lines", broken)
    d = scratch_dir(spark, "archive-bad")
    with open(os.path.join(d.replace("file:", "", 1), "1_2.meta"), "wb") as f:
        f.write(b"x")
    schema = T.StructType(list(TRANSACTION_SCHEMA.fields) + [T.StructField("prefix", T.StringType())])
    with pytest.raises(OSError, match="no access"):
        jobs.ingest_batch(spark, d, ledger, spark.createDataFrame(_tx_rows(), schema), scratch_dir(spark, "s"), "t")


def _dated_copies(spark, keep):
    H = 1704067200
    schema = "signature string, instruction_index long, timestamp long, event_date date"
    local = spark.range(1000).selectExpr("concat('s', id) signature", "id instruction_index", f"{H} + id * 60 timestamp",
                                         f"to_date(timestamp_seconds({H} + id * 60)) event_date")
    path = scratch_dir(spark, "dated-remote") + "/t"
    local.where(keep).write.partitionBy("event_date").parquet(path)
    return local, spark.read.schema(schema).parquet(path), path


def test_repair_of_a_dated_target_is_visible(spark):
    local, remote, path = _dated_copies(spark, "instruction_index % 5 > 0")
    res = jobs.reconcile_and_repair({"t": (local, remote, path)}, as_of="2024-01-02T02:00:00", check_days=1, apply=True)
    assert res.summary.collect()[0].synced_records == 200
    assert spark.read.schema(remote.schema).parquet(path).count() == 1000


def test_summary_counts_nothing_without_apply(spark):
    local, remote, path = _dated_copies(spark, "instruction_index % 5 > 0")
    row = jobs.reconcile_and_repair({"t": (local, remote, path)}, as_of="2024-01-02T02:00:00", check_days=1).summary.collect()[0]
    assert row.diff_minutes == 200 and row.synced_records == 0


def test_repair_that_did_not_arrive_fails(spark, monkeypatch):
    import pytest
    local, remote, path = _dated_copies(spark, "instruction_index % 5 > 0")
    monkeypatch.setattr(R, "apply_repair", lambda *_: None)
    with pytest.raises(RuntimeError, match="200 keys are still missing"):
        jobs.reconcile_and_repair({"t": (local, remote, path)}, as_of="2024-01-02T02:00:00", check_days=1, apply=True)


def test_import_of_doubled_folder(spark):
    from ledgerline.sources import transfer as X
    local, remote, path = _dated_copies(spark, "instruction_index < 35")
    root, target = os.path.dirname(path), scratch_dir(spark, "doubled-import")
    remote.write.mode("append").partitionBy("event_date").parquet(path)
    schema = T.StructType(remote.schema.fields[:3])
    X.import_folder(spark, root, "t", {"t": "copy"}, target, schema, dedupe=True)
    assert X.read_target(spark, target, "copy", schema).count() == 35
