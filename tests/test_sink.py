import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.plans import sink as K
from ledgerline.schemas import TRANSACTION_SCHEMA
from ledgerline.session import scratch_dir
from ledgerline.sources import files as W
from ledgerline.sources import transfer as X
from ledgerline.streaming import jobs as J

SCHEMA = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType.elementType, True) if f.name == "instructions" else f.dataType, True)
                       for f in TRANSACTION_SCHEMA.fields])
TIME = 1736899200
INS = ("PumpFunBuy", "PumpfunBuy", None, None, None)


def ev(t=TIME):
    return ("PumpFunTradeEvent", "PumpfunTradeEvent", {"timestamp": t, "is_buy": True}, None, None)


def tx(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def good(i, slot=None, t=TIME):
    return (bytes([i]) * 64, Decimal(100 + i if slot is None else slot), 0, [INS, ev(t)])


BAD = [(None, Decimal(1), 0, [INS, ev()]), (bytes([91]) * 64, None, 0, [INS, ev()]), (bytes([92]) * 64, Decimal(1), None, [INS, ev()]),
       (bytes([93]) * 64, Decimal(1), 0, None), (bytes([94]) * 64, Decimal(1), 0, [INS, ev(), INS, ev(None)]),
       (bytes([95]) * 64, Decimal(1), 0, [INS, ("PumpFunTradeEvent", "PumpfunTradeEvent", None, None, None)]),
       (bytes([96]) * 64, Decimal(1), 0, [INS, None])]
REASONS = ["no event time", "no event time", "no index", "no instruction type", "no instructions", "no signature", "no slot"]


def signatures(spark, sink):
    return sorted(r[0] for r in J.sink_keys(spark, sink).select("signature").collect())


def test_malformed_transactions_are_set_aside_once(spark):
    sink = scratch_dir(spark, "bad")
    batch = tx(spark, BAD + [good(1), good(2)] + BAD[:2])
    out = K.append_transactions(batch, sink, "a-0")
    assert (out["transactions"], out["rejected"], out["bundles"], out["rows"]["trade"]) == (11, 9, 2, 2)
    for load in ("a-0", "b-0"):                                    # repeated, and by another run
        K.append_transactions(batch, sink, load)
        assert len(signatures(spark, sink)) == 2
        assert sorted(r.reason for r in K.read_rejects(spark, sink, SCHEMA).collect()) == REASONS


def test_only_malformed_or_nothing(spark):
    sink = scratch_dir(spark, "none")
    assert K.append_transactions(tx(spark, BAD[:1]), sink, "x")["rejected"] == 1
    assert K.append_transactions(tx(spark, []), sink, "y")["transactions"] == 0
    assert signatures(spark, sink) == [] and K.read_keys(spark, sink).count() == 0


def test_redelivery(spark):
    sink = scratch_dir(spark, "again")
    K.append_transactions(tx(spark, BAD + [good(1)]), sink, "a-0")

    def fix(bad):
        return bad.withColumn("slot", F.coalesce("slot", F.lit(7).cast(bad.schema["slot"].dataType)))
    out = K.redeliver(spark, sink, SCHEMA, fix)
    assert (out["transactions"], out["rejected"]) == (1, 6) and len(signatures(spark, sink)) == 2
    assert "no slot" not in {r.reason for r in K.read_rejects(spark, sink, SCHEMA).collect()}
    K.redeliver(spark, sink, SCHEMA, fix)
    assert len(signatures(spark, sink)) == 2 and K.read_rejects(spark, sink, SCHEMA).count() == 6


def test_a_transaction_stays_with_its_load(spark):
    """The same transaction in two loads, in one batch or later; a repeated load changes nothing."""
    sink = scratch_dir(spark, "owner")
    both = tx(spark, [good(1), good(1), good(2)]).withColumn("load", F.lit("b")).unionByName(tx(spark, [good(1), good(3)]).withColumn("load", F.lit("a")))
    assert K.append_transactions(both, sink)["duplicates"] == 2
    for _ in range(2):
        assert K.append_transactions(tx(spark, [good(2), good(4)]), sink, "c")["rows"]["trade"] == 1
        K.append_transactions(both, sink)
    held = {(r.signature[:3], r.load) for r in J.sink_keys(spark, sink, ["load"]).collect()}
    assert len(held) == 4 and J.sink_keys(spark, sink).count() == 4 and {x for _, x in held} == {"a", "b", "c"}


def test_known_transactions_in_another_slot_range_are_not_read(spark):
    """The plan: keys pruned by slot at the scan, no exchange on their side, the batch broadcast."""
    sink = scratch_dir(spark, "plan")
    K.append_transactions(tx(spark, [good(i) for i in range(1, 40)]), sink, "a")
    batch = tx(spark, [good(5), good(50)])
    found = K.owners(K.read_keys(spark, sink), batch, Decimal(105), Decimal(150), 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("BroadcastHashJoin"):]
    scan = below[:below.index("BroadcastExchange")]
    assert "FileScan parquet" in scan and "Exchange" not in scan and "slot" in scan[scan.index("PushedFilters"):]
    assert [(r.signature, r.owner) for r in found.collect()] == [(bytes([5]) * 64, "a")]
    assert K.BROADCAST_KEYS >= 2
    far = K.owners(K.read_keys(spark, sink), batch, Decimal(105), Decimal(150), K.BROADCAST_KEYS + 1)
    assert far.count() == 1


def test_unfinished_loads_and_interrupted_compaction(spark, monkeypatch):
    sink = scratch_dir(spark, "crash")
    K.append_transactions(tx(spark, [good(1), good(2)]), sink, "a")
    K.append_transactions(tx(spark, [good(3, t=TIME + 86400)]), sink, "b")

    def broken(df, path, *args, **kw):
        if path.endswith("/keys"):
            raise OSError("lost")
        return write(df, path, *args, **kw)
    write = W.write_load
    monkeypatch.setattr(W, "write_load", broken)
    with pytest.raises(OSError):
        K.append_transactions(tx(spark, [good(7)]), sink, "dead")
    monkeypatch.setattr(W, "write_load", write)
    assert len(signatures(spark, sink)) == 4
    assert K.drop_unfinished(spark, sink, prefix="wave-") == [] and K.drop_unfinished(spark, sink) == ["dead"]
    assert len(signatures(spark, sink)) == 3

    replace, calls = W.replace, []

    def stops(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        return replace(*args)
    monkeypatch.setattr(W, "replace", stops)
    with pytest.raises(OSError):
        K.compact(spark, sink)
    K.append_transactions(tx(spark, [good(1), good(2)]), sink, "a")              # a repeated batch in between adds nothing
    monkeypatch.setattr(W, "replace", replace)
    assert K.drop_unfinished(spark, sink) == [] and len(signatures(spark, sink)) == 3
    loads = {r.load for r in J.sink_keys(spark, sink, ["load"]).collect()}
    assert len(loads) == 1 and next(iter(loads)).startswith("merged-") and K.compact(spark, sink) is None


def test_swap(spark):
    root = scratch_dir(spark, "swap")
    spark.range(3).coalesce(1).write.mode("append").parquet(root)
    old = [n for n in W.names_in(spark, root) if n.startswith("part-")]

    def moves(to):
        spark.range(10, 12).coalesce(1).write.mode("append").parquet(root)       # comes meanwhile
        return [(n, n) for n in W.names_in(spark, to) if n.startswith("part-")]

    def fails(to):
        raise OSError("disk")
    with pytest.raises(OSError):
        W.replace(spark, root, fails, old, moves)
    assert spark.read.parquet(root).count() == 3
    W.replace(spark, root, lambda to: spark.range(100, 101).write.parquet(to), old, moves)
    assert sorted(r.id for r in spark.read.parquet(root).collect()) == [10, 11, 100]
    assert not [n for n in W.names_in(spark, root) if n.startswith("_swap")]


def test_snapshots(spark):
    s = W.Snapshots(spark, scratch_dir(spark, "snap") + "/s", "n long")
    assert s.before("a").count() == 0
    for load, n in (("a", 1), ("b", 2), ("b", 2), ("c", 3)):
        s.write(spark.createDataFrame([(n,)], "n long"), load)
    assert [s.before(x).first().n for x in ("c", "d")] == [2, 3] and s.latest().first().n == 3
    assert len(W.names_in(spark, s.path)) == 2


def test_undated_rows_are_appended_once(spark):
    path = scratch_dir(spark, "undated") + "/t"
    rows = spark.createDataFrame([("a", 1, None), ("a", 1, None), (None, 2, dt.date(2025, 1, 1)), ("c", 3, dt.date(2025, 1, 1))],
                                 "signature string, instruction_index long, event_date date")
    for _ in range(2):
        X.append_rows(rows, path)
        assert spark.read.parquet(path).count() == 3
