"""Physical-plan properties that matter at scale."""
import re

from pyspark.sql import functions as F

from ledgerline.operators import reconcile as R
from ledgerline.operators.envelope import retain
from ledgerline.operators.pairing import pair_fold, pair_window
from ledgerline.operators.project import project_tx
from ledgerline.plans import standins as S
from ledgerline.session import scratch_dir
from ledgerline.sources import transfer as X

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schema(df) -> str:
    s = _plan(df)
    i = s.find("ReadSchema")
    return s[i:s.find("\n", i)]


def test_nested_reads_are_pruned(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    path = scratch_dir(spark, "tx") + "/tx"
    S.transactions(spark, SF).write.parquet(path)
    tx = spark.read.parquet(path)
    pos = _read_schema(pair_fold(tx).select("user_id", "position", "partner_position"))
    assert "instructions:array<struct<type:string>>" in pos
    trade = _read_schema(project_tx(tx, "trade"))
    assert "accounts" not in trade and "base_amount_out" not in trade and "sol_amount" in trade
    buy = _read_schema(project_tx(tx, "amm_buy"))
    assert "accounts" in buy and "bonding_curve" not in buy


def test_reconcile_pushes_time_range_and_broadcasts_only_bounded_lists(spark):
    path = scratch_dir(spark, "ev") + "/ev"
    S.event_table(spark, SF).write.parquet(path)
    t = spark.read.parquet(path)
    start, end = R.time_window("2024-01-20T02:00:00", 2, 7)
    plan = _plan(R.reconcile_minutes(t, t, start, end))
    pushed = [line for line in plan.split("\n") if "PushedFilters" in line]
    lo, hi = R.hour_span(start, end)
    assert any(f"GreaterThanOrEqual(timestamp,{start})" in x and f"LessThan(timestamp,{end})" in x for x in pushed)
    assert any(f"GreaterThanOrEqual(timestamp,{lo})" in x and f"LessThan(timestamp,{hi})" in x for x in pushed)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_retention_limits_before_shuffle(spark):
    plan = _plan(retain(S.event_envelopes(spark, SF), "2024-01-30 12:00:00", 86400, 100, 700))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def _dated(spark, name):
    path = scratch_dir(spark, name) + "/t"
    df = S.event_table(spark, SF).withColumn("event_date", F.to_date(F.timestamp_seconds("timestamp")))
    df.repartition(1).write.partitionBy("event_date").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _partition_filters(df):
    return [x for x in re.findall(r"PartitionFilters: \[([^\]]*)\]", _plan(df))]


def test_time_ranges_prune_days(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    t, _ = _dated(spark, "dated")
    start, end = R.time_window("2024-01-20T02:00:00", 2, 7)
    dm = R.reconcile_minutes(t, t, start, end)
    for df in (R.reconcile_hours(t, t, start, end), dm, R.repair_rows(t, t, dm, span=R.hour_span(start, end)),
               X.extract_daily(t, "2024-01-05", "2024-01-06", order=("timestamp",))):
        found = _partition_filters(df)
        assert found and all("event_date" in f and ">=" in f and "<=" in f for f in found)
    days = X.extract_daily(t, "2024-01-05", "2024-01-06", order=("timestamp",))
    assert {str(r[0]) for r in days.select("event_date").distinct().collect()} == {"2024-01-05", "2024-01-06"}


def test_deduped_append_reads_the_days_it_writes(spark, monkeypatch):
    t, path = _dated(spark, "append")
    seen = []
    join = type(t).join
    monkeypatch.setattr(type(t), "join", lambda self, other, *a, **k: seen.append(other) or join(self, other, *a, **k))
    one = t.where("event_date = date'2024-01-07'")
    n = t.count()
    X.append_rows(one.unionByName(one), path)
    assert _partition_filters(seen[-1]) and "2024-01-07" in str(_partition_filters(seen[-1]))
    assert spark.read.schema(t.schema).parquet(path).count() == n


def test_scans_need_no_python(spark):
    flat = S.flat_instructions(spark, SF).select("user_id", "ts", "event_id", F.col("instruction.type").alias("type"))
    plan = _plan(pair_window(flat, ["user_id"], ["ts", "event_id"], "type"))
    assert "Python" not in plan and "Pandas" not in plan and "InMemoryTableScan" not in plan
