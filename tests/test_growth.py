"""What a task reads, holds and writes stays the same when the tables grow."""
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import envelope as V
from ledgerline.operators.project import event_bundle_inrow
from ledgerline.plans import catalog as Q
from ledgerline.plans import sink as K
from ledgerline.plans import standins as S
from ledgerline.session import READ_ROWS, ensure_utc, scratch_dir
from ledgerline.sources import files as W
from ledgerline.streaming import channels as C
from ledgerline.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def local(path: str) -> str:
    return path.replace("file:", "", 1)


def test_no_instruction_passes_through_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(S, "TASK_EVENTS", 300)
    tx = S.transactions(spark, SF)
    line = next(x for x in plan_of(tx).split("\n") if "Exchange" in x)
    n = -(-S.table(spark, SF, "events").count() // 300)
    assert f", {n})" in line and "REPARTITION_BY_NUM" in line and tx.rdd.getNumPartitions() == n
    below = plan_of(tx)[plan_of(tx).index("Exchange"):]
    assert "named_struct" not in below and "bonding_curve" not in below


def test_order_of_instructions_with_one_time_and_id(spark):
    rows = [(e, t, u, k, 0.0, "") for e, t, u, k in [(8, "2024-01-01 00:00:02", 1, "click"), (8, "2024-01-01 00:00:02", 1, None),
            (8, "2024-01-01 00:00:02", 1, "error"), (9, "2024-01-01 00:00:01", 1, "purchase"), (4, None, 1, "view"), (3, None, None, "view")]]
    ev = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    old = S.flat_instructions_from(ev).groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", "instruction"))).alias("x"))
    want = {r.user_id: [i["instruction"] for i in r.x] for r in old.collect()}
    assert {r.user_id: r.instructions for r in S.transactions_from(ev).collect()} == want and len(want[1]) == 5


def test_bundles_are_made_once(spark):
    """One fold and one making of the arrays; a condition on them is not moved below."""
    path = scratch_dir(spark, "bundle") + "/tx"
    S.transactions(spark, SF).write.parquet(path)
    for tx in (spark.read.parquet(path), S.transactions(spark, SF)):
        b = event_bundle_inrow(tx, ["user_id"])
        assert b._jdf.queryExecution().optimizedPlan().toString().count("partner_position, element_at") == 1
        assert not [x for x in plan_of(b).split("\n") if "Filter" in x and "transform" in x]


def test_deliveries_of_many_files_are_a_batch_each(spark, monkeypatch):
    monkeypatch.setattr(S, "TASK_EVENTS", 200)
    path = Q._tx_files(spark, SF)
    files = Counter(n.partition("-")[0] for n in W.names_in(spark, path) if n.endswith(".parquet"))
    assert set(files) == {"0", "1", "2"} and len(set(files.values())) == 1 and files["0"] > 1
    seen, ckpt = [], scratch_dir(spark, "deliveries")
    J.run_foreach(Q._tx_stream(spark, path), lambda b, n: seen.append(sorted({r[0] % 3 for r in b.select("user_id").collect()})), ckpt)
    assert seen == [[0], [1], [2]]


def test_a_delivered_file_holds_no_more_when_the_table_grows(spark, monkeypatch):
    """A task writes, and a file holds, TASK_EVENTS events or so, however many there are; none is lost."""
    monkeypatch.setattr(S, "TASK_EVENTS", 200)

    def most(n: int) -> int:
        d = scratch_dir(spark, "grown")
        spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + S.EPOCH_2024).cast("timestamp_ntz").alias("ts"),
                              F.expr("id div 10").alias("user_id"), F.when(F.col("id") % 2 == 0, "click").otherwise("purchase").alias("event_type"),
                              F.lit(1.0).alias("value"), F.lit("{}").alias("props")).write.parquet(f"{d}/events.parquet")
        tx = spark.read.parquet(Q._tx_files(spark, d))
        held = [r.n for r in tx.groupBy(F.input_file_name()).agg(F.sum(F.size("instructions")).alias("n")).collect()]
        assert sum(held) == n
        return max(held)
    assert most(600) <= S.TASK_EVENTS and most(2400) <= S.TASK_EVENTS


@pytest.mark.parametrize("name", ["stream_rejects", "ingest_waves"])
def test_rows_of_a_sink_are_not_sent_to_every_task(spark, name):
    assert "SortMergeJoin [signature" in plan_of(Q.QUERIES[name](spark, SF))


def test_judging_reads_types_and_times_only(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    path = scratch_dir(spark, "judge") + "/tx"
    S.transactions(spark, SF).write.parquet(path)
    plan = plan_of(spark.read.parquet(path).select(K.reject_reason().alias("r")).groupBy("r").count())
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "instructions:array<struct<type:string,event:struct<timestamp:" in read and "accounts" not in read and "bonding_curve" not in read


def test_scans_hold_few_wide_rows(spark):
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "4096")
    ensure_utc(spark)
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) == READ_ROWS <= 512


def test_a_load_of_known_transactions_is_not_paired(spark, monkeypatch):
    sink, tx = scratch_dir(spark, "known"), S.transactions(spark, SF)
    first = K.append_transactions(tx, sink, "a")

    def fails(*args, **kw):
        raise AssertionError("paired again")
    monkeypatch.setattr(K, "pair_fold", fails)
    again = K.append_transactions(tx.unionByName(tx), sink, "b")
    assert (again["transactions"], again["duplicates"], again["bundles"]) == (2 * first["transactions"], 2 * first["transactions"], 0)


def test_messages_are_gathered_by_folder(spark):
    """Not a file in every folder from every task, neither when published nor when expiry rewrites."""
    root = scratch_dir(spark, "gathered")
    env = V.build_envelopes(spark.range(0, 600, 1, 6).withColumn("ts", F.timestamp_seconds(F.col("id") + S.EPOCH_2024).cast("timestamp_ntz")),
                            channel=F.lit("a"), ts="ts", payload=F.col("id").cast("string"), id_cols=["id"], authority_text=F.lit("lv1"),
                            sender_agent="t").withColumn("payload_bytes", F.length("payload").cast("bigint"))

    def files():
        found = Counter(at for at, _, names in os.walk(local(f"{root}/messages")) for n in names if n.endswith(".parquet"))
        return len(found), sum(found.values())
    C.publish_batch(spark, root, "r", 300)(env.orderBy(F.xxhash64("uuid")).repartition(6), 0)
    assert files() == (2, 2)
    out = C.expire(spark, root, C.message_schema(env.schema), "2024-01-01 00:10:00", 450, bucket_seconds=300)
    assert len(out["rewritten"]) == 1 and files() == (2, 2)


def test_a_wave_reads_its_pairs_only(spark):
    tx = Q._staged_archive(spark, SF, "pairs")
    assert tx.schema.simpleString() == Q._archive_transactions(spark, SF).schema.simpleString()
    one = tx.where(F.col("prefix").isin(["300_399", "500_599"]))
    assert "PartitionFilters: [prefix" in plan_of(one) and 0 < one.count() < tx.count()
