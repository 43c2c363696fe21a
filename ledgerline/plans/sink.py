"""The keyed event sink (K1, T1, T4, H2): transactions in, each once, in 8 event tables.

    {root}/{table}/event_date=D/load=L/    rows of a load
    {root}/keys/load=L/                    signature and slot of the load's transactions
    {root}/rejects/load=L/                 transactions that were set aside, and why

A load is a batch of a stream run or a wave of archive pairs.  It owns its folders and the transactions
that it brought first, so a repeated load replaces its own rows.  Whether a transaction is already there is asked of ``keys`` alone, once
for all tables, and only in the batch's range of slots: files of other slots are skipped by
their statistics, the batch's keys are broadcast while they are few (counted first) and the
table is not shuffled.  So a batch costs what its own slots hold, not what its days hold.  The
keys of a load are written after its tables and so mark it complete; ``drop_unfinished`` removes
the rows of loads that never got there and will not be repeated.

A transaction that could not be placed (no signature, slot, index, instructions, or an event
without its time) goes to ``rejects`` with the reason; the others of its batch go on.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalars import epoch_to_date
from ledgerline.operators.pairing import EVENT_TYPES, pair_fold
from ledgerline.operators.project import common_field, rows_of, table_rows
from ledgerline.schemas import TABLES, U64
from ledgerline.session import staged
from ledgerline.sources import files as W
from ledgerline.sources.transfer import DAY, ORDER

KEYS, REJECTS, _MERGE = "keys", "rejects", "merge-plan"
KEY_SCHEMA = T.StructType([T.StructField("signature", T.BinaryType()), T.StructField("slot", U64), T.StructField(W.LOAD, T.StringType())])
REASON, DIGEST = "reason", "digest"
BROADCAST_KEYS = 200_000     # of at most 64 bytes
CONCURRENT_WRITES = 8


def names_of(table_names: dict[str, str] | None) -> dict[str, str]:
    return table_names or {t.name: t.table for t in TABLES}


def reject_reason() -> Column:
    """Why a transaction cannot be placed; null if it can."""
    types = F.col("instructions.type")          # of the instructions only the types and times are read
    untimed = F.zip_with(types, F.col("instructions.event.timestamp"), lambda t, at: t.isin(*EVENT_TYPES) & at.isNull())
    return F.when(F.col("signature").isNull(), "no signature").when(F.col("slot").isNull(), "no slot") \
        .when(F.col("index").isNull(), "no index").when(types.isNull(), "no instructions") \
        .when(F.exists(types, lambda t: t.isNull()), "no instruction type") \
        .when(F.exists(untimed, lambda x: x), "no event time")


def read_keys(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/{KEYS}"
    return spark.read.schema(KEY_SCHEMA).parquet(path) if W.exists(spark, path) else spark.createDataFrame([], KEY_SCHEMA)


def read_rejects(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Transactions set aside: the columns of ``schema`` (those of the transactions), reason and load."""
    full = T.StructType([*schema.fields, T.StructField(REASON, T.StringType()), T.StructField(W.LOAD, T.StringType())])
    path = f"{root.rstrip('/')}/{REJECTS}"
    return spark.read.schema(full).parquet(path) if W.exists(spark, path) else spark.createDataFrame([], full)


def owners(keys: DataFrame, batch: DataFrame, low, high, n: int) -> DataFrame:
    """(signature, owner): the load that holds a transaction of ``batch``, of ``keys`` only the
    slots from ``low`` to ``high``.  A batch of up to BROADCAST_KEYS keys is broadcast, so
    ``keys`` is scanned where it lies."""
    held = keys.where(F.col("slot").between(F.lit(low), F.lit(high))).select("signature", F.col(W.LOAD).alias("owner"))
    asked = batch.select("signature")
    return held.join(F.broadcast(asked) if n <= BROADCAST_KEYS else asked, "signature", "left_semi") \
        .groupBy("signature").agg(F.min("owner").alias("owner"))


def _digested(bad: DataFrame) -> DataFrame:
    """Each transaction once, by its content: it may lack any key."""
    content = [c for c in bad.columns if c not in (W.LOAD, REASON)]
    return bad.withColumn(DIGEST, F.sha2(F.to_json(F.struct(*content)), 256)).groupBy(DIGEST).agg(
        F.min_by(F.struct(*content, REASON, W.LOAD), W.LOAD).alias("_t")).select(DIGEST, "_t.*")


def _set_aside(bad: DataFrame, root: str) -> None:
    """Keep each rejected transaction once, with the load that brought it first."""
    spark, path = bad.sparkSession, f"{root}/{REJECTS}"
    rows = _digested(bad)
    if W.exists(spark, path):
        kept = spark.read.schema(f"{DIGEST} string, {W.LOAD} string").parquet(path).withColumnRenamed(W.LOAD, "_owner")
        kept = kept.groupBy(DIGEST).agg(F.min("_owner").alias("_owner"))
        rows = rows.join(kept, DIGEST, "left").where(F.col("_owner").isNull() | (F.col("_owner") == F.col(W.LOAD))).drop("_owner")
        rows = staged(rows, "rejects")          # the folders that it reads are about to be replaced
    W.write_load(rows, path, [])


def append_transactions(tx: DataFrame, root: str, load: str | None = None, table_names: dict[str, str] | None = None,
                        size_col: str | None = None) -> dict:
    """Append whole transactions (signature, slot, index, instructions) to the event tables.

    ``load`` names the load, or ``tx`` has a ``load`` column.  Returns what was found: counts of
    transactions, rejected, duplicates, bundles (new transactions with events), the sum of
    ``size_col`` as bytes and the rows of each kind."""
    spark, root, names = tx.sparkSession, root.rstrip("/"), names_of(table_names)
    if load is not None:
        tx = tx.withColumn(W.LOAD, F.lit(load))
    judged = tx.withColumn(REASON, reject_reason())
    good_only = F.col(REASON).isNull()
    size = F.sum(size_col) if size_col else F.lit(0)
    facts = judged.agg(F.count("*").alias("n"), F.count(REASON).alias("bad"), F.count_distinct(F.when(good_only, F.col("signature"))).alias("new"),
                       F.min(F.when(good_only, F.col("slot"))).alias("low"), F.max(F.when(good_only, F.col("slot"))).alias("high"),
                       size.cast("bigint").alias("bytes")).first()
    n, bad, new = facts["n"], facts["bad"], facts["new"]
    out = {"transactions": n, "rejected": bad, "duplicates": n - bad - new, "bundles": 0, "bytes": facts["bytes"] or 0,
           "rows": {t.name: 0 for t in TABLES}}
    if bad:
        _set_aside(judged.where(F.col(REASON).isNotNull()), root)
    if n == bad:
        return out
    good, held = judged.where(good_only).drop(REASON), []
    if W.exists(spark, f"{root}/{KEYS}"):
        batch = good.select("signature", W.LOAD).distinct()
        known = owners(read_keys(spark, root), batch, facts["low"], facts["high"], n - bad).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(known)
        if n_known := known.count():      # a transaction stays with its load: a repeated load finds its own ones and writes them again
            side = F.broadcast(known) if n_known <= BROADCAST_KEYS else known
            ours = F.col("owner").isNull() | (F.col("owner") == F.col(W.LOAD))
            good = good.join(side, "signature", "left").where(ours).drop("owner")
            new = batch.join(side, "signature", "left").where(ours).select("signature").distinct().count()
    out["duplicates"] = n - bad - new
    if not new:                           # all of them are held by other loads
        held[0].unpersist()
        return out
    if out["duplicates"]:                 # of copies in one batch that of the first load stays
        rest = [c for c in good.columns if c != "signature"]
        good = good.groupBy("signature").agg(F.min_by(F.struct(*rest), W.LOAD).alias("_t")).select("signature", "_t.*")
    rows = table_rows(pair_fold(good), keep=[W.LOAD, F.col("signature").alias("_signature"), F.col("slot").alias("_slot")]) \
        .withColumn(DAY, epoch_to_date(common_field("timestamp")))
    # few files a day: days are gathered, small ones together, large ones over several partitions
    rows = rows.hint("rebalance", DAY).persist(StorageLevel.MEMORY_AND_DISK)
    held.append(rows)
    try:
        found = {r["event_table"]: r["count"] for r in rows.groupBy("event_table").count().collect()}
        out["rows"] |= found

        def write(kind: str) -> None:
            W.write_load(rows_of(rows, kind, [DAY, W.LOAD]), f"{root}/{names[kind]}", [DAY])

        job = inheritable_thread_target(spark)
        with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:        # the tables are independent; a failed one fails the call
            for done in [pool.submit(job(write), kind) for kind in found]:
                done.result()
        if found:
            seen = Observation("keys")
            keys = rows.select(F.col("_signature").alias("signature"), F.col("_slot").alias("slot"), W.LOAD).distinct()
            W.write_load(keys.sortWithinPartitions(W.LOAD, "slot").observe(seen, F.count(F.lit(1)).alias("n")), f"{root}/{KEYS}", [])
            out["bundles"] = seen.get["n"]
        return out
    finally:
        for df in held:
            df.unpersist()


def redeliver(spark: SparkSession, root: str, schema: T.StructType, fix, table_names: dict[str, str] | None = None) -> dict:
    """H2: deliver the rejected transactions again after ``fix`` (DataFrame to DataFrame with the
    columns of ``schema``).  Those that still cannot be placed are set aside anew."""
    path = f"{root.rstrip('/')}/{REJECTS}"
    W.finish(spark, path)
    old = list(W.partitions(spark, path, [W.LOAD]).values())
    if not old:
        return {"transactions": 0, "rejected": 0}
    rows = staged(fix(read_rejects(spark, root, schema).drop(REASON, W.LOAD)).select(*schema.names), "redelivery")
    judged = rows.withColumn(REASON, reject_reason())
    load = f"redelivery-{uuid.uuid4().hex[:12]}"
    out = append_transactions(judged.where(F.col(REASON).isNull()).drop(REASON), root, load, table_names)
    bad = _digested(judged.where(F.col(REASON).isNotNull()).withColumn(W.LOAD, F.lit(load)))
    W.replace(spark, path, lambda to: bad.drop(W.LOAD).write.parquet(to), old, lambda to: [("", f"{W.LOAD}={load}")])
    out["rejected"] = bad.count()
    return out


# ------------------------------------------------------------------ maintenance
def _loads(spark: SparkSession, root: str) -> set[str]:
    return {values[0] for values in W.partitions(spark, f"{root.rstrip('/')}/{KEYS}", [W.LOAD])}


def is_complete(spark: SparkSession, root: str, load: str) -> bool:
    """Whether a load with events was written to the end."""
    return load in _loads(spark, root)


def drop_unfinished(spark: SparkSession, root: str, table_names: dict[str, str] | None = None, prefix: str = "") -> list[str]:
    """Remove the rows of loads (named ``prefix``...) without keys: runs that stopped in the middle
    and will not go on (a stream whose checkpoint was lost).  Only while none of them is at work."""
    _resume(spark, root, table_names)
    done, gone = _loads(spark, root), set()
    for table in names_of(table_names).values():
        for (_, load), folder in W.partitions(spark, f"{root.rstrip('/')}/{table}", [DAY, W.LOAD]).items():
            if load.startswith(prefix) and load not in done:
                W.delete(spark, f"{root.rstrip('/')}/{table}/{folder}")
                gone.add(load)
    return sorted(gone)


def compact(spark: SparkSession, root: str, table_names: dict[str, str] | None = None) -> str | None:
    """Merge the files of all complete loads: keys by slot, event tables by day in row order.

    The keys come first, under the name of the merged load: from then on a repeated old load
    finds its transactions known and writes nothing.  The plan is stored before, and an
    interrupted compaction is completed by the next one."""
    _resume(spark, root, table_names)
    loads = sorted(_loads(spark, root))
    if len(loads) < 2:
        return None
    merged = f"merged-{uuid.uuid4().hex[:12]}"
    W.write_text(spark, f"{root.rstrip('/')}/{_MERGE}", json.dumps({"merged": merged, "loads": loads}))
    _resume(spark, root, table_names)
    return merged


def _resume(spark: SparkSession, root: str, table_names: dict[str, str] | None) -> None:
    root = root.rstrip("/")
    if not W.exists(spark, f"{root}/{_MERGE}"):
        return
    plan = json.loads(W.read_text(spark, f"{root}/{_MERGE}"))
    merged, loads = plan["merged"], set(plan["loads"])
    W.finish(spark, f"{root}/{KEYS}")
    if old := sorted(_loads(spark, root) & loads):
        keys = read_keys(spark, root).where(F.col(W.LOAD).isin(old)).drop(W.LOAD)
        W.replace(spark, f"{root}/{KEYS}", lambda to: keys.repartitionByRange("slot").sortWithinPartitions("slot").write.parquet(to),
                  [f"{W.LOAD}={x}" for x in old], lambda to: [("", f"{W.LOAD}={merged}")])
    for table in names_of(table_names).values():
        path = f"{root}/{table}"
        W.finish(spark, path)
        if old := [f for (_, load), f in W.partitions(spark, path, [DAY, W.LOAD]).items() if load in loads]:
            rows = spark.read.parquet(path).where(F.col(W.LOAD).isin(sorted(loads))).withColumn(W.LOAD, F.lit(merged))

            def write(to: str, rows=rows) -> None:
                rows.repartitionByRange(DAY, *ORDER).sortWithinPartitions(DAY, *ORDER).write.partitionBy(DAY, W.LOAD).parquet(to)
            W.replace(spark, path, write, old, lambda to: [(f, f) for f in W.partitions(spark, to, [DAY, W.LOAD]).values()])
    W.delete(spark, f"{root}/{_MERGE}")
