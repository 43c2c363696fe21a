"""Structured Streaming jobs.

* Sources are ``readStream`` with explicit schemas (a file source here; any
  connector in production); back-pressure is ``maxFilesPerTrigger`` /
  ``maxOffsetsPerTrigger``, the reference's size/time flush is the trigger.
* The event tables are the keyed sink of the batch job (``plans.sink``): a
  transaction is kept once, so a replayed batch, a redelivered file or a second
  checkpoint adds nothing, and malformed transactions are set aside.
* Other sinks write inside ``foreachBatch`` into a directory owned by the run
  (its checkpoint) and the batch id: a replayed batch (crash after write,
  before commit) replaces its own output and never another run's.
* An exception in ``foreachBatch`` stops the query without committing the
  batch -- the ack-after-success behaviour of the reference's callbacks.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalars import start_slot, strip_repeated_suffix
from ledgerline.operators.envelope import SIGNAL_TYPE_V1, build_envelopes, route, to_v1
from ledgerline.operators.project import bundle_json, bundle_total, event_bundle_inrow
from ledgerline.plans.jobs import WAVE_BYTES, ingest_pairs, pending_waves
from ledgerline.plans.sink import append_transactions
from ledgerline.schemas import TABLES, table_schema
from ledgerline.sources.files import LOAD
from ledgerline.sources.transfer import _exists

RUN_COL = "run_id"
BATCH_COL = "batch_id"


def file_stream(spark: SparkSession, directory: str, schema: T.StructType, glob: str = "*.parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: a stream of Parquet files (explicit schema, no inference)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def dedupe_within(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop redelivered messages (at-least-once sources): one row per key while
    the key's event time is inside the watermark delay; state is bounded by it."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def run_id(checkpoint: str) -> str:
    """Name of a run: the same for restarts on one checkpoint, another for another one."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def write_batch(df: DataFrame, path: str, run: str, batch_id: int, partition_by: list[str]) -> None:
    """Idempotent per-batch append: the batch owns ``{path}/run_id=R/batch_id=N`` and
    overwrites it whole, so a replayed batch replaces its own output and never
    touches other batches or runs (readers discover both as partitions)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path.rstrip('/')}/{RUN_COL}={run}/{BATCH_COL}={batch_id}")


def _run(writer, trigger: dict):
    q = writer.trigger(**trigger).start()
    if trigger.get("availableNow") or trigger.get("once"):
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q


def fanout_batch(to_transactions: Callable[[DataFrame], DataFrame], sink_root: str, table_names=None,
                 log: Callable[[int, float, float, dict], None] | None = None, run: str = "run",
                 size_col: str | None = None, clock: Callable[[], float] = time.time):
    """Each micro-batch is a load of the keyed sink (``plans.sink``): a
    transaction once across batches and runs, malformed ones set aside.  ``log`` gets the batch
    id, the seconds at which the batch began and ended by ``clock``, and what the sink found."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        began = clock()
        found = append_transactions(to_transactions(batch), sink_root, f"{run}-{batch_id}", table_names, size_col)
        if log is not None:
            log(batch_id, began, clock(), found)
    return handle


def run_fanout(stream: DataFrame, to_transactions, sink_root: str, checkpoint: str,
               trigger: dict | None = None, table_names=None, log=None, size_col: str | None = None,
               clock: Callable[[], float] = time.time):
    """``trigger={'availableNow': True}`` is the single pass,
    ``{'processingTime': '600 seconds'}`` the watch mode."""
    handle = fanout_batch(to_transactions, sink_root, table_names, log, run_id(checkpoint), size_col, clock)
    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _run(w, trigger or {"availableNow": True})


BATCH_LOG = "epoch long, transactions long, rejected long, duplicates long, bundles long, rows_written long, bytes long, processing_us long"


def ingest_log(spark: SparkSession, path: str, checkpoint: str):
    """``log`` of ``fanout_batch`` that keeps one row for each micro-batch as it was
    measured: when it ended, its transactions and their bytes, what the sink did with them and
    how long the batch took.  ``stats.ingest_stats`` sums the rows up by period."""
    run = run_id(checkpoint)

    def log(batch_id: int, began: float, ended: float, found: dict) -> None:
        row = (int(ended), found["transactions"], found["rejected"], found["duplicates"], found["bundles"], sum(found["rows"].values()),
               found["bytes"], round((ended - began) * 1_000_000))
        write_batch(spark.createDataFrame([row], BATCH_LOG), path, run, batch_id, [])
    return log


def read_sink(spark: SparkSession, sink_root: str, kind: str, table_names=None, load: bool = False) -> DataFrame:
    names = table_names or {t.name: t.table for t in TABLES}
    own = [T.StructField("event_date", T.DateType())] + [T.StructField(LOAD, T.StringType())] * load
    schema = T.StructType([*table_schema(kind).fields, *own])
    path = f"{sink_root.rstrip('/')}/{names[kind]}"
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def sink_keys(spark: SparkSession, sink_root: str, keep=()) -> DataFrame:
    """event_table and the common columns of every row in the 8 tables; ``keep``: further
    columns, of the ``load`` that brought the row."""
    parts = [read_sink(spark, sink_root, t.name, load=bool(keep)).select(
        F.lit(t.name).alias("event_table"), "signature", "slot", "transaction_index", "instruction_index", "timestamp", *keep) for t in TABLES]
    return reduce(DataFrame.unionByName, parts)


def closed_window_stats(stream: DataFrame, stats_fn, sink: str, checkpoint: str, event_time: str,
                        delay: str, trigger: dict | None = None):
    """Tumbling-window statistics, appended when the watermark closes the window."""
    agg = stats_fn(stream.withWatermark(event_time, delay), event_time=event_time)
    w = agg.writeStream.outputMode("append").format("parquet").option("path", sink) \
        .option("checkpointLocation", checkpoint)
    return _run(w, trigger or {"availableNow": True})


def distinct_per_window(stream: DataFrame, key: list[str], event_time: str, window: str, delay: str) -> DataFrame:
    """Exact distinct keys per closed window on a stream: drop duplicate
    (key, window) under the watermark, then count -- two bounded stateful steps
    (``count_distinct`` is not supported on streams)."""
    w = stream.withWatermark(event_time, delay).withColumn("_w", F.window(event_time, window))
    return w.dropDuplicates([*key, "_w"]).groupBy("_w").agg(F.count(F.lit(1)).cast("bigint").alias("unique_count")) \
        .select(F.unix_seconds(F.col("_w.start").cast("timestamp")).alias("window_start"), "unique_count")


def run_append(df: DataFrame, sink: str, checkpoint: str, partition_by: list[str] | None = None,
               trigger: dict | None = None):
    w = df.writeStream.outputMode("append").format("parquet").option("path", sink) \
        .option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _run(w, trigger or {"availableNow": True})


def bundle_envelopes_batch(to_transactions, tx_keys: list[str], sink: str, checkpoint: str, sender_agent: str, ts,
                           authority_text: str = "lv0", channel: str = "events"):
    """T5 (v1): per transaction a bundle of the 8 arrays; empty bundles are
    dropped; each bundle becomes one envelope (replay-stable uuid, payload =
    self-describing JSON of the bundle), routed by authority.  ``ts``: column of
    the transactions that is the envelope's time (no clock, so a replay gives
    the same row)."""
    run = run_id(checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        tx = to_transactions(batch)
        bundles = event_bundle_inrow(tx.withColumn("_ts", ts), [*tx_keys, "_ts"])
        sized = bundles.select(*tx_keys, "_ts", bundle_total().alias("n_events"), bundle_json(bundles).alias("_payload"))
        env = build_envelopes(sized, channel=F.lit(channel), ts="_ts", payload="_payload",
                              id_cols=[F.lit("tx"), *tx_keys], authority_text=F.lit(authority_text),
                              sender_agent=sender_agent, content_type=SIGNAL_TYPE_V1, keep=[*tx_keys, "n_events"])
        write_batch(to_v1(route(env)), sink, run, batch_id, [])
    return handle


def run_foreach(stream: DataFrame, handle, checkpoint: str, trigger: dict | None = None):
    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _run(w, trigger or {"availableNow": True})


def raw_envelopes(stream: DataFrame, *, channel, ts, payload, id_cols, authority_text, sender_agent: str) -> DataFrame:
    """T6 (v2): payload passed through undecoded, nothing skipped, routed."""
    return route(build_envelopes(stream, channel=channel, ts=ts, payload=payload, id_cols=id_cols,
                                 authority_text=authority_text, sender_agent=sender_agent))


# ------------------------------------------------------------------ watch mode of the archive
#: Columns of Spark's binaryFile source.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def listing_stream(spark: SparkSession, directory: str, suffix: str, tag: str, max_files: int | None = None) -> DataFrame:
    """S1 as a stream: prefix, path, length and time of the files with ``suffix`` as they come."""
    r = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", f"*{suffix}")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    files = r.load(directory).select("path", "length", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(strip_repeated_suffix(name, suffix).alias(f"{tag}_prefix"), F.col("path").alias(f"{tag}_path"),
                        F.col("length").alias(f"{tag}_length"), F.col("modificationTime").alias(f"{tag}_time"))


def completed_pairs(spark: SparkSession, directory: str, wait: str, max_files: int | None = None) -> DataFrame:
    """J1 as a stream-stream join: a pair comes out when its second file does, in whichever order
    they arrive.  A file waits for its other half for ``wait``, which bounds the state; a half
    that comes later stays pending and is found by the next full scan (``plans.jobs.ingest_batch``)."""
    meta = listing_stream(spark, directory, ".meta", "meta", max_files).withWatermark("meta_time", wait)
    data = listing_stream(spark, directory, ".bin", "bin", max_files).withWatermark("bin_time", wait)
    near = F.expr(f"meta_prefix = bin_prefix AND bin_time BETWEEN meta_time - INTERVAL {wait} AND meta_time + INTERVAL {wait}")
    pairs = meta.where("meta_prefix <> ''").join(data, near, "inner")
    return pairs.select(F.col("meta_prefix").alias("prefix"), "meta_path", "meta_length", "bin_path", "bin_length")


def watch_archive(spark: SparkSession, directory: str, ledger_path: str, transactions: Callable[[], DataFrame], sink_root: str,
                  checkpoint: str, now: Callable[[], str], wait: str = "7 days", trigger: dict | None = None,
                  wave_bytes: int = WAVE_BYTES, max_files: int | None = None):
    """Pairs are ingested as they are completed (C1: wave by wave, each pair once by ledger
    and keyed sink).  ``transactions()`` is read anew for each batch; ``now()`` stamps the ledger.
    ``trigger={'processingTime': '600 seconds'}`` watches; the default takes what is there."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        manifest = batch.groupBy("prefix").agg(F.min_by("meta_length", "meta_path").alias("meta_length"),
                                               F.min_by("bin_length", "bin_path").alias("bin_length"))
        manifest = manifest.withColumn("start_slot", F.coalesce(start_slot("prefix"), F.lit(0).cast("decimal(20,0)")))
        ingest_pairs(pending_waves(spark, manifest, ledger_path, wave_bytes), ledger_path, transactions(), sink_root, now())
    return run_foreach(completed_pairs(spark, directory, wait, max_files), handle, checkpoint, trigger)
