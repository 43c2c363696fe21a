"""A store of numbered channels that forgets: publish (W4, T8), expire (T7, W6), subscribe.

    {root}/messages/subject=S/bucket=B/load=L/   envelopes with their channel's number
    {root}/counters/n=N,load=L/                  the last number of each channel, per batch

``bucket`` is the start of a period of event time, so what has expired are whole folders.
A load is a micro-batch of a run; it owns its folders, and a repeated one gets the same numbers.
One publisher and one expiry job at a time for a store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalars import bucket_start, channel_stream
from ledgerline.operators.envelope import DEFAULT_MAX_BYTES, DEFAULT_MAX_MSGS, DEFAULT_TTL_SECONDS, retain, route, sequence, subscribe
from ledgerline.session import staged
from ledgerline.sources import files as W
from ledgerline.streaming.jobs import dedupe_within, run_foreach, run_id

MESSAGES, COUNTERS = "messages", "counters"
PARTITIONS = ["subject", "bucket"]
KEPT = "kept-"               # loads written by expiry
BUCKET_SECONDS = 60


# ------------------------------------------------------------------ publish
def publish_batch(spark: SparkSession, root: str, run: str, bucket_seconds: int = BUCKET_SECONDS, order=("ts", "uuid")):
    """Each micro-batch's envelopes get the next numbers of their channel, in ``order``.

    The numbers within the batch come from a segmented scan of the narrow columns (one channel
    may hold most messages); the batch starts from the counters that the batch before it left.
    Messages are written before the counters, both under the load's name, so a batch repeated
    after a crash writes the same rows again."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        load = f"{run}-{batch_id}"
        counters = W.Snapshots(spark, f"{root.rstrip('/')}/{COUNTERS}",
                               f"channel {batch.schema['channel'].dataType.simpleString()}, last long")
        before = counters.before(load)
        rows = staged(route(batch).withColumn("_row", F.monotonically_increasing_id()), "publish")
        new = sequence(rows.select("channel", *order, "_row"), order=(*order, "_row")).select("_row", "seq")
        base = F.coalesce(F.col("last"), F.lit(0))
        numbered = rows.join(new, "_row").join(before, "channel", "left").withColumn("seq", F.col("seq") + base).drop("last", "_row")
        period = bucket_start(F.unix_seconds(F.col("ts").cast("timestamp")), bucket_seconds)
        # few files a folder: the rows of one are gathered, else each task would open a file in each
        W.write_load(numbered.withColumn("bucket", period).hint("rebalance", *PARTITIONS), f"{root.rstrip('/')}/{MESSAGES}", PARTITIONS, load)
        added = rows.groupBy("channel").agg(F.count(F.lit(1)).alias("added"))
        after = before.join(added, "channel", "full").select(
            "channel", (F.coalesce("last", F.lit(0)) + F.coalesce("added", F.lit(0))).cast("long").alias("last"))
        counters.write(after, load)
    return handle


def publish(stream: DataFrame, root: str, checkpoint: str, bucket_seconds: int = BUCKET_SECONDS, order=("ts", "uuid"),
            trigger: dict | None = None):
    """Envelopes (channel, authority, ts, uuid, ...) to their subjects, numbered per channel."""
    handle = publish_batch(stream.sparkSession, root, run_id(checkpoint), bucket_seconds, order)
    return run_foreach(stream, handle, checkpoint, trigger)


def message_schema(envelopes: T.StructType) -> T.StructType:
    """Schema of the stored messages from that of the published envelopes."""
    own = [f for f in envelopes.fields if f.name not in ("subject", "seq", "bucket", W.LOAD)]
    return T.StructType([*own, T.StructField("seq", T.LongType()), T.StructField("subject", T.StringType()),
                         T.StructField("bucket", T.LongType()), T.StructField(W.LOAD, T.StringType())])


def read_messages(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    path = f"{root.rstrip('/')}/{MESSAGES}"
    return spark.read.schema(schema).parquet(path) if W.exists(spark, path) else spark.createDataFrame([], schema)


# ------------------------------------------------------------------ expire
def expire(spark: SparkSession, root: str, schema: T.StructType, as_of: str, ttl_seconds: int = DEFAULT_TTL_SECONDS,
           max_msgs: int = DEFAULT_MAX_MSGS, max_bytes: int = DEFAULT_MAX_BYTES, bucket_seconds: int = BUCKET_SECONDS) -> dict:
    """Drop what the limits of ``envelope.retain`` let go.

    Buckets that end before the ttl go as folders, unread.  Of the others the narrow columns are
    read: a bucket that holds no kept message goes as a folder, one that holds only kept ones is
    left alone, and the few between are rewritten and swapped in (``files.replace``).  Messages
    later than ``as_of`` are not due and stay.  Returns the folders dropped and rewritten."""
    path = f"{root.rstrip('/')}/{MESSAGES}"
    W.finish(spark, path)
    now = spark.sql(f"SELECT unix_seconds(CAST(TIMESTAMP '{as_of}' AS TIMESTAMP))").first()[0]
    folders = W.partitions(spark, path, PARTITIONS)
    gone = [f for (_, bucket), f in folders.items() if int(bucket) + bucket_seconds <= now - ttl_seconds]
    for folder in gone:
        W.delete(spark, f"{path}/{folder}")
    messages = read_messages(spark, root, schema)
    narrow = messages.select("channel", "ts", "uuid", "payload_bytes", "seq", *PARTITIONS)
    due = F.unix_seconds(F.col("ts").cast("timestamp")) <= now
    kept = staged(retain(narrow.where(due), as_of, ttl_seconds, max_msgs, max_bytes).unionByName(narrow.where(~due))
                  .select("channel", "seq", *PARTITIONS), "kept")
    total = narrow.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n"))
    held = kept.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("held"))
    changed = total.join(held, PARTITIONS, "left").where("held is null or held < n").collect()   # a row for each folder that changes
    empty = [folders[r["subject"], str(r["bucket"])] for r in changed if r["held"] is None]
    for folder in empty:
        W.delete(spark, f"{path}/{folder}")
    partly = [r for r in changed if r["held"] is not None]
    if partly:
        old = [folders[r["subject"], str(r["bucket"])] for r in partly]
        some = F.concat_ws("|", *PARTITIONS).isin([f"{r['subject']}|{r['bucket']}" for r in partly])
        rest = messages.where(F.col("subject").isin([r["subject"] for r in partly]) & F.col("bucket").isin([r["bucket"] for r in partly]) & some) \
            .join(kept.select("channel", "seq"), ["channel", "seq"], "left_semi") \
            .hint("rebalance", *PARTITIONS).withColumn(W.LOAD, F.lit(f"{KEPT}{now}"))
        W.replace(spark, path, lambda to: rest.write.partitionBy(*PARTITIONS, W.LOAD).parquet(to), old,
                  lambda to: [(f, f) for f in W.partitions(spark, to, PARTITIONS).values()])
    return {"dropped": gone + empty, "rewritten": [folders[r["subject"], str(r["bucket"])] for r in partly]}


# ------------------------------------------------------------------ subscribe
def deliver(spark: SparkSession, root: str, schema: T.StructType, subscriptions, sink: str, checkpoint: str,
            channels: list | None = None, ttl: str = "1 hour", trigger: dict | None = None):
    """New messages of the store to the subscribers of their channels, each once.

    The position is the checkpoint's.  ``subscriptions()`` (subscriber, channel) is asked anew
    for every batch, so a subscriber gets the messages that come after it joined.  ``channels``
    prunes the subjects that are read at all.  Messages that come in new files a second time
    (published again after a crash, rewritten by expiry) are known by their number for ``ttl``,
    the life of a message, which bounds the state; what is older has expired."""
    stream = spark.readStream.schema(schema).parquet(f"{root.rstrip('/')}/{MESSAGES}")
    if channels is not None:
        names = [channel_stream(F.lit(c)) for c in channels]
        stream = stream.where(F.substring_index("subject", ".", 1).isin(names) if names else F.lit(False))
    once = dedupe_within(stream.withColumn("_at", F.col("ts").cast("timestamp")), ["channel", "seq"], "_at", ttl).drop("_at")
    run = run_id(checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        W.write_load(subscribe(batch.drop("bucket", W.LOAD), subscriptions()), sink, ["subscriber"], f"{run}-{batch_id}")
    return run_foreach(once, handle, checkpoint, trigger)
