"""Signal envelopes on routed, retention-limited channels.

A channel is a named log; messages go to subject ``telepath_{channel}.lv{n}``
by authority level, and a subscription to a channel receives every subject
under its prefix.  Sequence numbers and retention are per channel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.scalars import authority_level, channel_stream, channel_subject
from ledgerline.operators.scan import segmented_scan

# Reference defaults of a channel and of the envelope.
DEFAULT_TTL_SECONDS = 300
DEFAULT_MAX_MSGS = 10_000
DEFAULT_MAX_BYTES = -1          # unlimited
CONTENT_TYPE_V2 = "parsed_transaction"
SIGNAL_TYPE_V1 = "bytes"


def stable_uuid(*cols) -> Column:
    """Replay-stable UUID text from identifying columns (``uuid()`` is not)."""
    h = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                  for c in cols]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def build_envelopes(df: DataFrame, *, channel, ts, payload, id_cols, authority_text,
                    sender_agent: str, content_type: str = CONTENT_TYPE_V2, parent_uuid: str = "",
                    keep=()) -> DataFrame:
    """One envelope per input row (``keep``: extra columns carried along)."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    return df.select(
        *keep,
        c(channel).alias("channel"),
        c(ts).alias("ts"),
        stable_uuid(*id_cols).alias("uuid"),
        F.lit(parent_uuid).alias("parent_uuid"),
        F.lit(sender_agent).alias("sender_agent"),
        authority_level(c(authority_text)).alias("authority"),
        F.lit(content_type).alias("content_type"),
        c(payload).cast("binary").alias("payload"),
    )


def to_v1(env: DataFrame) -> DataFrame:
    """v1 envelope shape: ``signal_type`` and a oneof content (``text`` or
    ``binary_data``; binary payloads go to ``binary_data``)."""
    return env.withColumnRenamed("content_type", "signal_type") \
        .withColumn("text", F.lit(None).cast("string")) \
        .withColumnRenamed("payload", "binary_data")


def route(env: DataFrame) -> DataFrame:
    """Subject per envelope."""
    return env.withColumn("subject", channel_subject(F.col("channel"), F.col("authority")))


def subscribe(routed: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Every message whose subject lies under a subscribed channel's prefix
    (``telepath_X.>``).  The prefix is an equi-join key, not a scan per channel."""
    msgs = routed.withColumn("_stream", F.substring_index("subject", ".", 1))
    subs = subscriptions.select("subscriber", channel_stream(F.col("channel")).alias("_stream"))
    return msgs.join(subs, "_stream").drop("_stream")


def sequence(env: DataFrame, order=("ts", "uuid"), skew_safe: bool = True) -> DataFrame:
    """1-based sequence number per channel in (ts, uuid) order.  One channel
    may hold most messages, so the default is the range-partitioned scan; pass
    the narrow columns (channel, order, id), not the payloads."""
    if skew_safe:
        return segmented_scan(env, ["channel"], list(order), rownum="seq")
    return env.withColumn("seq", F.row_number().over(Window.partitionBy("channel").orderBy(*order)))


def retain(env: DataFrame, as_of: str, ttl_seconds: int = DEFAULT_TTL_SECONDS,
           max_msgs: int = DEFAULT_MAX_MSGS, max_bytes: int = DEFAULT_MAX_BYTES,
           order=("ts", "uuid"), size_col: str = "payload_bytes") -> DataFrame:
    """What a channel still holds at ``as_of``: messages not older than
    the ttl, then the newest ``max_msgs``, then the newest whose bytes fit
    ``max_bytes`` (negative = unlimited).  The ttl cut comes first, so the rank
    only sees the ttl window; ``row_number <= k`` is planned as a group limit
    that is applied before the shuffle."""
    now = F.to_timestamp(F.lit(as_of)).cast(env.schema["ts"].dataType)
    lo = now - F.make_dt_interval(secs=F.lit(ttl_seconds))
    kept = env.where((F.col("ts") >= lo) & (F.col("ts") <= now))
    newest_first = Window.partitionBy("channel").orderBy(*[F.col(c).desc() for c in order])
    if max_msgs >= 0:
        kept = kept.withColumn("_rn", F.row_number().over(newest_first)).where(F.col("_rn") <= max_msgs).drop("_rn")
    if max_bytes >= 0:
        if max_msgs >= 0:
            running = F.sum(size_col).over(newest_first.rowsBetween(Window.unboundedPreceding, 0))
            kept = kept.withColumn("_bytes", running)
        else:
            kept = segmented_scan(kept, ["channel"], [F.col(c).desc() for c in order], cumsums={"_bytes": size_col})
        kept = kept.where(F.col("_bytes") <= max_bytes).drop("_bytes")
    return kept
