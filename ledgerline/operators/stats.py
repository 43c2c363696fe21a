"""Per-period statistics (A5-A7, F13) over an ingest / send log.

The reference keeps in-process counters reset every period (60 s).  Here the
same numbers are tumbling-window aggregates over a log with one row per
transaction or message (event time, bytes, durations), so they are
reproducible and work in batch and in streaming alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import MB, bucket_start

PERIOD_SECONDS = 60


def _safe_div(num, den):
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _safe_int_div(num: str, den: str):
    return F.when(F.col(den) > 0, F.expr(f"{num} div {den}")).otherwise(F.lit(0)).cast("bigint")


def _period(log: DataFrame, period: int, event_time: str | None):
    """Grouping key: epoch bucket in batch; an event-time window when
    ``event_time`` names a watermarked column (streaming)."""
    if event_time is None:
        return bucket_start(F.col("epoch"), period).alias("period_start"), F.col("period_start")
    return F.window(event_time, f"{period} seconds").alias("_w"), \
        F.unix_seconds(F.col("_w.start").cast("timestamp")).alias("period_start")


def ingest_stats(log: DataFrame, period: int = PERIOD_SECONDS, event_time: str | None = None) -> DataFrame:
    """A5: per period: transactions, tx/s, bundles, rows written, MB, MB/s and
    the mean processing time (float, 0 without transactions).

    ``log`` columns: ``epoch`` (seconds), ``bytes``, ``processing_us``,
    ``bundles``, ``rows_written``; a row is a transaction, or a batch with the
    number of its ``transactions`` (the job's own log)."""
    key, start = _period(log, period, event_time)
    g = log.groupBy(key).agg(
        F.sum("transactions" if "transactions" in log.columns else F.lit(1)).cast("bigint").alias("transactions"),
        F.sum("bundles").cast("bigint").alias("bundles"),
        F.sum("rows_written").cast("bigint").alias("rows_written"),
        F.sum("bytes").cast("bigint").alias("bytes"),
        F.sum("processing_us").cast("bigint").alias("_proc"))
    return g.select(
        start, "transactions",
        (F.col("transactions") / F.lit(float(period))).alias("tx_per_sec"),
        "bundles", "rows_written", "bytes",
        (F.col("bytes") / F.lit(MB)).alias("mb"),
        (F.col("bytes") / F.lit(MB) / F.lit(float(period))).alias("mb_per_sec"),
        _safe_div(F.col("_proc"), F.col("transactions")).alias("avg_processing_us"))


def signal_stats(log: DataFrame, period: int = PERIOD_SECONDS, event_time: str | None = None) -> DataFrame:
    """Per period: messages, signals, integer means (conversion per
    message; serialization, send time and size per signal), total MB.

    ``log`` columns: ``epoch``, ``signal`` (0/1), ``conversion_us``,
    ``serialization_us``, ``send_us``, ``bytes`` (the last three count for signals)."""
    sig = F.col("signal") == 1
    key, start = _period(log, period, event_time)
    g = log.groupBy(key).agg(
        F.count(F.lit(1)).cast("bigint").alias("messages"),
        F.sum(F.when(sig, 1).otherwise(0)).cast("bigint").alias("signals"),
        F.sum("conversion_us").cast("bigint").alias("_conv"),
        F.sum(F.when(sig, F.col("serialization_us")).otherwise(0)).cast("bigint").alias("_ser"),
        F.sum(F.when(sig, F.col("send_us")).otherwise(0)).cast("bigint").alias("_send"),
        F.sum(F.when(sig, F.col("bytes")).otherwise(0)).cast("bigint").alias("_bytes"))
    return g.select(
        start, "messages", "signals",
        _safe_int_div("_conv", "messages").alias("avg_conversion_us"),
        _safe_int_div("_ser", "signals").alias("avg_serialization_us"),
        _safe_int_div("_send", "signals").alias("avg_send_us"),
        _safe_int_div("_bytes", "signals").alias("avg_bytes"),
        (F.col("_bytes") / F.lit(MB)).alias("total_mb"))
