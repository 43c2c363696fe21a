"""Reconciliation of two copies of an event table.

Plan shape (per table, one Spark job per step, never one query per hour):

1. exact distinct ``(signature, instruction_index)`` per hour on both sides
   over ``[start, end)``; both aggregates dedupe on (bucket, key) first, so a
   hot hour is spread over the key hash and only one row per bucket and
   partition reaches the final count;
2. full outer join on the hour (missing side = 0), keep hours that differ;
3. minutes of the differing **whole** hours, again on both sides; the
   differing-hour list is bounded by ``(end - start) / 3600`` rows, so its
   broadcast has a proven size bound;
4. repair rows: local rows of differing minutes (``append``) or only those
   whose key the remote side lacks (``missing_only``).

Counts are never rolled up from minutes to hours: a key present in two
minutes of one hour counts once per hour.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import bucket_start, epoch_to_date
from ledgerline.sources.transfer import DAY, append_rows, in_time_range

KEY = ("signature", "instruction_index")
TS = "timestamp"
MAX_BROADCAST = 100_000      # hours or minutes, 8 bytes each


def time_window(as_of: str, lag_hours: int = 2, check_days: int = 7) -> tuple[int, int]:
    """``end = as_of - lag_hours``, ``start = end - check_days`` (epoch seconds, UTC).
    The clock is an explicit argument, never ``now()``."""
    t = dt.datetime.fromisoformat(as_of.replace("Z", "+00:00"))
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    end = int(t.timestamp()) - lag_hours * 3600
    return end - check_days * 86400, end


def distinct_per_bucket(df: DataFrame, seconds: int, start: int | None = None, end: int | None = None,
                        key=KEY, ts: str = TS, bucket: str = "bucket") -> DataFrame:
    """A1/A2: exact distinct key tuples per bucket of ``seconds``.  The key is
    counted as a struct, so NULL members still count (as ``uniqExact(tuple)``)."""
    rows = in_time_range(df, start, end, ts).select(
        bucket_start(F.col(ts), seconds).alias(bucket), F.struct(*key).alias("_k"))
    return rows.groupBy(bucket).agg(F.count_distinct("_k").cast("bigint").alias("unique_count"))


def distinct_per_hour(df, start=None, end=None, key=KEY, ts=TS) -> DataFrame:
    return distinct_per_bucket(df, 3600, start, end, key, ts, "hour")


def distinct_per_minute(df, start=None, end=None, key=KEY, ts=TS) -> DataFrame:
    return distinct_per_bucket(df, 60, start, end, key, ts, "minute")


def compare_counts(local: DataFrame, remote: DataFrame, bucket: str) -> DataFrame:
    """Full outer join on the bucket, missing side counts 0; keep
    buckets that differ, with the direction of the difference."""
    l = local.withColumnRenamed("unique_count", "local_count")
    r = remote.withColumnRenamed("unique_count", "remote_count")
    j = l.join(r, on=bucket, how="full_outer")
    lc = F.coalesce(F.col("local_count"), F.lit(0)).cast("bigint")
    rc = F.coalesce(F.col("remote_count"), F.lit(0)).cast("bigint")
    return j.select(bucket, lc.alias("local_count"), rc.alias("remote_count")) \
        .where(F.col("local_count") != F.col("remote_count")) \
        .withColumn("direction", F.when(F.col("remote_count") == 0, "remote_missing")
                    .when(F.col("local_count") == 0, "remote_only")
                    .when(F.col("local_count") > F.col("remote_count"), "remote_short")
                    .otherwise("remote_extra"))


def reconcile_hours(local: DataFrame, remote: DataFrame, start: int, end: int, key=KEY, ts=TS) -> DataFrame:
    return compare_counts(distinct_per_hour(local, start, end, key, ts),
                          distinct_per_hour(remote, start, end, key, ts), "hour")


def _max_hours(start: int, end: int) -> int:
    return max(1, (end - start) // 3600 + 2)


def hour_span(start: int, end: int) -> tuple[int, int]:
    """Whole hours covering ``[start, end)``: the drill-down reads whole hours."""
    return start - start % 3600, end + (-end) % 3600


def _in_hours(df: DataFrame, hours: DataFrame, ts: str, bound: int, span: tuple[int, int] | None) -> DataFrame:
    """Rows whose whole hour differs.  With a ``span`` the hour list is cut
    to it and has at most ``bound`` rows; up to MAX_BROADCAST of them are
    broadcast, more are left to the planner.  The literal span also lets the
    scan skip days and row groups."""
    keys = hours.select(F.col("hour").alias("_hour"))
    if span is not None:
        df = in_time_range(df, span[0], span[1], ts)
        keys = keys.where((F.col("_hour") >= span[0]) & (F.col("_hour") < span[1]))
        keys = F.broadcast(keys) if bound <= MAX_BROADCAST else keys
    tagged = df.withColumn("_hour", bucket_start(F.col(ts), 3600))
    return tagged.join(keys, "_hour", "left_semi").drop("_hour")


def reconcile_minutes(local: DataFrame, remote: DataFrame, start: int, end: int, key=KEY, ts=TS,
                      diff_hours: DataFrame | None = None) -> DataFrame:
    """Minutes of the differing hours that differ; hours are taken whole."""
    hours = diff_hours if diff_hours is not None else reconcile_hours(local, remote, start, end, key, ts)
    bound, span = _max_hours(start, end), hour_span(start, end)
    lm = distinct_per_minute(_in_hours(local, hours, ts, bound, span), key=key, ts=ts)
    rm = distinct_per_minute(_in_hours(remote, hours, ts, bound, span), key=key, ts=ts)
    return compare_counts(lm, rm, "minute").withColumn("hour", bucket_start(F.col("minute"), 3600))


def _in_minutes(df: DataFrame, minutes: DataFrame, ts: str, span: tuple[int, int] | None = None) -> DataFrame:
    """Rows of the differing minutes.  With a ``span`` the minute list is
    cut to it, so it holds at most ``(hi - lo) / 60`` rows; up to MAX_BROADCAST
    of them are broadcast.  Otherwise the join is left to the planner."""
    keys = minutes.select(F.col("minute").alias("_minute"))
    if span is not None:
        df = in_time_range(df, span[0], span[1], ts)
        keys = keys.where((F.col("_minute") >= span[0]) & (F.col("_minute") < span[1]))
        keys = F.broadcast(keys) if (span[1] - span[0]) // 60 <= MAX_BROADCAST else keys
    tagged = df.withColumn("_minute", bucket_start(F.col(ts), 60))
    return tagged.join(keys, "_minute", "left_semi").drop("_minute")


def repair_counts(local: DataFrame, diff_minutes: DataFrame, ts=TS, span=None) -> DataFrame:
    """A3: local rows per differing minute, duplicates included (0 if none)."""
    rows = _in_minutes(local, diff_minutes, ts, span).groupBy(bucket_start(F.col(ts), 60).alias("minute")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("local_rows"))
    return diff_minutes.select("minute").join(rows, "minute", "left") \
        .select("minute", F.coalesce("local_rows", F.lit(0)).cast("bigint").alias("local_rows"))


def repair_rows(local: DataFrame, remote: DataFrame, diff_minutes: DataFrame, mode: str = "missing_only",
                key=KEY, ts=TS, span: tuple[int, int] | None = None) -> DataFrame:
    """K4: rows to append to the remote copy.

    ``append``: every local row of each differing minute (the reference's
    behaviour; not idempotent, partial minutes gain duplicates).
    ``missing_only``: only local rows whose key the remote side lacks in
    those minutes (safe to repeat).  ``span`` (see ``hour_span``) lets the
    scans skip everything outside the checked hours.
    """
    rows = _in_minutes(local, diff_minutes, ts, span)
    if mode == "append":
        return rows
    if mode != "missing_only":
        raise ValueError(f"unknown repair mode {mode}")
    have = _in_minutes(remote, diff_minutes, ts, span).select(*key)
    return rows.join(have, on=list(key), how="left_anti")


def reconcile_summary(table: str, diff_hours: DataFrame, diff_minutes: DataFrame,
                      repaired: DataFrame) -> DataFrame:
    """A4: one row per table: differing hours, differing minutes, rows re-sent.
    The three counts are scalar subqueries (no join between one-row sides)."""
    def n(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    h = diff_hours.agg(F.count(F.lit(1)).cast("bigint").alias("diff_hours"))
    return h.select(F.lit(table).alias("table_name"), "diff_hours",
                    n(diff_minutes).alias("diff_minutes"), n(repaired).alias("synced_records"))


def apply_repair(rows: DataFrame, target_path: str, partition_by: list[str] | None = None) -> None:
    """Append the repair rows to the remote copy in its own layout (one
    distributed write).  A target laid out by day needs ``partition_by``: files
    beside its day folders are not read."""
    if partition_by == [DAY] and DAY not in rows.columns:
        rows = rows.withColumn(DAY, epoch_to_date(F.col(TS)))
    if partition_by == [DAY]:
        append_rows(rows, target_path, dedupe=False)
        return
    w = rows.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target_path)


def still_missing(local: DataFrame, remote: DataFrame, diff_minutes: DataFrame, key=KEY, ts=TS,
                  span: tuple[int, int] | None = None) -> DataFrame:
    """Local keys of the differing minutes that the remote copy lacks."""
    mine = _in_minutes(local, diff_minutes, ts, span).select(*key).distinct()
    return mine.join(_in_minutes(remote, diff_minutes, ts, span).select(*key), list(key), "left_anti")
