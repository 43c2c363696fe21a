"""Skew-safe ordered scans over groups (running sums, row numbers, lag).

``Window.partitionBy(key)`` sends every row of a key to one task; a key that
holds a third of the data then becomes one straggler task.  ``segmented_scan``
computes the same running values with windows over segments of a key:

1. ``repartitionByRange`` on ``(keys, order)`` -- the range sampler splits a
   hot key over many partitions -- and the partition number is kept with the
   rows, which are written to the shared folder (range bounds are sampled, so
   they must not be drawn anew when a lost executor's work is repeated);
2. built-in windows by (partition number, keys): no window is larger than a
   range partition;
3. one total per (partition number, keys); only keys that go on from an earlier
   partition need a carry, at most one for each partition, so the broadcast
   of the carries is bounded by the partition count, not by the data.

Everything is built-in and exact: sums have Spark's sum types.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir

_PID = "_scan_pid"


def segmented_scan(df: DataFrame, keys: list[str], order: list[str | Column], *,
                   cumsums: dict[str, str] | None = None, rownum: str | None = None,
                   lags: dict[str, str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add running columns per key group ordered by ``order``.

    ``cumsums``: ``{out: src}`` inclusive running sum of ``src`` (nulls count 0);
    ``rownum``: 1-based row number; ``lags``: ``{out: src}`` previous row's ``src``.
    ``order``: column names or sort expressions that make the order total (ties
    are broken arbitrarily otherwise).  Select narrow columns first: all columns
    of ``df`` are shuffled twice.
    """
    cumsums, lags = cumsums or {}, lags or {}
    spark = df.sparkSession
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{scratch_dir(spark, 'scan')}/{uuid.uuid4().hex}"
    ranged = df.repartitionByRange(n, *keys, *by).withColumn(_PID, F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)

    local = Window.partitionBy(_PID, *keys).orderBy(*by)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {f"_s_{out}": F.coalesce(F.sum(src).over(upto), F.lit(0)) for out, src in cumsums.items()}
    prev = {f"_l_{out}": F.lag(src).over(local) for out, src in lags.items()}
    scanned = ranged.withColumns({"_n": F.row_number().over(local).cast("bigint"), **sums, **prev})

    totals = scanned.groupBy(_PID, *keys).agg(
        F.max("_n").alias("_tn"), *[F.max_by(f"_s_{o}", "_n").alias(f"_ts_{o}") for o in cumsums],
        *[F.max_by(s, "_n").alias(f"_tl_{o}") for o, s in lags.items()])
    over = Window.partitionBy(*keys).orderBy(_PID)
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(
        F.col(_PID).alias("_cp"), *[F.col(k).alias(f"_ck_{k}") for k in keys], F.sum("_tn").over(earlier).alias("_cn"),
        *[F.sum(f"_ts_{o}").over(earlier).alias(f"_cs_{o}") for o in cumsums],
        *[F.lag(f"_tl_{o}").over(over).alias(f"_cl_{o}") for o in lags]).where("_cn is not null")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_ck_{k}")) for k in keys], F.col(_PID) == F.col("_cp"))
    out = scanned.join(F.broadcast(carries), same, "left")
    added = [(F.col(f"_s_{o}") + F.coalesce(f"_cs_{o}", F.lit(0))).alias(o) for o in cumsums]
    if rownum:
        added.append((F.col("_n") + F.coalesce("_cn", F.lit(0))).cast("bigint").alias(rownum))
    added += [F.when(F.col("_n") == 1, F.col(f"_cl_{o}")).otherwise(F.col(f"_l_{o}")).alias(o) for o in lags]
    return out.select(*df.columns, *added)
