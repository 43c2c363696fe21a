"""Daily extract / export / import of event tables.

Layout: ``{root}/{table}/event_date=YYYY-MM-DD/part-*.snappy.parquet`` -- one
partition directory per UTC day instead of one file per day; a large day is
split over several files whose name order is the row order.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalars import epoch_to_date

ORDER = ("slot", "transaction_index", "instruction_index")
NATURAL_KEY = ("signature", "instruction_index")
DAY = "event_date"


def _day_epoch(d: str) -> int:
    return int(dt.datetime.fromisoformat(d).replace(tzinfo=dt.timezone.utc).timestamp())


def in_time_range(df: DataFrame, start: int | None, end: int | None, ts: str = "timestamp") -> DataFrame:
    """Rows with ``start <= ts < end`` (epoch seconds).  On a table laid out by
    ``event_date`` the same range is also put on the day, so that a scan lists
    and opens the days in question only."""
    dated = DAY in df.columns
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start))
        df = df.where(F.col(DAY) >= F.lit(_day_of(start))) if dated else df
    if end is not None:
        df = df.where(F.col(ts) < F.lit(end))
        df = df.where(F.col(DAY) <= F.lit(_day_of(end - 1))) if dated else df
    return df


def _day_of(epoch: int) -> dt.date:
    return dt.datetime.fromtimestamp(epoch, dt.timezone.utc).date()


def days_in(rows: DataFrame) -> list[dt.date | None]:
    """The days of ``rows`` (one value per day, whatever the rows); None for rows without one."""
    return [r[0] for r in rows.select(DAY).distinct().collect()]


def on_days(df: DataFrame, days) -> DataFrame:
    """Rows of the listed days; None stands for rows without a day."""
    dated = F.col(DAY).isin([d for d in days if d is not None])
    return df.where(dated | F.col(DAY).isNull() if None in days else dated)


def append_rows(rows: DataFrame, path: str, key=NATURAL_KEY, dedupe: bool = True, layout=None,
                days=None, distinct: bool = False) -> None:
    """Append ``rows`` (with ``event_date``) to the dated table at ``path``.

    ``dedupe`` keeps one row for each natural key within the run (unless the
    rows are ``distinct`` by it) and skips the keys that the target holds, so a
    redelivery, a replayed batch or a run on a new checkpoint adds nothing (a
    null day or key member equals itself); of the target it reads the ``days``
    of the rows alone (looked up if not given).
    ``layout``: order columns of a range partitioning by (day, order), done
    last, so that a backfill of many days writes few files a day and no later
    shuffle undoes it."""
    spark = rows.sparkSession
    if dedupe:
        rows = rows if distinct else rows.dropDuplicates([DAY, *key])
        if _exists(spark, path):
            days = days_in(rows) if days is None else days
            have = on_days(spark.read.schema(rows.schema).parquet(path), days).select(*[F.col(c).alias(f"_h_{c}") for c in (DAY, *key)])
            same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in (DAY, *key)])
            rows = rows.join(have, same, "left_anti")
    if layout:
        rows = rows.repartitionByRange(DAY, *layout)
    rows.write.mode("append").partitionBy(DAY).parquet(path)


def day_range(start_date: str, end_date: str) -> list[str]:
    """Inclusive list of ``YYYY-MM-DD`` dates (the export covers today too)."""
    a, b = dt.date.fromisoformat(start_date), dt.date.fromisoformat(end_date)
    return [(a + dt.timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]


def extract_daily(df: DataFrame, start_date: str, end_date: str, ts: str = "timestamp",
                  order=ORDER) -> DataFrame:
    """Rows of ``[start_date 00:00, end_date 24:00)`` UTC, with
    ``event_date``, range-partitioned on (event_date, order) and sorted inside
    partitions -- a hot day is spread over several partitions, and the
    partition sequence is the global order."""
    lo, hi = _day_epoch(start_date), _day_epoch(end_date) + 86400
    rows = in_time_range(df, lo, hi, ts).withColumn(DAY, epoch_to_date(F.col(ts)))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, "event_date", *order).sortWithinPartitions("event_date", *order)


def export_daily(df: DataFrame, table: str, root: str, start_date: str, end_date: str,
                 ts: str = "timestamp", order=ORDER) -> list[str]:
    """K2: one job writes all days of ``[start_date, end_date]`` (inclusive),
    Snappy, overwriting only the days it covers; days without rows become
    empty folders, so a rerun also clears them.  Returns the dates."""
    spark = df.sparkSession
    dates = day_range(start_date, end_date)
    path = f"{root.rstrip('/')}/{table}"
    # the days that received rows in *this* run, observed during the write
    # (a set bounded by the number of requested days; no second scan)
    seen = Observation(f"export_{table}")
    out = extract_daily(df, start_date, end_date, ts, order) \
        .observe(seen, F.collect_set(F.date_format("event_date", "yyyy-MM-dd")).alias("days"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy("event_date").parquet(path))
    written = set(seen.get.get("days") or [])
    for d in dates:        # a day without rows keeps an empty folder (a rerun clears old rows)
        if d not in written:
            part = f"{path}/{DAY}={d}"
            _delete(spark, part)
            fs, p = _fs(spark, part)
            fs.mkdirs(p)
    return dates


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def read_daily_folder(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Every ``*.parquet`` file under a table folder, with an
    explicit schema; a missing or empty folder yields 0 rows (not an error).
    Adds ``event_date`` and the source ``file_name``."""
    full = T.StructType(list(schema.fields) + [T.StructField("event_date", T.DateType(), True)])
    if not _exists(spark, folder):
        return spark.createDataFrame([], full).withColumn("file_name", F.lit(None).cast("string"))
    df = spark.read.schema(full).option("pathGlobFilter", "*.parquet").parquet(folder)
    return df.withColumn("file_name", F.col("_metadata.file_name"))


def check_mapping(mapping: dict[str, str], table: str) -> str:
    """The table must be mapped to a target, checked before any job runs."""
    if table not in mapping:
        raise KeyError(f"Event type not found: {table}")
    return mapping[table]


def import_folder(spark: SparkSession, folder_root: str, table: str, mapping: dict[str, str],
                  target_root: str, schema: T.StructType, dedupe: bool = False,
                  key=("signature", "instruction_index")) -> DataFrame:
    """K3: append a table folder to its mapped target.  Not idempotent unless
    ``dedupe=True`` (see ``append_rows``).  Returns the folder's rows."""
    target = check_mapping(mapping, table)
    rows = read_daily_folder(spark, f"{folder_root.rstrip('/')}/{table}", schema).drop("file_name")
    append_rows(rows, f"{target_root.rstrip('/')}/{target}", key, dedupe)
    return rows


def read_target(spark: SparkSession, target_root: str, target: str, schema: T.StructType) -> DataFrame:
    full = T.StructType(list(schema.fields) + [T.StructField("event_date", T.DateType(), True)])
    return spark.read.schema(full).parquet(f"{target_root.rstrip('/')}/{target}")


def import_totals(folder_df: DataFrame) -> DataFrame:
    """Rows per daily partition and the running total in date
    order.  The running window sees one row per day (bounded by the days)."""
    per_day = folder_df.groupBy("event_date").agg(
        F.count_distinct("file_name").cast("bigint").alias("files"),
        F.count(F.lit(1)).cast("bigint").alias("rows"))
    w = Window.orderBy("event_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.withColumn("running_rows", F.sum("rows").over(w).cast("bigint"))
