"""Composite, user-level jobs (C1-C6): the reference's entry points as
functions of DataFrames and paths.  Clocks and settings are arguments."""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalars import epoch_to_date
from ledgerline.operators import reconcile as R
from ledgerline.operators.pairing import pair_fold
from ledgerline.operators.project import common_field, rows_of, table_rows
from ledgerline.operators.scan import segmented_scan
from ledgerline.plans.sink import append_transactions, drop_unfinished, is_complete
from ledgerline.schemas import TABLES
from ledgerline.session import staged
from ledgerline.sources import archive as A
from ledgerline.sources import transfer as X


CONCURRENT_WRITES = 4        # event tables that are written at a time


def write_event_tables(paired: DataFrame, sink_root: str, table_names: dict[str, str] | None = None,
                       kinds=tuple(t.name for t in TABLES), dedupe: bool = False, layout: bool = True) -> dict[str, int]:
    """The 8 tables from one pairing, ``{sink_root}/{table name}/event_date=...``, appended
    as they are (the keyed sink of the jobs is ``plans.sink``); ``table_names`` maps kinds to configured names.

    All tables' rows come from one codegen'd projection (``table_rows``: the
    event table tag plus one struct per kind, keys binary) that is persisted --
    about the size of the output, and a lost executor only recomputes its own
    blocks -- so the input is not scanned once per table.  ``layout`` and
    ``dedupe`` as in ``append_rows``.  A kind without rows writes nothing (P15).
    Returns the rows of each kind in the pairing."""
    names = table_names or {t.name: t.table for t in TABLES}
    rows_all = table_rows(paired).withColumn(X.DAY, epoch_to_date(common_field("timestamp")))
    if dedupe:
        rows_all = rows_all.withColumns({f"_k_{c}": common_field(c) for c in X.NATURAL_KEY})
        rows_all = rows_all.dropDuplicates(["event_table", X.DAY, *[f"_k_{c}" for c in X.NATURAL_KEY]])
    rows_all = rows_all.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = rows_all.groupBy("event_table", X.DAY).count().collect()       # a row per kind and day

        def write(kind: str) -> None:
            days = {r[1] for r in found if r[0] == kind}
            if days:
                X.append_rows(rows_of(rows_all, kind, [X.DAY]), f"{sink_root.rstrip('/')}/{names[kind]}", dedupe=dedupe,
                              layout=X.ORDER if layout else None, days=days, distinct=True)

        job = inheritable_thread_target(paired.sparkSession)
        with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:      # the tables are independent; a failed one fails the call
            for done in [pool.submit(job(write), kind) for kind in kinds]:
                done.result()
        return {kind: sum(r[2] for r in found if r[0] == kind) for kind in kinds}
    finally:
        rows_all.unpersist()


def write_tables_from_transactions(tx: DataFrame, sink_root: str, table_names: dict[str, str] | None = None,
                                   kinds=tuple(t.name for t in TABLES), dedupe: bool = False,
                                   layout: bool = True) -> dict[str, int]:
    """T2 / K1 straight from nested transactions (pairing needs no shuffle)."""
    return write_event_tables(pair_fold(tx), sink_root, table_names, kinds, dedupe, layout)


WAVE_BYTES, WAVE_PAIRS = 64 << 30, 1000


def pending_waves(spark: SparkSession, manifest: DataFrame, ledger_path: str, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """Pairs that the ledger does not hold, newest first, with the ``wave`` that each falls in:
    about ``wave_bytes`` of files or WAVE_PAIRS pairs, whichever is less.  Staged, as the ledger
    grows while the waves run."""
    A.finish_ledger(spark, ledger_path)
    if A.ledger_exists(spark, ledger_path):
        done = A.processed_prefixes(A.read_ledger_lines(spark, ledger_path))
    else:
        done = spark.createDataFrame([], "prefix string")
    weight = F.greatest(F.col("meta_length") + F.col("bin_length"), F.lit(-(-wave_bytes // WAVE_PAIRS)))
    pairs = A.pending_pairs(manifest, done).select("prefix", "start_slot", weight.alias("weight"), F.lit(0).alias("all"))
    summed = segmented_scan(pairs, ["all"], [F.col("start_slot").desc(), F.col("prefix")], cumsums={"upto": "weight"})
    return staged(summed.select("prefix", "start_slot", F.expr(f"(upto - weight) div {wave_bytes}").alias("wave")), "pending")


def ingest_pairs(pending: DataFrame, ledger_path: str, transactions: DataFrame, sink_root: str, now: str,
                 table_names: dict[str, str] | None = None) -> None:
    """C1, wave by wave: the transactions of the wave's pairs go to the keyed sink as one load,
    then the pairs to the ledger.  A failure leaves the waves before it recorded; the next run
    drops what the failed one had written and starts with its pairs.  One such job at a time."""
    spark = pending.sparkSession
    drop_unfinished(spark, sink_root, table_names, prefix="wave-")
    for wave in sorted(r[0] for r in pending.select("wave").distinct().collect()):
        pairs = pending.where(F.col("wave") == wave)
        prefixes = sorted(r[0] for r in pairs.select("prefix").collect())           # WAVE_PAIRS and one at most
        load = f"wave-{hashlib.sha256(','.join(prefixes).encode()).hexdigest()[:16]}"
        if not is_complete(spark, sink_root, load):                                 # else only its ledger lines were lost
            append_transactions(transactions.where(F.col("prefix").isin(prefixes)).drop("prefix"), sink_root, load, table_names)
        A.append_ledger(pairs, ledger_path, now)


def ingest_batch(spark: SparkSession, archive_dir: str, ledger_path: str, transactions: DataFrame,
                 sink_root: str, now: str, wave_bytes: int = WAVE_BYTES, table_names: dict[str, str] | None = None) -> DataFrame:
    """Archive pairs not yet in the ledger -> their transactions -> 8 event
    tables -> ledger lines, in waves of pairs.  ``transactions`` carries a
    ``prefix`` column naming its archive pair.  Returns the pairs that were pending."""
    manifest = A.archive_pairs(A.list_files(spark, archive_dir))
    pending = pending_waves(spark, manifest, ledger_path, wave_bytes)
    ingest_pairs(pending, ledger_path, transactions, sink_root, now, table_names)
    return pending


def export_tables(tables: dict[str, DataFrame], mapping: dict[str, str], root: str, start_date: str,
                  end_date: str) -> dict[str, list[str]]:
    """Every mapped table, every day of ``[start_date, end_date]``."""
    out = {}
    for name, df in tables.items():
        X.check_mapping(mapping, name)
        out[name] = X.export_daily(df, name, root, start_date, end_date)
    return out


def import_tables(spark: SparkSession, root: str, mapping: dict[str, str], target_root: str,
                  schemas: dict, dedupe: bool = False) -> DataFrame:
    """C4: import every table folder into its mapped target; returns per-day
    totals with the running row count (A9)."""
    totals = []
    for name in schemas:
        X.check_mapping(mapping, name)
    for name, schema in schemas.items():
        folder = X.read_daily_folder(spark, f"{root.rstrip('/')}/{name}", schema)
        totals.append(X.import_totals(folder).withColumn("table_name", F.lit(name)))
        X.import_folder(spark, root, name, mapping, target_root, schema, dedupe=dedupe)
    out = totals[0]
    for t in totals[1:]:
        out = out.unionByName(t)
    return out


@dataclass
class SyncResult:
    summary: DataFrame | None
    errors: list[str] = field(default_factory=list)


def reconcile_and_repair(tables: dict[str, tuple[DataFrame, DataFrame, str | None]], as_of: str,
                         lag_hours: int = 2, check_days: int = 7, mode: str = "missing_only",
                         apply: bool = False, fail_on_error: bool = True) -> SyncResult:
    """Per table: hour compare -> minute drill-down -> repair rows ->
    optional append to the remote path -> check -> summary.

    The repair rows are written once to the shared folder; their count, the
    append and the summary all use that table.  The append keeps the remote's
    layout (by ``event_date`` if it has that column), and the remote is read
    again: local keys still missing fail the table.  ``synced_records`` counts
    rows that were appended, 0 without ``apply``.  Errors are collected per
    table and the others go on; any error fails the run at the end."""
    start, end = R.time_window(as_of, lag_hours, check_days)
    span = R.hour_span(start, end)
    summaries, errors = [], []
    for name, (local, remote, remote_path) in tables.items():
        try:
            spark = local.sparkSession
            # the difference lists are small (bounded by the checked hours) and
            # must not be re-evaluated after the repair changed the remote copy:
            # their lineage is cut before writing
            dh = staged(R.reconcile_hours(local, remote, start, end), "hours")
            dm = staged(R.reconcile_minutes(local, remote, start, end, diff_hours=dh), "minutes")
            rows = staged(R.repair_rows(local, remote, dm, mode=mode, span=span), "repair")
            done = bool(apply and remote_path)
            if done:
                R.apply_repair(rows, remote_path, [X.DAY] if X.DAY in remote.columns else None)
                after = spark.read.schema(remote.schema).parquet(remote_path)
                left = R.still_missing(local, after, dm, span=span).count()
                if left:
                    raise RuntimeError(f"{left} keys are still missing after the repair")
            summaries.append(R.reconcile_summary(name, dh, dm, rows if done else rows.limit(0)))
        except Exception as e:  # noqa: BLE001
            errors.append(f"{name}: {e}")
    summary = None
    if summaries:
        summary = summaries[0]
        for s in summaries[1:]:
            summary = summary.unionByName(s)
    if errors and fail_on_error:
        raise RuntimeError("; ".join(errors))
    return SyncResult(summary, errors)
