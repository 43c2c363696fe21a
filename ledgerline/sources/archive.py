"""Archive file pairs, the slot index and the processed ledger
(S1, S2, S8, J1, J4, F7, F8, O2, O4, P13, W3, A10, K5).

Sources are Spark readers: ``binaryFile`` with only ``path`` and ``length``
selected (file contents are never read for the listing) and ``text`` for
ledger lines, ordered by their own time and then by file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalars import start_slot, strip_repeated_suffix
from ledgerline.sources import files as W


# --------------------------------------------------------------------------- listing
def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """(path, name, length) of the files directly in ``directory``."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(directory)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def _side(listing: DataFrame, suffix: str, tag: str) -> DataFrame:
    named = listing.where(F.col("name").endswith(suffix)) \
        .withColumn("prefix", strip_repeated_suffix("name", suffix)).where(F.col("prefix") != "")
    # one file per prefix and suffix (e.g. a.meta and a.meta.meta): keep the smallest path
    return named.groupBy("prefix").agg(F.min_by(F.struct("path", "length"), "path").alias(tag)) \
        .select("prefix", F.col(f"{tag}.path").alias(f"{tag}_path"), F.col(f"{tag}.length").alias(f"{tag}_length"))


def archive_pairs(listing: DataFrame) -> DataFrame:
    """Prefixes having both ``.meta`` and ``.bin``,
    newest start slot first (unparsable start slot = 0)."""
    pairs = _side(listing, ".meta", "meta").join(_side(listing, ".bin", "bin"), "prefix", "inner")
    pairs = pairs.withColumn("start_slot", F.coalesce(start_slot("prefix"), F.lit(0).cast("decimal(20,0)")))
    return pairs.orderBy(F.col("start_slot").desc(), "prefix")


def pending_pairs(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """Pairs whose prefix is not in the processed ledger."""
    return manifest.join(processed.select("prefix"), "prefix", "left_anti")


# --------------------------------------------------------------------------- slot index
def expand_slot_index(index: DataFrame, entries: str = "entries") -> DataFrame:
    """One row per ``(slot, offset, size)`` entry of each file's index."""
    others = [c for c in index.columns if c != entries]
    return index.select(*others, F.inline(entries))


def slot_status(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """Readable work of each entry: ``no_offset`` / ``missing_file`` /
    ``out_of_range`` entries are skipped, ``ok`` ones are read."""
    j = entries.join(manifest.select("prefix", "bin_length"), "prefix", "left")
    end = F.col("offset").cast("decimal(21,0)") + F.col("size").cast("decimal(21,0)")
    status = F.when(F.col("offset").isNull(), "no_offset") \
        .when(F.col("bin_length").isNull(), "missing_file") \
        .when(end > F.col("bin_length").cast("decimal(21,0)"), "out_of_range") \
        .otherwise("ok")
    return j.withColumn("status", status)


def file_totals(status: DataFrame) -> DataFrame:
    """Per file: entries, readable entries and their bytes."""
    ok = F.col("status") == "ok"
    return status.groupBy("prefix").agg(
        F.count(F.lit(1)).cast("bigint").alias("entries"), F.sum(ok.cast("bigint")).alias("readable"),
        F.coalesce(F.sum(F.when(ok, F.col("size").cast("bigint"))), F.lit(0)).cast("bigint").alias("bytes"))


# --------------------------------------------------------------------------- ledger
def ledger_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a ledger with files at ``path``; other errors are raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) and fs.getContentSummary(p).getFileCount() > 0


def read_ledger_lines(spark: SparkSession, path: str) -> DataFrame:
    """Ledger text lines with an order key: the line's own timestamp (first
    field of an entry), then file modification time, file, split and position.
    Appends put their lines into files with random names, so the names alone
    say nothing about the order."""
    return _lines(spark, [path])


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    t = F.trim("value")
    ts = F.when((t != "") & ~t.startswith("#"), F.get(F.split(t, ","), 0)).otherwise(F.lit(""))
    return spark.read.text(paths).select(F.col("value").alias("line"), F.struct(
        ts.alias("ts"), F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos")).alias("ord"))


def parse_ledger(lines: DataFrame) -> DataFrame:
    """Trim, classify and split ledger lines ``ts,prefix,status``."""
    t = F.trim(F.col("line"))
    parts = F.split(t, ",", -1)
    return lines.select(
        "ord", t.alias("text"),
        F.when(t == "", "blank").when(t.startswith("#"), "comment").otherwise("entry").alias("line_kind"),
        F.size(parts).alias("n_fields"),
        F.get(parts, 0).alias("ts"), F.get(parts, 1).alias("prefix"), F.get(parts, 2).alias("status"))


def processed_prefixes(lines: DataFrame) -> DataFrame:
    """Distinct prefixes with a ``completed`` line (>= 3 fields)."""
    p = parse_ledger(lines)
    return p.where((F.col("line_kind") == "entry") & (F.col("n_fields") >= 3) & (F.col("status") == "completed")) \
        .select("prefix").distinct()


def compact_ledger(lines: DataFrame, keep: str = "first") -> DataFrame:
    """One entry line per prefix; comments and blank lines stay; entries with
    fewer than 2 fields go.  ``keep='first'`` is what the reference code does,
    ``'last'`` what its comment says.  The pick is an aggregate (the line with
    the least or greatest order key per prefix, map-side combined): one scan, no
    join, and a hot prefix is not one task."""
    p = parse_ledger(lines)
    entries = p.where((F.col("line_kind") == "entry") & (F.col("n_fields") >= 2))
    pick = F.min_by if keep == "first" else F.max_by
    kept = entries.groupBy("prefix").agg(pick(F.struct("ord", "text", "line_kind"), "ord").alias("e")).select("e.*")
    other = p.where(F.col("line_kind") != "entry").select("ord", "text", "line_kind")
    return kept.unionByName(other).select("ord", F.col("text").alias("line"), "line_kind")


def ledger_stats(lines: DataFrame) -> DataFrame:
    """A10: number of distinct processed prefixes."""
    return processed_prefixes(lines).agg(F.count(F.lit(1)).cast("bigint").alias("processed_count"))


def ledger_tail(lines: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` processed prefixes in alphabetical order (top-k), with
    the number of the others."""
    processed = processed_prefixes(lines)
    top = processed.orderBy(F.col("prefix").desc()).limit(n)
    total = processed.agg(F.count(F.lit(1))).scalar()      # scalar subquery, no join
    return top.select("prefix", F.greatest(total - F.lit(n), F.lit(0)).cast("bigint").alias("others"))


def ledger_lines(prefixes: DataFrame, ts: str, status: str = "completed") -> DataFrame:
    """K5: ``ts,prefix,status`` lines for a batch of prefixes."""
    return prefixes.select(F.concat_ws(",", F.lit(ts), F.col("prefix"), F.lit(status)).alias("value"))


def append_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("append").text(path)


def append_ledger(prefixes: DataFrame, path: str, ts: str, status: str = "completed") -> None:
    append_lines(ledger_lines(prefixes, ts, status), path)


def finish_ledger(spark: SparkSession, path: str) -> None:
    """Complete a rewrite of the ledger that was interrupted."""
    W.finish(spark, path)


def rewrite_ledger(spark: SparkSession, path: str, keep: str = "first") -> None:
    """Replace the ledger's files by its compacted lines, in their order.

    Only the files that are there when it starts are read and replaced; lines appended
    meanwhile are in other files and stay.  The new files are written beside the old ones and
    swapped in (``files.replace``): a run that fails before leaves the old ledger, one that
    fails during the swap is completed by the next reader that calls ``finish_ledger``."""
    W.finish(spark, path)
    root = path.rstrip("/")
    old = [n for n in W.names_in(spark, root) if not n.startswith(("_", "."))]
    if not old:
        return
    lines = compact_ledger(_lines(spark, [f"{root}/{n}" for n in old]), keep)

    def write(to: str) -> None:
        lines.repartitionByRange("ord").sortWithinPartitions("ord").select(F.col("line").alias("value")).write.text(to)
    W.replace(spark, root, write, old, lambda to: [(n, n) for n in W.names_in(spark, to) if n.startswith("part-")])
