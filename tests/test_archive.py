"""Archive pairs, the slot index and the ledger, each rule with a case of its own."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir
from ledgerline.sources import archive as A

FILE = "path string, name string, length long"
ENTRY = "prefix string, entries array<struct<slot:decimal(20,0),offset:decimal(20,0),size:decimal(20,0)>>"


def manifest(spark, *names):
    return A.archive_pairs(spark.createDataFrame([(f"/x/{n}", n, 10 + i) for i, n in enumerate(names)], FILE))


def prefixes(df):
    return [r.prefix for r in df.collect()]


@pytest.mark.parametrize("names,want", [
    ([], []),
    (["7_9.meta", "7_9.bin"], ["7_9"]),
    (["7_9.meta", "8_9.bin"], []),                                            # two halves of different pairs
    (["7_9.META", "7_9.bin"], []),                                            # suffixes are case-sensitive
    (["7_9.meta.meta.meta", "7_9.bin"], ["7_9"]),                             # a repeated suffix counts once
    (["7_9.bin.meta", "7_9.bin"], []),                                        # only its own suffix is taken off
    ([".bin", ".meta", ".meta.meta"], []),                                    # no prefix left
    (["notes", "7_9.metadata", "7_9.bin"], []),
    (["90_99.meta", "90_99.bin", "100_109.meta", "100_109.bin"], ["100_109", "90_99"]),     # by number, not by text
    (["zz_1.meta", "zz_1.bin", "5_6.meta", "5_6.bin"], ["5_6", "zz_1"]),      # no number counts as 0
])
def test_pairs(spark, names, want):
    assert prefixes(manifest(spark, *names)) == want


def test_repeated_suffix_keeps_the_smallest_path(spark):
    row = manifest(spark, "4_5.meta.meta", "4_5.meta", "4_5.bin").collect()[0]
    assert (row.meta_path, row.meta_length, row.bin_length) == ("/x/4_5.meta", 11, 12)


def test_pending(spark):
    pairs = manifest(spark, "1_1.meta", "1_1.bin", "2_2.meta", "2_2.bin", "3_3.meta", "3_3.bin")
    done = spark.createDataFrame([("2_2",), ("2_2",), ("9_9",)], "prefix string")
    assert prefixes(A.pending_pairs(pairs, done)) == ["3_3", "1_1"]


def test_slot_status_and_totals(spark):
    pairs = manifest(spark, "1_1.meta", "1_1.bin").withColumn("bin_length", F.lit(50).cast("long"))

    def entry(*values):
        return tuple(None if v is None else Decimal(v) for v in values)
    index = spark.createDataFrame([
        ("1_1", [entry(11, 0, 50), entry(12, 1, 50), entry(13, None, 5), entry(14, 49, 1), entry(15, 2 ** 64 - 1, 2 ** 64 - 1)]),
        ("2_2", [entry(21, 0, 1)]), ("3_3", [])], ENTRY)
    status = A.slot_status(A.expand_slot_index(index), pairs)
    assert {int(r.slot): r.status for r in status.collect()} == {
        11: "ok", 12: "out_of_range", 13: "no_offset", 14: "ok", 15: "out_of_range", 21: "missing_file"}
    assert {r.prefix: (r.entries, r.readable, r.bytes) for r in A.file_totals(status).collect()} == {"1_1": (5, 2, 51), "2_2": (1, 0, 0)}


# ------------------------------------------------------------------ ledger
def ledger(spark, *appends):
    """A ledger of several appends, each a list of lines."""
    path = scratch_dir(spark, "ledger")
    for lines in appends:
        A.append_lines(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), path)
    return A.read_ledger_lines(spark, path)


@pytest.mark.parametrize("line,done", [
    ("2024-05-01T10:00:00Z,k,completed", True), ("  2024-05-01T10:00:00Z,k,completed ", True), ("t,k,completed,more", True),
    ("t,k,COMPLETED", False), ("t,k,failed", False), ("t,k", False), ("k", False), ("", False), ("   ", False), ("#t,k,completed", False)])
def test_which_lines_count(spark, line, done):
    assert prefixes(A.processed_prefixes(ledger(spark, [line, "t,other,completed"]))) in ([["other", "k"], ["k", "other"]] if done else [["other"]])


@pytest.mark.parametrize("trial", range(3))
def test_compaction_follows_the_lines_own_time(spark, trial):
    """Four appends that write the times in no order; the part files' names are random."""
    times = ["03", "01", "04", "02"]
    lines = ledger(spark, *[[f"2024-05-{t},k,failed", "# note", ""] for t in times])
    picked = {keep: [r.line for r in A.compact_ledger(lines, keep).where("line_kind = 'entry'").collect()] for keep in ("first", "last")}
    assert picked == {"first": ["2024-05-01,k,failed"], "last": ["2024-05-04,k,failed"]}
    assert A.compact_ledger(lines).where("line_kind <> 'entry'").count() == 8


def test_compaction_of_equal_times_follows_the_position(spark):
    lines = ledger(spark, ["t,k,failed", "t,k,completed", "lone", "t,m,completed"])
    assert sorted(r.line for r in A.compact_ledger(lines, "first").collect()) == ["t,k,failed", "t,m,completed"]
    assert sorted(r.line for r in A.compact_ledger(lines, "last").collect()) == ["t,k,completed", "t,m,completed"]
    plan = A.compact_ledger(lines)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_stats_and_tail(spark):
    lines = ledger(spark, [f"t,{c},completed" for c in "gfedcba"], ["t,a,completed", "t,zz,failed"])
    assert A.ledger_stats(lines).first()[0] == 7
    assert sorted(tuple(r) for r in A.ledger_tail(lines, 2).collect()) == [("f", 5), ("g", 5)]
    assert {r.others for r in A.ledger_tail(lines, 20).collect()} == {0}


def test_append_and_existence(spark):
    path = scratch_dir(spark, "fresh")
    assert not A.ledger_exists(spark, path) and not A.ledger_exists(spark, path + "/none")
    A.append_ledger(spark.createDataFrame([("5_6",)], "prefix string"), path, "2024-05-01T00:00:00Z")
    A.append_ledger(spark.createDataFrame([("7_8",)], "prefix string"), path, "2024-05-02T00:00:00Z", status="failed")
    assert A.ledger_exists(spark, path)
    assert prefixes(A.processed_prefixes(A.read_ledger_lines(spark, path))) == ["5_6"]
