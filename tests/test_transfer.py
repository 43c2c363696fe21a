import pytest
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir
from ledgerline.sources import transfer as X

SCHEMA = "signature string, slot decimal(20,0), transaction_index long, instruction_index long, timestamp long"
D15 = 1736899200        # 2025-01-15 00:00 UTC


def src(spark):
    rows = [("a", 3, 0, 0, D15 + 10), ("b", 1, 0, 1, D15 + 86399), ("c", 2, 0, 0, D15 + 86400),
            ("d", 9, 1, 2, D15 - 1)]
    from decimal import Decimal
    return spark.createDataFrame([(s, Decimal(sl), t, i, ts) for s, sl, t, i, ts in rows], SCHEMA)


def test_day_bounds_and_order(spark):
    got = X.extract_daily(src(spark), "2025-01-15", "2025-01-15").collect()
    assert [r.signature for r in got] == ["b", "a"]          # ordered by slot
    assert all(D15 <= r.timestamp < D15 + 86400 for r in got)


def test_export_import_roundtrip_empty_day_rerun(spark):
    root, target = scratch_dir(spark, "t-exp"), scratch_dir(spark, "t-imp")
    df = src(spark)
    dates = X.export_daily(df, "trade", root, "2025-01-15", "2025-01-17")
    assert dates == ["2025-01-15", "2025-01-16", "2025-01-17"]
    X.export_daily(df, "trade", root, "2025-01-15", "2025-01-17")      # rerun overwrites
    back = X.read_daily_folder(spark, f"{root}/trade", df.schema)
    per_day = {str(r.event_date): r.n for r in back.groupBy("event_date").agg(F.count("*").alias("n")).collect()}
    assert per_day == {"2025-01-15": 2, "2025-01-16": 1}
    assert X.read_daily_folder(spark, f"{root}/trade/event_date=2025-01-17", df.schema).count() == 0
    mapping = {"trade": "trade_copy"}
    X.import_folder(spark, root, "trade", mapping, target, df.schema)
    X.import_folder(spark, root, "trade", mapping, target, df.schema)
    assert X.read_target(spark, target, "trade_copy", df.schema).count() == 6      # not idempotent
    target2 = scratch_dir(spark, "t-imp2")
    for _ in range(2):
        X.import_folder(spark, root, "trade", mapping, target2, df.schema, dedupe=True)
    assert X.read_target(spark, target2, "trade_copy", df.schema).count() == 3
    totals = X.import_totals(back).orderBy("event_date").collect()
    assert [(r.rows, r.running_rows) for r in totals] == [(2, 2), (1, 3)]


def test_missing_folder_and_mapping(spark):
    schema = src(spark).schema
    assert X.read_daily_folder(spark, scratch_dir(spark, "none") + "/missing", schema).count() == 0
    with pytest.raises(KeyError, match="Event type not found"):
        X.check_mapping({"a": "b"}, "trade")


def test_unknown_event_type():
    from ledgerline.schemas import table_schema
    with pytest.raises(KeyError, match="Unknown event type"):
        table_schema("PumpfunCompleteEventV2")


def test_rerun_clears_day_that_lost_its_rows(spark):
    root = scratch_dir(spark, "t-rerun")
    df = src(spark)
    X.export_daily(df, "trade", root, "2025-01-15", "2025-01-16")
    X.export_daily(df.where(F.col("timestamp") >= D15 + 86400), "trade", root, "2025-01-15", "2025-01-16")
    back = X.read_daily_folder(spark, f"{root}/trade", df.schema)
    assert {str(r.event_date) for r in back.collect()} == {"2025-01-16"}


def test_export_without_any_rows(spark):
    root = scratch_dir(spark, "t-empty")
    df = src(spark).where(F.lit(False))
    assert X.export_daily(df, "trade", root, "2030-01-01", "2030-01-02") == ["2030-01-01", "2030-01-02"]
    assert X.read_daily_folder(spark, f"{root}/trade", df.schema).count() == 0
