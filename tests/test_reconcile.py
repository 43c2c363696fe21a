from ledgerline.operators import reconcile as R

H = 1704067200          # 2024-01-01 00:00 UTC
SCHEMA = "signature string, instruction_index long, timestamp long, payload string"


def rows_for(hour_offset, minute, keys):
    t = H + hour_offset * 3600 + minute * 60
    return [(f"s{k}", k, t + 5, "p") for k in keys]


def run(spark, local_rows, remote_rows, start=H, end=H + 48 * 3600):
    local = spark.createDataFrame(local_rows, SCHEMA)
    remote = spark.createDataFrame(remote_rows, SCHEMA)
    dh = R.reconcile_hours(local, remote, start, end)
    dm = R.reconcile_minutes(local, remote, start, end, diff_hours=dh)
    app = R.repair_rows(local, remote, dm, "append")
    miss = R.repair_rows(local, remote, dm, "missing_only")
    return dh.collect(), dm.collect(), app.count(), miss.count()


def test_identical(spark):
    data = rows_for(0, 1, [1, 2, 3])
    dh, dm, a, m = run(spark, data, data)
    assert (dh, dm, a, m) == ([], [], 0, 0)


def test_remote_lacks_one_key_of_a_minute(spark):
    data = rows_for(0, 1, [1, 2, 3]) + rows_for(0, 2, [4])
    dh, dm, a, m = run(spark, data, data[1:])
    assert len(dh) == 1 and dh[0].direction == "remote_short"
    assert [r.minute for r in dm] == [H + 60]
    assert (a, m) == (3, 1)


def test_remote_lacks_an_hour(spark):
    data = rows_for(1, 1, [1]) + rows_for(1, 7, [2, 3])
    dh, dm, a, m = run(spark, data, [])
    assert [r.direction for r in dh] == ["remote_missing"]
    assert sorted(r.minute for r in dm) == [H + 3600 + 60, H + 3600 + 420]
    assert (a, m) == (3, 3)


def test_remote_duplicates_same_keys(spark):
    data = rows_for(0, 1, [1, 2])
    assert run(spark, data, data + data) == ([], [], 0, 0)


def test_remote_only_hour(spark):
    dh, dm, a, m = run(spark, [], rows_for(2, 3, [9]))
    assert [r.direction for r in dh] == ["remote_only"]
    assert len(dm) == 1 and (a, m) == (0, 0)


def test_blind_spots(spark):
    # different keys with the same count, and a key moved inside the hour
    local = rows_for(0, 1, [1, 2])
    assert run(spark, local, rows_for(0, 1, [3, 4]))[0] == []
    assert run(spark, local, rows_for(0, 1, [1]) + rows_for(0, 5, [2]))[0] == []


def test_lag_zone_not_compared(spark):
    local = rows_for(5, 1, [1])
    dh, *_ = run(spark, local, [], start=H, end=H + 5 * 3600)
    assert dh == []


def test_null_key_member_counts(spark):
    local = spark.createDataFrame([(None, 1, H, "p"), ("a", 1, H, "p")], SCHEMA)
    got = R.distinct_per_hour(local).collect()
    assert got[0].unique_count == 2


def test_time_window_defaults():
    start, end = R.time_window("2024-02-01T02:00:00")
    assert end - start == 7 * 86400 and end == 1706745600
