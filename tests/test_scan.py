import pandas as pd
from pyspark.sql import functions as F

from ledgerline.operators.scan import segmented_scan


def test_hot_key_cumsum_rownum_lag(spark):
    rows = [(0 if i % 3 else i % 7, i, i % 5) for i in range(3000)]   # key 0 holds 2/3 of the rows
    df = spark.createDataFrame(rows, "k long, o long, v long")
    out = segmented_scan(df, ["k"], ["o"], cumsums={"cs": "v"}, rownum="rn", lags={"lg": "o"}, num_partitions=9)
    got = out.toPandas().sort_values(["k", "o"]).reset_index(drop=True)
    exp = pd.DataFrame(rows, columns=["k", "o", "v"]).sort_values(["k", "o"]).reset_index(drop=True)
    g = exp.groupby("k")
    assert (got["cs"].to_numpy() == g["v"].cumsum().to_numpy()).all()
    assert (got["rn"].to_numpy() == (g.cumcount() + 1).to_numpy()).all()
    lag = g["o"].shift(1)
    assert got["lg"].isna().equals(lag.isna())
    assert (got["lg"].dropna().astype("int64").to_numpy() == lag.dropna().astype("int64").to_numpy()).all()


def test_empty_partitions_and_null_keys(spark):
    rows = [(None if i % 5 == 0 else i % 3, i, 1) for i in range(30)] + [(7, 100 + i, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    out = segmented_scan(df, ["k"], ["o"], cumsums={"cs": "v"}, rownum="rn", lags={"lg": "o"},
                         num_partitions=50).toPandas()
    exp = pd.DataFrame(rows, columns=["k", "o", "v"])
    exp["kk"] = exp["k"].fillna(-1)
    exp = exp.sort_values(["kk", "o"]).reset_index(drop=True)
    got = out.assign(kk=out["k"].fillna(-1)).sort_values(["kk", "o"]).reset_index(drop=True)
    g = exp.groupby("kk")
    assert (got["cs"].to_numpy() == g["v"].cumsum().to_numpy()).all()
    assert (got["rn"].to_numpy() == (g.cumcount() + 1).to_numpy()).all()
    lag = g["o"].shift(1)
    assert got["lg"].isna().equals(lag.isna())


def test_exact_sums_with_nulls_and_descending_order(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(1, 1, big), (1, 2, None), (1, 3, 0)], "k long, o long, v long")
    up = {r.o: r.cs for r in segmented_scan(df, ["k"], ["o"], cumsums={"cs": "v"}, num_partitions=3).collect()}
    assert up == {1: big, 2: big, 3: big}
    down = {r.o: r.cs for r in segmented_scan(df, ["k"], [F.col("o").desc()], cumsums={"cs": "v"}, num_partitions=3).collect()}
    assert down == {1: big, 2: 0, 3: 0}
