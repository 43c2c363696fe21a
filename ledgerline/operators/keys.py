"""Key dictionary (F1): base58 text of the distinct binary keys of tables, kept between runs.

Encoding is a numpy-vectorized Arrow UDF; a dictionary pays off when keys repeat a lot
(mints, pools).  The stored one is partitioned by a hash of the key, ``{path}/shard=S/load=L``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.base58 import base58
from ledgerline.session import staged
from ledgerline.sources import files as W

SHARDS = 64
SCHEMA = f"key binary, address string, shard int, {W.LOAD} string"


def _shard(key):
    return F.pmod(F.xxhash64(key), F.lit(SHARDS)).cast("int")


def distinct_keys(df: DataFrame, key_cols: list[str]) -> DataFrame:
    parts = [df.select(F.col(c).alias("key")) for c in key_cols]
    return reduce(DataFrame.unionByName, parts).where(F.col("key").isNotNull()).distinct()


def address_dictionary(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """(key BINARY, address STRING) for every distinct non-null key of ``key_cols``."""
    return distinct_keys(df, key_cols).withColumn("address", base58("key"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path) if W.exists(spark, path) else spark.createDataFrame([], SCHEMA)


def extend_dictionary(spark: SparkSession, path: str, df: DataFrame, key_cols: list[str], load: str) -> int:
    """Add the keys of ``df`` that the dictionary at ``path`` lacks; only those are encoded.
    Returns their number.  A repeated ``load`` writes its own keys again; one writer at a time."""
    held = read_dictionary(spark, path).where(F.col(W.LOAD) != load).select("shard", "key")
    new = distinct_keys(df, key_cols).withColumn("shard", _shard("key")).join(held, ["shard", "key"], "left_anti")
    new = staged(new, "new-keys")
    if n := new.count():
        W.write_load(new.select("key", base58("key").alias("address"), "shard"), path, ["shard"], load)
    return n


def resolve(df: DataFrame, id_cols: list[str], key_cols: list[str], dictionary: DataFrame) -> DataFrame:
    """``df`` with its binary ``key_cols`` replaced by their addresses, null for null.

    All key columns are looked up in one join: the rows' ids and keys are unpivoted, joined and
    gathered by id again.  ``id_cols`` identify a row and are not null.  A key that the
    dictionary lacks raises an error."""
    n = len(key_cols)
    asked = df.select(*id_cols, F.posexplode(F.array(*key_cols)).alias("_at", "key")).where("key is not null")
    found = asked.join(dictionary.select("key", "address"), "key", "left").select(
        *id_cols, "_at", F.when(F.col("address").isNotNull(), F.col("address")).otherwise(
            F.raise_error(F.concat(F.lit("no address for key "), F.hex("key")))).alias("address"))
    wide = found.groupBy(*id_cols).agg(*[F.max(F.when(F.col("_at") == i, F.col("address"))).alias(f"_a{i}") for i in range(n)])
    at = {c: f"_a{i}" for i, c in enumerate(key_cols)}
    return df.join(wide, id_cols, "left").select(*[F.col(at[c]).alias(c) if c in at else F.col(c) for c in df.columns])
