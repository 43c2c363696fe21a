"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerline.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """At most BATCH_ROWS rows in an Arrow batch: texts are long, and a Python worker
    holds a batch several times over.  Changes no result."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared checkpoint folder and read
    it back.  One computation (``checkpoint()`` would run the plan twice), and
    the rows survive the loss of any executor."""
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base_1``, ``base_2`` ... : the first that no column of ``df`` has
    (names compare without case, as Spark resolves them)."""
    taken = {c.lower() for c in df.columns}
    for k in itertools.count():
        name = base if k == 0 else f"{base}_{k}"
        if name.lower() not in taken:
            return name


def col(df: DataFrame, name: str) -> Column:
    """Column of ``df`` by its exact name (dots in names are not paths)."""
    return df["`" + name.replace("`", "``") + "`"]


def crc_mod(key: Column, m: int) -> Column:
    """crc32 of the key's decimal text, modulo m (null key: null)."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % m


def text_udf(fn, returns: DataType | str):
    """Scalar Arrow UDF over one text column.  Marked non-deterministic only so that
    the optimizer does not run it twice when its result is both filtered and kept."""
    return F.pandas_udf(fn, returns).asNondeterministic()
