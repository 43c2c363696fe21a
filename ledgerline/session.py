"""Session construction and the shared scratch folder.

Scratch data (exports, stream sinks, stream checkpoints, reliable
checkpoints) always lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that is unset (local runs and tests) do
we create one of our own, and only on a local master.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # the instruction superset struct (event + accounts) has ~90 nested fields;
    # keep whole-stage codegen on for it (the default cut-off is 100 fields)
    "spark.sql.codegen.maxFields": "1000",
}


READ_ROWS = 256


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "ledgerline",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All epoch/hour/day arithmetic in this package is UTC; wide instruction
    structs stay inside whole-stage codegen, and a Parquet scan holds few rows
    of them at a time (4,096 transactions of 70 instructions are 0.5 GB a task)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if int(spark.conf.get("spark.sql.codegen.maxFields", "100")) < 1000:
        spark.conf.set("spark.sql.codegen.maxFields", "1000")
    if int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize", "4096")) > READ_ROWS:
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created locally only for local masters."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    path = root.rstrip("/") + f"/ledgerline/{name}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: written once to the shared folder and read back
    (``checkpoint()`` would run its plan twice)."""
    spark = df.sparkSession
    path = scratch_dir(spark, name) + "/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
