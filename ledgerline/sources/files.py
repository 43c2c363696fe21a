"""Folders that several jobs share: loads that own their files, small state that moves on
batch by batch, and files that are replaced by others.

Everything goes through Spark's own file systems, so any path that Spark can write will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.transfer import _delete as delete
from ledgerline.sources.transfer import _exists as exists
from ledgerline.sources.transfer import _fs as fs_of

LOAD = "load"
_STAGE = "_swap-"


# ------------------------------------------------------------------ folders
def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly in ``path``, in order; none if it is missing."""
    fs, p = fs_of(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = fs_of(spark, old)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"{old} could not be renamed to {new}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all."""
    hidden = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    fs, p = fs_of(spark, hidden)
    out = fs.create(p)
    out.write(bytearray(text.encode()))
    out.close()
    delete(spark, path)
    rename(spark, hidden, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = fs_of(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def partitions(spark: SparkSession, path: str, columns: list[str]) -> dict[tuple, str]:
    """Partition folders ``c1=v1/c2=v2`` below ``path``: {values as text: relative folder}."""
    level = {(): ""}
    for c in columns:
        level = {(*values, unquote(name[len(c) + 1:])): f"{folder}/{name}".lstrip("/")
                 for values, folder in level.items() for name in names_in(spark, f"{path.rstrip('/')}/{folder}")
                 if name.startswith(f"{c}=")}
    return level


# ------------------------------------------------------------------ loads
def write_load(df: DataFrame, path: str, partition_by: list[str], load: str | None = None) -> None:
    """Write the rows of a load (a batch of a run, a wave of archive pairs): the load owns the partition
    folders ``.../load=L`` and replaces them whole, so doing it again changes nothing and
    touches no other load.  ``load`` names it, or the rows have a ``load`` column."""
    if load is not None:
        df = df.withColumn(LOAD, F.lit(load))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by, LOAD).parquet(path)


class Snapshots:
    """Small state that every load moves on: ``path/n=00000007,load=L``, the last two kept.

    ``before(load)`` is the state that the load started from, also when it is repeated, so a
    repeated load computes the same rows and writes the same state.  One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _all(self) -> list[tuple[int, str, str]]:
        found = []
        for name in names_in(self.spark, self.path):
            if name.startswith("n=") and exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                n, load = name[2:].split(",load=")
                found.append((int(n), load, name))
        return found

    def _read(self, name: str | None) -> DataFrame:
        if name is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{name}")

    def latest(self) -> DataFrame:
        found = self._all()
        return self._read(found[-1][2] if found else None)

    def before(self, load: str) -> DataFrame:
        found = [s for s in self._all() if s[1] != load]
        return self._read(found[-1][2] if found else None)

    def write(self, state: DataFrame, load: str) -> None:
        found = self._all()
        n = next((s[0] for s in found if s[1] == load), found[-1][0] + 1 if found else 0)
        state.write.mode("overwrite").parquet(f"{self.path}/n={n:08d},load={load}")
        for _, _, name in [s for s in found if s[1] != load][:-1]:
            delete(self.spark, f"{self.path}/{name}")


# ------------------------------------------------------------------ replacing files
def replace(spark: SparkSession, root: str, write: Callable[[str], None], retire: list[str],
            moves: Callable[[str], list[tuple[str, str]]]) -> None:
    """Replace the files or folders ``retire`` (relative to ``root``) by others.

    ``write(path)`` writes the new ones to a hidden folder beside the old; ``moves(path)`` then
    lists (name below path, name below root) of what is to be moved in.  Before anything is
    touched the plan is stored, so a run that fails earlier leaves the old files and one that
    fails later is completed by ``finish``.  Files that came meanwhile are not in ``retire``
    and stay.  One such job at a time for a root; readers may miss the rows in question, never
    see them twice."""
    finish(spark, root)
    stage = f"{root.rstrip('/')}/{_STAGE}{uuid.uuid4().hex[:12]}"
    write(f"{stage}/new")
    write_text(spark, f"{stage}/plan", json.dumps({"retire": retire, "moves": moves(f"{stage}/new")}))
    finish(spark, root)


def finish(spark: SparkSession, root: str) -> None:
    """Complete replacements whose plan was stored and drop what was never planned."""
    root = root.rstrip("/")
    for name in names_in(spark, root):
        if not name.startswith(_STAGE):
            continue
        stage = f"{root}/{name}"
        if exists(spark, f"{stage}/plan"):
            plan = json.loads(read_text(spark, f"{stage}/plan"))
            for old in plan["retire"]:
                delete(spark, f"{root}/{old}")
            for new, target in plan["moves"]:
                if exists(spark, f"{stage}/new/{new}"):
                    rename(spark, f"{stage}/new/{new}", f"{root}/{target}")
        delete(spark, stage)
