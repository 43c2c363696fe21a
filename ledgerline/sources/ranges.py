"""Byte ranges of archive files as units of reading.

A slot index says where each slot lies in its ``.bin`` file.  The readable entries are dealt to
tasks by the bytes that they read, not by files or rows: a running sum of sizes in
``(path, offset)`` order cuts them into packs of ``PACK_BYTES``, and a pack is one partition.
A file that holds a third of all slots is thus read by many tasks, small files share one, and
the list of ranges never passes through the driver.

Within a task ranges are read in file order; neighbours at most ``GAP`` bytes apart are one
request of at most ``SPAN`` bytes.  Files are opened with Arrow's file systems (local, HDFS and
object stores); another store needs an ``open_file`` of its own.

Cases: entries with a null path, offset or size are no ranges and are left out; an empty range
gives empty bytes; overlapping and repeated ranges each give their own row; a range behind the
end of its file (cut off since it was listed) raises an error; a range of 2 GB or more does not
fit an Arrow value and raises one before anything is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.scan import segmented_scan
from ledgerline.session import staged

PACK_BYTES = 128 << 20
GAP = 64 << 10
SPAN = 8 << 20
LARGEST = (1 << 31) - 1


def open_uri(path: str) -> BinaryIO:
    """A file of any store that Arrow knows, for reading at positions."""
    from pyarrow import fs
    if path.startswith("/") or path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def pack_ranges(ranges: DataFrame, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """``ranges`` (path, offset, size and other columns) with ``pack``: the number of its unit of
    reading.  A pack begins less than ``pack_bytes`` of ranges; its last range may go beyond."""
    longs = {c: F.col(c).cast("long") for c in ("offset", "size")}
    usable = ranges.withColumns(longs).where("path is not null and offset is not null and size is not null")
    upto = segmented_scan(usable, [], ["path", "offset", "size"], cumsums={"_upto": "size"})
    first = F.col("_upto") - F.col("size")
    return upto.withColumn("pack", F.floor(first / F.lit(pack_bytes)).cast("long")).drop("_upto")


def _spans(paths: list[str], offsets: list[int], sizes: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(first, behind last, begin, end): runs of rows that one request reads."""
    first = 0
    while first < len(paths):
        begin, end, last = offsets[first], offsets[first] + sizes[first], first + 1
        while last < len(paths) and paths[last] == paths[first] and offsets[last] <= end + GAP \
                and max(end, offsets[last] + sizes[last]) - begin <= SPAN:
            end = max(end, offsets[last] + sizes[last])
            last += 1
        yield first, last, begin, end
        first = last


def read_ranges(ranges: DataFrame, pack_bytes: int = PACK_BYTES,
                open_file: Callable[[str], BinaryIO] = open_uri) -> DataFrame:
    """``ranges`` with ``pack`` and ``content``, the bytes of each; one task a pack."""
    packed = staged(pack_ranges(ranges, pack_bytes), "ranges")
    packs, largest = packed.agg(F.max("pack"), F.max("size")).first()
    if (largest or 0) > LARGEST:
        raise ValueError(f"a range of {largest} bytes")
    names = packed.columns
    at = [names.index(c) for c in ("path", "offset", "size")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        try:
            for batch in batches:
                paths, offsets, sizes = (batch.column(k).to_pylist() for k in at)
                done, content, held = 0, [], 0                     # rows given on, values of those after, their bytes
                for first, last, begin, end in _spans(paths, offsets, sizes):
                    if paths[first] != path:
                        if file is not None:
                            file.close()
                        path, file = paths[first], open_file(paths[first])
                    file.seek(begin)
                    data = memoryview(file.read(end - begin))
                    if len(data) < end - begin:
                        raise OSError(f"{path}: {len(data)} of {end - begin} bytes at {begin}")
                    content += [data[o - begin:o - begin + s] for o, s in zip(offsets[first:last], sizes[first:last], strict=True)]
                    held += sum(sizes[first:last])
                    if held >= SPAN or last == len(paths):
                        yield pa.RecordBatch.from_arrays([*batch.slice(done, last - done).columns, pa.array(content, pa.binary())],
                                                         names=[*names, "content"])
                        done, content, held = last, [], 0
        finally:
            if file is not None:
                file.close()

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema] + ["content binary"])
    dealt = packed.repartitionById((packs or 0) + 1, F.col("pack").cast("int")).sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(run, schema)
