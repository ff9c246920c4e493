"""Four-line read files as a data source: one scan, plain or gzip, plain files in splits that begin with a record.

``spark.read.format("reads").load(path)``, after ``register(spark)``. The path is a file, a folder, a pattern or several with commas, on a
file system that Arrow opens by its URI (local or shared folders, object stores, HDFS). A split's reader looks for the first
record that begins in it: a line that starts with ``@`` two lines before one that starts with ``+``; a line of
qualities has the bases there. A record belongs to the split in which it begins. Only columns of the wanted schema are made.
Records that are cut off, or whose lines are not what they should be, raise, whatever columns are wanted.
"""

from __future__ import annotations

import fnmatch
import gzip
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FIELDS = ("header", "seq", "plus", "qual")
SCHEMA = "path string, split long, number long, begin long, header string, seq string, plus string, qual string"
SPLIT_BYTES, CHUNK = 64 << 20, 4 << 20


def files(path: str) -> list[tuple[str, int]]:
    """Files with their sizes, hidden ones left out."""
    out = []
    for one in path.split(","):
        fs, inside = _opened(one)
        folder, _, pattern = inside.rpartition("/")
        info = fs.get_file_info(inside)
        if info.type == pafs.FileType.File:
            found = [info]
        elif info.type == pafs.FileType.Directory:
            found = fs.get_file_info(pafs.FileSelector(inside, recursive=True))
        else:
            found = [x for x in fs.get_file_info(pafs.FileSelector(folder)) if fnmatch.fnmatchcase(x.base_name, pattern)]
        uri = one[: len(one) - len(inside)] if one.endswith(inside) else ""
        out += [(uri + x.path, x.size) for x in found if x.type == pafs.FileType.File and not x.base_name.startswith(("_", "."))]
    if not out:
        raise FileNotFoundError(path)
    return sorted(out)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass
class Split(InputPartition):
    path: str
    begin: int
    end: int | None


class ReadSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "reads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return ReadReader(self.options, schema)


class ReadReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.size, self.columns = options["path"], int(options.get("splitbytes", SPLIT_BYTES)), schema.names
        if unknown := set(self.columns) - {x.split()[0] for x in SCHEMA.split(", ")}:
            raise ValueError(f"no such columns: {sorted(unknown)}")

    def partitions(self) -> list[Split]:
        out = []
        for path, size in files(self.path):
            if path.endswith(".gz"):
                out.append(Split(path, 0, None))
            else:
                out += [Split(path, at, min(at + self.size, size)) for at in range(0, size, self.size)]
        return out or [Split("", 0, 0)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        done = 0
        for begin, lines in records(split.path, split.begin, split.end) if split.path else ():
            n = len(begin)
            made = {"path": lambda: pa.array([split.path] * n), "split": lambda: pa.array(np.full(n, split.begin)), "number": lambda at=done: pa.array(np.arange(at, at + n)), "begin": lambda: pa.array(begin)}
            made |= {f: (lambda k=k: pa.array([x.decode("utf-8", "replace") for x in lines[k::4]], pa.string())) for k, f in enumerate(FIELDS)}
            yield pa.RecordBatch.from_arrays([made[c]() for c in self.columns], self.columns)
            done += n


def records(path: str, begin: int, end: int | None) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Where records begin, and their lines, of all that begin from ``begin`` on and before ``end`` (None: all)."""
    fs, inside = _opened(path)
    with fs.open_input_file(inside) as plain:
        if end is None:
            source, at = gzip.GzipFile(fileobj=plain), 0
        else:
            source, at = plain, max(begin - 1, 0)  # a byte before tells whether a line begins here
            plain.seek(at)
        rest, found, over = b"", begin == 0, False
        while not over:
            data = source.read(CHUNK)
            over, rest = not data, rest + data
            cut = len(rest) if over else rest.rfind(b"\n") + 1
            lines = rest[:cut].split(b"\n")
            if not lines[-1]:
                lines.pop()
            start = at + np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines])]).astype(np.int64)
            lines = [x.removesuffix(b"\r") for x in lines]
            first = 0
            if not found:
                hit = next((i for i in range(1, len(lines) - 2) if lines[i][:1] == b"@" and lines[i + 2][:1] == b"+"), None)
                if hit is None:
                    if over or (end is not None and len(start) > 9 and start[1] >= end):
                        return
                    continue
                found, first = True, hit
            full = (len(lines) - first) // 4 * 4
            if over and full < len(lines) - first and (end is None or start[first + full] < end):
                raise ValueError(f"{path}: incomplete record")
            heads = start[first : first + full : 4]
            n = len(heads) if end is None else int(np.searchsorted(heads, end))
            mine = lines[first : first + 4 * n]
            if n:
                _checked(path, mine)
                yield heads[:n], mine
            if n < len(heads) or (end is not None and start[first + full] >= end):
                return
            rest, at = rest[int(start[first + full]) - at :], int(start[first + full])


def _checked(path: str, lines: list[bytes]) -> None:
    for head, seq, plus, qual in zip(lines[::4], lines[1::4], lines[2::4], lines[3::4]):
        uneven = len(seq) != len(qual) and len(seq.decode("utf-8", "replace")) != len(qual.decode("utf-8", "replace"))
        if head[:1] != b"@" or plus[:1] != b"+" or uneven:
            raise ValueError(f"{path}: not a record: {head[:80]!r}")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ReadSource)


def scan_reads(spark: SparkSession, path: str, columns: tuple[str, ...] = ("path", "begin", *FIELDS), split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The wanted ``columns`` of all records, in one scan."""
    register(spark)
    kinds = dict(x.split() for x in SCHEMA.split(", "))
    return spark.read.format("reads").schema(", ".join(f"{c} {kinds[c]}" for c in columns)).option("splitBytes", split_bytes).load(path)


def with_ordinals(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``path, ordinal`` (from 1 in each file) and the fields: a scan that counts each split's records, then the scan."""
    counts = scan_reads(spark, path, ("path", "split"), split_bytes).groupBy("path", "split").count()
    before = F.sum("count").over(Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0))).drop("count")  # a row per split
    rows = scan_reads(spark, path, ("path", "split", "number", *FIELDS), split_bytes)
    return rows.join(counts, ["path", "split"]).select("path", (F.col("before") + F.col("number") + 1).alias("ordinal"), *FIELDS)
