"""CSV files that each go by their own header, as one data source.

Spark takes the header of one file for all files of a read. This source cuts files into byte ranges; the task of a
range looks up the first line of its file and binds the range's lines by it, so that one pass over the bytes and
one plan serve any number of files and headers. Lines are parsed as Arrow batches; columns are text, a column that
a file lacks is null, and so is an empty cell. Short lines end in nulls, what goes beyond the header is left out.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import posixpath
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pacsv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

NAME = "headered_csv"
#: Bytes of a range, and bytes parsed at a time.
RANGE, BLOCK = 64 << 20, 4 << 20
#: Bytes that take as long as opening a file does.
OPENING = 1 << 17
#: Files whose headers one task looks up.
FILES = 200
PACKED = (".gz", ".bz2", ".zst", ".lz4")


@dataclass
class Range:
    """The lines of a file that begin in ``[start, end)``; all of them for an end of -1."""

    path: str
    start: int
    end: int


@dataclass
class Ranges(InputPartition):
    """What one task reads."""

    parts: list[Range]


@dataclass
class Headers(InputPartition):
    """Files whose headers are wanted."""

    paths: list[str]


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if re.match(r"[a-z0-9+.-]+:/", path):
        path = re.sub(r"^file:/+", "file:///", path)
        # A glob is no valid URI; only the part before it names the system.
        scheme, _, rest = path.partition("://")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        host = rest.partition("/")[0]
        system, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
        return system, posixpath.join(base, rest.partition("/")[2])
    return fs.LocalFileSystem(), path


def alternatives(pattern: str) -> list[str]:
    """A glob without its braces: one pattern for every choice."""
    found = re.search(r"\{([^{}]*)\}", pattern)
    if not found:
        return [pattern]
    return [p for part in found[1].split(",") for p in alternatives(pattern[:found.start()] + part + pattern[found.end():])]


def _visible(name: str) -> bool:
    return not name.startswith(("_", "."))


def listed(pattern: str) -> list[fs.FileInfo]:
    """The files that a glob matches, and those inside folders that it matches, in order."""
    system, whole = file_system(pattern)
    out: dict[str, fs.FileInfo] = {}
    for one in alternatives(whole):
        parts = one.strip("/").split("/")
        root = "/" if one.startswith("/") else ""
        at = [fs.FileInfo(root, type=fs.FileType.Directory)]
        for part in parts:
            if not re.search(r"[*?\[]", part):
                at = [x for x in system.get_file_info([posixpath.join(a.path, part) for a in at]) if x.type != fs.FileType.NotFound] if at else []
                continue
            inside = [x for a in at if a.type == fs.FileType.Directory for x in system.get_file_info(fs.FileSelector(a.path or ".", allow_not_found=True))]
            at = [x for x in inside if _visible(x.base_name) and fnmatch.fnmatchcase(x.base_name, part)]
        for x in at:
            if x.type == fs.FileType.File:
                out[x.path] = x
            elif x.type == fs.FileType.Directory:
                for y in system.get_file_info(fs.FileSelector(x.path, recursive=True)):
                    below = posixpath.relpath(y.path, x.path).split("/")
                    if y.type == fs.FileType.File and all(map(_visible, below)):
                        out[y.path] = y
    return [out[p] for p in sorted(out)]


def _header(line: bytes) -> list[str]:
    return next(csv.reader([line.decode("utf-8-sig", "replace").rstrip("\r\n")]), [])


def _opened(system: fs.FileSystem, path: str) -> io.BufferedReader:
    return io.BufferedReader(system.open_input_stream(path, compression="detect") if path.endswith(PACKED) else system.open_input_file(path), 1 << 16)


def _blocks(file: io.BufferedReader, part: Range) -> Iterator[bytes]:
    """The lines that begin in a range, some megabytes at a time; the header has been read."""
    if part.end >= 0 and part.start > file.tell():
        # A line that began before the range belongs to the range before.
        file.seek(part.start - 1)
        file.readline()
    at = file.tell() if part.end >= 0 else 0
    while part.end < 0 or at < part.end:
        data = file.read(BLOCK if part.end < 0 else min(BLOCK, part.end - at))
        if not data:
            return
        if not data.endswith(b"\n"):
            data += file.readline()
        at += len(data)
        yield data


def dealt(files: Sequence[fs.FileInfo], size: int, tasks: int) -> list[Ranges]:
    """Files cut into ranges, neighbouring ones in one task: up to ``size`` bytes, or less to keep ``tasks`` busy."""
    most = min(size, max(BLOCK, sum(f.size + OPENING for f in files) // max(tasks, 1)))
    out: list[Ranges] = []
    held = most
    for f in files:
        step = max(f.size, 1) if f.path.endswith(PACKED) else most
        for start in range(0, f.size, step):
            end = min(start + step, f.size)
            if held + end - start > most:
                out.append(Ranges([]))
                held = 0
            out[-1].parts.append(Range(f.path, start, -1 if f.path.endswith(PACKED) else end))
            held += end - start + OPENING
    return out


def _parsed(data: bytes, header: list[str], wanted: Sequence[str]) -> pa.Table:
    """The wanted columns of some lines as text."""
    names = [f"{i}" for i in range(len(header))]
    at = {name: f"{i}" for i, name in reversed(list(enumerate(header)))}
    odd: list[str] = []

    def keep(row: pacsv.InvalidRow) -> str:
        odd.append(row.text)
        return "skip"

    found = pacsv.read_csv(
        io.BytesIO(data), pacsv.ReadOptions(column_names=names, use_threads=False),
        pacsv.ParseOptions(invalid_row_handler=keep),
        pacsv.ConvertOptions(
            column_types={n: pa.string() for n in names}, include_columns=[at[w] for w in wanted if w in at],
            strings_can_be_null=True, quoted_strings_can_be_null=False, null_values=[""],
        ),
    )
    columns = [found[at[w]] if w in at else pa.nulls(found.num_rows, pa.string()) for w in wanted]
    table = pa.table(columns, names=list(wanted))
    if odd:  # too short or too long
        rows = [r for r in csv.reader(odd) if r]
        cell = lambda r, w: (r[int(at[w])] or None) if w in at and int(at[w]) < len(r) else None
        more = [pa.array([cell(r, w) for r in rows], pa.string()) for w in wanted]
        table = pa.concat_tables([table, pa.table(more, names=list(wanted))])
    return table


class HeaderedCsv(DataSource):
    """Options: ``path``, ``columns`` (a line each), ``range`` (bytes), ``tasks`` to keep busy, ``headers`` to read the headers' names only."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _columns(self) -> list[str]:
        return [c for c in self.options.get("columns", "").split("\n") if c]

    def schema(self) -> StructType:
        names = ["header"] if "headers" in self.options else ["file", *self._columns()]
        return StructType([StructField(n, StringType()) for n in names])

    def reader(self, schema: StructType) -> DataSourceReader:
        size, tasks = int(self.options.get("range", RANGE)), int(self.options.get("tasks", 1))
        return _Reader(self.options["path"], self._columns(), "headers" in self.options, size, tasks)


class _Reader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], headers: bool, size: int, tasks: int):
        self.path, self.columns, self.headers, self.size, self.tasks = path, columns, headers, size, tasks

    def partitions(self) -> Sequence[InputPartition]:
        found = listed(self.path)
        if self.headers:
            return [Headers([f.path for f in found[i:i + FILES]]) for i in range(0, len(found), FILES)] or [Headers([])]
        return dealt(found, self.size, self.tasks) or [Ranges([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        if isinstance(partition, Headers):
            names = {name for path in partition.paths for name in _header(_opened(system, path).readline())}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(names), pa.string())], names=["header"])
            return
        for part in partition.parts:
            with _opened(system, part.path) as file:
                header = _header(file.readline())
                for data in _blocks(file, part):
                    table = _parsed(data, header, self.columns)
                    table = table.add_column(0, "file", pa.array([part.path] * table.num_rows, pa.string()))
                    yield from table.to_batches()


def read_headered(spark: SparkSession, path: str, wanted: Sequence[str], size: int = RANGE) -> DataFrame | None:
    """``file`` and those of the wanted columns that some file has, as text; None if no file is there."""
    spark.dataSource.register(HeaderedCsv)
    names = spark.read.format(NAME).option("path", path).option("headers", "1").load().distinct()
    there = {r["header"] for r in names.where(names["header"].isin(list(wanted))).collect()}  # at most the wanted ones
    if not there and names.isEmpty():
        return None
    columns = "\n".join(c for c in wanted if c in there)
    tasks = spark.sparkContext.defaultParallelism
    found = spark.read.format(NAME).option("path", path).option("columns", columns)
    return found.option("range", str(size)).option("tasks", str(tasks)).load()
