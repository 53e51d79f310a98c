"""ZIP member scan (S2): the lines of bulk archives, read in place.

``spark.read.format("bulkzip")`` is a Python data source with one partition for each
member that is to be read: a compressed member cannot be split, and a task inflates
it once, block by block, cut at line ends. The options ``cycles`` and ``members`` say which are wanted: others are
not opened. (They are options and not pushed-down filters, since Spark 4.1 keeps what
one query pushed for every later scan of the same frame.) ``read_zip_lines`` lists the archives through Hadoop's file system (as Spark's own readers resolve a
path) and hands their full addresses to the source; ``load(path)`` alone lists by
pyarrow's file systems.

Member choice: for ``indiv`` only the root ``itcont.txt`` is read; the
``by_date/`` partials repeat its rows and would duplicate them. For other file
types every root-level ``.txt`` member is read. An archive without such a member
is an error that names it, and so are a name that tells no cycle and bytes that
are not text in the given ``encoding``.
"""

from __future__ import annotations

import json
import re
import zipfile
from typing import Iterator, NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ballotbox import schemas
from ballotbox.session import list_folder
from ballotbox.sources.delimited import parse

BLOCK = 1 << 20
COLUMNS = {"archive": pa.string(), "cycle": pa.int32(), "member": pa.string(), "value": pa.string()}


class Archive(NamedTuple):
    path: str
    size: int
    cycle: int


def cycle_of_name(path: str) -> int:
    """``indiv_2024.zip``, ``indiv_2024-part3.zip`` or ``indiv24.zip`` -> 2024."""
    name = path.rpartition("/")[2]
    m = re.search(r"_(\d{4})[-.][^/]*$", name) or re.search(r"[a-z](\d{2})\.zip$", name, re.IGNORECASE)
    if not m:
        raise ValueError(f"no election cycle in the name of {path}")
    year = int(m[1])
    return year if year > 99 else year + (1900 if year >= 70 else 2000)


def archives(spark: SparkSession, path: str) -> list[Archive]:
    """The archives at or below ``path``: metadata only."""
    found, folders = [], [path]
    while folders:
        for name, full, folder, size in list_folder(spark, folders.pop(), sizes=True):
            if folder:
                folders.append(full)
            elif name.lower().endswith(".zip"):
                found.append(Archive(full, size, cycle_of_name(full)))
    if not found:
        raise FileNotFoundError(f"no ZIP archive at or below {path}")
    return sorted(found)


def open_file(address: str):
    """A task's handle on a file known by its full address."""
    if address.startswith("file:") or "://" not in address:
        return pafs.LocalFileSystem().open_input_file("/" + address.removeprefix("file:").lstrip("/"))
    store, inner = pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", address))
    return store.open_input_file(inner)


def choose_members(names: list[str], file_type: str | None, inner: str | None) -> list[str]:
    if inner:
        return [n for n in names if n == inner]
    root_txt = [n for n in names if "/" not in n and n.lower().endswith(".txt")]
    if file_type == "indiv":
        return [n for n in root_txt if n.lower() == schemas.INDIV_INNER_FILE]
    return root_txt


def _blocks(raw):
    """Whole lines of a stream, about ``BLOCK`` bytes at a time."""
    rest = b""
    while chunk := raw.read(BLOCK):
        head, end, tail = chunk.rpartition(b"\n")
        if not end:
            rest += tail
            continue
        yield rest + head
        rest = tail
    if rest:
        yield rest


def _lines(text: str) -> pa.Array:
    """The lines of a block; a ``\\r`` before a line end is dropped."""
    values = pc.split_pattern(pa.array([text], pa.string()), "\n").flatten()
    return pc.replace_substring_regex(values, r"\r\z", "") if "\r" in text else values


class Member(InputPartition):
    def __init__(self, archive: str, cycle: int, member: str):
        self.archive, self.cycle, self.member = archive, cycle, member


def _wanted(options) -> list[str]:
    return json.loads(options["columns"]) if "columns" in options else list(COLUMNS)


class BulkZip(DataSource):
    """Options: ``file_type`` or ``inner`` choose the members, ``cycles`` and ``members``
    (JSON lists) those of them that are wanted, ``columns`` (JSON list) what is told of a
    line, ``encoding`` (UTF-8), and ``archives`` (addresses and cycles as JSON) or a path."""

    @classmethod
    def name(cls) -> str:
        return "bulkzip"

    def schema(self) -> str:
        return ", ".join(f"{c} {'int' if c == 'cycle' else 'string'}" for c in _wanted(self.options))

    def reader(self, schema: StructType) -> "BulkZipReader":
        return BulkZipReader(self.options)


class BulkZipReader(DataSourceReader):
    def __init__(self, options):
        self.file_type, self.inner = options.get("file_type"), options.get("inner")
        self.encoding = options.get("encoding", "UTF-8")
        if "\n|a".encode(self.encoding) != b"\n|a":
            raise ValueError(f"lines cannot be cut in {self.encoding}")
        self.found = [tuple(a) for a in json.loads(options["archives"])] if "archives" in options else _listed(options["path"])
        self.columns = _wanted(options)
        self.cycles, self.members = (json.loads(options[k]) if k in options else None for k in ("cycles", "members"))

    def partitions(self) -> list[Member]:
        out = []
        for archive, cycle in self.found:
            if self.cycles is not None and cycle not in self.cycles:
                continue
            with open_file(archive) as fh, zipfile.ZipFile(fh) as z:        # the central directory only
                members = choose_members(z.namelist(), self.file_type, self.inner)
            if not members:
                raise ValueError(f"{archive} has no member to read for {self.inner or self.file_type}")
            out += [Member(archive, cycle, m) for m in members if self.members is None or m in self.members]
        return out

    def read(self, partition: Member | None) -> Iterator[pa.RecordBatch]:
        if partition is None:                   # no member is wanted
            return
        with open_file(partition.archive) as fh, zipfile.ZipFile(fh) as z, z.open(partition.member) as raw:
            for block in _blocks(raw):
                try:
                    text = block.decode(self.encoding)
                except UnicodeDecodeError as e:
                    raise ValueError(f"{partition.member} of {partition.archive} is not {self.encoding}: {e}") from e
                values = _lines(text)
                told = {"archive": partition.archive, "cycle": partition.cycle, "member": partition.member}
                yield pa.RecordBatch.from_arrays(
                    [values if c == "value" else pa.repeat(pa.scalar(told[c], COLUMNS[c]), len(values)) for c in self.columns],
                    names=self.columns)


def _listed(path: str) -> list[tuple[str, int]]:
    """Archives at or below ``path`` where only Python looks."""
    local = "://" not in path and not path.startswith("file:")
    store, inner = (pafs.LocalFileSystem(), path) if local else pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    info = store.get_file_info(inner)
    files = [info] if info.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(inner, recursive=True))
    prefix = "" if local else path[:path.index(inner)] if inner in path else path.split("://")[0] + "://"
    found = sorted((prefix + f.path, cycle_of_name(f.path)) for f in files if f.path.lower().endswith(".zip"))
    if not found:
        raise FileNotFoundError(f"no ZIP archive at or below {path}")
    return found


def read_zip_lines(spark: SparkSession, path: str, file_type: str | None = None, inner: str | None = None,
                   encoding: str = "UTF-8", cycles: list[int] | None = None, members: list[str] | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """archive, cycle, member, value (or the listed ``columns``) of every line of the chosen
    members (of the listed ``cycles`` and ``members`` only). A column that is not listed is
    not sent from Python to Spark; Spark does not tell the source what a query leaves out."""
    found = json.dumps([(a.path, a.cycle) for a in archives(spark, path)])
    spark.dataSource.register(BulkZip)
    chosen = {k: v for k, v in (("file_type", file_type), ("inner", inner)) if v}
    chosen |= {k: json.dumps(v) for k, v in (("cycles", cycles), ("members", members), ("columns", columns)) if v is not None}
    return spark.read.format("bulkzip").options(archives=found, encoding=encoding, **chosen).load()


def read_zip(spark: SparkSession, path: str, file_type: str, inner: str | None = None,
             encoding: str = "UTF-8") -> DataFrame:
    """Raw string columns of the chosen members, with the ``cycle`` of the archive."""
    return parse(read_zip_lines(spark, path, file_type, inner, encoding, columns=["value", "cycle"]), file_type)
