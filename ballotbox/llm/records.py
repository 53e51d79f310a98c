"""Token ids as length-delimited binary records with a separate offset index.

A shard ``shard-00012-003.rec`` holds records one after the other::

    length   uint64, little endian
    masked CRC-32 of those 8 bytes   uint32
    data     ``length`` bytes
    masked CRC-32 of the data        uint32

(the mask rotates right by 15 bits and adds 0xa282ead8). The data are one flag
byte (1: the doc_id is NULL), one byte that says how wide an id is (2 where the
vocabulary has at most 65,536 tokens, else 4), the doc_id as int64 and the ids,
all little endian. ``shard-00012-003.idx`` holds the offset of each record as uint64,
so that a shuffled reader can seek to any record of any shard. Reading back uses it:
tasks get ranges of records and read their bytes only.

Documents are range partitioned by doc_id (then by text and row, so one id, and one
text that very many rows have, are split too) and sorted inside a partition: record
order over the shards (partition, then number) is ascending doc_id. A partition goes on
in a new shard once one reaches ``SHARD_BYTES``; only a single larger record exceeds it. NULL doc_ids come first; rows that share a doc_id
are ordered by text. NULL and empty texts have no ids but the end id. An empty
table writes no shard. Other columns are not read.

Each task writes under a name of its own attempt and renames at the end, so a
retry replaces the shard as a whole. Files are written and read through pyarrow's
file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize, pieces, text_key
from ballotbox.llm.tokens import encoder
from ballotbox.session import list_folder

MASK = 0xA282EAD8
SHARD_BYTES = 256 << 20     # of a shard
RANGE_BYTES = 16 << 20      # read by a task at a time

HEAD = "<BBq"


def masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    head = struct.pack("<Q", len(data))
    return b"".join((head, struct.pack("<I", masked(zlib.crc32(head))), data, struct.pack("<I", masked(zlib.crc32(data)))))


def unframe(blob):
    """(offset, data) of each record of a bytes-like object; raises on a damaged one."""
    at = 0
    while at < len(blob):
        head = blob[at:at + 8]
        (n,) = struct.unpack("<Q", head)
        data = blob[at + 12:at + 12 + n]
        if (struct.unpack("<I", blob[at + 8:at + 12])[0] != masked(zlib.crc32(head)) or len(data) != n
                or struct.unpack("<I", blob[at + 12 + n:at + 16 + n])[0] != masked(zlib.crc32(data))):
            raise ValueError(f"damaged record at byte {at}")
        yield at, data
        at += 16 + n


def _file_system(folder: str):
    from pyarrow import fs

    if "://" not in folder or folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Writes ``docs`` (doc_id, text) and returns one row per shard: part, number, n_records,
    n_tokens, n_bytes. ``folder`` must be one that all executors share."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(least, -(-size // SHARD_BYTES))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key(F.col("text")).alias("k"),
                        F.monotonically_increasing_id().alias("row"))
    ordered = (keyed.repartitionByRange(n, "doc_id", "k", "row").sortWithinPartitions("doc_id", "k", "text", "row")
               .select("doc_id", "text"))

    def put(batches):
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        store, root = _file_system(folder)
        store.create_dir(root, recursive=True)
        enc = encoder(vocabulary)
        end = np.array([end_id], f"<u{enc.width}").tobytes()
        number, out, offsets, at, tokens = 0, None, [], 0, 0

        def close():
            name = f"{root}/shard-{part:05d}-{number:03d}"
            out.close()
            with store.open_output_stream(f"{name}.idx.{attempt}") as idx:
                idx.write(np.array(offsets, "<u8").tobytes())
            for kind in ("rec", "idx"):
                store.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), *(pa.array([x], pa.int64()) for x in (len(offsets), tokens, at))],
                names=["part", "number", "n_records", "n_tokens", "n_bytes"])

        for batch in pieces(batches, 2 << 20):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, codes in zip(ids, enc.encode(batch.column("text").to_pylist())):
                rec = frame(struct.pack(HEAD, doc_id is None, enc.width, doc_id or 0) + codes + end)
                if out is not None and at + len(rec) > SHARD_BYTES:
                    yield close()
                    number, out, offsets, at, tokens = number + 1, None, [], 0, 0
                if out is None:
                    out = store.open_output_stream(f"{root}/shard-{part:05d}-{number:03d}.rec.{attempt}")
                out.write(rec)
                offsets.append(at)
                at, tokens = at + len(rec), tokens + len(codes) // enc.width + 1
        if out is not None:
            yield close()

    return materialize(ordered.mapInArrow(put, "part int, number int, n_records long, n_tokens long, n_bytes long"), "records-shards")


RANGE = "part int, number int, path string, record long, start long, stop long"


def ranges(spark: SparkSession, folder: str) -> DataFrame:
    """part, number, path, record, start, stop: runs of records of about ``RANGE_BYTES``
    (one record at least), cut by the offset indexes; ``record`` is the first one's number."""
    files = {name: (full, size) for name, full, is_folder, size in list_folder(spark, folder, sizes=True) if not is_folder}
    listed = [(int(name[6:11]), int(name[12:-4]), full, files[f"{name[:-4]}.rec"][0], files[f"{name[:-4]}.rec"][1])
              for name, (full, _) in files.items() if name.startswith("shard-") and name.endswith(".idx")]
    names = [c.split()[0] for c in RANGE.split(", ")]

    def cut(batches):
        for batch in batches:
            out = []
            for part, number, index, path, size in zip(*(c.to_pylist() for c in batch.columns)):
                store, place = _file_system(index)
                with store.open_input_stream(place) as f:
                    offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
                first = 0
                while first < len(offsets):
                    last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RANGE_BYTES)))
                    out.append((part, number, path, first, int(offsets[first]), int(offsets[last]) if last < len(offsets) else size))
                    first = last
            if out:
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    shards = spark.createDataFrame(listed, "part int, number int, index string, path string, size long")
    tasks = max(1, min(len(listed), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return shards.repartition(tasks, "part", "number").mapInArrow(cut, RANGE)


def _records(batches):
    """(part, number, start of the range, record, offset, doc_id or None, ids as unsigned
    32-bit integers) of ranges, in order within each."""
    for batch in batches:
        for part, number, path, record, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
            store, place = _file_system(path)
            with store.open_input_file(place) as f:
                f.seek(start)
                blob = memoryview(f.read(stop - start))
            if len(blob) != stop - start:
                raise ValueError(f"{path} ends before byte {stop}")
            for i, (at, data) in enumerate(unframe(blob)):
                null, width, doc_id = struct.unpack(HEAD, data[:10])
                ids = np.frombuffer(data[10:], f"<u{width}").astype("<u4").tobytes()
                yield part, number, start, record + i, start + at, None if null else doc_id, ids


def _spread(spark: SparkSession, folder: str) -> DataFrame:
    """``ranges`` dealt out evenly."""
    return ranges(spark, folder).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part", "number", "start")


def _batches(rows, names: list[str], types: list, most: int = 8 << 20):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + (len(row[-1]) if isinstance(row[-1], bytes) else 0)
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the folder: part, number, record, offset, doc_id, n_tokens, ids
    (binary, unsigned 32-bit). Bytes are checked against both checksums."""
    names = ["part", "number", "record", "offset", "doc_id", "n_tokens", "ids"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def get(batches):
        yield from _batches(((p, n, i, at, d, len(ids) // 4, ids) for p, n, _, i, at, d, ids in _records(batches)), names, types)

    return _spread(spark, folder).mapInArrow(
        get, "part int, number int, record long, offset long, doc_id long, n_tokens long, ids binary")


def digest(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Writes, reads back and returns per document doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    shards = write(docs, folder, vocabulary, end_id)
    if not shards.take(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    names = ["part", "number", "range", "doc_id", "inside", "n_tokens", "ids_crc32"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def rows(batches):
        range_, inside = None, 0
        for part, number, start, _, _, doc_id, ids in _records(batches):
            if (part, number, start) != range_:
                range_, inside = (part, number, start), 0
            yield part, number, start, doc_id, inside, len(ids) // 4, zlib.crc32(ids)
            inside += len(ids) // 4

    found = materialize(_spread(spark, folder).mapInArrow(
        lambda b: _batches(rows(b), names, types),
        "part int, number int, range long, doc_id long, inside long, n_tokens long, ids_crc32 long"), "records-digests")
    # ids before a range: those of the parts before, then of the part's ranges before
    tokens = found.groupBy("part", "number", "range").agg(F.sum("n_tokens").alias("n"))
    upto = Window.partitionBy("part").orderBy("number", "range").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))                       # one row per task
    before = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    starts = (tokens.withColumn("first", F.coalesce(F.sum("n").over(upto), F.lit(0))).join(before, "part")
              .select("part", "number", "range", (F.col("first") + F.col("before")).alias("first")))
    return found.join(starts, ["part", "number", "range"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
