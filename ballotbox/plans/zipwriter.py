"""Bulk archives made from stand-in rows, for the ZIP queries and tests."""

from __future__ import annotations

import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotbox import schemas
from ballotbox.sources.delimited import line_of


def _text(values: pa.Array) -> memoryview:
    """The bytes of an array of texts, one after the other, as Arrow holds them."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(values.type) else np.int32)
    return memoryview(data)[at[values.offset]:at[values.offset + len(values)]]


def write_zip_archives(df: DataFrame, path: str, file_type: str, partial_every: int = 10) -> DataFrame:
    """Write raw rows into ``<ft>_<cycle>-part<partition>.zip`` archives, one per (partition, cycle).

    Each holds the root member with all its rows and a ``by_date/`` partial that
    repeats every ``partial_every``-th row, as bulk archives do. Returns one row
    per archive; an action on it writes them. An archive is written under a name
    of its attempt and moved to its own name when complete, so a retried task
    replaces it. Spark ends the lines and Python hands whole runs of them to the
    archive: it holds no line on its own.
    """
    inner = schemas.INDIV_INNER_FILE if file_type == "indiv" else f"{file_type}.txt"
    lines = (df.select(F.concat(line_of(schemas.column_names(file_type)), F.lit("\n")).alias("value"), "cycle")
             .sortWithinPartitions("cycle"))

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, root = (pafs.FileSystem.from_uri(path) if "://" in path
                    else (pafs.LocalFileSystem(), path.removeprefix("file:")))
        fs.create_dir(root, recursive=True)
        now, done = None, []

        def close():
            cycle, z, stream, body, repeated, n, tmp, final = now
            body.close()
            with z.open(f"by_date/itcont_{cycle}_partial.txt", "w") as extra:
                for text in repeated:
                    extra.write(text)
            z.close()
            stream.close()
            fs.move(f"{root}/{tmp}", f"{root}/{final}")
            done.append((f"{path}/{final}", cycle, n))

        for batch in batches:
            runs, first = pc.run_end_encode(batch.column("cycle")), 0
            for cycle, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if now is None or cycle != now[0]:
                    if now is not None:
                        close()
                    final = f"{file_type}_{cycle}-part{part:05d}.zip"
                    tmp = f"_{final}.{uuid.uuid4().hex}.inprogress"
                    stream = fs.open_output_stream(f"{root}/{tmp}")
                    z = zipfile.ZipFile(stream, "w", compression=zipfile.ZIP_DEFLATED, compresslevel=1)
                    now = [cycle, z, stream, z.open(inner, "w", force_zip64=True), [], 0, tmp, final]
                run = batch.column("value").slice(first, end - first)
                now[3].write(_text(run))
                again = np.arange(-now[5] % partial_every, len(run), partial_every)
                if len(again):
                    now[4].append(bytes(_text(run.take(pa.array(again)))))
                now[5], first = now[5] + len(run), end
        if now is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int32(), pa.int64()))],
                                             names=["archive", "cycle", "n_lines"])

    return lines.mapInArrow(write, "archive string, cycle int, n_lines long")
