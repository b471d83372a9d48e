"""Zip archives as a Spark job: list archives -> deal members to tasks -> stream lines.

One path for archives of any size: the archive list comes from ``binaryFile`` without content, each zip's
directory is read once a task, and every member (one deflate stream, so one task) is opened by its directory
entry and streamed line by line in bounded batches. Neither an archive nor a member is ever held whole.
The lines can be parsed with ``from_csv`` or staged as parquet.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import groupby, islice

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES_SCHEMA = "archive string, member string, line_number long, line string"
MEMBERS_SCHEMA = "archive string, entry int, member string, size long"
# Bytes of members dealt to a task, and tasks per slot at least, so unequal members even out.
TASK_BYTES = 128 << 20


def _lines(text: io.TextIOWrapper):
    """Lines split on '\\n', '\\r\\n' or '\\r' (as Hadoop's line reader does), terminators removed."""
    for line in text:
        if line.endswith("\r\n"):
            yield line[:-2]
        elif line.endswith("\n") or line.endswith("\r"):
            yield line[:-1]
        else:
            yield line


def _open_storage(uri: str):
    """(pyarrow filesystem, path inside it) for a Spark file URI."""
    from pyarrow import fs as pafs

    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def _list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            filesystem, inner = _open_storage(path)
            with filesystem.open_input_file(inner) as fh, zipfile.ZipFile(fh) as zf:  # reads the directory only
                rows = [(path, k, i.filename, i.file_size) for k, i in enumerate(zf.infolist()) if not i.is_dir()]
            yield pd.DataFrame(rows, columns=["archive", "entry", "member", "size"])


def _stream_members(encoding: str, batch_rows: int):
    """mapInPandas function: (archive, entry) sorted -> lines. An archive is opened, and its directory read, once."""
    def lines_of(members):
        for archive, entries in groupby(members, key=lambda m: m[0]):
            filesystem, inner = _open_storage(archive)
            with filesystem.open_input_file(inner) as fh, zipfile.ZipFile(fh) as zf:
                directory = zf.infolist()
                for _, entry in entries:  # by entry: two members may share a name
                    with zf.open(directory[entry]) as raw:
                        for n, line in enumerate(_lines(io.TextIOWrapper(raw, encoding=encoding, newline=""))):
                            yield archive, directory[entry].filename, n, line

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines = lines_of(m for batch in batches for m in zip(batch["archive"], batch["entry"]))
        while held := list(islice(lines, batch_rows)):
            yield pd.DataFrame(held, columns=["archive", "member", "line_number", "line"])

    return run


def list_members(spark: SparkSession, path: str) -> DataFrame:
    """One row per member of the archives at ``path``: archive, entry (place in the directory), member, size."""
    return spark.read.format("binaryFile").load(path).select("path").mapInPandas(_list_members, MEMBERS_SCHEMA)


def expand_archives(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", batch_rows: int = 20_000) -> DataFrame:
    """Every text line of every member of the zip archives at ``path`` (a glob or folder).

    Columns: ``archive`` (path), ``member`` (name inside), ``line_number`` (0-based), ``line``. Members of
    one name in one archive are both read. Members are dealt round-robin to a number of tasks set from their
    count and bytes (several a slot), so large members rarely meet in one task. ``pyarrow`` must
    reach the storage from the executors (local/NFS, S3, GCS, HDFS with libhdfs); if not, this raises.
    """
    members = list_members(spark, path)
    count, size = members.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(1, min(count, max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))))
    # Round-robin, and an explicit count is never coalesced; sorted, so that a task opens each archive once.
    spread = members.repartition(tasks).sortWithinPartitions("archive", "entry")
    return spread.mapInPandas(_stream_members(encoding, batch_rows), LINES_SCHEMA)


def lines_to_columns(lines: DataFrame, columns, sep: str = ";", line_col: str = "line", **options) -> DataFrame:
    """Parse delimited lines into string columns with ``from_csv`` (JVM-side, no Python)."""
    from ..sources.delimited import ddl_schema

    opts = {"sep": sep, "escape": '"', **options}
    parsed = F.from_csv(F.col(line_col), ddl_schema(columns), opts).alias("_rec")
    return lines.select(parsed).select("_rec.*")


def write_archives(df: DataFrame, root: str, name_col: str, text_col: str, encoding: str = "ISO-8859-1",
                   prefix: str = "part") -> DataFrame:
    """Fixture writer: each task writes one zip under ``root`` with a member ``<name>`` per row.

    Uses ``pyarrow.fs`` so ``root`` may be a local path or any URI pyarrow can open (shared storage);
    returns a frame of the archives written (one row per task that had rows). The archive is named after
    the task's partition and renamed into place when complete, so a task that runs again replaces it.
    Characters outside ``encoding`` are an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context, n = TaskContext.get(), 0
        filesystem, base = _open_storage(root)
        target = f"{base.rstrip('/')}/{prefix}-{context.partitionId():05d}.zip"
        part = f"{target}.{context.taskAttemptId()}.tmp"
        filesystem.create_dir(base, recursive=True)
        with filesystem.open_output_stream(part) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
            for batch in batches:
                for name, text in zip(batch[name_col], batch[text_col]):
                    zf.writestr(str(name), (text or "").encode(encoding))
                    n += 1
        if n == 0:
            filesystem.delete_file(part)
            return
        filesystem.move(part, target)
        yield pd.DataFrame({"archive": [target], "members": [n]})

    return df.select(name_col, text_col).mapInPandas(run, "archive string, members long")
