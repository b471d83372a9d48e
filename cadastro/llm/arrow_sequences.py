"""Token ids as Arrow files of equal-length sequences with masks, readable without copying.

Layout of an output folder (one shard per task, shards in document order):

* ``shard-00012.sequences.arrow``: Arrow IPC file; every record batch holds ``batch_sequences`` rows of
  ``ids`` (fixed-size list of ``seq_len`` unsigned ints, two bytes where the vocabulary fits, else four)
  and ``mask`` (fixed-size list of ``seq_len`` booleans, a bit each: true for an id, false for padding). The
  values of a batch are one flat buffer, so sequence ``s`` of a memory-mapped file is a numpy view at row
  ``s % batch_sequences`` of batch ``s // batch_sequences``: nothing is parsed or copied.
* ``shard-00012.documents.arrow``: Arrow IPC file with the documents of the shard in order: id, ``start``
  (ids of the shard before it) and ``n_tokens``.
* ``manifest``: Parquet table with one row per shard: file names, counts and the shard's first position.

Ids of a shard run on from document to document across sequences; only a shard's last sequence is
padded. Batches are uncompressed, as compression would rule out views.

A task writes its files under a name of its own and renames them when complete. A task that runs again
after a lost executor writes the same bytes and replaces them, so readers never see half a file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import slices
from .tokens import encoder

MANIFEST = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("sequences_file", T.StringType()),
    T.StructField("documents_file", T.StringType()), T.StructField("n_documents", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("n_sequences", T.LongType()),
])


def open_folder(uri: str):
    """(file system, path) of a folder: any scheme pyarrow knows (local, hdfs, s3, gs, abfs)."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class _Target:
    """An Arrow IPC file that appears under its name only when complete."""

    def __init__(self, folder: str, name: str, schema: pa.Schema):
        self.files, root = open_folder(folder)
        self.files.create_dir(root, recursive=True)
        self.final, self.part = f"{root}/{name}", f"{root}/.{name}.{TaskContext.get().taskAttemptId()}"
        self.stream = self.files.open_output_stream(self.part)
        self.writer = pa.ipc.new_file(self.stream, schema)

    def commit(self) -> None:
        self.writer.close()
        self.stream.close()
        self.files.move(self.part, self.final)


def _sequence_schema(dtype: np.dtype, seq_len: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("item", pa.from_numpy_dtype(dtype)), seq_len)),
                      ("mask", pa.list_(pa.field("item", pa.bool_()), seq_len))])


class _ShardWriter:
    def __init__(self, folder: str, shard: int, dtype: np.dtype, seq_len: int, batch_sequences: int, id_type: pa.DataType):
        self.seq_len, self.room, self.dtype = seq_len, seq_len * batch_sequences, dtype
        self.names = f"shard-{shard:05d}.sequences.arrow", f"shard-{shard:05d}.documents.arrow"
        self.seq_schema = _sequence_schema(dtype, seq_len)
        self.doc_schema = pa.schema([("id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.seqs = _Target(folder, self.names[0], self.seq_schema)
        self.docs = _Target(folder, self.names[1], self.doc_schema)
        self.buffer, self.filled = np.zeros(self.room, dtype), 0
        self.n_documents = self.n_tokens = self.n_sequences = 0

    def add(self, doc_ids: pa.Array, encoded: list[np.ndarray]) -> None:
        lengths = np.array([len(x) for x in encoded], np.int64)
        starts = self.n_tokens + np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        self.docs.writer.write_batch(pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(starts), pa.array(lengths)], schema=self.doc_schema))
        self.n_documents += len(encoded)
        self.n_tokens += int(lengths.sum())
        for ids in encoded:
            while len(ids):
                taken = min(len(ids), self.room - self.filled)
                self.buffer[self.filled:self.filled + taken] = ids[:taken]
                self.filled += taken
                ids = ids[taken:]
                if self.filled == self.room:
                    self._flush()

    def _flush(self) -> None:
        rows = -(-self.filled // self.seq_len)
        values = self.buffer[:rows * self.seq_len]
        mask = np.ones(len(values), bool)
        values[self.filled:], mask[self.filled:] = 0, False
        self.seqs.writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (values, mask)], schema=self.seq_schema))
        self.n_sequences += rows
        self.filled = 0

    def commit(self) -> None:
        if self.filled:
            self._flush()
        self.docs.commit()
        self.seqs.commit()


def write_sequences(
    docs: DataFrame,
    folder: str,
    tokenizer_json: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    seq_len: int = 2048,
    batch_sequences: int = 64,
) -> DataFrame:
    """Encode whole texts in id order into ``folder``; returns the manifest (one row per shard).

    Documents are dealt to shards by ranges of (id, text hash): a range sort spreads any input evenly
    and rows repeating one id are ordered by their text, so reruns write the same files. One shuffle
    moves the texts; encoding and writing happen in the same task. A task holds one batch of sequences
    and at most a few hundred texts. Null text counts as empty (only the end id); a null id sorts first;
    repeated rows are written as often as they come; an empty table gives an empty manifest. Extra
    columns are not read.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(tokenizer_json)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    dealt = (narrow.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie")
             .sortWithinPartitions("id", "tie", "text").select("id", "text"))

    def run(batches):
        writer, shard = None, TaskContext.get().partitionId()
        encode = encoder(shipped.value)
        end = np.array([end_id], encode.dtype).tobytes()
        for batch in batches:
            if writer is None and batch.num_rows:
                writer = _ShardWriter(folder, shard, encode.dtype, seq_len, batch_sequences, batch.column(0).type)
            for start, texts in slices(batch, 1):
                writer.add(batch.column(0).slice(start, len(texts)),
                           [np.frombuffer(encode.encode(t) + end, encode.dtype) for t in texts])
        if writer is not None:
            writer.commit()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "sequences_file": [writer.names[0]], "documents_file": [writer.names[1]],
                "n_documents": [writer.n_documents], "n_tokens": [writer.n_tokens], "n_sequences": [writer.n_sequences]})

    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of a folder plus ``first_token``: ids in all shards before this one."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def open_arrow(folder: str, name: str) -> pa.ipc.RecordBatchFileReader:
    """A file of the folder, memory-mapped where it is local."""
    files, root = open_folder(folder)
    path = f"{root}/{name}"
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(path))


class SequenceReader:
    """Random access to the sequences and the id stream of one shard."""

    def __init__(self, folder: str, name: str):
        self.file = open_arrow(folder, name)
        self.seq_len = self.file.schema.field("ids").type.list_size
        self.batch_sequences = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1
        self.held: tuple[int, np.ndarray, pa.BooleanArray] = (-1, np.empty(0), pa.array([], pa.bool_()))

    def _batch(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if self.held[0] != k:
            batch = self.file.get_batch(k)
            self.held = (k, batch.column(0).flatten().to_numpy(zero_copy_only=True), batch.column(1).flatten())
        return self.held[1:]

    def sequence(self, s: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """(ids, mask) of sequence ``s`` as views of the file."""
        ids, mask = self._batch(s // self.batch_sequences)
        at = s % self.batch_sequences * self.seq_len
        return ids[at:at + self.seq_len], mask.slice(at, self.seq_len)

    def stream(self, start: int, length: int):
        """Views that make up ids ``start`` to ``start + length`` of the shard, batch by batch."""
        room = self.seq_len * self.batch_sequences
        while length > 0:
            ids, mask = self._batch(start // room)
            at = start % room
            taken = min(length, room - at)
            if mask.slice(at, taken).true_count != taken:
                raise ValueError("a document reaches into padding: the shard is damaged")
            yield ids[at:at + taken]
            start, length = start + taken, length - taken


def read_documents(spark: SparkSession, folder: str, *, id_col: str = "doc_id", id_type: T.DataType | None = None) -> DataFrame:
    """Every document of the folder, from its files: id, shard, start (over all shards), n_tokens, ids_crc32.

    One task per shard; a task holds one record batch of the file at a time.
    """
    manifest = read_manifest(spark, folder)
    schema = T.StructType([
        T.StructField(id_col, id_type or T.LongType()), T.StructField("shard", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").count()

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reader = SequenceReader(folder, row["sequences_file"])
                documents = open_arrow(folder, row["documents_file"])
                for k in range(documents.num_record_batches):
                    part = documents.get_batch(k)
                    sums = []
                    for start, length in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                        crc = 0
                        for view in reader.stream(start, length):
                            crc = zlib.crc32(view.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    starts = pa.array(part.column(1).to_numpy() + row["first_token"])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array([row["shard"]] * part.num_rows, pa.int32()), starts, part.column(2),
                         pa.array(sums, pa.int64())], names=schema.names)

    return manifest.repartition(max(1, shards)).mapInArrow(run, schema)
