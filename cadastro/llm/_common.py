"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastro.operators.lookups import broadcast_max_bytes, profile_dimensions, salted_join
from cadastro.session import delete_path, scratch_path

# Rows that a task turns into Python objects at once: a batch is cut by rows and by characters.
SLICE_ROWS = 256
SLICE_CHARS = 1 << 20


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder (``spark.checkpoint.dir``) and read it back.

    Cuts the lineage with a table every executor can read again, so a lost executor costs only its
    running tasks, and work feeding several consumers is done once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cadastro_scratch = path
    return out


def materialise_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``materialise``, in buckets of ``key``: a join on ``key`` then reads the table where it lies.

    The number of buckets is that of shuffle partitions, so the other side of the join is dealt alike. The
    files belong to the scratch folder; the session's catalog only names them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    table_name = f"cadastro_{name}_{path.rsplit('/', 1)[1]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table_name)
    return spark.table(table_name)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that no later plan reads."""
    for df in tables:
        delete_path(df.sparkSession, df._cadastro_scratch)


_CHUNK = 1 << 16


def key_filter(keys: DataFrame, filter_bits: int) -> np.ndarray:
    """A bitmap with a bit set for each 64-bit hash of ``keys`` (one column): packed in the tasks, and of
    2^filter_bits bits on the driver whatever the size of the table."""
    slots = keys.select(F.shiftrightunsigned(keys.columns[0], 64 - filter_bits).alias("slot"))

    def run(batches):
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(1).to_numpy()
            for c in np.unique(slot // _CHUNK).tolist():
                bits = chunks.setdefault(c, np.zeros(_CHUNK, np.uint8))
                bits[slot[slot // _CHUNK == c] % _CHUNK] = 1
        for c, bits in chunks.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()])], names=["chunk", "bits"])

    packed = slots.select(F.expr(f"slot div {_CHUNK}").alias("c"), "slot").repartition("c").sortWithinPartitions("c")
    out = np.zeros((1 << filter_bits) // 8, np.uint8)
    for row in packed.mapInArrow(run, "chunk long, bits binary").toLocalIterator():
        at = row["chunk"] * _CHUNK // 8
        part = np.frombuffer(bytes(row["bits"]), np.uint8)[:len(out) - at]
        out[at:at + len(part)] |= part
    return out


def in_filter(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (unsigned 64-bit) have their bit set: all that were put in, and a few others by chance."""
    slot = hashes >> np.uint64(64 - (len(bitmap) * 8).bit_length() + 1)
    return (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def checked_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``fact`` joined with ``dim`` on ``key``: by a broadcast if a bound of ``dim``'s measured size allows
    it, else by a shuffle in which the hot keys of ``fact`` are salted. Keys of ``dim`` need not be unique.

    Both sides are read more than once; they should be tables or cheap to read.
    """
    profile = profile_dimensions({key: (dim, key)})[key]
    if profile.broadcastable(broadcast_max_bytes(dim.sparkSession)):
        return fact.join(F.broadcast(dim), key, how)
    return salted_join(fact, dim, key, how)


def byte_parts(data: bytes, breaks: re.Pattern, size: int = 1 << 20) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes, cut only before a byte that matches ``breaks``."""
    start = 0
    while len(data) - start > size:
        cut = breaks.search(data, start + size)
        if cut is None:
            break
        yield data[start:cut.start()]
        start = cut.start()
    yield data[start:] if start else data


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less every column whose name equals one of ``names`` ignoring case (output names win)."""
    low = {n.lower() for n in names}
    return df.select(*[_col(c) for c in df.columns if c.lower() not in low])


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores appended until no column of ``df`` has it (ignoring case)."""
    low = {c.lower() for c in df.columns}
    while name.lower() in low:
        name += "_"
    return name


def _col(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def slices(batch: pa.RecordBatch, text_index: int) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) for pieces of a batch with few rows and characters, so lists stay small."""
    column = batch.column(text_index)
    start = 0
    while start < batch.num_rows:
        texts = column.slice(start, SLICE_ROWS).to_pylist()
        total, n = 0, 0
        for text in texts:
            total += len(text or "")
            n += 1
            if total >= SLICE_CHARS:
                break
        yield start, texts[:n]
        start += n


def append_columns(
    df: DataFrame,
    make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
    fields: list[tuple[str, T.DataType]],
    text_col: str = "text",
) -> DataFrame:
    """``df`` plus columns computed from its text column, Arrow batch by Arrow batch.

    ``make()`` runs once per task and returns ``texts -> [array per field]``. Columns of ``df`` with a
    field's name (ignoring case) are replaced. No shuffle; every other column passes through untouched.
    """
    base = without(df, [n for n, _ in fields])
    text_index = [c.lower() for c in base.columns].index(text_col.lower())
    schema = T.StructType(base.schema.fields + [T.StructField(n, t) for n, t in fields])
    names = schema.names

    def run(batches):
        compute = make()
        for batch in batches:
            for start, texts in slices(batch, text_index):
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(part.columns + compute(texts), names=names)

    return base.mapInArrow(run, schema)


# Rows and bytes of an Arrow batch between Spark and a Python worker. The defaults (10,000 rows, 64 MB) hold
# tens of MB of texts at once, in the executor and in the worker, for every running task.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch limits to ``BATCH_CONF``: texts are large rows."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, in a session with batch limits fit for texts."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
