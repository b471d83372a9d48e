"""Document fingerprints: one-permutation MinHash, densified, packed to the low bits of every bin.

A text's five-word shingles are hashed once each. The top bits of a hash choose one of ``bins`` bins, and
every bin keeps its least hash (one permutation instead of one per bin). An empty bin borrows from a full
one by optimal densification: a fixed hash of (bin, attempt) names bins until a full one is met, so two
texts borrow alike where their bins agree and every full bin is equally likely. Of each bin's value,
mixed with the bin's number so that borrowed values stay independent, the low ``bits`` bits are kept.

Two equal values agree in their low bits, two different ones by chance in a share ``2^-bits`` of bins, so
the likeness (Jaccard similarity of the shingle sets) is estimated without bias as
``(agreeing share - 2^-bits) / (1 - 2^-bits)``, cut to 0..1.

Texts with fewer than five words have one shingle, all their words; texts without a word have the shingle
of no words, so they are alike to each other and unlike others.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import materialise, slices

WORDS = 5
BINS = 512
BITS = 4
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_CACHE: dict[bytes, int] = {}
_CACHE_WORDS = 400_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of every word, through a bounded cache."""
    cache = _CACHE
    found = list(map(cache.get, words))
    if None in found:
        digest = xxhash.xxh64_intdigest
        for i, h in enumerate(found):
            if h is None:
                found[i] = cache[words[i]] = digest(words[i])
        if len(cache) > _CACHE_WORDS:
            cache.clear()
    return np.array(found, np.uint64)


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of all word shingles of a whole text, repeats included; one for a short or empty text."""
    h = _word_hashes((text or "").encode().split())
    n = max(1, len(h) - words + 1)
    width = min(words, len(h))
    total = np.full(n, np.uint64(width))
    for k in range(width):
        total = _mix(total + h[k:k + n])
    return total


@lru_cache(maxsize=4)
def _borrow_order(bins: int, attempts: int = 64) -> np.ndarray:
    """For every bin the bins it asks in turn (attempts x bins), from a fixed hash."""
    k = np.arange(attempts, dtype=np.uint64)[:, None] * np.uint64(bins) + np.arange(bins, dtype=np.uint64)
    return (_mix(k + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bins)).astype(np.int64)


def fingerprint(hashes: np.ndarray, bins: int = BINS, bits: int = BITS) -> bytes:
    """The packed fingerprint of a set of shingle hashes (bins * bits / 8 bytes)."""
    shift = np.uint64(64 - int(np.log2(bins)))
    least = np.full(bins, _EMPTY)
    np.minimum.at(least, (hashes >> shift).astype(np.int64), hashes)
    empty = np.flatnonzero(least == _EMPTY)
    if len(empty):
        full = least != _EMPTY
        filled = least.copy()
        for asked in _borrow_order(bins):
            hit = full[asked[empty]]
            filled[empty[hit]] = least[asked[empty[hit]]]
            empty = empty[~hit]
            if not len(empty):
                break
        if len(empty):  # after all attempts: the next full bin, cyclically
            places = np.flatnonzero(full)
            filled[empty] = least[places[np.searchsorted(places, empty) % len(places)]]
        least = filled
    low = (_mix(least + np.arange(bins, dtype=np.uint64) * _M1) & np.uint64(2**bits - 1)).astype(np.uint8)
    return np.packbits((low[:, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1).tobytes()


def likeness(a: bytes, b: bytes, bits: int = BITS) -> float:
    """Estimated Jaccard similarity of two fingerprints, corrected for chance agreement."""
    if a == b:
        return 1.0
    differ = np.unpackbits(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).reshape(-1, bits).any(axis=1)
    chance = 2.0**-bits
    return float(min(1.0, max(0.0, (1 - differ.mean() - chance) / (1 - chance))))


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _row(text: str, own: bytes, following: str, next_print: bytes) -> list:
    changed = edited(text, following)
    changed_print = fingerprint(shingle_hashes(changed))
    return [len(text), hashlib.sha256(changed.encode()).digest(), own, changed_print,
            likeness(own, changed_print), likeness(own, next_print)]


# Hashes stay bytes until the result, which spells them in hex: half the size on disk.
RESULT = [("n_chars", T.LongType()), ("edited_sha256", T.BinaryType()), ("fingerprint", T.BinaryType()),
          ("edited_fingerprint", T.BinaryType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (id and text) plus ``fingerprint`` (lower-case hex) of every whole text; no shuffle.

    Null text counts as empty. Equal texts have equal fingerprints.
    """
    narrow = docs.select(F.col(id_col), F.col(text_col))
    schema = T.StructType([*narrow.schema.fields, T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for batch in batches:
            for start, texts in slices(batch, 1):
                part = batch.slice(start, len(texts))
                prints = [fingerprint(shingle_hashes(t)).hex() for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(prints, pa.string())], names=schema.names)

    return narrow.mapInArrow(run, schema)


def compare_with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (see ``edited``), with their likeness and the
    likeness to the next document, in ascending id order; the first document follows the last.

    The texts are dealt once, by ranges of (id, text hash), and sorted within the tasks; a task sees the
    next document of all its rows but the last. First and last rows of the tasks, a few texts, are
    matched afterwards by task number. Null text counts as empty; a null id sorts first; rows that repeat
    an id are ordered by their text; a single document follows itself; an empty table gives an empty one;
    extra columns are not read.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = (narrow.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie")
             .sortWithinPartitions("id", "tie", "text").select("id", "text"))
    fields = [T.StructField(n, t) for n, t in RESULT]
    schema = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("edge", T.StringType()), narrow.schema["id"],
                           T.StructField("text", T.StringType()), *fields])

    def run(batches):
        task, held, ready = TaskContext.get().partitionId(), None, []
        columns = [pa.field(f.name, t) for f, t in zip(schema.fields, [
            pa.int32(), pa.string(), None, pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()],
            strict=True) if t is not None]

        def out(rows, id_type):
            full = pa.schema([*columns[:2], pa.field("id", id_type), *columns[2:]])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), full, strict=True)], schema=full)

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for start, texts in slices(batch, 1):
                for key, text in zip(batch.column(0).slice(start, len(texts)).to_pylist(), texts, strict=True):
                    own = fingerprint(shingle_hashes(text))
                    if held is None:
                        ready.append([task, "first", key, text, None, None, own, None, None, None])
                    else:
                        ready.append([task, None, held[0], None, *_row(held[1], held[2], text, own)])
                    held = key, text, own
                yield out(ready, id_type)
                ready = []
        if held is not None:
            yield out([[task, "last", held[0], held[1], None, None, held[2], None, None, None]], id_type)

    done = materialise(dealt.mapInArrow(run, schema), "fingerprints")
    names = [n for n, _ in RESULT]
    inner = done.where(F.col("edge").isNull()).select(F.col("id").alias(id_col), *names)
    # One first and one last row per task: the following task's first row closes each task's last.
    tasks = done.where(F.col("edge") == "first").select("task")
    order = Window.orderBy("task")
    following = tasks.select("task", F.coalesce(F.lead("task").over(order), F.min("task").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    last = done.where(F.col("edge") == "last").select("task", "id", "text", "fingerprint")
    first = done.where(F.col("edge") == "first").select(
        F.col("task").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    pairs = last.join(following, "task").join(first, "next").select("id", "text", "fingerprint", "next_text", "next_print")
    edge_schema = T.StructType([narrow.schema["id"], *fields])

    def close(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                _, text, own, following_text, next_print = (c[k].as_py() for c in batch.columns)
                values = _row(text, own, following_text, next_print)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), *(pa.array([v]) for v in values)], names=edge_schema.names)

    both = inner.unionByName(pairs.mapInArrow(close, edge_schema).withColumnRenamed("id", id_col))
    return both.select(id_col, *[F.lower(F.hex(n)).alias(n) if isinstance(t, T.BinaryType) else n for n, t in RESULT])
