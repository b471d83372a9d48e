"""Near duplicates by SimHash, found with pivot distance tables.

1. Fingerprints. Every four-word shingle is hashed (XXH64); bit b of a text's fingerprint is set if bit b
   is set in over half of its shingle hashes. Equal fingerprints are one row from here on, however many
   documents share one.
2. Pivot tables. Each distinct fingerprint's Hamming distances to many fixed reference fingerprints are
   computed once and stored with it. As |d(a, p) - d(b, p)| <= d(a, b), a pair whose coordinates differ by
   more than ``max_distance`` anywhere is discarded; only survivors are verified on their bits.
3. Candidates. The 64 bits are cut into ``blocks`` blocks. Two fingerprints that differ in at most
   ``max_distance`` bits agree in at least ``blocks - max_distance`` whole blocks, so every linked pair
   meets in a bucket keyed by one choice of that many blocks: no link can be missed. ``blocks`` (6: 15 keys
   of 21 bits) trades keys for smaller buckets: 7 gives 35 keys of 27 bits, 8 gives 70 of 32.
   A bucket is sorted by the first coordinate of its members' tables, so a large one is searched along it
   in a window.
4. Links leave a task as a spanning forest (each member with the smallest of its local group), never as
   all pairs. Buckets with more than ``bucket_rows`` members are dealt to several tasks as pairs of
   chunks, all chunk pairs covered, so a hot bucket is neither cut nor left to one task.
5. Components come from alternating large-star and small-star rounds on the remaining links, each round
   written to the shared scratch folder. Fingerprints are the nodes, so ids may be null or repeat.
6. Dropping copies moves no text but a few: the rows to drop are known by (id, text hash), and two bitmaps
   of bounded size tell, where the texts lie, which rows stay, which go, and which few need an exact join.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastro.operators.lookups import HOT_SHARE, salted_join

from ._common import append_columns, discard, fresh, in_filter, key_filter, materialise

SEED = 42
WORDS = 4
MAX_DISTANCE = 4
BLOCKS = 6
PIVOTS = 32
_TILE = 1024


def simhash(text: str | None, words: int = WORDS) -> int:
    """The fingerprint of a whole text as a signed 64-bit integer; 0 if it has no word."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[len(ends) - n:].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n)
    return int(np.frombuffer(bits.tobytes(), ">i8")[0])


def with_simhash(docs: DataFrame, *, text_col: str = "text", out: str = "simhash", words: int = WORDS) -> DataFrame:
    """``docs`` plus the fingerprint of every whole text (signed 64-bit); null text has fingerprint 0."""

    def make():
        return lambda texts: [pa.array([simhash(t, words) for t in texts], pa.int64())]

    return append_columns(docs, make, [(out, T.LongType())], text_col)


def pivots(n: int = PIVOTS, seed: int = 7) -> np.ndarray:
    """The reference fingerprints."""
    return np.random.default_rng(seed).integers(0, 1 << 64, n, np.uint64)


def block_masks(blocks: int, max_distance: int) -> list[int]:
    """Bit masks of every choice of ``blocks - max_distance`` blocks, as signed 64-bit integers."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    single = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    masks = [sum(c) for c in combinations(single, blocks - max_distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _linked(bits: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_distance: int) -> np.ndarray:
    """Which of the candidate pairs (a[i], b[i]) are linked: pivot filter first, then the bits."""
    left = np.arange(len(a))
    for k in range(0, table.shape[1], 8):  # coordinates in groups: most pairs fall out after the first
        gap = np.abs(table[a[left], k:k + 8].astype(np.int16) - table[b[left], k:k + 8])
        left = left[gap.max(axis=1) <= max_distance]
        if not len(left):
            return left
    return left[np.bitwise_count(bits[a[left]] ^ bits[b[left]]) <= max_distance]


def _run_links(bits: np.ndarray, table: np.ndarray, lo: int, hi: int, side: np.ndarray, max_distance: int):
    """Links among members lo..hi of one large bucket, tile by tile."""
    # Sorted by the first coordinate, members further apart in it than the limit cannot be linked.
    order = lo + np.argsort(table[lo:hi, 0], kind="stable")
    first = table[order, 0].astype(np.int64)
    across = bool((side[lo:hi] >= 0).any())
    for i in range(0, len(order), _TILE):
        rows = order[i:i + _TILE]
        stop = np.searchsorted(first, first[min(i + _TILE, len(order)) - 1] + max_distance, side="right")
        for j in range(i, stop, _TILE):
            cols = order[j:min(j + _TILE, stop)]
            near = np.abs(first[i:i + _TILE, None] - first[None, j:j + len(cols)]) <= max_distance
            if across:
                near &= side[rows][:, None] != side[cols][None, :]
            if i == j:
                near = np.triu(near, 1)
            x, y = np.nonzero(near)
            a, b = rows[x], cols[y]
            keep = _linked(bits, table, a, b, max_distance)
            if len(keep):  # a tile's links shrink to a star per group before the next tile
                members, at = np.unique(np.concatenate([a[keep], b[keep]]), return_inverse=True)
                label = _smallest(len(members), at[:len(keep)], at[len(keep):], members)
                yield members[label < members], label[label < members]


def _smallest(n: int, a: np.ndarray, b: np.ndarray, name: np.ndarray) -> np.ndarray:
    """The smallest name reachable from each of n members over the links (a, b)."""
    label = name.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        if (new == label).all():
            return label
        label = new


def _bucket_links(max_distance: int):
    """mapInArrow function: rows (key parts, side, bits, table) sorted by key and first coordinate -> links."""

    def solve(keys: np.ndarray, side: np.ndarray, signed: np.ndarray, table: np.ndarray):
        bits = signed.view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        run = np.repeat(np.arange(len(starts)), sizes)
        found_a, found_b = [], []
        small = sizes[run] <= 64
        for gap in range(1, int(min(64, sizes.max()))):
            a = np.flatnonzero(small[:-gap] & (run[:-gap] == run[gap:]))
            if not len(a):
                break
            keep = _linked(bits, table, a, a + gap, max_distance)
            found_a.append(a[keep])
            found_b.append(a[keep] + gap)
        for r in np.flatnonzero(sizes > 64):
            for a, b in _run_links(bits, table, starts[r], starts[r] + sizes[r], side, max_distance):
                found_a.append(a)
                found_b.append(b)
        if not found_a:
            return None
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        label = _smallest(len(signed), a, b, signed)
        hit = label < signed
        pairs = np.unique(np.stack([signed[hit], label[hit]], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:6]]
            stored = batch.column(6).cast(pa.large_binary())
            ends = np.frombuffer(stored.buffers()[1], np.int64)[stored.offset:stored.offset + batch.num_rows + 1]
            table = np.frombuffer(stored.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(batch.num_rows, -1)
            cols = [np.stack(cols[:4], axis=1), *cols[4:], table]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            keys = cols[0]
            # The last bucket may go on in the next batch.
            cut = len(keys) - int(np.argmax((keys[::-1] != keys[-1]).any(axis=1))) if (keys != keys[-1]).any() else 0
            held = [c[cut:] for c in cols]
            if cut:
                out = solve(*(c[:cut] for c in cols))
                if out is not None and out.num_rows:
                    yield out
        if held is not None and len(held[0]) > 1:
            out = solve(*held)
            if out is not None and out.num_rows:
                yield out

    return run


def with_pivots(prints: DataFrame, n_pivots: int = PIVOTS) -> DataFrame:
    """``prints`` (bits) plus its pivot table: a byte for the distance to each reference fingerprint."""

    def run(batches):
        reference = pivots(n_pivots)
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            table = np.bitwise_count(bits[:, None] ^ reference[None, :]).astype(np.uint8)
            stored = pa.FixedSizeBinaryArray.from_buffers(pa.binary(n_pivots), len(table), [None, pa.py_buffer(table.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), stored.cast(pa.binary())], names=["bits", "pivots"])

    return prints.select("bits").mapInArrow(run, "bits long, pivots binary")


def near_links(prints: DataFrame, *, max_distance: int = MAX_DISTANCE, blocks: int = BLOCKS, n_pivots: int = PIVOTS,
               bucket_rows: int = 4096) -> DataFrame:
    """Links (u, v) with u > v, as signed integers, that connect exactly the groups of ``prints`` (bits, distinct)."""
    masks = block_masks(blocks, max_distance)
    stored = materialise(with_pivots(prints, n_pivots), "simhash_pivots")
    keyed = stored.select(
        "bits", "pivots", F.explode(F.array(*[F.struct(F.lit(k).alias("choice"), F.col("bits").bitwiseAND(F.lit(m)).alias("key"))
                                              for k, m in enumerate(masks)])).alias("b")).select("b.choice", "b.key", "bits", "pivots")
    # Large buckets only: each member goes to chunk c and meets every chunk once, as (c, j) or (j, c).
    chunk_rows = bucket_rows // 2
    hot = materialise(keyed.groupBy("choice", "key").count().where(F.col("count") > bucket_rows)
                      .withColumn("chunks", F.ceil(F.col("count") / chunk_rows).cast("int")).drop("count"), "simhash_hot")
    joined = keyed.join(hot, ["choice", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunk = F.pmod(F.xxhash64("bits"), F.col("chunks")).cast("int")
    dealt = joined.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "choice", "key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        # Members of two different chunks are compared across them only; -1: all with all.
        F.when(F.col("chunk") == F.col("other"), -1).otherwise(F.col("chunk")).alias("side"), "bits", "pivots")
    grouped = dealt.repartition("choice", "key", "low", "high").sortWithinPartitions("choice", "key", "low", "high", "pivots")
    links = grouped.mapInArrow(_bucket_links(max_distance), "u long, v long")
    return links.distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over the links (u, v), for every id in a link.

    Alternating large-star and small-star rounds until nothing changes. An id with more than a 256th of the
    links is measured in each round, and its side of the join is salted over several tasks.
    """
    edges = materialise(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "component_edges")
    mark = _mark(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialise(_with_least(both, 2 * mark[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                            "component_edges")
        small = _with_least(large, large.count()).select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select(
            "e.u", "e.v").where("u <> v").distinct()
        old = edges
        edges, before = materialise(small, "component_edges"), mark
        mark = _mark(edges)
        discard(old, large)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """``edges`` (u, v) plus m, the least of u and all its v."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    hot = {r["u"]: -(-r["n"] * HOT_SHARE // total) for r in least.where(F.col("n") * HOT_SHARE > total).select("u", "n").collect()}
    return salted_join(edges, least.select("u", "m"), "u", "inner", hot)


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge sets: their count, and the sum and xor of the edges' hashes."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h % (1 << 31))).first())


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int, max_distance: int) -> DataFrame:
    """A row per row of ``docs``: id, h (the text's hash), bits and first, the component's first document
    (smallest id, null last, then h) as a struct (nameless, id, h)."""
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    marked = materialise(with_simhash(narrow, out="bits", words=words).drop("text"), "simhash")
    prints = materialise(marked.groupBy("bits").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "h")).alias("first")),
                         "simhash_prints")
    groups = materialise(components(near_links(prints, max_distance=max_distance)), "simhash_groups")
    # Fingerprints without a link are components of their own.
    known = prints.join(groups.withColumnRenamed("id", "bits"), "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    known = materialise(known, "simhash_components")
    firsts = known.groupBy("component").agg(F.min("first").alias("first"))
    classes = materialise(salted_join(known.select("bits", "component"), firsts, "component", "inner").drop("component"), "simhash_classes")
    discard(prints, groups, known)
    return salted_join(marked, classes, "bits", "inner")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """Per row of ``docs``: id, fingerprint (16 lower-case hex digits) and component_id.

    Texts of a component are chained by links of at most ``max_distance`` differing bits; its id is its
    smallest document id. Null text and text without a word have fingerprint zero and are linked like any
    other. Repeated rows each get their row, and unlike texts that share an id stay apart; a component of
    null ids has a null id; an empty table gives an empty one; extra columns are not read. Ids are integers.
    """
    return _classes(docs, id_col, text_col, words, max_distance).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), F.col("first.id").alias("component_id"))


# Bits per row to drop, and the most bits a filter has (64 MiB).
_FILTER_SHARE, MAX_FILTER_BITS = 16, 29


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                         max_distance: int = MAX_DISTANCE, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """Rows of ``docs`` (same columns), exactly one for each component: that of the smallest document id,
    null ids last, and of the smallest text hash among unlike texts with one id. Of rows with one id and one text
    the one whose columns have the smallest hash stays.

    Texts stay where they are. The rows to drop are worked out on (id, text hash) alone and put into a
    bitmap; a second bitmap holds the rows to keep that hit the first by chance. A row outside the first stays, a
    row inside the first and outside the second goes, and only the rows inside both are joined with the
    exact list. With more rows to drop than the bitmaps' bound (33 million for 64 MiB) more rows take that
    join; the result is the same.
    """
    spark, key = docs.sparkSession, ["id", "h"]
    rows = _classes(docs, id_col, text_col, words, max_distance)
    decided = materialise(rows.select(*key, F.xxhash64(*key).alias("k"), (
        F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h"))).alias("keep")), "simhash_decided")
    again = materialise(decided.where("keep").groupBy("k", *key).count().where("count > 1").select("k"), "simhash_again")
    dropped = decided.where("not keep").select("k")
    bits = min(max_filter_bits, max(16, (dropped.count() * _FILTER_SHARE).bit_length()))
    first = spark.sparkContext.broadcast(key_filter(dropped.union(again), bits))

    def where(test):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(test(batch.column(batch.num_columns - 1).to_numpy().view(np.uint64))))
        return run

    chance = decided.where("keep").select("k").mapInArrow(where(lambda k: in_filter(first.value, k)), "k long")
    second = spark.sparkContext.broadcast(key_filter(chance.union(again), bits))

    def doubtful(k):
        return in_filter(first.value, k) & in_filter(second.value, k)

    i, h, k = (fresh(f"_{n}", docs) for n in ("id", "hash", "key"))
    named = docs.withColumns({i: F.col(id_col).cast("long"), h: F.xxhash64(text_col)}).withColumn(k, F.xxhash64(i, h))
    certain = named.mapInArrow(where(lambda x: ~in_filter(first.value, x)), named.schema)
    doubt = named.mapInArrow(where(doubtful), named.schema)
    kept = decided.where("keep").select(*key, "k").mapInArrow(where(doubtful), "id long, h long, k long").distinct()
    content = Window.partitionBy(i, h).orderBy(F.xxhash64(*docs.columns))
    once = fresh("_rank", named)
    single = doubt.withColumn(once, F.row_number().over(content)).where(F.col(once) == 1)
    exact = single.join(kept.hint("merge"), single[i].eqNullSafe(kept["id"]) & (single[h] == kept["h"]), "left_semi")
    return certain.select(docs.columns).unionByName(exact.select(docs.columns))
