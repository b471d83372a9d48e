"""Exact top-k inner products with an impact-ordered index, processed score at a time.

Integer vectors are posted by component: a posting is a vector's place, a component and its value, and its
impact is the quantised size of the value. A block of vectors is indexed once: its postings, zeros left
out, lie in segments of descending impact, by component within a segment, and are written to the shared
scratch folder as one row of the index table. A query processes segment after segment, adding each
posting's exact product to its vector's accumulator. After a segment, what a vector can still gain or lose is
at most |query| * |its unprocessed components| (both known to the index), so every vector has a lower and an
upper bound on its score. A vector is a possible member while its upper bound reaches the k-th largest
lower bound. Processing stops only when that proof leaves few possible members (or no segment is left); those
are rescored exactly.

Equal vectors are indexed once, with their k + 1 smallest ids, which is all that any top k can show of
them, so a vector shared by a third of all rows costs one entry of each posting list. Distinct vectors and
distinct queries are dealt to blocks of bounded size by hash; query blocks are run over index blocks row by row,
neither side is shuffled for it, and only k + 1 rows per query leave a pair of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastro.operators.lookups import salted_join

from ._common import materialise

# Components in a block of the index, and in a block of queries: a few MB each, whatever the vectors' length.
INDEX_CELLS = 1 << 19
QUERY_CELLS = 1 << 17
SEGMENTS = 6
_TILE = 128


def integer_vector(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component (as double); null for a vector that is null or holds a null,
    NaN or infinite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


class ImpactIndex:
    """Postings of one block of integer vectors, in segments of descending impact.

    ``place``, ``component`` and ``value`` are parallel; segment s is ``edges[s]`` to ``edges[s + 1]``, sorted by
    component; ``rest[s]`` is the norm of what each vector has behind it.
    """

    def __init__(self, vectors: np.ndarray, segments: int = SEGMENTS):
        place, component = np.nonzero(vectors)
        value = vectors[place, component]
        size = np.abs(value)
        # Quantised impact: classes end where the shares of postings 1/2, 3/4, 7/8, ... are reached.
        shares = [0.5**s for s in range(1, segments)]
        levels = sorted(set(np.quantile(size, shares, method="lower").tolist()), reverse=True) if size.size else []
        impact = np.searchsorted(-np.array([*levels, -1], np.float64), -size.astype(np.float64), side="right")
        order = np.lexsort((place, component, impact))
        self.place, self.component, self.value = place[order].astype(np.int32), component[order].astype(np.int32), value[order]
        self.edges = np.searchsorted(impact[order], np.arange(len(levels) + 2))
        # From the last segment forwards, so that sums only grow and round by a tiny share.
        square, rest = np.zeros(len(vectors)), []
        for lo, hi in list(zip(self.edges, self.edges[1:], strict=False))[::-1]:
            rest.append(np.sqrt(square))
            np.add.at(square, self.place[lo:hi], self.value[lo:hi].astype(np.float64) ** 2)
        rest.reverse()
        self.rest = np.array(rest).reshape(-1, len(vectors))

    def top(self, vectors: np.ndarray, queries: np.ndarray, k: int, first_ids: np.ndarray):
        """For each query (number, places, scores) of the k best vectors, ties to the smaller first id."""
        n = len(vectors)
        for at in range(0, len(queries), _TILE):
            q = queries[at:at + _TILE].T  # by component, so that a posting meets all queries of the tile at once
            norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=0))[None, :]
            known = np.zeros((n, q.shape[1]), q.dtype)
            possible = np.ones(known.shape, bool)
            for lo, hi, rest in zip(self.edges, self.edges[1:], self.rest, strict=False):
                runs = np.flatnonzero(np.diff(self.component[lo:hi], prepend=-1)) + lo
                for start, end in zip(runs, [*runs[1:], hi], strict=True):
                    # Within a component no place comes twice.
                    known[self.place[start:end]] += self.value[start:end, None].astype(q.dtype) * q[self.component[start]]
                # Rounded outwards, so that the bounds hold whatever the rounding of the roots.
                slack = norm * rest[:, None] * (1 + 1e-6) + 1e-6
                if n > k:
                    floor = np.partition(known - slack, n - k, axis=0)[n - k]
                    possible = known + slack >= floor
                if possible.sum() <= max(8 * k, n // 50) * q.shape[1]:
                    break
            for i in range(q.shape[1]):
                members = np.flatnonzero(possible[:, i])
                exact = vectors[members] @ q[:, i]
                best = np.lexsort((first_ids[members], -exact))[:k]
                yield at + i, members[best], exact[best]


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as a matrix, shorter ones filled up with 0."""
    size = pa.compute.list_value_length(lists).to_numpy().astype(np.int64)
    out = np.zeros((len(lists), dims), np.int64)
    ends = np.cumsum(size)
    row = np.repeat(np.arange(len(lists)), size)
    out[row, np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)] = lists.flatten().to_numpy()
    return out


_INDEX = ("block long, n int, vectors binary, ids array<array<long>>, place binary, component binary, value binary, edges array<long>, rest binary")
_BLOCK = "block long, n int, vectors binary"


def _by_block(rows: DataFrame, blocks: int):
    """``rows`` (w, ...) dealt to blocks by hash, each block's rows together in one task."""
    return rows.withColumn("block", F.pmod(F.xxhash64("w"), F.lit(blocks))).repartition("block").sortWithinPartitions("block")


def _blocks(batches):
    """Batches sorted by their last column -> one batch per block."""
    held = []
    for batch in batches:
        block = batch.column(batch.num_columns - 1).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if held and held[0].column(batch.num_columns - 1)[0].as_py() != block[lo]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.concat_batches(held)


def index_table(classes: DataFrame, dims: int, blocks: int, segments: int = SEGMENTS) -> DataFrame:
    """Classes of equal vectors (w, ids) -> one row per block with its vectors and postings."""

    def run(batches):
        for part in _blocks(b for b in batches if b.num_rows):
            x = _matrix(part.column(0), dims)
            index = ImpactIndex(x, segments)
            yield pa.RecordBatch.from_arrays(
                [part.column(2).slice(0, 1), pa.array([len(x)], pa.int32()), pa.array([x.astype("<i8").tobytes()]),
                 pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), part.column(1)), pa.array([index.place.astype("<i4").tobytes()]),
                 pa.array([index.component.astype("<i4").tobytes()]), pa.array([index.value.astype("<i8").tobytes()]),
                 pa.array([index.edges.tolist()], pa.list_(pa.int64())), pa.array([index.rest.astype("<f8").tobytes()])],
                names=["block", "n", "vectors", "ids", "place", "component", "value", "edges", "rest"])

    return _by_block(classes.select("w", "ids"), blocks).mapInArrow(run, _INDEX)


def _query_table(asked: DataFrame, dims: int, blocks: int) -> DataFrame:
    """Distinct query vectors (w) -> one row per block with all of them."""

    def run(batches):
        for part in _blocks(b for b in batches if b.num_rows):
            x = _matrix(part.column(0), dims)
            yield pa.RecordBatch.from_arrays([part.column(1).slice(0, 1), pa.array([len(x)], pa.int32()), pa.array([x.astype("<i8").tobytes()])],
                                             names=["block", "n", "vectors"])

    return _by_block(asked.select("w"), blocks).mapInArrow(run, _BLOCK)


_PLACES = 32  # bits of a query's place in its block


def _search_pairs(k: int, dims: int):
    """mapInArrow function: pairs of an index block and a query block -> (q, vec_id, score) of the k best."""

    def whole(cell, dtype):
        return np.frombuffer(cell.as_buffer(), dtype)

    def run(batches):
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for row in range(batch.num_rows):
                cell = {name: c[row] for name, c in column.items()}
                x = whole(cell["vectors"], "<i8").reshape(-1, dims)
                q = whole(cell["q_vectors"], "<i8").reshape(-1, dims)
                index = ImpactIndex.__new__(ImpactIndex)
                index.place, index.component, index.value = whole(cell["place"], "<i4"), whole(cell["component"], "<i4"), whole(cell["value"], "<i8")
                index.edges, index.rest = np.array(cell["edges"].as_py()), whole(cell["rest"], "<f8").reshape(-1, len(x))
                # As double where every score fits 53 bits, else as 64-bit integers: products are exact either way.
                largest = max(int(np.abs(x).max(initial=0)), 1) * max(int(np.abs(q).max(initial=0)), 1) * max(dims, 1)
                if largest < 1 << 53:
                    x, q = x.astype(np.float64), q.astype(np.float64)
                ids = cell["ids"].as_py()
                first = np.array([i[0] for i in ids], np.int64)
                base = cell["q_block"].as_py() << _PLACES
                out = []
                for i, at, scores in index.top(x, q, k, first):
                    found = sorted((-int(s), v) for p, s in zip(at.tolist(), scores.tolist(), strict=True) for v in ids[p])[:k]
                    out += [(base + i, v, -s) for s, v in found]
                names, vecs, scores = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (names, vecs, scores)], names=["q", "vec_id", "score"])

    return run


def search(
    vectors: DataFrame, is_query: Column, *, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", factor: int = 256,
    index_cells: int = INDEX_CELLS, query_cells: int = QUERY_CELLS,
) -> DataFrame:
    """For each row with ``is_query``: its k best other rows by integer inner product.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller id, and fewer rows than k give
    fewer results. Rows whose vector is null or holds a null or non-finite component take no part, nor do
    rows with a null id. Vectors of different lengths compare as if filled up with zeros. Rows that
    repeat an id count once each as candidates; "every row but the query's own" goes by id. Scores must
    fit 64 bits. An empty table gives an empty one; extra columns are not read.
    """
    whole = integer_vector(F.col(vector_col), factor)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), whole.alias("w"), F.coalesce(is_query, F.lit(False)).alias("is_query")).where(
        F.col("id").isNotNull() & F.col("w").isNotNull())
    rows = materialise(rows.withColumn("w", _trimmed("w")), "search_rows")
    # Classes of equal vectors. The rank limit is applied before the shuffle too, so a class with a third
    # of all rows sends k + 1 ids per task.
    order = Window.partitionBy("w").orderBy("id")
    classes = materialise(rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).groupBy("w").agg(
        F.sort_array(F.collect_list("id")).alias("ids")), "search_classes")
    asked = materialise(rows.where("is_query").select("w").distinct(), "search_queries")
    n, dims = classes.agg(F.count("*"), F.coalesce(F.max(F.size("w")), F.lit(0))).first()
    m, dims = asked.count(), max(1, dims)
    index = materialise(index_table(classes, dims, max(1, -(-n * dims // index_cells))), "search_index")
    queries = materialise(_query_table(asked, dims, max(1, -(-m * dims // query_cells))), "search_query_blocks")
    # The stated queries against all rows, block by block: every index block meets every query block.
    named = queries.select(F.col("block").alias("q_block"), F.col("vectors").alias("q_vectors"))
    pairs = index.drop("block", "n").join(named.hint("shuffle_replicate_nl"), how="cross")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("q", "vec_id", "score")])
    found = pairs.mapInArrow(_search_pairs(k + 1, dims), schema)
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    merged = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("hits"))
    # Each query's vector again, by its place in its block.
    def places(batches):
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(packed.as_buffer(), "<i8").reshape(-1, dims)
                for lo in range(0, len(x), 256):
                    part = x[lo:lo + 256]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((block << _PLACES) + lo + np.arange(len(part))), pa.array(list(part), pa.list_(pa.int64()))], names=["q", "padded"])

    vector_of = queries.select("block", "vectors").mapInArrow(places, "q long, padded array<long>")
    hits = materialise(merged.join(vector_of, "q").select(_trimmed("padded").alias("v"), "hits").withColumn("h", F.xxhash64("v")), "search_hits")
    own = rows.where("is_query").select("id", F.col("w").alias("u")).withColumn("h", F.xxhash64("u"))
    # By a hash, so that a vector of very many queries is salted; the vectors themselves decide.
    others = salted_join(own, hits, "h", "inner").where("u = v").select(
        "id", F.slice(F.filter("hits", lambda x: x["vec_id"] != F.col("id")), 1, k).alias("hits"))
    return others.select(F.col("id").alias("query_id"), F.posexplode("hits").alias("p", "h")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("h.vec_id").alias("vec_id"), F.col("h.score").alias("score"))


def _trimmed(w: str) -> Column:
    """A vector up to its last component that is not zero: however long it was written, equal ones are equal."""
    last = F.aggregate(F.transform(F.col(w), lambda x, i: F.when(x != 0, i + 1).otherwise(0)), F.lit(0), lambda a, x: F.greatest(a, x))
    return F.slice(w, F.lit(1), last)
