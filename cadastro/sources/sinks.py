"""Table sinks and the optional staging layer.

``write_table`` never inspects ``df.rdd`` to decide on partitioning (that plans and, with broadcasts in
the plan, even runs the query once more just to count). Output file count is controlled declaratively:

* ``n_partitions=None`` (default): one file per task of the final stage, as the data comes;
* ``n_partitions=n``: exactly ``n`` partitions by a ``repartition`` (round-robin, or by the ``partition_by``
  columns; a shuffle that keeps the upstream stages fully parallel, unlike ``coalesce``, which would run
  the whole job in ``n`` tasks);
* ``n_partitions=n, shuffle=False`` (for a table read straight from its files): the reading tasks are merged into
  ``n`` where that gives ``n`` evenly filled partitions, so each reads its part of the files and nothing is
  shuffled; elsewhere as above;
* ``rebalance=True`` (the default with ``partition_by``): the ``REBALANCE`` hint (by the ``partition_by``
  columns when given), so AQE cuts evenly sized output partitions and splits a skewed partition value over
  several tasks;
* ``max_records_per_file`` bounds file size whatever the partitioning.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import delete_path, scratch_path

log = logging.getLogger(__name__)

SAVE_MODES = ("append", "overwrite", "ignore", "error", "errorifexists")

# Options that only make sense for text formats; harmless but noisy on parquet/orc.
_TEXT_ONLY_OPTIONS = {"encoding", "sep", "delimiter", "quote", "escape", "header", "lineSep"}

# A merged task may hold this many times its even share of the rows; beyond it the rows are shuffled.
MERGED_SHARE = 1.5


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "error",
    fmt: str | None = None,
    partition_by: str | list[str] | None = None,
    n_partitions: int | None = None,
    rebalance: bool | None = None,
    max_records_per_file: int | None = None,
    shuffle: bool = True,
    **options,
) -> None:
    """Write ``df`` to ``path`` (any Hadoop URI). ``mode``: append, overwrite, ignore, error.

    With ``partition_by`` the rows are rebalanced by those columns unless ``rebalance=False``: otherwise
    every task would write a file into every output folder. ``n_partitions`` and ``rebalance=True``
    exclude each other. ``shuffle=False`` lets ``n_partitions`` merge the tasks that read ``df`` where they fill
    ``n`` evenly (:func:`_merged`, which counts ``df`` once: cheap for a stored table only); with
    ``partition_by`` it changes nothing.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}")
    fmt = fmt or df.sparkSession.conf.get("spark.sql.sources.default", "parquet")
    if fmt in ("parquet", "orc"):
        dropped = sorted(set(options) & _TEXT_ONLY_OPTIONS)
        if dropped:
            log.debug("dropping text-only options %s for %s", dropped, fmt)
        options = {k: v for k, v in options.items() if k not in _TEXT_ONLY_OPTIONS}
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if n_partitions and rebalance:
        raise ValueError("n_partitions and rebalance=True exclude each other")
    if n_partitions:
        merged = None if shuffle or cols else _merged(df, int(n_partitions))
        df = df.repartition(int(n_partitions), *cols) if merged is None else merged
    elif rebalance or (rebalance is None and cols):
        # REBALANCE clusters rows by the partition columns (few files per output folder) and lets AQE
        # split any partition over the advisory size, so one value holding a third of the rows is
        # written by many tasks rather than one.
        df = df.hint("rebalance", *cols) if cols else df.hint("rebalance")
    writer = df.write.format(fmt).mode(mode)
    if options:
        writer = writer.options(**{k: str(v) if isinstance(v, bool) else v for k, v in options.items()})
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if cols:
        writer = writer.partitionBy(*cols)
    writer.save(path)


def _merged(df: DataFrame, n: int) -> DataFrame | None:
    """``df`` in ``n`` partitions without a shuffle, or None if they would not be ``n`` evenly filled ones.

    The rows of each merged task are counted first; no column is needed for it, so a stored parquet or ORC table is
    not read but for its footers.
    """
    merged = df.coalesce(n)
    tasks = merged.groupBy(F.spark_partition_id().alias("task")).count()
    filled, most, rows = tasks.agg(F.count("*"), F.max("count"), F.sum("count")).first()
    return merged if filled == n and most * n <= MERGED_SHARE * rows else None


def write_split(df: DataFrame, path: str, status_col: str, ok: str = "ok", mode: str = "error") -> tuple[DataFrame, DataFrame]:
    """Write ``df`` once, a folder per value of ``status_col``; return (accepted, rejected) frames of what was written.

    One job and no shuffle: every task writes its accepted rows and its rejected ones side by side. The
    accepted frame has the rows with ``ok`` and not the status column; both read only their own folders.
    """
    write_table(df, path, mode=mode, fmt="parquet", partition_by=status_col, rebalance=False)
    schema = StructType([f for f in df.schema.fields if f.name != status_col] + [df.schema[status_col]])
    written = df.sparkSession.read.schema(schema).parquet(path)
    return written.where(F.col(status_col) == ok).drop(status_col), written.where(F.col(status_col) != ok)


# Bits of a column's rank in a clustering key: 2^7 ranges a column.
CLUSTER_BITS = 7


def _number(df: DataFrame, name: str):
    """A column's values as numbers in the same order (text by its first six bytes)."""
    c, kind = F.col("`" + name.replace("`", "``") + "`"), df.schema[name].dataType.typeName()
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if kind in ("string", "varchar", "char"):
        return F.conv(F.rpad(F.hex(F.substr(F.encode(c, "UTF-8"), F.lit(1), F.lit(6))), 12, "0"), 16, 10).cast("double")
    return c.cast("double")


def clustering_key(df: DataFrame, columns: list[str], bits: int = CLUSTER_BITS) -> DataFrame:
    """``df`` plus ``_cluster``: the bits of the columns' ranks, interleaved (a Z-order curve).

    A rank is the range of 2^bits equally filled ones that a value lies in; the ranges come from one
    aggregate of percentile sketches, of which only the bounds reach the driver. Rows near each other on the
    curve are near each other in every column, so each column's ranges in a file are narrow. Null is first.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    bounds = df.agg(*[F.percentile_approx(_number(df, c), shares, 10_000).alias(f"b{j}") for j, c in enumerate(columns)]).first()
    ranks = {}
    for j, c in enumerate(columns):
        cuts, value = sorted(set(bounds[f"b{j}"] or [])), _number(df, c)
        below = F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), _at_most(value))) if cuts else F.lit(0)
        ranks[f"_rank{j}"] = F.when(value.isNull(), 0).otherwise(below)
    ranked = df.withColumns(ranks)
    key = F.lit(0).cast("long")
    for i in range(bits):
        for j in range(len(columns)):
            bit = F.shiftright(F.col(f"_rank{j}"), i).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    return ranked.withColumn("_cluster", key).drop(*ranks)


def _at_most(value):
    return lambda bound: bound <= value


def write_clustered(df: DataFrame, path: str, cluster_by: list[str], *, n_partitions: int | None = None, mode: str = "error",
                    max_records_per_file: int | None = None, **options) -> None:
    """Write ``df`` as parquet so that filters on any of ``cluster_by`` skip most files and row groups.

    Rows are range-partitioned by :func:`clustering_key` (``n_partitions`` files, by default the session's
    shuffle partitions) and sorted by it. A key that holds many rows is cut further by a hash of the row, so a city
    with a third of the rows is written by as many tasks as its share calls for.
    """
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = clustering_key(df, list(cluster_by))
    plain = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema.fields if "map" not in f.dataType.simpleString()]
    spread = keyed.withColumn("_spread", F.xxhash64(*plain)).repartitionByRange(n, "_cluster", "_spread")
    ordered = spread.sortWithinPartitions("_cluster").drop("_cluster", "_spread")
    write_table(ordered, path, mode=mode, fmt="parquet", max_records_per_file=max_records_per_file, **options)


@dataclass
class Stage:
    """A materialised intermediate table below the shared checkpoint folder."""

    spark: SparkSession
    path: str
    fmt: str = "parquet"

    def read(self) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def stage(df: DataFrame, name: str, root: str | None = None, fmt: str = "parquet") -> Stage:
    """Write ``df`` once (always overwrite) to a per-run path and return a handle to re-read it.

    Worth it when a non-splittable or expensive source (gzip text, archives, a wide CSV parse) feeds
    several passes; the staged parquet is splittable, column-pruned and has statistics. The path is
    unique per call, so concurrent runs never remove each other's staging. Drop it with ``Stage.drop``
    after the consumer has been written.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{name}" if root else scratch_path(spark, "staging", name)
    df.write.format(fmt).mode("overwrite").save(path)
    return Stage(spark, path, fmt)
