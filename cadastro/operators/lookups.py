"""Checked lookup joins: left, inner, role-playing and star-shaped, against small code tables.

Every lookup goes through :func:`profile_dimensions` first: one aggregate job over the dimension
tables (never over the fact table) that returns, per dimension, its row count, the largest number of
rows sharing one key and an upper bound of its size in bytes. From that:

* a duplicate key is rejected (it would silently multiply fact rows);
* the dimension is broadcast only when an upper bound of its size in memory is under
  ``spark.cadastro.broadcastMaxBytes`` (default 64 MiB); a forced broadcast above the bound is an error.
  Above it the join is a *salted* shuffle join. The keys that hold more than a 256th of the fact rows are
  measured (one partial aggregate over the key column alone, at most 255 of them); only their rows get a
  salt, from a hash of the row, over as many buckets as their share calls for, and only their dimension
  rows are replicated. A key with a third of all rows (one big city, one legal nature) is thus spread over
  86 reducers while the rest of the dimension moves once. Keys are unique, so every fact row still meets
  exactly one dimension row: no pair explosion, no row lost. AQE's skew-join splitting stays on as well.

The fact table is never collected or sampled.
"""

from __future__ import annotations

import logging
import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024


class DuplicateKeyError(ValueError):
    """A lookup table holds more than one row for a key."""


@dataclass(frozen=True)
class DimensionProfile:
    rows: int
    max_rows_per_key: int
    size_bytes: int

    def broadcastable(self, max_bytes: int) -> bool:
        return self.size_bytes <= max_bytes


EMPTY_PROFILE = DimensionProfile(0, 0, 0)


def broadcast_max_bytes(spark) -> int:
    return int(spark.conf.get("spark.cadastro.broadcastMaxBytes", str(DEFAULT_BROADCAST_MAX_BYTES)))


# Upper bound of what a broadcast hash table adds to a row: pointer array slots (16 bytes at half load,
# doubled while growing), the key copied beside the row, lengths and alignment.
HASH_ROW_BYTES = 96


def row_bytes(df: DataFrame) -> F.Column:
    """Upper bound of the bytes a row of ``df`` takes in a broadcast hash table: a null-bit word per 64
    columns, 8 bytes per column whether null or not, all variable-length data (padded to 8), the hash
    table's own share. Nested columns count by their JSON text, 8 bytes per character."""
    fixed = 8 * len(df.columns) + 8 * -(-len(df.columns) // 64) + HASH_ROW_BYTES
    total = F.lit(fixed).cast("long")
    for field in df.schema.fields:
        kind, c = field.dataType.typeName(), F.col("`" + field.name.replace("`", "``") + "`")
        if kind in ("string", "varchar", "char", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif kind == "decimal":
            total = total + 16
        elif kind in ("array", "map", "struct", "variant"):
            total = total + 8 * F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 64
    return total


def profile_dimensions(dims: Mapping[str, tuple[DataFrame, str]]) -> dict[str, DimensionProfile]:
    """Profile several lookup tables in one job: ``{name: (dimension_df, key_column)}``.

    The result that reaches the driver has one row per dimension.
    """
    if not dims:
        return {}
    # Dimensions whose profiling projection is the same plan (the same code table under other column
    # names, as in a star of codebooks cut from one source) are profiled once.
    groups: list[tuple[str, DataFrame, list[str]]] = []
    for name, (df, key) in dims.items():
        proj = df.select(F.col(key).cast("string").alias("k"), row_bytes(df).alias("b"))
        digest = proj.semanticHash()
        for rep_name, rep, members in groups:
            if rep.semanticHash() == digest and rep.sameSemantics(proj):
                members.append(name)
                break
        else:
            groups.append((name, proj, [name]))
    parts = [proj.select(F.lit(rep_name).alias("dim"), "k", "b") for rep_name, proj, _ in groups]
    rows = reduce(DataFrame.unionByName, parts)
    per_key = rows.groupBy("dim", "k").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"))
    summary = per_key.groupBy("dim").agg(
        F.sum("n").alias("rows"),
        F.max(F.when(F.col("k").isNotNull(), F.col("n"))).alias("max_n"),
        F.sum("b").alias("bytes"),
    )
    by_rep = {r["dim"]: DimensionProfile(int(r["rows"] or 0), int(r["max_n"] or 0), int(r["bytes"] or 0))
              for r in summary.collect()}
    return {name: by_rep.get(rep_name, EMPTY_PROFILE) for rep_name, _, members in groups for name in members}


def broadcast_within_bound(sides: Mapping[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """The sides ``{name: (df, key_column)}`` of plain joins, marked for a broadcast where its size is within the bound.

    For joins whose keys may repeat, which a checked lookup rejects: the rows are the same either way.
    """
    profiles = profile_dimensions(sides)
    return {name: F.broadcast(df) if profiles[name].broadcastable(broadcast_max_bytes(df.sparkSession)) else df
            for name, (df, _) in sides.items()}


def _check_unique(name: str, profile: DimensionProfile) -> None:
    if profile.max_rows_per_key > 1:
        raise DuplicateKeyError(
            f"lookup {name!r} has {profile.max_rows_per_key} rows for one key; joining would multiply rows"
        )


STRATEGIES = ("auto", "broadcast", "shuffle", "salted")


class BroadcastBoundError(ValueError):
    """A broadcast was asked for a lookup side above the broadcast bound."""


def _choose(dim: DataFrame, profile: DimensionProfile | None, strategy: str) -> str:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    bound = broadcast_max_bytes(dim.sparkSession)
    if strategy == "broadcast" and (profile is None or not profile.broadcastable(bound)):
        raise BroadcastBoundError(f"lookup side of {profile and profile.size_bytes} bytes is over the bound of {bound}")
    if strategy != "auto":
        return strategy
    if profile is not None and profile.broadcastable(bound):
        return "broadcast"
    log.info("lookup side of %s bytes is over the broadcast bound; using a salted shuffle join",
             profile and profile.size_bytes)
    return "salted"


# A key with more than 1/HOT_SHARE of the fact rows is salted, over one bucket per such share.
HOT_SHARE = 256


def hot_keys(fact: DataFrame, key: str, share: int = HOT_SHARE) -> dict:
    """``{key value: buckets}`` of the keys that hold more than ``1/share`` of the rows: fewer than
    ``share`` of them, whatever the data. Reads the key column only, with a partial aggregate."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = fact.count()
    heavy = counts.where(F.col("n") * share > F.lit(total)).collect() if total else []
    return {r[key]: -(-r["n"] * share // total) for r in heavy}


def salted_join(fact: DataFrame, dim: DataFrame, key: str, how: str, hot: dict | None = None) -> DataFrame:
    """Shuffle join on ``(key, salt)``: rows of hot keys get a salt, and their ``dim`` row is replicated.

    ``hot`` maps a key to its number of salts (:func:`hot_keys`, measured when not given; a streaming fact
    cannot be measured and is joined unsalted). The salt is a hash of the whole row modulo the key's
    buckets: it depends on the row's content only, never on row order, so a map task recomputed after an
    executor loss sends every row to the same reducer as before and shuffle retries stay exact. Copies of
    one row hash to one salt; AQE's skew-join split, which cuts a partition by map blocks, spreads those.
    Null keys keep their row in a left join and never match, as without salting.
    """
    if hot is None:
        hot = {} if fact.isStreaming else hot_keys(fact, key)
    if not hot:
        return fact.join(dim, key, how)
    salt = "_cadastro_salt"
    buckets = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    of = lambda c: F.coalesce(F.try_element_at(buckets, c), F.lit(1))
    as_type = dict(fact.dtypes)[key]
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), of(F.col(key)))
    salted_fact = fact.withColumn(salt, F.when(F.col(key).isNull(), F.lit(0)).otherwise(spread).cast("long"))
    replicated = dim.withColumn(salt, F.explode(F.sequence(
        F.lit(0).cast("long"), F.coalesce(of(F.col(key).cast(as_type)), F.lit(1)).cast("long") - 1)))
    return salted_fact.join(replicated, [key, salt], how).drop(salt)


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    *,
    check_unique: bool = True,
    strategy: str = "auto",
    profile: DimensionProfile | None = None,
    name: str | None = None,
) -> DataFrame:
    """Equi-join ``fact`` with a lookup table on the same-named column ``key`` (key kept once).

    Null keys never match: ``how='left'`` keeps such rows with null labels, ``how='inner'`` drops them.
    """
    if how not in ("left", "inner"):
        raise ValueError("lookup joins are 'left' or 'inner'")
    if profile is None and (check_unique or strategy in ("auto", "broadcast")):
        profile = profile_dimensions({name or key: (dim, key)})[name or key]
    if check_unique and profile is not None:
        _check_unique(name or key, profile)
    chosen = _choose(dim, profile, strategy)
    if chosen == "salted":
        if not check_unique:
            raise ValueError("a salted lookup needs unique dimension keys; keep check_unique=True")
        return salted_join(fact, dim, key, how)
    return fact.join(F.broadcast(dim) if chosen == "broadcast" else dim, key, how)


def left_lookup(fact: DataFrame, dim: DataFrame, key: str, **kw) -> DataFrame:
    return lookup(fact, dim, key, "left", **kw)


def inner_lookup(fact: DataFrame, dim: DataFrame, key: str, **kw) -> DataFrame:
    return lookup(fact, dim, key, "inner", **kw)


def unmatched(fact: DataFrame, dim: DataFrame, key: str, strategy: str = "auto", profile=None) -> DataFrame:
    """Fact rows an inner lookup would drop (null or unknown key), as a lazy ``left_anti`` join."""
    keys = dim.select(key)
    if profile is None and strategy in ("auto", "broadcast"):
        profile = profile_dimensions({key: (keys, key)})[key]
    chosen = _choose(keys, profile, strategy)
    if chosen == "salted":
        return salted_join(fact, keys, key, "left_anti")
    return fact.join(F.broadcast(keys) if chosen == "broadcast" else keys, key, "left_anti")


def with_role(dim: DataFrame, suffix: str) -> DataFrame:
    """Role-playing copy of a dimension: every column renamed ``<col><suffix>``."""
    return dim.select([F.col(c).alias(c + suffix) for c in dim.columns])


def role_lookup(fact: DataFrame, dim: DataFrame, key: str, suffix: str, how: str = "left", **kw) -> DataFrame:
    """Join a second copy of ``dim`` whose columns carry ``suffix``; ``key`` is the dimension's key name."""
    return lookup(fact, with_role(dim, suffix), key + suffix, how, **kw)


def star_lookup(
    fact: DataFrame,
    codebooks: Mapping[str, DataFrame | None],
    *,
    keep: Iterable[str] | None = None,
    key_prefix: str = "cod_",
    drop_key: bool = True,
    missing: str = "null",
    check_unique: bool = True,
    strategy: str = "auto",
) -> DataFrame:
    """Replace coded columns by labels from one codebook each: codebook ``name`` has ``(cod_name, name)``.

    Only the labels in ``keep`` are joined (all when ``None``): a left join against a unique key
    cannot change the row count, so an unrequested label is pruned at plan time. A requested
    codebook that is absent gives a null label with a warning (``missing='null'``) or raises
    (``missing='error'``). All codebooks are profiled in a single job.
    """
    wanted = list(codebooks) if keep is None else [n for n in keep]
    present = {n: codebooks[n] for n in wanted if codebooks.get(n) is not None}
    absent = [n for n in wanted if codebooks.get(n) is None]
    if absent and missing == "error":
        raise KeyError(f"codebooks not available: {absent}")
    profiles = profile_dimensions({n: (df, key_prefix + n) for n, df in present.items()}) if (check_unique or strategy in ("auto", "broadcast")) else {}
    out = fact
    for name in wanted:
        key = key_prefix + name
        if name in present:
            out = lookup(out, present[name], key, "left", check_unique=check_unique, strategy=strategy,
                         profile=profiles.get(name), name=name)
        else:
            warnings.warn(f"codebook {name!r} missing; label column is null", stacklevel=2)
            out = out.withColumn(name, F.lit(None).cast("string"))
        if drop_key and key in out.columns:
            out = out.drop(key)
    return out
