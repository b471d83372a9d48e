"""Whole-source runs: read raw dumps, consolidate every table in dependency order, write the outputs.

Directory model: ``<root>/data/raw/<source>`` for dumps and ``<root>/data/trusted/<source>`` for tables;
any Hadoop URI works. The company register runs its lookups first; the later tables join
the lookups of the same run.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.losses import Losses, report
from ..session import delete_path, list_folders, path_exists, read_text, replace_text, scratch_path
from ..sources import read_codebook, read_headered, read_lookup_set, read_positional, stage, write_table
from . import company_register as cr
from . import labour_flows as lf
from .spec import consolidate

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    root: str

    def raw(self, source: str) -> str:
        return f"{self.root.rstrip('/')}/data/raw/{source}"

    def trusted(self, source: str) -> str:
        return f"{self.root.rstrip('/')}/data/trusted/{source}"


COMPANY_TABLES = ("lookups", "simples", "socios", "empresas", "estab")
# lookups each company table needs (by lookup name)
COMPANY_NEEDS = {"simples": (), "socios": ("qual_socio", "pais"), "empresas": ("natju", "qual_socio"),
                 "estab": ("mun", "pais")}


def run_company_register(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    *,
    tables: Iterable[str] = COMPANY_TABLES,
    mode: str = "error",
    fmt: str | None = None,
    n_partitions: int | None = None,
    staged: bool = False,
    with_full_id: bool = False,
    keep_unknown_municipality: bool = False,
    kind_overrides: Mapping[str, str] | None = None,
    strategy: str = "auto",
    report_losses: bool = False,
    **write_options,
) -> dict[str, str]:
    """Consolidate the company register; returns ``{table name: output path}``.

    ``staged=True`` first rewrites each raw dump as parquet below the shared checkpoint folder (one
    fresh folder per run) and drops it when the run ends, well or not. ``kind_overrides`` and ``strategy``
    go to :func:`consolidate`; further options to :func:`write_table`. Tables join the lookups of this
    run; a run without the ``lookups`` step reads those an earlier run wrote. ``mode="append"`` adds a
    run's rows to every table, lookups included. ``report_losses`` adds a table ``df_losses``: the values that
    typing and the rows or labels that lookups lost in each table, counted while it was written.
    """
    tables = list(tables)
    written: dict[str, str] = {}

    def out(df: DataFrame, name: str):
        path = f"{out_dir.rstrip('/')}/{name}"
        write_table(df, path, mode=mode, fmt=fmt, n_partitions=n_partitions, **write_options)
        written[name] = path

    # The run's own lookups: what an earlier run wrote may be appended to, or older.
    dims: dict[str, DataFrame] = {}
    if "lookups" in tables:
        for name, raw in read_lookup_set(spark, raw_dir, cr.LOOKUP_IDS).items():
            dims[name] = cr.consolidate_lookup(raw, name)
            out(dims[name], f"df_{name}")

    def dim(name: str) -> DataFrame:
        if name not in dims:
            dims[name] = spark.read.format(fmt or "parquet").load(f"{out_dir.rstrip('/')}/df_{name}")
        return dims[name]

    run_root = scratch_path(spark, "staging") if staged else None
    counted: list[Losses] = []
    try:
        for key in ("simples", "socios", "empresas", "estab"):
            if key not in tables:
                continue
            spec = cr.TABLES[key]
            raw = read_positional(spark, f"{raw_dir.rstrip('/')}/{spec.source_glob}", spec.raw_columns)
            if staged:
                raw = stage(raw, spec.name, root=run_root).read()
            options = ("full_id",) if (key == "estab" and with_full_id) else ()
            overrides = {"mun": "left"} if (key == "estab" and keep_unknown_municipality) else None
            kinds = {c: k for c, k in (kind_overrides or {}).items() if c in spec.raw_columns}
            # A table that mode "ignore" leaves as it is runs no job, so it has no counts.
            kept = mode == "ignore" and path_exists(spark, f"{out_dir.rstrip('/')}/{spec.name}")
            losses = Losses(spec.name) if report_losses and not kept else None
            out(consolidate(raw, spec, {n: dim(n) for n in COMPANY_NEEDS[key]}, options=options, how_overrides=overrides,
                            kind_overrides=kinds, strategy=strategy, losses=losses), spec.name)
            counted += [losses] if losses else []
        if report_losses:
            out(report(spark, counted), "df_losses")
    finally:
        if run_root is not None:
            delete_path(spark, run_root)
    return written


# The file below a published folder that names its current version.
CURRENT = "_CURRENT"


def publish_company_register(spark: SparkSession, raw_dir: str, out_dir: str, *, keep: int = 2, **options) -> str:
    """A run of :func:`run_company_register` that becomes visible as a whole, or not at all.

    The run writes a new folder ``<out_dir>/version=<id>``; when every table of it is written, the small file
    ``<out_dir>/_CURRENT`` is replaced by one that names it. Readers (:func:`read_published`) follow that file, so
    they see the old tables until the new ones are all there; a run that fails leaves the old ones current and
    removes its own folder. The ``keep`` newest versions stay, for readers that have opened an older one.
    Returns the version's id. Runs into one folder must not overlap.
    """
    version = f"{time.time_ns():020d}"
    folder = f"{out_dir.rstrip('/')}/version={version}"
    try:
        written = run_company_register(spark, raw_dir, folder, mode="error", **options)
    except BaseException:
        delete_path(spark, folder)
        raise
    replace_text(spark, f"{out_dir.rstrip('/')}/{CURRENT}", "\n".join([version, *sorted(written)]))
    for old in sorted(v for v in list_folders(spark, out_dir) if v.startswith("version="))[:-keep]:
        delete_path(spark, f"{out_dir.rstrip('/')}/{old}")
    return version


def read_published(spark: SparkSession, out_dir: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A table of the current version of a folder that :func:`publish_company_register` writes."""
    version, *tables = read_text(spark, f"{out_dir.rstrip('/')}/{CURRENT}").split("\n")
    if table not in tables:
        raise KeyError(f"{table!r} is not in version {version}: {tables}")
    return spark.read.format(fmt).load(f"{out_dir.rstrip('/')}/version={version}/{table}")


def read_codebooks(spark: SparkSession, level_dir: str, level: str, strict: bool = False) -> dict[str, DataFrame | None]:
    """Codebooks of a level from ``<level_dir>/aux_tables/<name>.csv``; a missing file maps to ``None``."""
    books: dict[str, DataFrame | None] = {}
    for name in lf.codebook_names(level):
        path = f"{level_dir.rstrip('/')}/aux_tables/{name}.csv"
        if path_exists(spark, path):
            books[name] = lf.prepare_codebook(read_codebook(spark, path), name)
        elif strict:
            raise FileNotFoundError(path)
        else:
            log.warning("codebook %s missing at %s", name, path)
            books[name] = None
    return books


def run_labour_flows(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    *,
    levels: Iterable[str] = ("mov", "estab"),
    mode: str = "error",
    fmt: str | None = None,
    n_partitions: int | None = None,
    partition_by: str | None = None,
    strict_codebooks: bool = False,
    salary_decimal_comma: bool = False,
    keep_rest: bool = False,
    key_as_int: bool = False,
    strategy: str = "auto",
    **write_options,
) -> dict[str, str]:
    """Consolidate the labour-flow levels found in ``<raw_dir>/<level>/*.txt``.

    ``salary_decimal_comma``, ``keep_rest``, ``key_as_int`` and ``strategy`` go to :func:`consolidate_flows`,
    further options (``rebalance``, ``max_records_per_file``, format options) to :func:`write_table`.
    """
    written = {}
    for level in levels:
        level_dir = f"{raw_dir.rstrip('/')}/{level}"
        raw = read_headered(spark, f"{level_dir}/*.txt", expected=list(lf.RENAMES[level]))
        books = read_codebooks(spark, level_dir, level, strict=strict_codebooks)
        df = lf.consolidate_flows(raw, level, books, missing="error" if strict_codebooks else "null", keep_rest=keep_rest,
                                  salary_decimal_comma=salary_decimal_comma, key_as_int=key_as_int, strategy=strategy)
        path = f"{out_dir.rstrip('/')}/{lf.OUTPUT_NAMES[level]}"
        write_table(df, path, mode=mode, fmt=fmt, partition_by=partition_by, n_partitions=n_partitions, **write_options)
        written[lf.OUTPUT_NAMES[level]] = path
    return written
