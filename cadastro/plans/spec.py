"""Declarative table specs and the one function that consolidates a raw frame by its spec.

A spec says *what* a table needs (raw layout, column kinds, derived columns, lookups, output order);
:func:`consolidate` turns it into one Spark plan: a projection for typing, a projection per rule stage,
one checked lookup join per requested label, and the final ordered ``select``. It is a pure
``DataFrame -> DataFrame`` function, so it runs unchanged on a streaming frame (projections and
stream-static broadcast joins are stateless).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from ..operators.cleaning import clean_types
from ..operators.lookups import lookup, profile_dimensions, with_role
from ..operators.losses import Losses

Rule = Callable[[], Column]


@dataclass(frozen=True)
class Lookup:
    """Join the lookup table ``dimension`` on ``key`` (the fact column name after typing).

    ``suffix`` makes a role-playing copy: the dimension's columns are renamed ``<col><suffix>`` and the
    key is expected as ``<dimension key><suffix>`` in the fact table.
    """

    dimension: str
    key: str
    how: str = "left"
    suffix: str = ""


@dataclass(frozen=True)
class TableSpec:
    name: str
    raw_columns: tuple[str, ...]
    kinds: Mapping[str, str] = field(default_factory=dict)
    rules: tuple[Mapping[str, Rule], ...] = ()
    lookups: tuple[Lookup, ...] = ()
    output: tuple[str, ...] = ()
    source_glob: str = ""
    optional_output: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def output_columns(self, *options: str) -> list[str]:
        cols = list(self.output or self.raw_columns)
        for opt in options:
            cols += list(self.optional_output.get(opt, ()))
        return cols


def _dimension_for(spec_lookup: Lookup, dims: Mapping[str, DataFrame]) -> DataFrame:
    if spec_lookup.dimension not in dims:
        raise KeyError(f"lookup table {spec_lookup.dimension!r} not supplied")
    dim = dims[spec_lookup.dimension]
    return with_role(dim, spec_lookup.suffix) if spec_lookup.suffix else dim


def consolidate(
    raw: DataFrame,
    spec: TableSpec,
    dims: Mapping[str, DataFrame] | None = None,
    *,
    options: tuple[str, ...] = (),
    how_overrides: Mapping[str, str] | None = None,
    kind_overrides: Mapping[str, str] | None = None,
    check_unique: bool = True,
    strategy: str = "auto",
    losses: Losses | None = None,
) -> DataFrame:
    """Raw string frame -> consolidated table per ``spec``.

    ``dims`` maps lookup names to frames. ``options`` switches on optional output columns
    (e.g. ``("full_id",)``). ``how_overrides`` changes a lookup's join type by dimension name
    (e.g. ``{"mun": "left"}`` to keep establishments with an unknown municipality). ``kind_overrides``
    changes a column's kind (e.g. ``{"capital_social": "decimal_comma"}`` for exact cents). ``losses``
    counts, while the table is written, what typing and the lookups lose.
    """
    dims = dims or {}
    kinds = {**spec.kinds, **(kind_overrides or {})}
    out = losses.typing(raw, kinds) if losses else raw.transform(clean_types(kinds))
    for stage in spec.rules:
        out = out.withColumns({c: rule() for c, rule in stage.items()})

    wanted = set(spec.output_columns(*options))
    needed = []
    for lk in spec.lookups:
        how = (how_overrides or {}).get(lk.dimension, lk.how)
        dim = _dimension_for(lk, dims)
        labels = [c for c in dim.columns if c != lk.key]
        # Lookup pruning: a left join on a unique key cannot change the rows, so one whose labels are
        # not in the output is skipped. An inner join filters rows and is always kept.
        if how == "inner" or any(c in wanted for c in labels):
            needed.append((lk, dim, how))
    # one profile per base dimension: a role-playing copy has the same rows, bytes and key multiplicity
    base = {lk.dimension: (dims[lk.dimension], lk.key.removesuffix(lk.suffix) if lk.suffix else lk.key)
            for lk, _, _ in needed}
    profiles = profile_dimensions(base) if needed and (check_unique or strategy in ("auto", "broadcast")) else {}
    for lk, dim, how in needed:
        name = f"{lk.dimension}{lk.suffix}"
        join = losses.lookup if losses else lookup
        out = join(out, dim, lk.key, how, check_unique=check_unique, strategy=strategy,
                   profile=profiles.get(lk.dimension), name=name)
    return out.select(*spec.output_columns(*options))
