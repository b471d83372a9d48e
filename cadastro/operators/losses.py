"""What a consolidation loses, counted in the write itself.

Typing turns values that do not parse to null, an inner lookup drops rows with an unknown code, a left lookup
leaves such codes without a label. :class:`Losses` counts all three with ``DataFrame.observe``: the counts
are gathered by the tasks that write the table, so the raw data is scanned once and nothing is joined twice.

A table without a shuffle (every plan of this library below the broadcast bound) is counted exactly: a
retried task replaces its counts. Where a salted join shuffles rows after a count, a recomputed map stage may
count again; :func:`cadastro.operators.unmatched` is the exact second way.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .cleaning import clean_types
from .lookups import lookup

SCHEMA = "table_name string, step string, column_name string, lost long, seen long"
# Kinds that can turn a value to null, with what counts as no value at all.
_DATES = ("date", "month")
_LOSSLESS = ("text", "str")


def has_value(raw: Column, kind: str) -> Column:
    """Whether a raw text holds a value of the kind: not null, not blank, and for dates not all zeros."""
    filled = raw.isNotNull() & (F.trim(raw) != "")
    return filled & ~raw.rlike("^[0 ]*$") if kind in _DATES else filled


class Losses:
    """Counts of one table; read with :meth:`rows` once the table has been written."""

    def __init__(self, table: str):
        self.table = table
        self._observed: list[tuple[Observation, dict[str, tuple[str, str]]]] = []

    def _observe(self, df: DataFrame, counts: Mapping[tuple[str, str], Column]) -> DataFrame:
        seen = Observation()
        named = {f"lost{i}": key for i, key in enumerate(counts)}
        self._observed.append((seen, named))
        return df.observe(seen, F.count(F.lit(1)).alias("seen"), *[F.count_if(counts[key]).alias(n) for n, key in named.items()])

    def typing(self, raw: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
        """``clean_types(kinds)`` of ``raw``, counting per column the values that became null."""
        watched = {c: f"_raw{i}" for i, (c, k) in enumerate(kinds.items()) if k not in _LOSSLESS}
        if not watched:
            return raw.transform(clean_types(kinds))
        typed = raw.withColumns({copy: F.col(c) for c, copy in watched.items()}).transform(clean_types(kinds))
        # Null first: the raw text is looked at only where typing left nothing.
        counts = {("typing", c): F.col(c).isNull() & has_value(F.col(copy), kinds[c]) for c, copy in watched.items()}
        return self._observe(typed, counts).drop(*watched.values())

    def lookup(self, fact: DataFrame, dim: DataFrame, key: str, how: str = "left", **options) -> DataFrame:
        """:func:`cadastro.operators.lookup`, counting the rows an inner one drops, or the codes a left one
        leaves without a label. An inner lookup runs as a left one and a filter, with the same rows."""
        hit = "_cadastro_hit"
        joined = lookup(fact, dim.withColumn(hit, F.lit(True)), key, "left", **options)
        lost = F.col(hit).isNull() if how == "inner" else F.col(hit).isNull() & F.col(key).isNotNull()
        seen = self._observe(joined, {(f"{how} lookup", key): lost})
        return (seen.where(F.col(hit).isNotNull()) if how == "inner" else seen).drop(hit)

    def rows(self) -> list[tuple[str, str, str, int, int]]:
        """(table_name, step, column_name, lost, seen) in plan order; waits for the table's first action."""
        out = []
        for seen, named in self._observed:
            values = seen.get
            out += [(self.table, step, column, values[n], values["seen"]) for n, (step, column) in named.items()]
        return out


def report(spark: SparkSession, losses: list[Losses]) -> DataFrame:
    """The counts of written tables as a frame: table_name, step, column_name, lost, seen."""
    return spark.createDataFrame([row for table in losses for row in table.rows()], SCHEMA)
