"""Rename by map, tolerant of accent encoding and case in source headers."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

from pyspark.sql import DataFrame


def _norm(name: str) -> str:
    """NFC, no byte-order mark (a UTF-8 file starting with one puts it in the first header), trimmed, lower."""
    return unicodedata.normalize("NFC", name).replace("\ufeff", "").strip().lower()


def rename_map(mapping: Mapping[str, str], strict: bool = False):
    """Return a ``DataFrame -> DataFrame`` applying ``old -> new`` renames in one projection.

    Header names are matched after NFC normalisation, byte-order-mark removal and case folding, so
    ``'Competência'`` written in decomposed form, or first in a file with a BOM, still matches
    ``'competência'``. A source column that is absent is skipped (as a plain ``withColumnRenamed``
    does) unless ``strict=True``, which raises listing the missing names.
    """

    def _apply(df: DataFrame) -> DataFrame:
        actual = {_norm(c): c for c in df.columns}
        resolved, missing = {}, []
        for old, new in mapping.items():
            src = actual.get(_norm(old))
            if src is None:
                missing.append(old)
            elif src != new:
                resolved[src] = new
        if missing and strict:
            raise ValueError(f"columns not found for rename: {missing}; header has {df.columns}")
        return df.withColumnsRenamed(resolved) if resolved else df

    return _apply


def missing_columns(df: DataFrame, names) -> list[str]:
    """Names (compared as in :func:`rename_map`) that the frame does not have."""
    actual = {_norm(c) for c in df.columns}
    return [n for n in names if _norm(n) not in actual]
