"""Table specs, the consolidation plans built from them, and the multi-table runs."""

from .spec import Lookup, TableSpec, consolidate

__all__ = ["Lookup", "TableSpec", "consolidate"]
