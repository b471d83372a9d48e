"""DataFrame -> DataFrame operators (use with ``df.transform``) and the ingestion jobs."""

from .cleaning import KINDS, clean_types, columns_by_rule, kinds_by_rule
from .lookups import (
    DimensionProfile,
    DuplicateKeyError,
    inner_lookup,
    left_lookup,
    lookup,
    profile_dimensions,
    role_lookup,
    salted_join,
    star_lookup,
    unmatched,
    with_role,
)
from .losses import Losses
from .rename import missing_columns, rename_map

__all__ = [
    "KINDS", "DimensionProfile", "DuplicateKeyError", "Losses", "clean_types", "columns_by_rule", "inner_lookup",
    "kinds_by_rule", "left_lookup", "lookup", "missing_columns", "profile_dimensions", "rename_map",
    "role_lookup", "salted_join", "star_lookup", "unmatched", "with_role",
]
